"""Inputs of the registered queries, each a projection of one whole test table.

``oracles.py`` states the same inputs in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DUMP_FILE = "concat('data/beacons/fx/', lpad(cast(o_custkey % 24 as string), 4, '0'), '_beacon.txt')"

RECORDS = [
    f"{DUMP_FILE} AS source_file",
    """CASE o_custkey % 4 WHEN 1 THEN 'http://t.example/{ID}' WHEN 2 THEN 'http://t.example/x'
       WHEN 3 THEN 'http://t.example/y/' END AS TARGET""",
    "concat('src', o_custkey % 24) AS NAME",
    "CASE WHEN o_custkey % 3 <> 0 THEN concat('http://feed.example/', o_custkey % 24) END AS FEED",
    "cast(NULL AS string) AS TIMESTAMP",
    """CASE WHEN o_orderkey % 50 = 0 THEN concat('https://d-nb.info/gnd/', o_orderkey % 2500)
            WHEN o_orderkey % 7 = 0 THEN concat('(DE-588)', o_orderkey % 2500)
            WHEN o_orderkey % 9 = 0 THEN cast(100000 + o_orderkey % 2500 AS string)
            ELSE cast(o_orderkey % 2500 AS string) END AS col1""",
    """CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN ''
            ELSE concat('http://l.example/a/', o_orderkey) END AS col2""",
    """CASE WHEN o_orderkey % 3 < 2 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'http://l.example/i/'
            ELSE concat('http://l.example/i/', o_orderkey) END AS col3""",
    "cast(NULL AS string) AS col4",
    "cast(NULL AS string) AS col5",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One link dump per document: a header, the sentences of the text, a late # line."""
    target = """CASE WHEN doc_id % 4 = 0 THEN '#target:'
        WHEN doc_id % 2 = 0 THEN concat('#target: http://d.example/', doc_id, '/{ID}')
        ELSE concat('#target: http://d.example/', doc_id) END"""
    content = f"""array_join(filter(array('#FORMAT: BEACON', {target}, '# ',
        concat('#NAME: ', source), CASE WHEN doc_id % 5 = 0 THEN concat('#NAME: ', lang) END,
        replace(text, '. ', chr(10)), '#late: x'), x -> x IS NOT NULL), chr(10))"""
    documents = table(spark, sf_dir, "documents")
    return documents.selectExpr(
        "concat('data/beacons/docs/', doc_id) AS source_file",
        f"posexplode(split({content}, chr(10), -1)) AS (ord, line)",
    ).withColumn("ord", F.col("ord").cast("bigint"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order, from 24 dumps, in every slice."""
    return table(spark, sf_dir, "orders").selectExpr(*RECORDS)


def sparse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of which some lack their first field, which parsed ones never do."""
    return records(spark, sf_dir).withColumn(
        "col1", F.when(~F.col("NAME").isin("src5", "src6", "src7"), F.col("col1"))
    )


def harvest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metadata row per page; every sixth dump has none."""
    return table(spark, sf_dir, "pages").selectExpr(
        "url",
        """concat('data/beacons/', CASE WHEN page_id % 6 = 5 THEN 'gone/' ELSE 'fx/' END,
                  lpad(cast(page_id AS string), 4, '0'), '_beacon.txt') AS path""",
        "'2025-01-01T00:00:00+00:00' AS download_time_utc",
    )


def authority_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One authority entry per part, with current and old ids."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('https://d-nb.info/gnd/', p_partkey) AS id",
        """CASE p_partkey % 8 WHEN 0 THEN array('Person', 'AuthorityResource')
            WHEN 1 THEN array('Work', 'Person') WHEN 2 THEN array('CorporateBody')
            WHEN 3 THEN array('SubjectHeading') WHEN 4 THEN array('PlaceOrGeographicName')
            WHEN 5 THEN array('Family') WHEN 6 THEN array('AuthorityResource') END AS type""",
        """CASE WHEN p_partkey % 13 = 0 THEN array(concat('(DE-588)', p_partkey + 1))
            WHEN p_partkey % 3 = 0 THEN array(concat('(DE-588)', 100000 + p_partkey),
                                              concat('(DE-588a)', 200000 + p_partkey))
            END AS oldAuthorityNumber""",
    )


def source_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source list with the pages' URLs, some entries without one."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id AS list_index",
        """CASE WHEN page_id % 17 = 5 THEN NULL WHEN page_id % 17 = 6 THEN ''
            ELSE url END AS beacon_url""",
    )


def short_source_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source list whose safe prefixes are ``ex<n>_``, NULL or empty."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        """CASE WHEN page_id % 17 = 5 THEN NULL WHEN page_id % 17 = 6 THEN '://'
            ELSE concat('ex', page_id) END AS beacon_url""",
    )


def sliced_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slice and dump of every order."""
    return table(spark, sf_dir, "orders").selectExpr(
        """CASE WHEN o_custkey % 24 < 8 AND o_orderkey % 2 = 0 THEN 'target-null'
            ELSE 'target-notnull' END AS slice""",
        """concat('data/beacons/fx/', lpad(cast(o_custkey % 24 AS string), 4, '0'), '_ex',
                  o_custkey % 24, '_beacon.txt') AS source_file""",
    )


def records_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a run id: the year of the order."""
    return table(spark, sf_dir, "orders").selectExpr(
        *RECORDS, "date_format(o_orderdate, 'yyyy') AS run_id"
    )


def dump_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an authority dump, of which some are cut off, some no object, some of other types."""
    return table(spark, sf_dir, "part").selectExpr(
        """CASE WHEN p_partkey % 17 = 0 THEN concat('{"id": "https://d-nb.info/gnd/', p_partkey)
            WHEN p_partkey % 19 = 0 THEN concat('{"id": "', p_partkey, '", "type": "Person"}')
            WHEN p_partkey % 23 = 0 THEN concat('part ', p_partkey)
            WHEN p_partkey % 29 = 0 THEN ' '
            ELSE concat('{"id": "https://d-nb.info/gnd/', p_partkey, '", "type": ["Work", "Person"], "more": 1, ',
                        '"oldAuthorityNumber": ["(DE-588)', 100000 + p_partkey, '"]}') END AS line"""
    )

"""Hot keys known before the join: the result stays, and no task gets a hot key whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linkloom.operators.authority import attach_types, hot_ids
from linkloom.operators.hot_keys import hot_keys


@pytest.fixture
def records(spark):
    """Half of all records carry one id, in two forms; a quarter has none."""
    return spark.range(0, 40_000, 1, 8).selectExpr(
        "id AS n",
        """CASE WHEN id % 4 = 0 THEN '77' WHEN id % 4 = 1 THEN '(DE-588)77' WHEN id % 4 = 2 THEN NULL
           ELSE cast(id AS string) END AS authority_id""",
    )


@pytest.fixture
def types(spark):
    return spark.range(0, 40_000, 3, 8).selectExpr(
        "cast(id AS string) AS gnd", "'Work' AS gnd_type", "array('Work') AS gnd_type_list"
    ).union(spark.createDataFrame([("77", "Person", ["Person"])], "gnd string, gnd_type string, gnd_type_list array<string>"))


def largest_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).head()[0]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_ids_are_dealt_with_and_without_adaptive_execution(spark, settings, records, types, adaptive):
    settings(
        spark__sql__adaptive__enabled=adaptive,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="32",
    )
    hot = hot_ids(records)
    assert hot == ["77"]
    split, plain = attach_types(records, types, hot), attach_types(records, types)
    assert split.columns == plain.columns
    assert split.exceptAll(plain).count() == 0 and split.count() == plain.count() == 40_000
    assert split.where("gnd_type = 'Person'").count() == 20_000
    if adaptive == "false":
        assert largest_task(plain) >= 20_000
        assert largest_task(split) < 6_000


def test_no_key_is_hot_in_an_even_table_or_an_empty_one(spark):
    even = spark.range(10_000).select(F.col("id").cast("string").alias("k"))
    assert hot_keys(even, F.col("k")) == []
    assert hot_keys(even.limit(0), F.col("k")) == []
    assert hot_keys(even.select(F.lit(None).cast("string").alias("k")), F.col("k")) == []


def test_every_key_above_the_share_is_found(spark):
    skewed = spark.range(30_000).selectExpr("cast(CASE WHEN id % 3 = 0 THEN id % 21 ELSE id END AS string) AS k")
    found = {r.k for r in skewed.groupBy("k").count().where("count >= 0.02 * 30000").collect()}
    assert found and set(hot_keys(skewed, F.col("k"), 0.02)) == found

"""Tables written between steps, in the folder the cluster shares for that purpose.

A staged table is computed once however often it is read, and it survives the loss of the
executors that wrote it. It also has a known size, which is what :func:`broadcast_if_small`
goes by.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.counts import PassCounts
from linkloom.operators.rejects import accepted, rejected

BROADCAST_BYTES = 64 * 1024 * 1024


def staging_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` of the session names; there is no other."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return configured.rstrip("/")


@contextmanager
def staging_area(spark: SparkSession, folder: str | None = None) -> Iterator[str]:
    """A new folder for the staged tables of one job, removed with them when the job is done.

    It lies in ``folder``, by default the one that ``spark.checkpoint.dir`` names. Frames that read them must have been written or counted by then. A job that fails leaves
    the folder behind, for a look.
    """
    area = f"{folder.rstrip('/') if folder else staging_dir(spark)}/linkloom-{uuid.uuid4().hex}"
    yield area
    path = spark._jvm.org.apache.hadoop.fs.Path(area)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(
    df: DataFrame,
    name: str,
    plain: bool = False,
    area: str | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write ``df`` to the shared folder, or the area in it, and return the written table.

    ``plain`` leaves out compression and dictionaries, for tables that may be broadcast: their
    files then tell how much memory the rows need. Compressed ones can be fifty times smaller.
    """
    spark = df.sparkSession
    path = f"{area or staging_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(
        **{
            "compression": "uncompressed" if plain else "zstd",
            "parquet.enable.dictionary": str(not plain).lower(),
        }
    ).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def split_rejects(entries: DataFrame, rejects_path: str, area: str) -> tuple[DataFrame, int]:
    """The fields of the entries, and how many lines were rejected; those are written to ``rejects_path``.

    ``entries`` come from ``json_entries``. Lines are read and parsed once: both kinds are staged, each
    in a folder of its own, and counted on the way.
    """
    fine = F.col("reason").isNull()
    passing = PassCounts()
    watched = passing.watch(entries.withColumn("fine", fine), "lines", rejected=F.count_if(~fine))
    staged = stage(watched, "entries", area=area, partition_by=["fine"])
    bad = rejected(staged.where(~F.col("fine"))).drop("fine")
    bad.write.mode("overwrite").option("ignoreNullFields", "false").json(rejects_path)
    return accepted(staged.where("fine")), passing["lines"]["rejected"]


def staged_bytes(staged: DataFrame) -> int:
    """Size of the files of a staged table."""
    files = staged.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.coalesce(F.sum("file_size"), F.lit(0)).alias("total")).head().total


def broadcast_if_small(staged: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Ask for a broadcast of a plainly staged table if its files are within ``limit``.

    Beyond the limit the table is returned as it is, and Spark joins it by a shuffle. The hash
    table of a broadcast takes four to five times the bytes of the files.
    """
    return F.broadcast(staged) if staged_bytes(staged) <= limit else staged

"""Reading of the tables, and cutting of lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share, under the one ``spark.checkpoint.dir`` names.

    Without that setting only a local session gets a folder of its own; a cluster must name one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed now and kept in the shared folder.

    Lost executors then cost no recomputation.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder, for rounds: its size is known, not estimated.

    A checkpoint keeps the estimate of its plan, and a join multiplies those of its sides: over several rounds they grow
    to numbers that take the driver longer than the tasks.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """How many partitions the session deals shuffles over."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

"""Reading and writing of tables and reports."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linkloom.fixed_values import SAMPLES_SUFFIX
from linkloom.sources.listing import literal_path


def read_tables(spark: SparkSession, *paths: str) -> DataFrame:
    """One or several Parquet files, folders or globs as one table."""
    return spark.read.parquet(*paths)


def write_table(
    df: DataFrame, path: str, compression: str = "zstd", dictionary: bool = True
) -> None:
    """Parquet, by default with zstd compression and dictionary encoding."""
    df.write.mode("overwrite").option("compression", compression).option(
        "parquet.enable.dictionary", str(dictionary).lower()
    ).parquet(path)


def write_records(df: DataFrame, path: str, run_id: str) -> None:
    """Records of one harvest run, as the partition ``run_id`` of the record table.

    The partition's own folder is overwritten, so that running it again replaces the rows of the
    run and nothing else, also with no rows: the run then reads back as empty.
    """
    folder = f"{path.rstrip('/')}/run_id={quote(run_id, safe='')}"
    df.drop("run_id").write.mode("overwrite").option("partitionOverwriteMode", "static").option(
        "compression", "zstd"
    ).parquet(folder)


def latest_stored_run(spark: SparkSession, path: str) -> str | None:
    """The greatest run id a table is stored for, by the names of its folders; no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    names = [status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory()]
    return max((unquote(name.removeprefix("run_id=")) for name in names if name.startswith("run_id=")), default=None)


def read_latest_run(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of the newest run of a table that :func:`write_records` keeps, with its id.

    ``schema`` is that of the rows without the id. Files of other runs are not listed.
    """
    run_id = latest_stored_run(spark, path)
    if run_id is None:
        return spark.createDataFrame([], schema).withColumn("run_id", F.lit(None).cast("string"))
    folder = f"{path.rstrip('/')}/run_id={quote(run_id, safe='')}"
    return spark.read.schema(schema).parquet(literal_path(folder)).withColumn("run_id", F.lit(run_id))


def write_slices(df: DataFrame, path: str, rebalance: bool = False) -> None:
    """A table with a ``slice`` column, one partition folder per slice, in a single pass.

    ``rebalance`` first shuffles rows into files of the advisory size: fewer, larger files,
    and a slice that holds most of the rows is spread over many of them.
    """
    if rebalance:
        df = df.hint("rebalance", "slice")
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option(
        "compression", "zstd"
    ).partitionBy("slice").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """JSON lines with NULL fields written out and timestamps in ISO 8601."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def samples_path(parquet_path: str, out_dir: str | None = None) -> str:
    """Where the samples of a Parquet table go: ``<stem>_samples.json``, beside it by default."""
    if not parquet_path.endswith(".parquet"):
        raise ValueError("Expected a .parquet file name")
    folder, _, name = parquet_path.rpartition("/")
    folder = out_dir.rstrip("/") if out_dir is not None else folder
    target = name.removesuffix(".parquet") + SAMPLES_SUFFIX
    return f"{folder}/{target}" if folder else target


def write_slice_samples(
    df: DataFrame, names: Sequence[str], parquet_path: str, out_dir: str | None = None
) -> dict[str, str]:
    """Sample rows of every slice under a name of its own; returns the names by slice.

    ``df`` has a ``slice`` column and few rows; it is kept while it is written slice by slice.
    """
    base = parquet_path.removesuffix(".parquet")
    written = {}
    samples = df.persist()
    try:
        for name in names:
            rows = samples.where(F.col("slice") == name)
            written[name] = write_samples(rows, f"{base}_{name}.parquet", out_dir)
    finally:
        samples.unpersist()
    return written


def write_samples(df: DataFrame, parquet_path: str, out_dir: str | None = None) -> str:
    """Write sample rows under the name derived from their table, and return that name."""
    path = samples_path(parquet_path, out_dir)
    write_report(df, path)
    return path

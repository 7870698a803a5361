"""The profile of a table that grows by files, kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.file_profiles import FILE, file_profiles, merge_profiles, profile_schema
from linkloom.sources import STATE_IN_FOLDERS, changed_files, list_files, literal_path


def update_profiles(spark: SparkSession, table_path: str, profiles_path: str) -> DataFrame:
    """Profile the files of a Parquet table that are new or altered; the profile of the whole table.

    The result is that of ``profile_columns`` for all columns, with distinct counts from sketches.
    ``profiles_path`` keeps a row per file and state; rows of files that are gone or altered stay
    there and count no more. The driver gets the paths of the files to read.
    """
    table_path = table_path.rstrip("/")
    schema = spark.read.parquet(table_path).schema
    listed = list_files(spark, table_path, folders=True)
    # The first update has nothing to read; an update without rows leaves the folder readable.
    spark.createDataFrame([], profile_schema(schema)).write.mode("append").parquet(profiles_path)
    stored = spark.read.schema(profile_schema(schema)).parquet(profiles_path)
    known = stored.select(*[F.col(f"{FILE}.{name}").alias(name) for name in STATE_IN_FOLDERS])
    changed = changed_files(listed, known, STATE_IN_FOLDERS).select("path", *STATE_IN_FOLDERS)
    rows = changed.collect()
    if rows:
        read = spark.read.schema(schema).option("basePath", table_path)
        found = file_profiles(read.parquet(*[literal_path(row.path) for row in rows]))
        # A file without rows has a profile as well, or it would be read every time.
        seen = found.select(F.col(f"{FILE}.file_path").alias("file_path"))
        listed_now = spark.createDataFrame(rows, changed.schema)
        empty = listed_now.join(seen, "file_path", "left_anti").select(
            F.struct(*STATE_IN_FOLDERS, F.lit(0).cast("bigint").alias("row_count")).alias(FILE)
        )
        found.unionByName(empty, allowMissingColumns=True).write.mode("append").parquet(profiles_path)
    stored = spark.read.schema(profile_schema(schema)).parquet(profiles_path)
    here = F.struct(*STATE_IN_FOLDERS)
    state = F.struct(*[F.col(f"{FILE}.{name}").alias(name) for name in STATE_IN_FOLDERS])
    current = stored.withColumn("__state", state).dropDuplicates(["__state"])
    current = current.join(listed.select(here.alias("__state")), "__state", "left_semi")
    return merge_profiles(current, schema)

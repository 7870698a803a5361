"""Profiles of tables that grow by files."""

from __future__ import annotations

import datetime
import os

from linkloom.operators.file_profiles import FILE
from linkloom.operators.profiling import profile_columns
from linkloom.plans import update_profiles

EXACT = ("ordinal", "column_name", "data_type", "null_count", "min_value", "max_value")


def rows(df, columns=EXACT):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def some(spark, first, last):
    return spark.range(first, last).selectExpr(
        "id AS n", "CASE WHEN id % 5 > 0 THEN cast(id AS string) END AS `a.b`", "array(id) AS l",
        "map('k', id) AS m", "CASE id % 3 WHEN 0 THEN double('NaN') ELSE -id END AS d", "id % 2 AS run",
    )


def files_profiled(spark, path):
    return spark.read.parquet(path).select(f"{FILE}.*").where("file_path is not null").count()


def test_later_files_are_added_and_equal_a_whole_profile(spark, tmp_path):
    table, profiles = str(tmp_path / "t"), str(tmp_path / "p")
    some(spark, 0, 1000).repartition(3).write.partitionBy("run").parquet(table)
    assert rows(update_profiles(spark, table, profiles)) == rows(profile_columns(spark.read.parquet(table)))
    before = files_profiled(spark, profiles)
    some(spark, 5000, 5900).coalesce(1).write.mode("append").partitionBy("run").parquet(table)
    got = update_profiles(spark, table, profiles)
    assert rows(got) == rows(profile_columns(spark.read.parquet(table)))
    assert files_profiled(spark, profiles) == before + 2
    estimate = {r.column_name: r.approx_distinct for r in got.collect()}
    assert abs(estimate["n"] - 1900) < 100 and estimate["run"] == 2 and estimate["l"] > 1800
    # Nothing new: nothing is read.
    update_profiles(spark, table, profiles)
    assert files_profiled(spark, profiles) == before + 2


def test_altered_removed_and_empty_files_and_new_columns(spark, tmp_path):
    table, profiles = str(tmp_path / "t"), str(tmp_path / "p")
    for name, df in {"a": some(spark, 0, 10), "b": some(spark, 90, 99), "c": some(spark, 0, 0)}.items():
        df.select("n", "d").coalesce(1).write.parquet(f"{table}/{name}")
    whole = spark.read.option("recursiveFileLookup", True).parquet(table)
    flat = str(tmp_path / "flat")
    whole.coalesce(1).write.parquet(flat)
    some(spark, 0, 0).select("n", "d").coalesce(1).write.mode("append").parquet(flat)
    assert rows(update_profiles(spark, flat, profiles)) == rows(profile_columns(spark.read.parquet(flat)))
    count = files_profiled(spark, profiles)
    assert count == len(spark.read.parquet(flat).inputFiles())
    update_profiles(spark, flat, profiles)
    assert files_profiled(spark, profiles) == count
    some(spark, 7, 8).select("n", "d").coalesce(1).write.mode("overwrite").parquet(flat)
    assert rows(update_profiles(spark, flat, profiles)) == rows(profile_columns(spark.read.parquet(flat)))
    file = next(p for p in (tmp_path / "flat").iterdir() if p.suffix == ".parquet")
    then = datetime.datetime(2020, 1, 1).timestamp()
    os.utime(file, (then, then))
    before = files_profiled(spark, profiles)
    update_profiles(spark, flat, profiles)
    assert files_profiled(spark, profiles) == before + 1


def test_a_table_without_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    some(spark, 0, 0).write.parquet(table)
    got = update_profiles(spark, table, str(tmp_path / "p"))
    assert rows(got) == rows(profile_columns(spark.read.parquet(table)))

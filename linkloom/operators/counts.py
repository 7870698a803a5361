"""Row counts, duplicate rows, and selection of the latest run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from linkloom.operators.joining import shuffled_anew


class PassCounts:
    """Counts taken while rows pass on their way to a sink, so that none is read again for them.

    A frame is watched under a name and used in the place of the original; once an action has
    run, the counts are there. Spark adds up what finished tasks report: a task that has to run
    again, because an executor is lost, may count twice. Treat a surprising count as a reason to count.
    """

    def __init__(self) -> None:
        self._observed: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, **measures: Column) -> DataFrame:
        """``df``, whose rows are counted as they pass; ``measures`` are further aggregates."""
        self._observed[name] = Observation(name)
        return df.observe(
            self._observed[name],
            F.count(F.lit(1)).alias("rows"),
            *[measure.alias(key) for key, measure in measures.items()],
        )

    def __getitem__(self, name: str) -> dict[str, int]:
        """The counts of a watched frame; waits for the first action that uses it."""
        return self._observed[name].get


def row_count(df: DataFrame) -> DataFrame:
    """One row: the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def compare_counts(before: DataFrame, after: DataFrame, strict: bool = False) -> DataFrame:
    """One row: rows before, rows after, difference, equality. ``strict`` fails on a mismatch.

    Both tables are counted in one aggregate, which reads no column of either.
    """
    marks = before.select(F.lit(1).alias("before"), F.lit(0).alias("after")).unionAll(
        after.select(F.lit(0).alias("before"), F.lit(1).alias("after"))
    )
    counts = marks.agg(
        F.coalesce(F.sum("before"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.coalesce(F.sum("after"), F.lit(0)).cast("bigint").alias("rows_after"),
    )
    same = F.col("rows_before") == F.col("rows_after")
    if strict:
        message = F.format_string(
            "Row count mismatch: before=%d, after=%d", F.col("rows_before"), F.col("rows_after")
        )
        same = F.when(same, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return counts.select(
        "rows_before",
        "rows_after",
        (F.col("rows_after") - F.col("rows_before")).alias("difference"),
        same.alias("same"),
    )


def analyze_table(df: DataFrame) -> DataFrame:
    """One row: rows, columns, distinct rows, surplus copies of rows.

    Copies meet in the partial aggregate, so a row that makes up much of the table is
    shuffled once per task. Rows and distinct rows come from the same pass.
    """
    per_row = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(
        F.count(F.lit(1)).alias("__copies")
    )
    counts = per_row.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_rows"),
    )
    return counts.select(
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        "distinct_rows",
        (F.col("row_count") - F.col("distinct_rows")).alias("full_row_duplicates"),
    )


def fingerprints(df: DataFrame) -> list[Column]:
    """128 bits of a row, equal for equal rows; where its NULLs are is part of them."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return [F.xxhash64(*columns), F.xxhash64(*[c.isNull() for c in columns], *reversed(columns))]


def analyze_by_fingerprint(df: DataFrame, prints: Sequence[Column] | None = None) -> DataFrame:
    """The row of :func:`analyze_table`, by way of fingerprints.

    Fingerprints are counted first, and only rows whose fingerprint occurs again are compared as a whole; rows
    that merely share one are told apart there. It pays for wide tables with few copies, at the price of a second
    scan: while the fingerprints that occur again are few enough for Spark to broadcast, no other row is
    moved whole. Beyond that whole rows are shuffled, as by ``analyze_table``. ``prints`` replaces the
    fingerprints; they decide the work, not the result.
    """
    names = ["__print1", "__print2"]
    prints = [F.lit(0)] * 2 if not df.columns else list(prints or fingerprints(df))
    marked = df.select(*[p.alias(n) for p, n in zip(prints, names, strict=True)], *[F.col(f"`{c}`") for c in df.columns])
    counted = marked.groupBy(*names).agg(F.count(F.lit(1)).alias("__copies"))
    again = shuffled_anew(counted.where("__copies > 1").select(*names))
    met = marked.join(again, names, "left_semi").groupBy(*names, *[F.col(f"`{c}`") for c in df.columns]).agg(
        F.count(F.lit(1)).alias("__copies")
    )
    alone = counted.where("__copies = 1").select("__copies").agg(F.count(F.lit(1)).alias("n"), F.sum("__copies").alias("rows"))
    shared = met.agg(F.count(F.lit(1)).alias("n"), F.sum("__copies").alias("rows"))
    counts = alone.unionAll(shared).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"), F.sum("n").alias("distinct_rows")
    )
    return counts.select(
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        "distinct_rows",
        (F.col("row_count") - F.col("distinct_rows")).alias("full_row_duplicates"),
    )


def latest_run(df: DataFrame, by: str = "run_id") -> DataFrame:
    """Rows of the run with the greatest id; a run stored as a partition is all that is read."""
    newest = df.agg(F.max(by)).scalar()
    return df.where(F.col(by) == newest)

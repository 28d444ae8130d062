"""Checks the database constraints made, as reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.schemas import Table


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL in the key."""
    return df.filter(" or ".join(f"`{k}` is null" for k in keys))


def orphans(df: DataFrame, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
    """Rows that refer to a parent that does not exist. A NULL refers to none."""
    known = parents.select(F.col(parent_column).alias("__parent"))
    return df.filter(F.col(column).isNotNull()).join(
        known, F.col(column) == F.col("__parent"), "left_anti"
    )


def too_long(df: DataFrame, table: Table) -> DataFrame:
    """Per limited column, how many values are longer than the column allows."""
    counts = [
        F.struct(
            F.lit(column).alias("column_name"), F.lit(limit).alias("max_length"),
            F.count_if(F.char_length(column) > limit).alias("n"),
        )
        for column, limit in table.limits.items()
        if column in df.columns
    ]
    return df.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def table_report(
    df: DataFrame, keys: Sequence[str], limits: Mapping[str, int] | None = None,
    references: Mapping[str, tuple[DataFrame, str]] | None = None, names: Mapping[str, str] | None = None,
) -> DataFrame:
    """(check, column_name, n): duplicate keys, rows with a NULL in the key, values without their parent and
    values that are too long, all from one scan and one shuffle by key.

    references gives for a column the parents and their column; names another name for that check.
    Violations are counted per key in the map tasks, so keys on very many rows move as one row a task.
    """
    checks: list[tuple[str, str | None, Column]] = []
    for column, (parents, parent_column) in (references or {}).items():
        # A parent on several rows is one parent.
        known = parents.select(F.col(parent_column).alias(f"__parent_{column}")).distinct()
        df = df.join(known, F.col(column) == F.col(f"__parent_{column}"), "left")
        unknown = F.col(column).isNotNull() & F.col(f"__parent_{column}").isNull()
        checks.append(((names or {}).get(column, "unknown reference"), column, unknown))
    checks.append(("null in key", None, F.expr(" or ".join(f"`{k}` is null" for k in keys))))
    checks += [("too long", c, F.char_length(c) > limit) for c, limit in (limits or {}).items() if c in df.columns]
    by_key = df.groupBy(*keys).agg(
        F.count("*").alias("__rows"), *[F.count_if(bad).alias(f"__n{i}") for i, (_, _, bad) in enumerate(checks)]
    )
    totals = by_key.agg(
        F.count_if(F.col("__rows") > 1).alias("__twice"),
        *[F.coalesce(F.sum(f"__n{i}"), F.lit(0)).alias(f"__n{i}") for i in range(len(checks))],
    )

    def line(check: str, column: str | None, count: str) -> Column:
        return F.struct(
            F.lit(check).alias("check"), F.lit(column).cast("string").alias("column_name"), F.col(count).alias("n")
        )

    lines = [line("duplicate key", None, "__twice"), *[line(c, col, f"__n{i}") for i, (c, col, _) in enumerate(checks)]]
    return totals.select(F.inline(F.array(*lines)))


def run_counters(log: DataFrame, *by: str) -> DataFrame:
    """Requests per status (and further columns)."""
    return log.groupBy(*by, "status").agg(F.count("*").alias("n"))


def failure_share(log: DataFrame, *by: str) -> DataFrame:
    """Requests, failed requests and their share."""
    return log.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(~F.col("status").eqNullSafe("ok")).alias("failed"),
    ).withColumn("share", F.when(F.col("n") > 0, F.col("failed") / F.col("n")))


def require_successes(log: DataFrame, max_share: float = 0.5) -> None:
    """Raise when more than this share of the requests failed."""
    row = failure_share(log).first()
    if row.share is not None and row.share > max_share:
        raise RuntimeError(f"{row.failed} of {row.n} requests failed")

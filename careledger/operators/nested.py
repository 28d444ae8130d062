"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array: str, name: str, position: str | None = None) -> DataFrame:
    """One row per element of an array column.

    The outer form with a filter behind it gives the rows of the inner one, but Spark does
    not test the array in front of it, which would parse the JSON once more.
    """
    index = position or f"__{name}_pos"
    rows = df.select("*", F.posexplode_outer(array).alias(index, name)).filter(F.col(index).isNotNull())
    return rows if position else rows.drop(index)

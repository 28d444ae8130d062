"""Fixed-size groups of ids: inside an array, and over the rows of a large frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the hash that spread the rows: 4096 buckets.
_PREFIX = 3


def chunks(ids: Column, size: int) -> Column:
    """An array cut into arrays of at most size elements, in order."""
    last = F.floor((F.size(ids) - 1) / size).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(ids, i * size + 1, F.lit(size)))
    return F.when(F.size(ids) > 0, cut)


def batch_rows(df: DataFrame, key: str, size: int, name: str = "batch") -> DataFrame:
    """Number the rows and put every size of them into one batch, counting from 0.

    Rows are ordered by a hash bucket, then the key. Each bucket is numbered on its own,
    and only one count per bucket is summed up in one place, so no task sees all rows.
    """
    bucketed = df.withColumn("__bucket", F.substring(F.md5(F.col(key)), 1, _PREFIX))
    local = bucketed.withColumn(
        "__row", F.row_number().over(Window.partitionBy("__bucket").orderBy(key))
    )
    before = Window.partitionBy(F.lit(0)).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucketed.groupBy("__bucket").agg(F.count("*").alias("__n")).select(
        "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    number = F.col("__offset") + F.col("__row") - 1
    return local.join(offsets, "__bucket").select(
        *df.columns, F.floor(number / size).cast("long").alias(name)
    )

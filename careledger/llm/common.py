"""Helpers the operators share: tables, staged results, bounded slices of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careledger.session import shared_dir

# A slice of texts that a Python task works on at once, in characters. A longer text is a
# slice of its own.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that nothing above them runs again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[range]:
    """Index ranges of at most that many characters, or of one text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield range(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield range(start, len(texts))


def any_row(df: DataFrame) -> bool:
    return bool(df.take(1))

"""Token counts of documents in flat token streams that have no index.

A stream is the ids of many documents one after another, each closed by an end-of-document id, cut
into blocks of a fixed number of ids with no regard to documents. Counting looks only at the ids:
each block is searched for the end id in one vectorised comparison, and a prefix scan over what the
blocks found (ends so far, place of the last one) stitches documents that run over block borders.

Blocks are rows (file_id, block, ids as little-endian bytes), so that any store Spark reads will do.
read_files makes them from binary files of bounded size.

Defined results: an empty document counts 0; ids after a stream's last end id are one open document,
closed = false; an empty stream has no documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from careledger.llm.common import slices, staged, text_of
from careledger.llm.tokens import WIDTH, Encoder

BLOCK_TOKENS = 65_536
END_ID = 50_256
# A binary file is read as one row; longer streams come as several files or as blocks.
FILE_BYTES = 256 * 2**20


def write_stream(docs: DataFrame, tokenizer: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS,
                 id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(blocks, order): one stream for each task that reads docs, and which document is which in it,
    by place (0 first). Both are staged. Strings of special tokens in a
    text are ordinary text, so that no text holds the end id."""
    end = np.array([end_id], "<u4").tobytes()
    size = block_tokens * WIDTH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file_id = Encoder(tokenizer, ordinary=True), TaskContext.get().partitionId()
        left, block, place = b"", 0, 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in slices(texts):
                encoded = encoder.encode(texts[part.start : part.stop])
                n = len(part)
                yield _rows(file_id, range(place, place + n), ids=batch.column(0).slice(part.start, n))
                place += n
                flat = b"".join([left, *(x + end for x in encoded)])
                whole = len(flat) // size
                for at in range(0, whole, 32):
                    cut = [flat[i * size : (i + 1) * size] for i in range(at, min(at + 32, whole))]
                    yield _rows(file_id, range(block, block + len(cut)), blocks=cut, kind=batch.column(0).type)
                    block += len(cut)
                left = flat[whole * size :]
        if left:
            yield _rows(file_id, range(block, block + 1), blocks=[left], kind=id_type)

    docs = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    both = staged(
        docs.mapInArrow(run, f"file_id int, at bigint, doc_id {kind.simpleString()}, ids binary"), "stream",
    )
    return (
        both.where("ids IS NOT NULL").select("file_id", F.col("at").alias("block"), "ids"),
        both.where("ids IS NULL").select("file_id", F.col("at").alias("place"), "doc_id"),
    )


def _rows(file_id: int, at: range, ids=None, blocks=None, kind=None) -> pa.RecordBatch:
    n = len(at)
    return pa.RecordBatch.from_arrays([
        pa.array([file_id] * n, pa.int32()), pa.array(at, pa.int64()),
        ids if blocks is None else pa.nulls(n, kind), pa.array(blocks or [None] * n, pa.binary()),
    ], ["file_id", "at", "doc_id", "ids"])


def read_files(spark: SparkSession, path: str, width: int = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of flat binary files of ids of width bytes; file_id is the path."""
    files = spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("file_id"),
        F.when(F.col("length") > FILE_BYTES, F.raise_error(F.concat(F.col("path"), F.lit(" is too long; split it"))).cast("binary"))
        .otherwise(F.col("content")).alias("content"),
    )
    size = width * block_tokens
    starts = F.sequence(F.lit(0), F.floor((F.length("content") - 1) / size))
    return files.where(F.length("content") > 0).select(
        "file_id", "content", F.explode(starts).alias("block"),
    ).select("file_id", "block", F.substring("content", F.col("block") * size + 1, F.lit(size)).alias("ids"))


def _search(end_id: int, width: int, block_tokens: int):
    kind = {2: "<u2", 4: "<u4", 8: "<u8"}[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, tokens = [], []
            for block, raw in zip(batch.column(1).to_pylist(), batch.column(2)):
                ids = np.frombuffer(raw.as_buffer(), kind)
                ends.append(np.flatnonzero(ids == end_id).astype(np.int64) + block * block_tokens)
                tokens.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), pa.array(ends, pa.list_(pa.int64()))],
                ["file_id", "block", "tokens", "ends"],
            )

    return run


def count_tokens(blocks: DataFrame, end_id: int = END_ID, width: int = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """file_id, place, n_tokens (without the end id), first_token, closed: each document of each stream."""
    kind = blocks.schema["file_id"].dataType.simpleString()
    found = staged(blocks.select("file_id", "block", "ids").mapInArrow(
        _search(end_id, width, block_tokens), f"file_id {kind}, block bigint, tokens bigint, ends array<bigint>",
    ), "ends")
    before = Window.partitionBy("file_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.element_at("ends", -1)
    scanned = found.withColumn("ends_before", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0))).withColumn(
        "last_before", F.coalesce(F.max(F.when(F.size("ends") > 0, last)).over(before), F.lit(-1)),
    )
    closed = scanned.select("file_id", "ends_before", "last_before", "ends", F.posexplode("ends").alias("i", "end")).select(
        "file_id", (F.col("ends_before") + F.col("i")).alias("place"), "end",
        F.when(F.col("i") == 0, F.col("last_before")).otherwise(F.expr("get(ends, i - 1)")).alias("previous"),
    )
    open_ = found.groupBy("file_id").agg(
        F.sum(F.size("ends")).alias("place"), F.sum("tokens").alias("end"),
        F.coalesce(F.max(F.when(F.size("ends") > 0, last)), F.lit(-1)).alias("previous"),
    ).where("end > previous + 1")
    return closed.withColumn("closed", F.lit(True)).unionByName(open_.withColumn("closed", F.lit(False))).select(
        "file_id", "place", (F.col("end") - F.col("previous") - 1).alias("n_tokens"),
        (F.col("previous") + 1).alias("first_token"), "closed",
    )

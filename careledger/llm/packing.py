"""Shortest-pack-first packing of tokenised documents into sequences of bounded length.

Documents become pieces of at most max_tokens ids: full pieces and one remainder. Only the
histogram of piece lengths (at most max_tokens counts) comes to the driver. There, lengths are
placed longest first; each goes to the open packing patterns that are filled least among those
with room, and a pattern used for only part of its copies is split in two counts. Patterns
then go back to the pieces by rank: a piece's rank among all pieces of its length is its rank in its
task plus the counts of that length in the tasks before, and a pattern's slot of a length owns a range
of ranks.

Defined results: a null or empty text is one piece that holds the end id alone; a null doc_id is kept;
repeated rows are packed each; without rows there are no sequences.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careledger.llm.common import slices, staged, text_of
from careledger.llm.tokens import WIDTH, Encoder

MAX_TOKENS = 1024
END_ID = 0
# Counts by task and length up to which they are sent to every task; beyond, the pieces are shuffled.
BROADCAST_COUNTS = 500_000
# Pieces in one output batch, and their bytes of ids.
_ROWS, _BYTES = 4_000, 8_000_000


def cut(ids: bytes, max_tokens: int) -> list[bytes]:
    """Full pieces and a remainder."""
    step = max_tokens * WIDTH
    return [ids[i : i + step] for i in range(0, len(ids), step)]


def pieces(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids (little-endian 32 bit), doc_tokens; part and rank number the pieces
    of a length: by task, and within it."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder(tokenizer), TaskContext.get().partitionId()
        seen = [0] * (max_tokens + 1)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for span in slices(texts):
                source, start, ids, total, rank, size = [], [], [], [], [], 0
                for i, encoded in zip(span, encoder.encode(texts[span.start : span.stop])):
                    at, encoded = 0, encoded + end
                    for piece in cut(encoded, max_tokens):
                        n = len(piece) // WIDTH
                        source.append(i)
                        start.append(at)
                        ids.append(piece)
                        total.append(len(encoded) // WIDTH)
                        rank.append(seen[n])
                        seen[n] += 1
                        at += n
                        size += len(piece)
                        if len(ids) >= _ROWS or size >= _BYTES:
                            yield _batch(batch, source, start, ids, total, part, rank)
                            source, start, ids, total, rank, size = [], [], [], [], [], 0
                if ids:
                    yield _batch(batch, source, start, ids, total, part, rank)

    docs = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, start bigint, length int, ids binary, doc_tokens bigint, part int, rank bigint")


def _batch(batch, source, start, ids, total, part, rank) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        batch.column(0).take(pa.array(source)), pa.array(start, pa.int64()),
        pa.array([len(x) // WIDTH for x in ids], pa.int32()), pa.array(ids, pa.binary()),
        pa.array(total, pa.int64()), pa.array([part] * len(ids), pa.int32()), pa.array(rank, pa.int64()),
    ], ["doc_id", "start", "length", "ids", "doc_tokens", "part", "rank"])


def shortest_pack_first(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, copies) for each packing pattern; together they use up the histogram."""
    room: dict[int, list[list]] = defaultdict(list)  # free tokens -> [lengths, copies]
    done = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        # Most room first. A pattern filled in this pass may take the same length again.
        while left:
            free = max((f for f in room if f >= length and room[f]), default=None)
            if free is None:
                lengths, copies = (), left
                free = max_tokens
            else:
                lengths, copies = room[free].pop()
            used = min(copies, left)
            if used < copies:
                room[free].append([lengths, copies - used])
            left -= used
            filled = [(*lengths, length), used]
            if free == length:
                done.append(filled)
            else:
                room[free - length].append(filled)
    return [(tuple(a), b) for a, b in [*done, *(x for f in sorted(room) for x in room[f])]]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first, offset) of each place in a pattern."""
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for lengths, copies in patterns:
        offset = 0
        for length in lengths:
            out.append((length, used[length], used[length] + copies - 1, sequence, offset))
            used[length] += copies
            offset += length
        sequence += copies
    return out


def pack(cut_up: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """The pieces, without part and rank, with sequence_id and offset.

    cut_up: the result of pieces(), staged, as it is read twice."""
    spark = cut_up.sparkSession
    counts = staged(cut_up.groupBy("part", "length").agg(F.count("*").alias("n")), "histogram")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # At most a few places per length and pattern, and max_tokens lengths: independent of the rows.
    places = spark.createDataFrame(
        slots(shortest_pack_first(histogram, max_tokens)),
        "of int, low bigint, high bigint, sequence bigint, offset bigint",
    )
    if counts.count() <= BROADCAST_COUNTS:
        first = F.broadcast(first)
    ranked = cut_up.join(first, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("first"))
    return (
        ranked.join(F.broadcast(places), (F.col("length") == F.col("of")) & F.col("rank").between(F.col("low"), F.col("high")))
        .withColumn("sequence_id", F.col("sequence") + F.col("rank") - F.col("low"))
        .drop("part", "rank", "first", "of", "low", "high", "sequence")
    )


def sequences(packed: DataFrame, max_tokens: int = MAX_TOKENS, pad_id: int = END_ID) -> DataFrame:
    """sequence_id, ids: the pieces of each sequence joined and padded to max_tokens, except where
    they fill a power of two. A group holds at most max_tokens ids."""
    n = F.sum("length")
    padding = F.when(F.log2(n) % 1 == 0, 0).otherwise(max_tokens - n)
    pad = f"unhex('{np.array([pad_id], '<u4').tobytes().hex()}')"
    return (
        packed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), padding.cast("int").alias("padding"))
        .select("sequence_id", F.expr(
            f"unhex(concat(array_join(transform(parts, p -> hex(p.ids)), ''), repeat(hex({pad}), padding)))"
        ).alias("ids"))
    )

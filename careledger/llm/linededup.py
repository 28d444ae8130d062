"""Line dedup through a sharded minimal perfect hash.

Lines are known by a 128-bit hash of their key: the line without white space around it, A-Z in lower case. Keys
found in MIN_DOCS documents or more are dealt to shards by hash. Each shard is built by one task: a minimal perfect
hash of its keys, and two arrays in its order, fingerprints and counts, beside the last document that holds the key.
Documents' line hashes are sent to the shards, probe the arrays there, and only what must go comes back.

The perfect hash is a cascade of bit arrays: in each, keys alone in their slot set its bit, the others go on to
the next; a key's place is the number of set bits before its own.

A shard that gets more than PROBES hashes is copied for as many tasks as they fill, so a line that all documents
hold doesn't wait for one task. Nothing is broadcast by hand or seen by the driver but the number of keys.

Defined results: a null or empty text is one empty line; documents that share an id are one document; rows without
an id take no part, their lines neither count nor go; lines are compared by hash, whose 64 bits of place and 64 bits
of fingerprint must both agree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger.llm.common import any_row, slices, staged, text_of
from careledger.llm.neardup import mix

MIN_CHARS = 40
MIN_DOCS = 5
# Keys of a shard; 21 bytes each in its arrays.
SHARD_KEYS = 1_000_000
# Hashes that one task holds against one copy of a shard.
PROBES = 2_000_000

# What counts as white space around a line.
WHITE_SPACE = " \t\n\v\f\r"
# Slots of a level for each key that comes to it.
_SLOTS = 2
_STEP = 0x9E3779B97F4A7C15


def key_of(line: str) -> str | None:
    """What a line is compared by; None if it is too short to be dropped."""
    key = line.strip(WHITE_SPACE)
    return key if len(key) >= MIN_CHARS else None


def hash_of(key: str) -> bytes:
    """16 bytes. bytes.lower changes A-Z alone."""
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())


class PerfectHash:
    """Gives each of its keys (pairs of 64-bit words, all different) a number of its own, from 0 without gaps."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        starts, self.ranks = 0, []
        for bits in levels:
            # Set bits before each 64-bit word, counted through all levels.
            counts = np.bitwise_count(bits).astype(np.int64)
            self.ranks.append(starts + np.cumsum(counts) - counts)
            starts += int(counts.sum())

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        levels = []
        while len(high):
            words = -(-_SLOTS * len(high) // 64)
            at = cls._slot(high, low, len(levels), words)
            alone = np.bincount(at, minlength=words * 64)[at] == 1
            bits = np.zeros(words * 64, dtype=np.uint8)
            bits[at[alone]] = 1
            levels.append(np.packbits(bits, bitorder="little").view("<u8"))
            high, low = high[~alone], low[~alone]
        return cls(levels)

    @staticmethod
    def _slot(high: np.ndarray, low: np.ndarray, level: int, words: int) -> np.ndarray:
        mixed = mix(high ^ mix(low + np.uint64((level + 1) * _STEP & (1 << 64) - 1)))
        return (mixed % np.uint64(words * 64)).astype(np.int64)

    def place(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The numbers of keys; for what is no key -1, or any number."""
        out = np.full(len(high), -1, dtype=np.int64)
        open_ = np.arange(len(high))
        for level, bits in enumerate(self.levels):
            slot = self._slot(high[open_], low[open_], level, len(bits))
            word, bit = bits[slot >> 6], (slot & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            before = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[hit]] = self.ranks[level][slot[hit] >> 6] + before[hit]
            open_ = open_[~hit]
        return out


# --- lines of documents ---


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for part in slices(texts):
            owners, found = [], []
            for i in part:
                own = {hash_of(k) for k in filter(None, map(key_of, texts[i].split("\n")))}
                owners += [i] * len(own)
                found += own
            raw = np.frombuffer(b"".join(found), dtype=">i8").astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(owners, pa.int64())), pa.array(raw[0::2]), pa.array(raw[1::2])], ["id", "high", "low"],
            )


def line_hashes(docs: DataFrame) -> DataFrame:
    """id, high, low: the different long lines of each document (id, text)."""
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(_hashes, f"id {kind}, high bigint, low bigint")


# --- the index ---


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of arrays for each shard; rows come sorted by shard."""
    held: list[pa.RecordBatch] = []

    def built() -> pa.RecordBatch:
        keys = pa.Table.from_batches(held).combine_chunks()
        high, low = (keys[c].to_numpy().view(np.uint64) for c in ("high", "low"))
        index = PerfectHash.build(high, low)
        order = np.argsort(index.place(high, low))
        last = keys["last"].combine_chunks().take(pa.array(order))
        counts = keys["n"].to_numpy()[order]
        return pa.RecordBatch.from_arrays([
            keys["shard"].combine_chunks()[:1],
            pa.array([[bits.tobytes() for bits in index.levels]], pa.list_(pa.binary())),
            pa.array([low[order].tobytes()], pa.binary()), pa.array([counts.astype("<i8").tobytes()], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(last)], pa.int32()), last),
        ], ["shard", "levels", "fingerprints", "counts", "last"])

    for batch in batches:
        shards = batch.column(0).to_numpy()
        ends = np.flatnonzero(np.diff(shards)) + 1
        for start, end in zip([0, *ends], [*ends, len(shards)]):
            if start == end:
                continue
            if held and held[0].column(0)[0].as_py() != shards[start]:
                yield built()
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield built()


def index_of(lines: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, int]:
    """The shards (shard, levels, fingerprints, counts, last) of the lines that min_docs documents hold, and
    how many shards there are. Staged."""
    # Partial counts in the map tasks: a line that all documents hold is one row of each task.
    keys = staged(
        lines.groupBy("high", "low").agg(F.count("*").alias("n"), F.max("id").alias("last")).where(f"n >= {min_docs}"), "keys",
    )
    shards = max(1, -(-keys.count() // SHARD_KEYS))
    kind = lines.schema["id"].dataType.simpleString()
    dealt = keys.select(F.expr(f"CAST(pmod(high, {shards}) AS int)").alias("shard"), "high", "low", "n", "last")
    built = dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        _shards, f"shard int, levels array<binary>, fingerprints binary, counts binary, last array<{kind}>",
    )
    return staged(built, "shards"), shards


def _probe(min_docs: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(probes: pa.Table, shard: pa.Table) -> pa.Table:
        out = probes.select(["id", "high", "low"])
        if not shard.num_rows or not probes.num_rows:
            return out.slice(0, 0)
        high, low = (out[c].to_numpy().view(np.uint64) for c in ("high", "low"))
        index = PerfectHash([np.frombuffer(b, "<u8") for b in shard["levels"][0].as_py()])
        prints = np.frombuffer(shard["fingerprints"][0].as_py(), "<u8")
        counts = np.frombuffer(shard["counts"][0].as_py(), "<i8")
        at = index.place(high, low)
        held = np.flatnonzero(at >= 0)
        held = held[(prints[at[held]] == low[held]) & (counts[at[held]] >= min_docs)]
        last = shard["last"].combine_chunks().values.take(pa.array(at[held]))
        found = out.take(pa.array(held)).combine_chunks()
        return found.filter(pa.compute.not_equal(found["id"], last))

    return run


def dropped(lines: DataFrame, shards: DataFrame, number: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """id, high, low: the lines that a document loses."""
    kind = lines.schema["id"].dataType.simpleString()
    probes = lines.withColumn("shard", F.expr(f"CAST(pmod(high, {number}) AS int)"))
    # How many tasks each shard's probes fill.
    copies = staged(probes.groupBy("shard").agg(F.ceil(F.count("*") / PROBES).cast("int").alias("copies")), "copies")
    salted = probes.join(copies, "shard").withColumn("salt", F.expr("CAST(pmod(xxhash64(id), copies) AS int)")).drop("copies")
    given = shards.join(copies, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    return (
        salted.groupBy("shard", "salt").cogroup(given.groupBy("shard", "salt"))
        .applyInArrow(_probe(min_docs), f"id {kind}, high bigint, low bigint")
    )


def _without(texts: pd.Series, gone: pd.Series) -> tuple[list[str], list[int], list[int]]:
    kept, lines, lost = [], [], []
    for text, hashes in zip(texts, gone):
        all_lines = text.split("\n")
        out = all_lines
        if hashes is not None and len(hashes):
            drop = {bytes(h) for h in hashes}

            def stays(line: str) -> bool:
                key = key_of(line)
                return key is None or hash_of(key) not in drop

            out = [line for line in all_lines if stays(line)]
        kept.append("\n".join(out))
        lines.append(len(all_lines))
        lost.append(len(all_lines) - len(out))
    return kept, lines, lost


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with the text without its repeated lines, and with n_lines and n_dropped (lines before, lines lost)."""
    @F.pandas_udf("text string, n_lines bigint, n_dropped bigint")
    def cut(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        kept, lines, lost = _without(texts, gone)
        return pd.DataFrame({"text": kept, "n_lines": lines, "n_dropped": lost})

    named = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).where("id IS NOT NULL")
    lines = line_hashes(named)
    if any_row(named.groupBy("id").count().where("count > 1")):
        lines = lines.distinct()
    lines = staged(lines, "lines")
    shards, number = index_of(lines, min_docs)
    word = F.concat(F.lpad(F.hex("high"), 16, "0"), F.lpad(F.hex("low"), 16, "0"))
    own, lost, done = (_free(docs, c) for c in ("_id", "_gone", "_cut"))
    gone = dropped(lines, shards, number, min_docs).groupBy(F.col("id").alias(own)).agg(
        F.collect_list(F.unhex(word)).alias(lost),
    )
    joined = docs.join(gone, F.col(id_col) == F.col(own), "left").drop(own)
    out = joined.withColumn(done, cut(text_of(text_col), F.col(lost))).drop(lost)
    clash = [c for c in docs.columns if c in ("n_lines", "n_dropped")]
    return out.drop(*clash).withColumns({
        text_col: F.col(f"{done}.text"), "n_lines": F.col(f"{done}.n_lines"), "n_dropped": F.col(f"{done}.n_dropped"),
    }).drop(done)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs don't have."""
    while name in docs.columns:
        name = f"_{name}"
    return name

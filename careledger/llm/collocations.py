"""Phrase collocations: word pairs counted in direct-address tiles, frequent pairs becoming the words of the next level.

Level 1 counts words per language. Frequent ones are ranked by frequency; the first HEAD get their rank as a code,
which addresses a cell directly: pairs of ranks fall into SIDE x SIDE tiles, and a tile with many pairs is counted by
one dense bincount, all sparse tiles together as sorted coordinates. Tasks send packed tiles, not pairs; a tile of all
tasks is summed by one task, of SPAN tasks at a time, into a dense array or, while it is thin, into sorted coordinates.
Level 2 gives the frequent pairs, which are ranked anew. A text is then read as the codes of its overlapping pairs, so
that pairs of pairs are the phrases of three words, and so on; each level reads the streams of codes that the one
before has written, without the stretches that hold nothing frequent.

Only the HEAD ranks of a level and a bitmap of BITS bits are sent to the tasks, whatever the size of the vocabulary.
Frequent words and pairs beyond HEAD are known by the bitmap and coded by their 63-bit hash; a word that meets a set
bit by chance is only counted in vain. Pairs with such a code are packed by buckets of their hash, of which there are
more with more such words and pairs, and a bucket is summed in sorted order.

A phrase's counts need no other look at the texts: the parts of a frequent phrase are frequent, so two joins a level
bring the counts of all beginnings and endings.

Defined results: a null or empty text has no words; a null language is UNKNOWN, as is that name itself; words of any
length and repeated rows count as they stand; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careledger.llm.common import any_row, staged, text_of
from careledger.llm.neardup import mix

MIN_COUNT = 30
LONGEST = 4
TOP = 2_000
# A phrase goes if a longer one around it has this share of its count.
INSIDE = (4, 5)
SCALE = 2_000_000
UNKNOWN = "und"

# Ranks with a code of their own, and the side of a tile.
HEAD = 1 << 18
SIDE = 1 << 11
# Pairs from which a tile is counted densely.
DENSE = SIDE * SIDE // 16
# Bits of the map of frequent words or pairs beyond HEAD.
BITS = 1 << 27
# Buckets of pairs beyond the ranks, at least, and frequent words or pairs beyond the ranks for each.
BUCKETS, A_BUCKET = 1 << 10, 1 << 12
# Bytes up to which a word may be among the ranked ones.
WORD_BYTES = 64
# Tasks whose tiles are summed at a time.
SPAN = 64
# Pairs of ranks, pairs beyond them, words, codes and bytes of text that a task holds at once (or one text).
PAIRS, TAILS, WORDS, CODES, BYTES = 4_000_000, 500_000, 200_000, 50_000, 1_000_000
# Pairs that are worked on at once while they are counted; a thin tile has fewer.
STEP = 2 * DENSE

_TAIL = 1 << 62
_ACROSS, _CELLS = HEAD // SIDE, SIDE * SIDE
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BREAK = b"\n"
# Characters that end a piece, the other white space, and A-Z in lower case.
_PLAIN = bytes.maketrans(b".,;:!?\v\f\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n\n\n\n\n\n\n\n\n abcdefghijklmnopqrstuvwxyz")


def words_of(text: bytes) -> list[bytes]:
    """Words of the text's pieces, with a break behind each piece."""
    out = []
    for piece in text.translate(_PLAIN).split(_BREAK):
        found = piece.split()
        if found:
            out += found
            out.append(_BREAK)
    return out


def word_id(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\0" + word) & (_TAIL - 1) | _TAIL


def pair_ids(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = mix(mix(left.view(np.uint64)) * _STEP + right.view(np.uint64))
    return (mixed & np.uint64(_TAIL - 1) | np.uint64(_TAIL)).view(np.int64)


@dataclass
class Level:
    """What tasks know of a level: ids by rank, the words where it is the first, the bitmap of all ids if there
    are more than ranks, and the number of buckets for pairs of such ids."""
    ids: np.ndarray
    words: pa.Table | None
    bits: np.ndarray | None
    buckets: int = BUCKETS

    @cached_property
    def order(self) -> np.ndarray:
        return np.argsort(self.ids)

    def known(self, ids: np.ndarray) -> np.ndarray:
        """Whether ids may be frequent ones beyond the ranks."""
        if self.bits is None:
            return np.zeros(len(ids), dtype=bool)
        at = ids & (BITS - 1)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def id_of(self, codes: np.ndarray) -> np.ndarray:
        return np.where(codes < HEAD, self.ids[np.minimum(codes, len(self.ids) - 1)], codes)

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """Rank, or the id itself if it may be frequent, or -1."""
        at = np.searchsorted(self.ids, ids, sorter=self.order)
        rank = self.order[np.minimum(at, len(self.ids) - 1)]
        return np.where(self.ids[rank] == ids, rank, np.where(self.known(ids), ids, -1))


class _Codes(dict):
    """Codes of one language's words; room is how many words without a rank all languages of a task remember."""

    def __init__(self, level: Level, lang: str, room: list[int]):
        super().__init__({_BREAK: -1})
        self.level, self.lang, self.room = level, lang, room
        ranks = np.flatnonzero(pc.equal(level.words["lang"], lang).to_numpy())
        own = level.words["word"].take(pa.array(ranks)).cast(pa.binary()).to_pylist()
        self.update(zip(own, ranks.tolist()))

    def __missing__(self, word: bytes) -> int:
        if self.level.bits is None:
            return -1
        own = word_id(self.lang, word)
        code = own if self.level.known(np.array([own]))[0] else -1
        if self.room[0]:
            self.room[0] -= 1
            self[word] = code
        return code


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Language and words of some texts at a time."""
    for batch in batches:
        start = 0
        # Only the texts of a part leave their batch.
        for size in _parts(pc.binary_length(batch.column(1)).to_numpy()):
            part = batch.slice(start, size)
            start += size
            of: dict[str, list[bytes]] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                of.setdefault(lang, []).append(text)
            for lang, own in of.items():
                yield lang, words_of(_BREAK.join(own))


def _parts(sizes: np.ndarray) -> Iterator[int]:
    """How many rows to take at a time, for at most BYTES or one row."""
    count = total = 0
    for size in sizes.tolist():
        if count and total + size > BYTES:
            yield count
            count = total = 0
        count += 1
        total += size
    if count:
        yield count


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            words = list(found)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()),
                pa.array([word_id(lang, w) for w in words], pa.int64()), pa.array(found.values(), pa.int64()),
            ], ["lang", "word", "id", "n"])
        counts.clear()

    for lang, words in _texts(batches):
        own = counts.setdefault(lang, Counter())
        own.update(words)
        del own[_BREAK]
        if sum(map(len, counts.values())) > WORDS:
            yield from flush()
    yield from flush()


def compacted(codes: np.ndarray) -> np.ndarray:
    """The stream with one break where there are several."""
    return codes[(codes >= 0) | np.append(True, codes[:-1] >= 0)]


Tiles = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _steps(values: np.ndarray) -> Iterator[np.ndarray]:
    for at in range(0, len(values), STEP):
        yield values[at : at + STEP]


def tile_counts(left: np.ndarray, right: np.ndarray) -> Iterator[Tiles]:
    """Counts of pairs of ranks, in parts: tiles, where their cells begin, different cells, their counts."""
    # Tile and cell in one number; beside these numbers only a step's are held.
    places, sizes = np.empty(len(left), dtype=np.int64), np.zeros(_ACROSS * _ACROSS, dtype=np.int64)
    for own, a, b in zip(_steps(places), _steps(left), _steps(right)):
        a, b = a.astype(np.int64), b.astype(np.int64)
        own[:] = (a // SIDE * _ACROSS + b // SIDE) * _CELLS + a % SIDE * SIDE + b % SIDE
        sizes += np.bincount(own // _CELLS, minlength=len(sizes))
    for t in np.flatnonzero(sizes >= DENSE):
        counts = np.bincount(np.concatenate([own[own // _CELLS == t] % _CELLS for own in _steps(places)]), minlength=_CELLS)
        found = np.flatnonzero(counts)
        yield np.array([t]), np.array([0]), found, counts[found]
    end = 0
    for own in _steps(places):
        rest = own[sizes[own // _CELLS] < DENSE]
        places[end : end + len(rest)] = rest
        end += len(rest)
    thin = places[:end]
    thin.sort()
    ends = np.searchsorted(thin, np.arange(1, len(sizes) + 1) * _CELLS)
    start = 0
    while start < end:
        # Whole tiles, as many as a step holds.
        stop = ends[np.searchsorted(ends, start + STEP, side="right") - 1]
        own = thin[start:stop]
        new = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        found, counts = own[new], np.diff(new, append=len(own))
        tiles = found // _CELLS
        starts = np.flatnonzero(np.diff(tiles, prepend=-1))
        yield tiles[starts], starts, found % _CELLS, counts
        start = stop


def tail_counts(left: np.ndarray, right: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of any codes with their counts, or the sums of n."""
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    new = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))) if len(left) else np.empty(0, np.int64)
    return left[new], right[new], np.diff(new, append=len(left)) if n is None else np.add.reduceat(n[order], new)


#: Of a level's counts: packed tiles of part (a number of tasks), packed buckets of pairs beyond the ranks, streams of codes.
_COUNTED = pa.schema([
    ("tile", pa.int32()), ("part", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary()),
    ("bucket", pa.int32()), ("lefts", pa.binary()), ("rights", pa.binary()), ("codes", pa.binary()),
])
_COUNTED_SQL = "tile int, part int, cells binary, counts binary, bucket int, lefts binary, rights binary, codes binary"
_FOUND_SQL = "id bigint, left bigint, right bigint, n bigint"


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _COUNTED], schema=_COUNTED,
    )


def _pieces(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes of values, cut at starts."""
    offsets = (np.append(starts, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def _packed(tiles: Tiles, part: int) -> pa.RecordBatch:
    names, starts, cells, counts = tiles
    return _rows(tile=names, part=np.full(len(names), part), cells=_pieces(cells.astype("<u4"), starts), counts=_pieces(counts.astype("<i8"), starts))


def _bucketed(left: np.ndarray, right: np.ndarray, n: np.ndarray, buckets: int) -> pa.RecordBatch:
    own = pair_ids(left, right) % buckets
    order = np.argsort(own, kind="stable")
    own = own[order]
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    lefts, rights, counts = (_pieces(x[order].astype("<i8"), starts) for x in (left, right, n))
    return _rows(bucket=own[starts], lefts=lefts, rights=rights, counts=counts)


def _first_codes(level: Level):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        tables: dict[str, _Codes] = {}
        room = [CODES]
        for lang, words in _texts(batches):
            if lang not in tables:
                tables[lang] = _Codes(level, lang, room)
            yield np.fromiter(map(tables[lang].__getitem__, words), np.int64, len(words))

    return run


def _next_codes(lower: Level, level: Level):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for stream in batch.column(0):
                codes = np.frombuffer(stream.as_buffer(), "<i8")
                left, right = codes[:-1], codes[1:]
                both = np.flatnonzero((left >= 0) & (right >= 0))
                out = np.full(len(codes), -1, dtype=np.int64)
                out[both] = level.codes(pair_ids(lower.id_of(left[both]), lower.id_of(right[both])))
                yield out

    return run


def _pairs(levels, onward: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of neighbouring codes of the last of these levels; with onward also the streams of codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *lower, level = [x.value for x in levels]
        part = TaskContext.get().partitionId()
        # Ranks are held in arrays of fixed size, pairs beyond them as they come.
        held = np.empty((2, PAIRS), dtype=np.int32)
        size = 0
        tails: list[np.ndarray] = []

        def flush_tails() -> Iterator[pa.RecordBatch]:
            a, b, n = tail_counts(*np.concatenate(tails, axis=1))
            tails.clear()
            yield _bucketed(level.id_of(a), level.id_of(b), n, level.buckets)

        for codes in (_next_codes(lower[-1], level) if lower else _first_codes(level))(batches):
            codes = compacted(codes)
            if len(codes) < 2:
                continue
            if onward:
                yield _rows(codes=[codes.astype("<i8").tobytes()])
            # Streams end with a break, so no pair reaches from one into the next.
            pairs = np.stack([codes[:-1], codes[1:]])
            pairs = pairs[:, (pairs >= 0).all(axis=0)]
            ranked = (pairs < HEAD).all(axis=0)
            if not ranked.all():
                tails.append(pairs[:, ~ranked])
                if sum(t.shape[1] for t in tails) >= TAILS:
                    yield from flush_tails()
                pairs = pairs[:, ranked]
            at = 0
            while at < pairs.shape[1]:
                taken = min(pairs.shape[1] - at, PAIRS - size)
                held[:, size : size + taken] = pairs[:, at : at + taken]
                at, size = at + taken, size + taken
                if size == PAIRS:
                    for tiles in tile_counts(*held):
                        yield _packed(tiles, part)
                    size = 0
        for tiles in tile_counts(*held[:, :size]):
            yield _packed(tiles, part)
        if tails:
            yield from flush_tails()

    return run


class _Sum:
    """Counts of one tile: sorted coordinates, or a dense array once there are many."""

    def __init__(self):
        self.parts, self.size, self.dense = [], 0, None

    def add(self, cells: np.ndarray, counts: np.ndarray) -> None:
        if self.dense is None:
            # Copies: a view would keep its whole batch.
            self.parts.append((cells.copy(), counts.copy()))
            self.size += len(cells)
            if self.size >= DENSE:
                self.dense = np.zeros(_CELLS, dtype=np.int64)
                for a, n in self.parts:
                    self.dense[a] += n
                self.parts = []
        else:
            # The cells of a part are all different.
            self.dense[cells] += counts

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        if self.dense is not None:
            cells = np.flatnonzero(self.dense)
            return cells, self.dense[cells]
        cells, counts = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(cells, kind="stable")
        cells, counts = cells[order].astype(np.int64), counts[order]
        starts = np.flatnonzero(np.diff(cells, prepend=-1))
        return cells[starts], np.add.reduceat(counts, starts)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """tile, part, cells, counts of rows sorted by tile and part."""
    now, total = None, _Sum()
    for batch in batches:
        tiles, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, key in enumerate(zip(tiles, parts)):
            if key != now:
                if now:
                    yield *now, *total.counts()
                now, total = key, _Sum()
            total.add(np.frombuffer(batch.column(2)[i].as_buffer(), "<u4"), np.frombuffer(batch.column(3)[i].as_buffer(), "<i8"))
    if now:
        yield *now, *total.counts()


def _partly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tile, part, cells, counts in _sums(batches):
        yield _packed((np.array([tile]), np.array([0]), cells, counts), part).select(["tile", "part", "cells", "counts"])


def _frequent(level, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, _, cells, counts in _sums(batches):
            many = counts >= least
            cells, counts = cells[many], counts[many]
            left = level.value.id_of(tile // _ACROSS * SIDE + cells // SIDE)
            right = level.value.id_of(tile % _ACROSS * SIDE + cells % SIDE)
            if len(cells):
                yield _found(left, right, counts)

    return run


def _found(left: np.ndarray, right: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (pair_ids(left, right), left, right, n)], ["id", "left", "right", "n"])


def _frequent_tails(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows bucket, lefts, rights, counts sorted by bucket; what is held of one is summed up as it grows."""
        now, held, size, room = None, [], 0, TAILS

        def flush() -> Iterator[pa.RecordBatch]:
            left, right, n = tail_counts(*np.concatenate(held, axis=1))
            many = n >= least
            if many.any():
                yield _found(left[many], right[many], n[many])

        for batch in batches:
            for i, bucket in enumerate(batch.column(0).to_pylist()):
                if bucket != now:
                    if held:
                        yield from flush()
                    now, held, size, room = bucket, [], 0, TAILS
                held.append(np.stack([np.frombuffer(batch.column(c)[i].as_buffer(), "<i8") for c in (1, 2, 3)]))
                size += held[-1].shape[1]
                if size >= room:
                    held = [np.stack(tail_counts(*np.concatenate(held, axis=1)))]
                    size = held[0].shape[1]
                    room = max(TAILS, 2 * size)
        if held:
            yield from flush()

    return run


def _summed(counted: DataFrame, level, least: int) -> DataFrame:
    """id, left, right, n of the pairs with enough counts."""
    tiles = counted.where("tile IS NOT NULL").select("tile", "part", "cells", "counts")
    parts = (tiles.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        parts = -(-parts // SPAN)
        together = tiles.withColumn("part", F.expr(f"part div {SPAN}")).repartition("tile", "part").sortWithinPartitions("tile", "part")
        if parts == 1:
            break
        tiles = together.mapInArrow(_partly, "tile int, part int, cells binary, counts binary")
    found = together.mapInArrow(_frequent(level, least), _FOUND_SQL)
    tails = counted.where("bucket IS NOT NULL").select("bucket", "lefts", "rights", "counts")
    tails = tails.repartition("bucket").sortWithinPartitions("bucket")
    return found.union(tails.mapInArrow(_frequent_tails(least), _FOUND_SQL))


def _known(frequent: DataFrame, first: bool) -> Level:
    """The ranks of a level and the bitmap of what has none; both of bounded size."""
    rows = frequent.where(f"octet_length(word) <= {WORD_BYTES}") if first else frequent
    columns = ["id", "lang", "word"] if first else ["id"]
    head = rows.orderBy(F.desc("n"), "id").limit(HEAD).select(*columns).toArrow()
    words = head.select(["lang", "word"]) if first else None
    bits = None
    beyond = frequent.count() - head.num_rows
    if beyond:
        bits = np.zeros(BITS // 8, dtype=np.uint8)
        at = frequent.select((F.pmod("id", F.lit(BITS)) + 1).alias("at"))
        parts = at.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        for row in parts.collect():
            part = np.frombuffer(row["bits"], np.uint8)
            start = (row["part"] - 1) * len(part)
            bits[start:start + len(part)] = part
    # One id more than there are, so that there is always one to compare with.
    return Level(np.append(head["id"].to_numpy(), np.int64(-1)), words, bits, max(BUCKETS, beyond // A_BUCKET))


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """Of docs (lang, text): words in all by language (lang, n), and for each length the frequent phrases
    (id, left, right, lang, phrase, last, n, pre, suf). left and right are the ids of the phrases without the last and
    the first word; pre and suf the counts of the first and last words, two words and so on."""
    spark = docs.sparkSession
    counted = staged(
        docs.mapInArrow(_words, "lang string, word string, id bigint, n bigint")
        .groupBy("lang", "word", "id").agg(F.sum("n").alias("n")), "words",
    )
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    words = staged(counted.where(f"n >= {min_count}"), "frequent")
    found = [words.select(
        "id", F.lit(None).cast("bigint").alias("left"), F.lit(None).cast("bigint").alias("right"), "lang",
        F.col("word").alias("phrase"), F.col("word").alias("last"), "n", F.array("n").alias("pre"), F.array("n").alias("suf"),
    )]
    levels, current, source = [], words, docs
    while len(found) < longest and any_row(current):
        levels.append(spark.sparkContext.broadcast(_known(current, len(found) == 1)))
        onward = len(found) + 1 < longest
        counted = staged(source.mapInArrow(_pairs(levels[-2:], onward), _COUNTED_SQL), "counted")
        source = counted.where("codes IS NOT NULL").select("codes")
        current = staged(_summed(counted, levels[-1], min_count), "pairs")
        begin = found[-1].select(F.col("id").alias("left"), "lang", F.col("phrase").alias("begin"), "pre")
        end = found[-1].select(F.col("id").alias("right"), "last", "suf")
        found.append(staged(
            current.join(begin, "left").join(end, "right").select(
                "id", "left", "right", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "last", "n",
                F.array_append("pre", F.col("n")).alias("pre"), F.array_append("suf", F.col("n")).alias("suf"),
            ), "phrases",
        ))
    for level in levels:
        level.unpersist()
    return totals, found


def _scored(level: DataFrame, words: int) -> DataFrame:
    """The phrases of a level with score, l and r of their lowest cut."""
    cuts = []
    for first in range(1, words):
        l, r = f"pre[{first - 1}]", f"suf[{words - first - 1}]"
        # Decimals: the product may pass 64 bits.
        score = f"CAST(n AS DECIMAL(20,0)) * {SCALE} div (CAST({l} AS DECIMAL(20,0)) + {r})"
        cuts.append(f"named_struct('score', {score}, 'k', {first}, 'l', {l}, 'r', {r})")
    low = F.expr(f"array_min(array({', '.join(cuts)}))")
    return level.withColumn("cut", low).select("id", "lang", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                 longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the top phrases of two to longest words of each language."""
    named = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), text_of(text_col).alias("text"))
    totals, found = phrases(named, min_count, longest)
    out = None
    for words, level in enumerate(found[1:], 2):
        own = _scored(level, words)
        if words < len(found):
            # A phrase two words longer lies around one that is one word longer and as frequent at least.
            longer = found[words].select(F.explode(F.array_distinct(F.array("left", "right"))).alias("id"), "n")
            around = longer.groupBy("id").agg(F.max("n").alias("most"))
            own = own.join(around, "id", "left").where(f"most IS NULL OR {INSIDE[1]} * most < {INSIDE[0]} * a").drop("most")
        own = own.drop("id")
        out = own if out is None else out.union(own)
    if out is None:
        out = _scored(found[0].where("false").withColumn("suf", F.array("n")), 2).drop("id")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""MinHash near-duplicates: one-permutation hashing with optimal densification.

A document's set is its distinct word shingles. One hash per shingle falls into one of
rows x bands bins; a bin keeps its smallest hash, and an empty bin borrows from the bin that
its own probe sequence meets first, so every document has a full signature from a single
pass. Bands of the signature are bucket keys. Inside a bucket, candidate edges are a star
around one centre, never all pairs; every edge is confirmed on the full sets.

A star alone may miss a link between two members that are both unlike the centre. The members of buckets that
still hold several components are therefore compared by how they differ from their group's core, the shingles that
most of them hold. Two sets are linked when what each lacks and adds weighs little enough, or when they lack or add
enough of the same. The first kind of link is found by a star around the member that differs least; for the second,
sets with the same shared differences are one class, and classes meet in the rarest of their differences, as many
as a link can't do without (a prefix filter). Nothing is compared twice, and no link inside a bucket is lost.
Identical sets are one node throughout, so copies cost one row each and no edge.

Defined results: a null or blank text has an empty set and is linked with nothing; rows with one doc_id are one
document, whatever their texts; rows without a doc_id link as others do, but are never a group's smallest; repeated
rows are each returned.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careledger.llm.common import any_row, slices, staged, text_of
from careledger.llm.components import components

SHINGLE = 5
ROWS = 6
# The chance that a link exactly at the threshold shares no bucket.
MISS = 1e-7
# Words whose hashes a task remembers, and characters whose shingles it holds at once (or one text).
WORDS = 200_000
CHARS = 1_000_000
# Candidate documents up to which their ids are sent to every task instead of shuffling texts.
BROADCAST_IDS = 1_000_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def bands_for(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """Hash of a word, remembered up to WORDS words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_sets(texts: list[str], hashes: dict, size: int = SHINGLE) -> list[np.ndarray]:
    """For each text, the sorted distinct hashes of its shingles."""
    words = [text.encode("utf-8", "surrogatepass").lower().split() for text in texts]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    total = int(counts.sum())
    flat = np.fromiter(map(hashes.__getitem__, chain.from_iterable(words)), np.uint64, total)
    rolled = flat[: max(total - size + 1, 0)].copy()
    for j in range(1, size):
        rolled = rolled * _MULTIPLIER + flat[j : total - size + 1 + j]
    rolled = mix(rolled)
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(rolled[at : at + n - size + 1]))
        elif n:
            whole = np.array([n], dtype=np.uint64)
            for j in range(at, at + n):
                whole = mix(whole * _MULTIPLIER + flat[j : j + 1])
            out.append(whole)
        else:
            out.append(np.empty(0, dtype=np.uint64))
        at += n
    return out


@cache
def _probe(bins: int, attempt: int) -> np.ndarray:
    at = np.arange(bins, dtype=np.uint64)
    return (mix(at * _MULTIPLIER + np.uint64(attempt + 1)) % np.uint64(bins)).astype(np.int64)


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of bins values for each set that is not empty."""
    out = np.zeros((len(sets), bins), dtype=np.uint64)
    full = np.zeros((len(sets), bins), dtype=bool)
    for i, found in enumerate(sets):
        at = ((found >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))  # sorted: the first of a bin is its smallest
        out[i, at[first]] = found[first]
        full[i, at[first]] = True
    row, col = np.nonzero(~full)
    attempt = 0
    while len(row):
        source = _probe(bins, attempt % 4096)[col] if attempt < 4096 else (col + attempt) % bins
        hit = full[row, source]
        out[row[hit], col[hit]] = out[row[hit], source[hit]]
        row, col = row[~hit], col[~hit]
        attempt += 1
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), bands)).copy()
    cells = signature.reshape(len(signature), bands, ROWS)
    for j in range(ROWS):
        keys = mix(keys * _MULTIPLIER + cells[:, :, j])
    return keys.view(np.int64)


def _node(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def _sketch(bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for part in slices(texts, CHARS):
                sets = shingle_sets(texts[part.start : part.stop], hashes)
                keys = np.zeros((len(sets), bands), dtype=np.int64)
                some = np.array([len(s) > 0 for s in sets], dtype=bool)
                if some.any():
                    keys[some] = band_keys(signatures([s for s in sets if len(s)], bands * ROWS), bands)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(part.start, len(part)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), pa.array(keys.ravel()),
                    ),
                ], ["doc_id", "n", "node", "keys"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for part in slices(texts, CHARS):
            sets = shingle_sets(texts[part.start : part.stop], hashes)
            yield pa.RecordBatch.from_arrays([
                pa.array([_node(s) for s in sets], pa.binary()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ], ["node", "items"])


def _sets_of(docs: DataFrame, nodes: DataFrame, some: DataFrame) -> DataFrame:
    """node, items for the nodes in some; items is the sorted set. Staged."""
    named = staged(some.distinct().join(nodes.select("node", "id"), "node"), "named")
    wanted = staged(named.select("id").where("id IS NOT NULL").distinct(), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, docs["doc_id"] == wanted["id"], "left_semi").select("text")
    missing = any_row(named.where("id IS NULL"))
    if missing:
        texts = texts.union(docs.where("doc_id IS NULL").select("text"))
    found = texts.mapInArrow(_sets, "node binary, items array<bigint>").where("node IS NOT NULL")
    if missing:
        found = found.join(named.select("node"), "node", "left_semi")
    return staged(found.groupBy("node").agg(F.first("items").alias("items")), "sets")


def _linked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int, sets: DataFrame | None = None) -> DataFrame:
    """The linked ones of these pairs (u, v) of nodes, by the full sets of their documents. Staged."""
    if sets is None:
        sets = _sets_of(docs, nodes, pairs.select("u").union(pairs.select("v")).toDF("node"))
    left = sets.select(F.col("node").alias("u"), F.col("items").alias("left"))
    right = sets.select(F.col("node").alias("v"), F.col("items").alias("right"))
    both = pairs.join(right, "v").join(left, "u").withColumn("common", F.size(F.array_intersect("left", "right")))
    return staged(
        both.where(f"100 * common >= {percent} * (size(left) + size(right) - common)").select("u", "v"), "linked",
    )


def _members(nodes: DataFrame) -> DataFrame:
    """key, node, n, centre, m: who shares a bucket with others, and the node in it that shares most. Staged."""
    each = nodes.select("node", "n", F.explode("keys").alias("key"))
    sizes = each.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = staged(each.join(sizes, "key"), "shared")
    weight = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = shared.join(weight, "node")
    # The node that shares most is the origin of a group of variants, or close to it.
    first = weighed.groupBy("key").agg(F.min(F.struct(-F.col("weight"), "node", "n")).alias("first"))
    first = first.select("key", F.col("first.node").alias("centre"), F.col("first.n").alias("m"))
    return staged(weighed.select("key", "node", "n").join(first, "key"), "members")


def _with_component(rows: DataFrame, comps: DataFrame) -> DataFrame:
    comps = comps.withColumnRenamed("node", "at")
    return rows.join(comps, F.col("node") == F.col("at"), "left").drop("at").withColumn("comp", F.coalesce("comp", "node"))


def _differences(docs: DataFrame, nodes: DataFrame, left: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of the undecided nodes (key, node, n, centre, comp): node, comp, grp, weight, slack, diff, class; and their sets.

    A group is all that share buckets by some chain, its core the items of more than half of it. diff lists what a
    node lacks of the core or has beside it, where another node of the group differs in the same, rarest first.
    With weight = 100 * lacking + percent * beside and slack = (100 - percent) * core, two nodes are linked
    if (100 + percent) * shared differences >= the sum of their weights - slack. Staged.
    """
    groups = components(left.select(F.col("centre").alias("u"), F.col("node").alias("v")).distinct())
    groups = groups.select(F.col("node").alias("at"), F.col("comp").alias("grp"))
    each = staged(
        left.select("node", "n", "comp").distinct().join(groups, F.col("node") == F.col("at")).drop("at"), "undecided",
    )
    sets = _sets_of(docs, nodes, each.select("node"))
    held = each.join(sets, "node")
    counts = held.select("grp", F.explode("items").alias("item")).groupBy("grp", "item").agg(F.count("*").alias("f"))
    sizes = each.groupBy("grp").agg(F.count("*").alias("g"))
    # No longer than two of the group's sets.
    core = counts.join(sizes, "grp").where("2 * f > g").groupBy("grp").agg(F.collect_list("item").alias("core"))
    none = F.expr("CAST(array() AS array<bigint>)")
    apart = staged(
        held.join(core, "grp", "left").withColumn("core", F.coalesce("core", none)).select(
            "node", "comp", "grp", F.array_except("core", "items").alias("lacks"), F.array_except("items", "core").alias("adds"),
            ((100 - percent) * F.size("core")).alias("slack"),
        ), "apart",
    )
    marked = F.concat(F.transform("lacks", lambda i: F.struct(F.lit(False).alias("adds"), i.alias("item"))),
                      F.transform("adds", lambda i: F.struct(F.lit(True).alias("adds"), i.alias("item"))))
    each_diff = apart.select("node", "grp", F.explode(marked).alias("d")).select("node", "grp", "d.*")
    often = each_diff.groupBy("grp", "adds", "item").agg(F.count("*").alias("f")).where("f > 1")
    shared = each_diff.join(often, ["grp", "adds", "item"]).groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("f", "adds", "item"))).alias("diff"),
    )
    no_diff = F.expr("CAST(array() AS array<struct<f:bigint,adds:boolean,item:bigint>>)")
    weighed = apart.join(shared, "node", "left").withColumn("diff", F.coalesce("diff", no_diff)).select(
        "node", "comp", "grp", "slack", "diff", F.size("lacks").alias("lacking"), F.size("adds").alias("beside"),
        (100 * F.size("lacks") + percent * F.size("adds")).alias("weight"),
    )
    # Nodes that share their group, sizes and shared differences have as much in common with any other.
    told = F.array_join(F.transform("diff", lambda d: F.concat(d["adds"].cast("string"), d["item"].cast("string"))), ",")
    name = F.unhex(F.sha2(F.concat_ws(" ", F.hex("grp"), "lacking", "beside", told), 256))
    return staged(weighed.withColumn("class", name).drop("lacking", "beside"), "weighed"), sets


def _undecided_links(docs: DataFrame, nodes: DataFrame, left: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that connect what is linked among the undecided nodes."""
    each, sets = _differences(docs, nodes, left, percent)
    lowest = each.groupBy("grp").agg(F.min(F.struct("weight", "node", "comp")).alias("low"))
    # Sets that differ little from the core are linked whatever they differ in: also with the one that differs least.
    little = each.join(lowest, "grp").where("weight + low.weight <= slack AND comp <> low.comp")
    pairs = little.select(F.col("low.node").alias("u"), F.col("node").alias("v"))
    classes = staged(each.groupBy("class", "grp", "slack", "weight").agg(
        F.min("node").alias("u"), F.first("diff").alias("diff"), F.min("comp").alias("low"), F.max("comp").alias("high"),
    ).join(lowest.select("grp", F.col("low.weight").alias("least")), "grp"), "classes")
    part = 100 + percent
    loose = classes.where("low <> high").select(
        "class", "u", F.expr(f"{part} * size(diff) >= 2 * weight - slack").alias("alike"),
    )
    others = each.select("class", F.col("node").alias("v")).join(loose, "class").where("u <> v")
    pairs = pairs.union(others.where("alike").select("u", "v"))
    # How many differences a link needs; the rarest ones hold at least one of these.
    needs = F.greatest(F.lit(1), F.ceil((F.col("weight") + F.col("least") - F.col("slack")) / part)).cast("int")
    seen = classes.select("grp", "u", "weight", "slack", "low", "high", F.size("diff").alias("d"), needs.alias("needs"), "diff").where("d >= needs")
    places = seen.select("grp", "u", "weight", "slack", "low", "high", "d", F.explode(F.expr("slice(diff, 1, d - needs + 1)")).alias("at"))
    places = places.select("*", "at.adds", "at.item").drop("at")
    theirs = places.select("grp", "adds", "item", *(F.col(c).alias(f"{c}2") for c in ("u", "weight", "low", "high", "d")))
    met = places.join(theirs, ["grp", "adds", "item"]).where(
        f"u < u2 AND NOT (low = high AND low2 = high2 AND low = low2) AND weight + weight2 > slack "
        f"AND {part} * least(d, d2) >= weight + weight2 - slack"
    ).select("u", "u2", (F.col("weight") + F.col("weight2") - F.col("slack")).alias("rest")).distinct()
    diffs = classes.select("u", "diff")
    close = staged(
        met.join(diffs, "u").join(diffs.select(F.col("u").alias("u2"), F.col("diff").alias("diff2")), "u2")
        .where(f"{part} * size(array_intersect(diff, diff2)) >= rest").select("u", F.col("u2").alias("v")), "close",
    )
    # A class in several components that aren't linked among themselves is linked through each of its members.
    apart = others.where("NOT alike").select(F.col("u").alias("w"), F.col("v").alias("member"))
    pairs = pairs.union(close).union(
        close.join(apart, F.col("v") == F.col("w")).select("u", F.col("member").alias("v")),
    ).union(close.join(apart, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("member").alias("v")))
    return _linked(docs, nodes, staged(pairs.distinct(), "pairs"), percent, sets)


def links(docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Node pairs (u, v) that connect all linked nodes: every link lies inside a component of them."""
    members = _members(nodes)
    pairs = members.where(f"node <> centre AND 100 * least(n, m) >= {percent} * greatest(n, m)")
    pairs = staged(pairs.select(F.col("centre").alias("u"), F.col("node").alias("v")).distinct(), "pairs")
    found = _linked(docs, nodes, pairs, percent)
    told = _with_component(members, components(found))
    live = told.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size"))
    # The centre of two was compared with the other, or their sizes differ too much.
    left = staged(told.join(live.where("low <> high AND size > 2").select("key"), "key"), "left")
    if not any_row(left):
        return found
    return found.union(_undecided_links(docs, nodes, left, percent))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; percent is the Jaccard threshold."""
    docs = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    bands = bands_for(percent)
    rows = staged(
        docs.mapInArrow(_sketch(bands), f"doc_id {kind}, n bigint, node binary, keys array<bigint>"), "sketch",
    )
    nodes = staged(
        rows.where("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("keys").alias("keys"),
        ), "nodes",
    )
    edges = links(docs, nodes, percent)
    # A doc_id with several texts joins the nodes of all of them.
    several = (
        rows.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
        .agg(F.min("node").alias("u"), F.max("node").alias("high")).where("u <> high")
        .select("doc_id", "u")
    )
    same = rows.select("doc_id", "node").join(several, "doc_id").where("node <> u").select("u", F.col("node").alias("v"))
    edges = staged(edges.union(same), "links")
    comps = components(edges)
    labelled = nodes.select("node", "id").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = labelled.groupBy("comp").agg(F.min("id").alias("component_id"))
    of_node = staged(labelled.join(lowest, "comp").select("node", "component_id"), "of_node")
    return (
        rows.select("doc_id", "n", "node").join(of_node, "node", "left")
        .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select(
            "doc_id", F.col("n").alias("n_shingles"), "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """The rows of docs that near_duplicates keeps, with all their columns. Of rows that repeat a doc_id the one with
    the greatest text stays; rows without a doc_id are told apart by their text and stay only where no row with a
    doc_id is in their group. Rows without words stay, one for each doc_id."""
    missing = F.col(id_col).isNull()
    names = [F.col(id_col)]
    if any_row(docs.where(missing)):
        # Without an id, a row is known by its text and comes behind all that have one.
        names = [missing.alias("_missing"), F.col(id_col), F.when(missing, F.sha2(text_of(text_col), 256)).alias("_text")]
    key = F.struct(*names) if len(names) > 1 else names[0]
    gone = near_duplicates(docs.select(key.alias("_key"), text_col), "_key", text_col, percent).where("NOT kept")
    kept = docs.withColumn("_own", key).join(gone.select(F.col("doc_id").alias("_gone")).distinct(), F.col("_own") == F.col("_gone"), "left_anti")
    repeated = kept.groupBy(F.col("_own").alias("_again")).count().where("count > 1").select("_again")
    repeated = staged(repeated, "repeated")
    if not any_row(repeated):
        return kept.drop("_own")
    again = F.col("_own") == F.col("_again")
    order = Window.partitionBy("_own").orderBy(F.desc(text_col))
    first = (
        kept.join(repeated, again, "left_semi").withColumn("_place", F.row_number().over(order))
        .where("_place = 1").drop("_place")
    )
    return kept.join(repeated, again, "left_anti").unionByName(first).drop("_own")

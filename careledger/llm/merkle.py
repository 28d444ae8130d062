"""A Merkle manifest of a dataset: a persistent tree of three branches, checked by copying paths.

A leaf is the digest of a row; a source's leaves, by id, are a tree, and the sources' roots another one. Leaves
get their places from a range sort, so a source of any size spreads over all tasks. A task holds blocks of BLOCK
neighbours, aligned to whole subtrees: one layer of blocks gives the leaves of the next, until one node is left.
Going back down, every block learns the siblings above it.

A changed leaf makes a version of its block's tree that copies only the leaf's ancestors and shares every
other node. Versions go on through the layers above by the siblings of their block, each on its own: no task sees
more versions than a block has leaves.

Defined results: nulls are leaves of their own form; rows that repeat an id stay leaves of their own, ordered by
digest; rows without an id come first and count as unchanged; without rows there is no tree and no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careledger.llm.common import any_row, staged

BRANCHES = 3
LEVELS = 7
BLOCK = BRANCHES**LEVELS
# Rows a task hands on at once.
ROWS = 5_000

NODES = "key string, pos bigint, total bigint, digest string"
PATHS = "key string, pos bigint, steps array<string>, tips array<string>"


def digest_of(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Tree:
    """The tree over a block's digests: up to one node where the block is the whole tree, else LEVELS high."""

    def __init__(self, digests: list[str], whole: bool):
        self.levels = [digests]
        while len(self.levels[-1]) > 1 if whole else len(self.levels) <= LEVELS:
            last = self.levels[-1]
            self.levels.append([digest_of(last[i:i + BRANCHES]) for i in range(0, len(last), BRANCHES)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def steps(self, at: int) -> list[str]:
        """What stands left and right of a leaf's ancestors in their runs, from the leaf up: left, right, left ..."""
        out = []
        for level in self.levels[:-1]:
            start = at - at % BRANCHES
            out += ["".join(level[start:at]), "".join(level[at + 1:start + BRANCHES])]
            at //= BRANCHES
        return out


class Version:
    """A tree with another leaf: its own copies of the leaf and its ancestors, all other nodes shared."""

    def __init__(self, base: Tree, at: int, leaf: str):
        self.base, self.at, self.copied = base, at, [leaf]
        for level in base.levels[:-1]:
            start = at - at % BRANCHES
            self.copied.append(digest_of([*level[start:at], self.copied[-1], *level[at + 1:start + BRANCHES]]))
            at //= BRANCHES

    @property
    def root(self) -> str:
        return self.copied[-1]

    def node(self, level: int, place: int) -> str:
        return self.copied[level] if place == self.at // BRANCHES**level else self.base.levels[level][place]


def folded(digest: str, steps: list[str]) -> str:
    """The root above a node, given what stands beside its ancestors."""
    for left, right in zip(steps[::2], steps[1::2]):
        digest = digest_of([left, digest, right])
    return digest


# --- places ---


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, numbered within each key of the task."""
    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = batch.column(0)
        new = np.ones(n, dtype=bool)
        new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        at = np.arange(n) - starts
        if keys[0].as_py() == last:
            at[starts == 0] += count
        last, count = keys[n - 1].as_py(), int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(at, pa.int64())],
            [*batch.schema.names, "part", "at"],
        )


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (key first) with pos, the place of a row within its key by order, from 0, and total, the key's rows. Staged."""
    key = rows.columns[0]
    kinds = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes)
    sorted_rows = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    numbered = staged(sorted_rows.mapInArrow(_number, f"{kinds}, part int, at bigint"), "numbered")
    # As many rows a key as there are tasks.
    counts = numbered.groupBy(key, "part").agg((F.max("at") + 1).alias("n"))
    of_key = Window.partitionBy(key)
    before = F.sum("n").over(of_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(key, "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(of_key).alias("total"))
    placed = numbered.join(counts, [key, "part"])
    return staged(placed.select(*rows.columns, (F.col("at") + F.col("before")).alias("pos"), "total"), "ranked")


# --- layers ---


def _block() -> Column:
    return F.expr(f"pos div {BLOCK}").alias("block")


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "block").sortWithinPartitions("key", "block", "pos")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[dict]]]:
    """key, block and rows of each block."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for (key, block), group in groupby(rows, lambda r: (r["key"], r["block"])):
        yield key, block, list(group)


def _emit(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_NODES = pa.schema([("key", pa.string()), ("pos", pa.int64()), ("total", pa.int64()), ("digest", pa.string())])
_PATHS = pa.schema([("key", pa.string()), ("pos", pa.int64()), ("steps", pa.list_(pa.string())), ("tips", pa.list_(pa.string()))])


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for key, block, nodes in _blocks(batches):
            total = nodes[0]["total"]
            yield key, block, -(-total // BLOCK), Tree([n["digest"] for n in nodes], total <= BLOCK).root

    yield from _emit(rows(), _NODES)


def layers(leaves: DataFrame) -> list[DataFrame]:
    """The leaves (key, pos, total, digest, ...), then the roots of their blocks, and so on up to one node a key."""
    out = [leaves]
    while any_row(out[-1].where("total > 1")):
        out.append(staged(_in_blocks(out[-1].select("key", "pos", "total", "digest", _block())).mapInArrow(_roots, NODES), "layer"))
    return out


def _descend(rows: Callable[[str, list[dict], dict], Iterable[tuple]], schema: pa.Schema):
    """Applies rows(key, nodes, parent) to each block; the parent's path is the block's first row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for key, _, (parent, *nodes) in _blocks(batches):
                if nodes:
                    yield from rows(key, nodes, parent)

        yield from _emit(each(), schema)

    return run


def _below(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """The nodes of a layer by block, each block headed by the path of its root."""
    head = parents.select("key", F.lit(-1).cast("bigint").alias("pos"), "steps", "tips", F.col("pos").alias("block"))
    return _in_blocks(nodes.select("*", _block()).unionByName(head, allowMissingColumns=True))


def _path_rows(key: str, nodes: list[dict], parent: dict) -> Iterator[tuple]:
    tree = Tree([n["digest"] for n in nodes], nodes[0]["total"] <= BLOCK)
    for at, node in enumerate(nodes):
        yield key, node["pos"], tree.steps(at) + parent["steps"], parent["tips"]


def paths(found: list[DataFrame], top: DataFrame, down_to: int) -> DataFrame:
    """key, pos, steps, tips of the nodes of layer down_to, from the path of each key's last node."""
    for layer in reversed(found[down_to:-1]):
        below = _below(layer.select("key", "pos", "total", "digest"), top)
        top = staged(below.mapInArrow(_descend(_path_rows, _PATHS), PATHS), "paths")
    return top


# --- manifests ---


def row_digest(columns: list[Column]) -> Column:
    """The digest of a row: each value by its length in bytes, so that no two rows read alike."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _checked(id_type: pa.DataType):
    schema = pa.schema([
        ("id", id_type), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
        ("proof_sha256", pa.string()), ("folded_root", pa.string()),
    ])

    def rows(key: str, nodes: list[dict], parent: dict) -> Iterator[tuple]:
        tree = Tree([n["digest"] for n in nodes], nodes[0]["total"] <= BLOCK)
        above, (subroot, root) = parent["steps"], parent["tips"]
        for at, node in enumerate(nodes):
            leaf, changed = node["digest"], node["changed"]
            version = Version(tree, at, leaf if changed is None else changed)
            yield node["id"], leaf, subroot, root, digest_of(tree.steps(at) + above), folded(version.root, above)

    return _descend(rows, schema)


def audit(docs: DataFrame, columns: list[str], changed: dict[str, Column], where: Column,
          id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of docs.

    A leaf is the digest of columns. Where the condition holds, a row is checked with the values in changed instead
    of its own; the proof is that of the untouched dataset. Rows with the same source are one tree.
    """
    own = [F.col(c) for c in columns]
    other = [changed.get(c, F.col(c)) for c in columns]
    # A null source comes before the empty one.
    key = F.coalesce(F.concat(F.lit("1"), F.col(source_col).cast("string")), F.lit("0"))
    leaves = staged(docs.select(
        key.alias("key"), F.col(id_col).alias("id"), row_digest(own).alias("digest"),
        F.when(where, row_digest(other)).alias("changed"), F.monotonically_increasing_id().alias("row"),
    ), "leaves")
    placed = ranked(leaves, ["id", "digest", "row"]).drop("row")
    found = layers(placed)
    subroots = found[-1].select(F.lit("").alias("key"), F.col("key").alias("source"), "digest")
    sources = ranked(subroots, ["source"])
    tops = layers(sources)
    root = tops[-1].first()
    none = F.expr("CAST(array() AS array<string>)")
    top = tops[-1].select("key", "pos", none.alias("steps"), none.alias("tips"))
    above = paths(tops, top, 0).withColumnRenamed("pos", "at").drop("key", "tips")
    start = sources.join(above, F.col("pos") == F.col("at")).select(
        F.col("source").alias("key"), F.lit(0).cast("bigint").alias("pos"), "steps",
        F.array("digest", F.lit(root["digest"] if root else None).cast("string")).alias("tips"),
    )
    if len(found) == 1:
        # Every source has one leaf: a block of its own below its path.
        parents = start
    else:
        parents = paths(found, start, 1)
    kind = docs.schema[id_col].dataType
    out = _below(placed, parents).mapInArrow(
        _checked(_arrow(placed, "id")),
        f"id {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string",
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)

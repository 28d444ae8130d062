"""Connected components of an edge list, by joins and partial aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from careledger.llm.common import staged

# Passes that are undone by one job.
UNDONE = 4


def _counted(edges: DataFrame) -> tuple[DataFrame, int]:
    """The edges staged, and their number, counted while they are written so that it costs no job."""
    seen = Observation()
    out = staged(edges.observe(seen, F.count("*").alias("rows")), "edges")
    return out, seen.get["rows"]


def components(edges: DataFrame) -> DataFrame:
    """node, comp: the smallest node reachable, for every node that an edge (u, v) names.

    Each pass merges every node into the first one of itself and its neighbours, in an order that
    is drawn anew for the pass, and goes on with the different edges between merged nodes. A pass
    leaves about half of the nodes or fewer whatever they form, chain or star, so all passes
    together read little more than the edges once. A hub's edges are only joined, and summed up in
    the map task first.
    """
    left, rows = _counted(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    passes = []
    while rows:
        both = left.union(left.select("v", "u")).toDF("node", "near")

        def drawn(column: str):
            return F.struct(F.xxhash64(F.lit(len(passes)), column).alias("place"), F.col(column).alias("node"))

        first = both.groupBy("node").agg(F.min(drawn("near")).alias("near"))
        merged = staged(first.select("node", F.least("near", drawn("node"))["node"].alias("into")), "merged")
        passes.append(merged)
        a, b = merged.toDF("u", "a"), merged.toDF("v", "b")
        left, rows = _counted(
            left.join(a, "u").join(b, "v").where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(),
        )
    if not passes:
        return left.toDF("node", "comp")
    ends = passes.pop()
    while passes:
        # Nodes that had no edge left after a pass stay what they were merged into.
        further = ends.toDF("at", "end")
        merged = passes.pop()
        ends = merged.join(further, F.col("into") == F.col("at"), "left").select("node", F.coalesce("end", "into").alias("into"))
        if not passes or len(passes) % UNDONE == 0:
            ends = staged(ends, "ends")
    lowest = ends.groupBy("into").agg(F.min("node").alias("comp"))
    return staged(ends.join(lowest, "into").select("node", "comp"), "labels")

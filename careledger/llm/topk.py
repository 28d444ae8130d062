"""Exact top-k by inner product with a pivot table (elimination by precomputed distances).

The index holds, for each vector, its distances to a few pivots. By the triangle inequality the
largest difference of the two vectors' distances to a pivot is a lower bound of their own distance,
and so gives an upper bound of their inner product. For each query, the candidates of a block are
looked at in the order of that bound, a few at a time, until the next bound is below the k-th best
score so far; what is left cannot enter the result.

Components are compared as floor(scale * x), integers, so scores are exact; bounds are widened by
more than their rounding error. Queries go to the tasks in rounds of bounded size, chosen by hash,
and every round passes over the whole index; a task keeps one block of candidates.

Defined results: vectors that are null, empty or hold null or non-finite components, and rows without
an id, take no part; ids with several vectors count once, with the smallest; vectors of another
dimension than most are refused with an error; fewer candidates than k give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careledger.llm.common import staged

SCALE = 256
PIVOTS = 16
# Vectors among which pivots are chosen, by hash of the id.
PIVOT_SAMPLE = 2_048
# Queries in a round, on average.
ROUND = 4_096
# Candidates in a block, queries compared with a block at once, candidates looked at first.
BLOCK, TILE, FIRST = 8_192, 64, 64


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(column) * width:
        raise ValueError(f"vectors must all have {width} components")
    return flat.reshape(len(column), width).astype(np.float64)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of a to all rows of b; both hold integers, so the squares are exact."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other, found greedily."""
    chosen = [int(np.argmax((sample * sample).sum(1)))]
    far = _apart(sample, sample[chosen])[:, 0]
    while len(chosen) < min(count, len(sample)) and far.max() > 0:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, _apart(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE):
    """(index, pivots): vec_id, v and its distances to the pivots, staged. Every usable row is in it."""
    rows = staged(
        vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
        .select(F.col(id_col).cast("bigint").alias("vec_id"), quantised(F.col(vector_col), scale).alias("v"))
        .groupBy("vec_id").agg(F.min("v").alias("v")), "vectors",
    )
    sample = [r["v"] for r in rows.orderBy(F.xxhash64("vec_id")).limit(PIVOT_SAMPLE).collect()]
    if not sample:
        return rows.withColumn("d", F.array().cast("array<double>")), np.zeros((0, 0))
    width = len(sample[0])
    pivots = spread(np.array([v for v in sample if len(v) == width], dtype=np.float64), PIVOTS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), width)
            d = _apart(v, pivots)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * len(pivots), pa.int32()), pa.array(d.ravel())),
            ], ["vec_id", "v", "d"])

    return staged(rows.mapInArrow(measure, "vec_id bigint, v array<bigint>, d array<double>"), "index"), pivots


def best(qid, q, ids, c, dc, pivots, k):
    """For each query, the ids and scores of its k best among one block of candidates."""
    dq, square_q, square_c = _apart(q, pivots), (q * q).sum(1), (c * c).sum(1)
    reach = np.zeros((len(q), len(c)))
    for p in range(len(pivots)):
        np.maximum(reach, np.abs(dq[:, p, None] - dc[None, :, p]), out=reach)
    slack = 1e-6 * (1 + square_q[:, None] + square_c[None, :])
    bound = (square_q[:, None] + square_c[None, :] - reach * reach) / 2 + slack
    bound[qid[:, None] == ids[None, :]] = -np.inf
    for i in range(len(q)):
        order = np.argsort(-bound[i], kind="stable")
        found_id, found = np.empty(0, np.int64), np.empty(0)
        at, step = 0, FIRST
        while at < len(order):
            look = order[at : at + step]
            if bound[i, look[0]] == -np.inf or len(found) == k and bound[i, look[0]] < found[-1]:
                break
            score = c[look] @ q[i]
            real = bound[i, look] != -np.inf
            found_id = np.concatenate([found_id, ids[look[real]]])
            found = np.concatenate([found, score[real]])
            top = np.lexsort((found_id, -found))[:k]
            found_id, found = found_id[top], found[top]
            at, step = at + step, step * 2
        yield i, found_id, found


def _search(queries: list[tuple[int, list[int]]], pivots: np.ndarray, k: int):
    qid = np.array([i for i, _ in queries], dtype=np.int64)
    q = np.array([v for _, v in queries], dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                block = batch.slice(start, BLOCK)
                ids = block.column(0).to_numpy()
                c, dc = _matrix(block.column(1), q.shape[1]), _matrix(block.column(2), len(pivots))
                out = [[], [], []]
                for at in range(0, len(q), TILE):
                    own = qid[at : at + TILE]
                    for i, found, score in best(own, q[at : at + TILE], ids, c, dc, pivots, k):
                        out[0].append(np.full(len(found), own[i]))
                        out[1].append(found)
                        out[2].append(score.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in out], ["query_id", "vec_id", "score"],
                )

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row its k highest inner products among all other
    rows, ties to smaller ids. is_query: a condition on vec_id."""
    table, pivots = index(vectors, id_col, vector_col, scale)
    asked = table.where(is_query).select("vec_id", "v")
    rounds = max(1, -(-asked.count() // ROUND))
    found = None
    for n in range(rounds):
        some = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == n).collect()
        if some:
            part = table.mapInArrow(
                _search([(r["vec_id"], r["v"]) for r in some], pivots, k), "query_id bigint, vec_id bigint, score bigint",
            )
            found = part if found is None else found.union(part)
    if found is None:
        found = table.where("false").selectExpr("vec_id AS query_id", "vec_id", "vec_id AS score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

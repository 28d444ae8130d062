"""Toxicity grades by cumulative-link ordinal regression on sparse word counts.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector for all grades, ordered thresholds.
x holds log(1 + count) of the words that go with toxic labels (or against them) by a z-test on
document frequencies, counts in texts of more than RELATIVE words as for RELATIVE of them. A text of more
than PASSAGE words is read in passages, and the highest score counts. The result is the expected grade, sum over k of P(grade >= k).

Labels say toxic or not. grades() derives ordered grades from them: 0 for rows that aren't toxic; 1, 2,
3 for toxic ones by thirds of how many words they hold that go with the label (1 without any). fit()
takes any ordered grades. It uses a bounded sample of labelled rows (SAMPLE_ROWS, by hash); scoring
covers whole texts of all rows and moves none.

Defined results: a null or empty text has no words and gets the grade of the thresholds alone; labels
that are null, or of no document, take no part; a document labelled twice is toxic if one says so;
repeated rows are scored alike; without labelled rows of both kinds there is no model, every expected
grade is 0 and nothing is toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.llm.common import staged, text_of

# Labelled rows for the fit, on average; features at most; documents a feature must stand in; its z.
SAMPLE_ROWS = 50_000
FEATURES = 2_048
LEAST_DOCS, LEAST_Z = 6, 4.5
GRADES = 4
# Words of a text to which the counts of longer ones are scaled; words read together.
RELATIVE, PASSAGE = 200, 2_000
STEPS, RATE, PENALTY = 400, 0.1, 1e-4
# Probability of grade 1 or more from which a document is toxic.
TOXIC = 0.5

_WORDS = re.compile(r"[^\W\d_]+")


def relative(n_words):
    """The factor of counts in a text of so many words."""
    return RELATIVE / np.maximum(n_words, RELATIVE)


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)

    def score(self, text: str | None) -> float:
        found = _WORDS.findall((text or "").lower())
        # Passages of about one size, so that none is a short rest.
        parts = max(1, -(-len(found) // PASSAGE))
        cuts = [len(found) * i // parts for i in range(parts + 1)]
        return max(self._passage(found[a:b]) for a, b in zip(cuts, cuts[1:]))

    def _passage(self, found: list[str]) -> float:
        counts = Counter(w for w in found if w in self.weights)
        scale = relative(len(found))
        return sum(self.weights[w] * np.log1p(n * scale) for w, n in sorted(counts.items()))

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., a row for each score."""
        if not self.thresholds:
            return np.zeros((len(scores), GRADES - 1))
        return 1 / (1 + np.exp(np.array(self.thresholds)[None, :] - np.asarray(scores)[:, None]))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample_rows: int) -> DataFrame:
    """doc_id, text, toxic of a bounded sample of labelled rows, staged."""
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col("toxic").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IS NOT NULL"
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = marks.count()
    if total > sample_rows:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * sample_rows / total)))
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    # The sample is bounded, and so is what is sent to every task.
    return staged(texts.join(F.broadcast(marks), "doc_id"), "labelled")


def indicators(rows: DataFrame) -> list[tuple[str, float]]:
    """(word, z) of words whose documents are toxic more, or less, often than chance allows."""
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    share = total["t"] / max(total["n"], 1)
    if not 0 < share < 1:
        return []
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}]+)"), F.lit(1)))
    z = (F.col("t") - share * F.col("n")) / F.sqrt(F.col("n") * share * (1 - share))
    found = (
        rows.select("toxic", F.explode(words).alias("word")).groupBy("word")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).where(F.col("n") >= LEAST_DOCS)
        .withColumn("z", z).where(F.abs("z") >= LEAST_Z).orderBy(F.desc(F.abs("z")), "word").limit(FEATURES)
    )
    return [(r["word"], r["z"]) for r in found.collect()]


def ordered(rows: DataFrame) -> DataFrame:
    """The rows by doc_id and text. Ranges are of doc_id alone: Spark draws their bounds from keys that it
    collects, which would be most of the texts."""
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")


def features(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    """toxic, at, n, size: the vocabulary words of each row, how often they occur, and the number of its words."""
    place = {w: i for i, w in enumerate(vocabulary)}

    @F.pandas_udf("struct<at:array<int>,n:array<int>,size:int>")
    def counts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            split = [_WORDS.findall(t.lower()) for t in part]
            found = [sorted(Counter(place[w] for w in words if w in place).items()) for words in split]
            yield pd.DataFrame({
                "at": [[i for i, _ in f] for f in found], "n": [[n for _, n in f] for f in found], "size": [len(w) for w in split],
            })

    return rows.select(*[c for c in rows.columns if c != "text"], counts("text").alias("x")).select("*", "x.at", "x.n", "x.size").drop("x")


def grades(toxic: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Ordered grades of labelled rows, from the label and the number of words that go with it."""
    out = np.where(toxic > 0, 1, 0)
    some = hits[(toxic > 0) & (hits > 0)]
    if len(some):
        low, high = np.quantile(some, [1 / 3, 2 / 3])
        out = np.where((toxic > 0) & (hits > low), 2, out)
        out = np.where((toxic > 0) & (hits > high), 3, out)
    return out


def fit_ordinal(row: np.ndarray, col: np.ndarray, x: np.ndarray, y: np.ndarray, width: int, n_grades: int = GRADES):
    """(w, thresholds) of the most likely penalised model; row, col, x: the entries of a sparse matrix,
    y: grades from 0. Adam on w and on the thresholds' first value and log gaps."""
    n, k = len(y), n_grades - 1
    above = np.array([(y >= g).mean() for g in range(1, n_grades)]).clip(1e-4, 1 - 1e-4)
    start = np.log((1 - above) / above)
    theta = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    p = np.concatenate([np.zeros(width), theta])
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda a: 1 / (1 + np.exp(-np.clip(a, -40, 40)))
    at = np.arange(n)
    for step in range(1, STEPS + 1):
        cuts = p[width] + np.concatenate([[0.0], np.cumsum(np.exp(p[width + 1:]))])
        s = np.bincount(row, weights=p[col] * x, minlength=n)
        below = np.concatenate([np.zeros((n, 1)), sigmoid(cuts[None, :] - s[:, None]), np.ones((n, 1))], axis=1)
        density = below * (1 - below)
        chance = np.maximum(below[at, y + 1] - below[at, y], 1e-12)
        # d log P / d cut is +density at the upper cut of a row's grade and -density at its lower one.
        up, low = density[at, y + 1] / chance, density[at, y] / chance
        slope = np.zeros((n, k + 2))
        slope[at, y + 1] += up
        slope[at, y] -= low
        by_cut = slope[:, 1:-1].sum(0)
        g = np.empty_like(p)
        g[:width] = np.bincount(col, weights=x * (low - up)[row], minlength=width)
        g[width] = by_cut.sum()
        g[width + 1:] = np.exp(p[width + 1:]) * by_cut[::-1].cumsum()[::-1][1:]
        g = -g / n
        g[:width] += PENALTY * p[:width]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:width], p[width] + np.concatenate([[0.0], np.cumsum(np.exp(p[width + 1:]))])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample_rows: int = SAMPLE_ROWS) -> Model:
    rows = labelled(docs, labels, id_col, text_col, sample_rows)
    words = indicators(rows)
    if not words:
        return Model()
    # At most SAMPLE_ROWS rows of at most FEATURES counts.
    seen = features(ordered(rows), [w for w, _ in words]).toPandas()
    sizes = seen["at"].map(len).to_numpy()
    row = np.repeat(np.arange(len(seen)), sizes)
    col = np.concatenate(seen["at"].to_numpy()).astype(np.int64)
    count = np.concatenate(seen["n"].to_numpy()).astype(np.float64)
    count = count * relative(seen["size"].to_numpy(dtype=np.float64))[row]
    toward = np.array([z > 0 for _, z in words], dtype=float)
    hits = np.bincount(row, weights=count * toward[col], minlength=len(seen))
    y = grades(seen["toxic"].to_numpy(), hits)
    w, cuts = fit_ordinal(row, col, np.log1p(count), y, len(words))
    return Model({word: float(a) for (word, _), a in zip(words, w)}, [float(c) for c in cuts])


def graded(model: Model, text: str = "text") -> Column:
    """Struct of score, expected_grade, p_toxic, grade (the likeliest) and toxic, from a text column."""

    @F.pandas_udf("struct<score:double,expected_grade:double,p_toxic:double,grade:int,toxic:boolean>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            score = np.array([model.score(t) for t in part], dtype=np.float64)
            above = model.above(score)
            each = np.concatenate([np.ones((len(part), 1)), above], axis=1) - np.concatenate([above, np.zeros((len(part), 1))], axis=1)
            yield pd.DataFrame({
                "score": score, "expected_grade": above.sum(1), "p_toxic": above[:, 0],
                "grade": each.argmax(1).astype("int32"), "toxic": above[:, 0] >= TOXIC,
            })

    return run(F.col(text).cast("string"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are not toxic, with all their columns."""
    return docs.where(~graded(fit(docs, labels, id_col, text_col), text_col)["toxic"])

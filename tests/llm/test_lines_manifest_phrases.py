"""Line dedup, manifests and collocations against plain code, on edge rows and hot groups."""

import hashlib
import random
import tracemalloc
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from careledger.llm import collocations, common, linededup, merkle

LONG = "a line that is long enough to be dropped {} times over"


# --- lines ---


def plain_lines(rows):
    """id -> lines, lost and the text that stays; ids are unique."""
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))

    holders = {}
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 40:
                holders.setdefault(k, []).append(i)
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= 5}
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(key(x), i) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def cleaned(df):
    return {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in linededup.dedup_lines(df).collect()}


@given(st.sets(st.integers(0, 2**128 - 1), max_size=300))
@settings(max_examples=50, deadline=None)
def test_perfect_hash(keys):
    high, low = (np.array([k >> s & (2**64 - 1) for k in keys], dtype=np.uint64) for s in (64, 0))
    index = linededup.PerfectHash.build(high, low)
    assert sorted(index.place(high, low)) == list(range(len(keys)))
    other = index.place(~high, low)
    assert ((other >= -1) & (other < max(len(keys), 1))).all()


def test_perfect_hash_of_many():
    high, low = np.random.default_rng(1).integers(0, 2**64, (2, 200_000), dtype=np.uint64)
    index = linededup.PerfectHash.build(high, low)
    assert (np.sort(index.place(high, low)) == np.arange(200_000)).all()
    assert sum(b.nbytes for b in index.levels) * 8 < 5 * 200_000


ROWS = [
    (1, None), (2, ""), (3, "\n\n"), (4, LONG.upper() + "\r\nshort"), (5, f" \t{LONG}\v\n{LONG}"), (6, f"x\n{LONG}"),
    (7, LONG + "\n" + LONG.replace("line", "LINE")), (8, LONG), (9, LONG + " "), (10, "é" * 40), (11, "é" * 40), (12, "é" * 40),
    (13, "É" * 40), (14, "é" * 40), (15, "é" * 40 + "\n" + "é" * 39), (16, "\n".join(["y" * 50] * 3000)),
    *((i, "y" * 50 + "\n" + "z" * 39) for i in range(17, 25)),
]


def test_lines_of_edge_rows(spark):
    assert cleaned(spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)) == plain_lines(ROWS)


def test_lines_in_many_shards_and_copies(spark, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 7)
    monkeypatch.setattr(linededup, "PROBES", 50)
    draw = random.Random(3)
    lines = [f"{LONG}{i}" for i in range(60)] + ["short"]
    rows = [(i, "\n".join(["everywhere " * 5, *draw.choices(lines, k=draw.randrange(6))])) for i in range(400)]
    assert cleaned(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == plain_lines(rows)


def test_lines_of_repeated_and_missing_ids(spark):
    rows = [(1, LONG)] * 6 + [(None, LONG)] * 6 + [(i, LONG) for i in range(2, 5)]
    assert all(r["n_dropped"] == 0 for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    rows += [(5, LONG)]
    got = Counter((r["doc_id"], r["n_dropped"], r["text"]) for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == {(1, 1, ""): 6, (None, 0, LONG): 6, **{(i, 1, ""): 1 for i in range(2, 5)}, (5, 0, LONG): 1}


def test_lines_of_an_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n_lines string, shard int")
    assert linededup.dedup_lines(empty).collect() == []
    rows = [(i, LONG, "own", 7, 8) for i in range(5)]
    out = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, id string, _id int, shard int")).collect()
    assert {(r["doc_id"], r["id"], r["_id"], r["shard"], r["n_dropped"]) for r in out} == {(i, "own", 7, 8, int(i < 4)) for i in range(5)}


# --- manifests ---


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_siblings(levels, at):
    out = []
    for level in levels[:-1]:
        start = at // 3 * 3
        out.append((level[start:at], level[at + 1:start + 3]))
        at //= 3
    return out


def plain_audit(rows, tampered):
    """id -> leaf, subroot, root, proof, folded root; rows (id, source, text) with unique ids."""
    def leaf(i, source, text):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, text)))

    of = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        of.setdefault(row[1], []).append(row)
    order = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([leaf(*r) for r in of[s]]) for s in order}
    top = plain_tree([trees[s][-1][0] for s in order])
    out = {}
    for place, s in enumerate(order):
        for at, row in enumerate(of[s]):
            steps = plain_siblings(trees[s], at) + plain_siblings(top, place)
            own = folded = leaf(*row)
            if tampered(row[0]):
                folded = leaf(row[0], row[1], None if row[2] is None else row[2].replace("\n", ""))
            for before, behind in steps:
                folded = h(*before, folded, *behind)
            out[row[0]] = (own, trees[s][-1][0], top[-1][0], h(*(x for a, b in steps for x in [*a, *b])), folded, folded == top[-1][0])
    return out


def audited(df, **columns):
    cut = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    where = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    out = merkle.audit(df, ["doc_id", "source", "text"], cut, where)
    return out.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()


def even_crc(i):
    return i is not None and zlib.crc32(str(i).encode()) % 2 == 0


@pytest.mark.parametrize("count", [1, 2, 4, 10, 3 * merkle.BLOCK + 5])
def test_audit_against_plain_trees(spark, count):
    draw = random.Random(count)
    names = ["hot"] * 6 + [None, "", "é", "z", "src1"]
    rows = [(i, draw.choice(names), draw.choice([None, "", "a\nb", "ab", f"{i}\n"])) for i in range(count)]
    rows.append((None, "hot", "no id\n"))
    got = audited(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4))
    assert {r[0]: tuple(r)[1:] for r in got} == plain_audit(rows, even_crc) and len(got) == len(rows)


def test_audit_of_one_hot_source(spark):
    rows = [(i, "all", f"{i}\n") for i in range(2 * merkle.BLOCK)]
    got = audited(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7))
    assert {r[0]: tuple(r)[1:] for r in got} == plain_audit(rows, even_crc)
    assert {r["id"]: r["verified"] for r in got} == {i: not even_crc(i) for i, _, _ in rows}


def test_audit_of_repeated_rows_and_none(spark):
    rows = [(1, "s", "a")] * 7 + [(1, "s", "b")]
    got = audited(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    leaves = sorted(h("1:1", "1:s", f"1:{t}") for _, _, t in rows)
    assert len(got) == 8 and {r["root"] for r in got} == {plain_tree(leaves)[-1][0]} and all(r["verified"] for r in got)
    assert audited(spark.createDataFrame([], "doc_id long, source string, text string, key string")) == []


def test_versions_share_all_but_the_path():
    digests = [h(str(i)) for i in range(merkle.BLOCK)]
    tree = merkle.Tree(digests, True)
    version = merkle.Version(tree, 1000, h("other"))
    changed = [*digests[:1000], h("other"), *digests[1001:]]
    whole = merkle.Tree(changed, True)
    assert version.root == whole.root != tree.root and len(version.copied) == merkle.LEVELS + 1
    assert all(version.node(level, at) == d for level, row in enumerate(whole.levels) for at, d in enumerate(row))
    assert merkle.folded(h("other"), tree.steps(1000)) == version.root


# --- collocations ---


def plain_phrases(rows, least, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            totals["und" if lang is None else lang] += len(words)
            for k in range(1, 5):
                own.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        for g, a in candidates.items():
            longer = (b for q, b in candidates.items() if len(q) > len(g) and any(q[i:i + len(g)] == g for i in range(len(q) - len(g) + 1)))
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, k = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def mined(df, least, top=collocations.TOP):
    return sorted(tuple(r) for r in collocations.collocations(df, min_count=least, top=top).collect())


TEXTS = [
    ("en", "New York is big. New York is old, NEW YORK is new!"), ("en", "new\tyork  is big\r\nnew york"), ("en", None), ("en", ""),
    (None, "a a a a a a a a"), ("und", "a a\nb"), ("fr", "lé chât, lé chât; Été été"), ("fr", " x  \x00 \x1c y.  x  \x00 \x1c y"),
    ("de", "w" * 3000 + " b " + "w" * 3000 + " b"), ("", "no name no name"), ("en", " . , ;"),
]


@pytest.mark.parametrize("least, top", [(1, 2000), (2, 2000), (2, 3)])
def test_phrases_of_edge_texts(spark, least, top):
    df = spark.createDataFrame(TEXTS, "lang string, text string")
    assert mined(df, least, top) == plain_phrases(TEXTS, least, top)


def test_phrases_of_random_texts(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    rows = [(draw.choice("ab"), " ".join(draw.choices(words, weights=[1 / (i + 1) for i in range(30)], k=200)).replace("w3 ", "w3. ")) for _ in range(60)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert mined(df.repartition(5), 30, 50) == plain_phrases(rows, 30, 50)


def test_more_frequent_words_and_pairs_than_ranks(spark):
    words = [f"w{i}" for i in range(collocations.HEAD + 4_000)]
    rows = [("en", " ".join(words))] * 2 + [("en", " ".join(words[::-1][:3000]))]
    got = mined(spark.createDataFrame(rows, "lang string, text string"), 2, 10**9)
    # Every window of the repeated text is a phrase; only the longest stay.
    assert len(got) == len(words) - 3
    assert {r[2] for r in got} == {" ".join(words[i:i + 4]) for i in range(len(words) - 3)}
    count = Counter(w for _, t in rows for w in t.split(" "))
    assert all(r[3] == 2 and r[6] == 2 * len(words) + 3000 for r in got)
    first = {w: n for w, n in count.items()}
    for _, _, phrase, a, l, r, _, score in got:
        assert score == min(2_000_000 * a // (first[phrase.split()[0]] + 2), 1_000_000, 2_000_000 * a // (2 + first[phrase.split()[3]]))


def test_no_texts_have_no_phrases(spark):
    assert mined(spark.createDataFrame([], "lang string, text string"), 1) == []
    assert mined(spark.createDataFrame([("en", None), (None, "")], "lang string, text string"), 1) == []


def test_tiles_count_all_pairs():
    draw = np.random.default_rng(7)
    codes = np.concatenate([draw.integers(0, 300, collocations.DENSE + 100), draw.zipf(1.3, 200_000) % collocations.HEAD])
    got, thin = Counter(), 0
    for tiles, starts, cells, counts in collocations.tile_counts(codes[:-1], codes[1:]):
        of = np.repeat(tiles, np.diff(starts, append=len(cells)))
        thin += len(tiles) > 1
        left = of // collocations._ACROSS * collocations.SIDE + cells // collocations.SIDE
        right = of % collocations._ACROSS * collocations.SIDE + cells % collocations.SIDE
        for x, y, n in zip(left.tolist(), right.tolist(), counts.tolist()):
            assert (x, y) not in got
            got[x, y] = n
    assert got == Counter(zip(codes[:-1].tolist(), codes[1:].tolist())) and thin == 1
    tail = collocations._TAIL + draw.integers(0, 50, 1000)
    a, b, n = collocations.tail_counts(tail[:-1], tail[1:])
    assert Counter(dict(zip(zip(a.tolist(), b.tolist()), n.tolist()))) == Counter(zip(tail[:-1].tolist(), tail[1:].tolist()))


def test_tiles_are_counted_in_little_memory():
    draw = np.random.default_rng(9)
    n = 3_000_000
    left, right = draw.integers(0, collocations.HEAD, (2, n), dtype=np.int32)
    tracemalloc.start()
    total = sum(int(counts.sum()) for _, _, _, counts in collocations.tile_counts(left, right))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == n and peak < 30 * n


def test_pairs_of_a_task_beyond_its_arrays(spark, monkeypatch):
    rows = [("en", "alpha beta gamma alpha beta. " * 40)] * 3
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    out = []
    for name, value in (("HEAD", collocations.HEAD), ("PAIRS", 7)):
        monkeypatch.setattr(collocations, name, value)
        out.append(mined(df, 5))
    assert out[0] == out[1] == plain_phrases(rows, 5, 2000)


def test_pairs_beyond_the_ranks_are_packed_and_summed(monkeypatch):
    monkeypatch.setattr(collocations, "TAILS", 500)
    draw = np.random.default_rng(10)
    want, rows = Counter(), []
    for _ in range(30):
        left, right = collocations._TAIL + draw.integers(0, 40, (2, 400))
        n = draw.integers(1, 5, 400)
        for x, y, k in zip(left.tolist(), right.tolist(), n.tolist()):
            want[x, y] += k
        packed = collocations._bucketed(*collocations.tail_counts(left, right, n), 16)
        # One row a bucket, not one a pair.
        assert packed.num_rows <= 16
        rows += packed.select(["bucket", "lefts", "rights", "counts"]).to_pylist()
    batch = pa.RecordBatch.from_pylist(sorted(rows, key=lambda row: row["bucket"]))
    got = {}
    for found in collocations._frequent_tails(20)(iter([batch.slice(0, 7), batch.slice(7)])):
        ids, left, right, n = (c.to_numpy() for c in found.columns)
        assert (ids == collocations.pair_ids(left, right)).all()
        got.update(zip(zip(left.tolist(), right.tolist()), n.tolist()))
    assert got == {pair: n for pair, n in want.items() if n >= 20} and len(got) < len(want)


def test_a_stage_of_pairs_starts_one_python_worker_a_task(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(collocations, "staged", lambda df, name: (plans.append((name, df)), common.staged(df, name))[1])
    mined(spark.createDataFrame([("en", "alpha beta gamma. " * 9)], "lang string, text string"), 5)
    pairs = [df._jdf.queryExecution().executedPlan().toString() for name, df in plans if name == "pairs"]
    assert pairs and all("MapInArrow" in plan and "ArrowEvalPython" not in plan for plan in pairs)


def test_sums_of_tiles_thin_and_dense():
    draw = np.random.default_rng(8)
    for parts in (3, 40):
        total, want = collocations._Sum(), np.zeros(collocations._CELLS, dtype=np.int64)
        for _ in range(parts):
            cells = np.unique(draw.integers(0, collocations._CELLS, 20_000)).astype("<u4")
            counts = draw.integers(1, 9, len(cells))
            total.add(cells, counts)
            want[cells] += counts
        cells, counts = total.counts()
        assert (cells == np.flatnonzero(want)).all() and (counts == want[cells]).all() and (total.dense is None) == (parts == 3)


def test_many_tasks_are_summed_in_steps(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SPAN", 2)
    rows = [("en", f"alpha beta gamma. beta gamma delta {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(9)
    assert mined(df, 5) == plain_phrases(rows, 5, 2000)


def test_streams_keep_one_break():
    codes = np.array([-1, -1, 4, 5, -1, -1, -1, 6, -1])
    assert collocations.compacted(codes).tolist() == [-1, 4, 5, -1, 6, -1]
    assert collocations.compacted(codes[:0]).tolist() == []

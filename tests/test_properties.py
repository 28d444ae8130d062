"""Random input against a plain Python statement of the rule."""

import math
import random

from pyspark.sql import functions as F

from careledger.functions.names import number_clashes, safe_name
from careledger.functions.values import parse_value
from careledger.operators.merge import upsert
from careledger.operators.numbering import batch_rows, chunks


def test_numbers_are_what_float_takes(spark):
    rng = random.Random(1)
    pieces = ["1", "23", "0", "_", ".", "e", "E", "+", "-", "nan", "inf", "infinity", "d", "x", " ", "\t", ","]
    texts = sorted({"".join(rng.choices(pieces, k=rng.randint(1, 6))) for _ in range(6000)})
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for text, (string, double) in zip(texts, (tuple(r) for r in df.select(*parse_value(F.col("v"))).collect())):
        try:
            want = float(text)
        except ValueError:
            assert (string, double) == (text.strip() or None, None), text
        else:
            assert string is None and (double == want or (math.isnan(want) and math.isnan(double))), text


def test_names_are_safe_and_unique(spark):
    rng = random.Random(2)
    names = sorted({"".join(rng.choices("aAéÉ1_ -(),ﬁß", k=rng.randint(0, 5))) for _ in range(800)})
    df = spark.createDataFrame([(n,) for n in names], "name string")
    bases = dict(tuple(r) for r in df.select("name", safe_name(F.col("name"))).collect())
    unique = number_clashes(bases)
    assert len(set(unique.values())) == len(names)
    assert all(c in "abcdefghijklmnopqrstuvwxyz0123456789_" and not b[0].isdigit() for b in bases.values() for c in b)


def test_upsert_is_a_dictionary_update(spark):
    rng = random.Random(3)
    old = {f"k{rng.randint(0, 200)}": (rng.random(), "old") for _ in range(150)}
    events = [(f"k{rng.randint(0, 300)}", rng.random(), "new", n) for n in range(400)]
    want = dict(old)
    last = {}
    for key, value, note, _ in events:
        last[key] = (value, note)
    for key, (value, note) in last.items():
        want[key] = (value, old[key][1] if key in old else note)
    target = spark.createDataFrame([(k, *v) for k, v in old.items()], "k string, v double, note string")
    updates = spark.createDataFrame(events, "k string, v double, note string, seq int")
    for small in (False, True):
        merged = upsert(target, updates, ["k"], ["v"], order=["seq"], small_updates=small)
        assert {r.k: (r.v, r.note) for r in merged.collect()} == want


def test_chunks_and_batches_lose_nothing(spark):
    rng = random.Random(4)
    lists = [[f"i{n}" for n in range(rng.randint(0, 45))] for _ in range(60)]
    df = spark.createDataFrame([(ids,) for ids in lists], "ids array<string>")
    for size in (1, 7, 10):
        for ids, (cut,) in zip(lists, df.select(chunks(F.col("ids"), size)).collect()):
            assert [i for c in cut or [] for i in c] == ids
            assert all(len(c) == size for c in (cut or [])[:-1])
    keys = [f"key {rng.random()}" for _ in range(501)]
    rows = batch_rows(spark.createDataFrame([(k,) for k in keys], "k string"), "k", 10).collect()
    assert sorted(r.k for r in rows) == sorted(keys)
    assert {r.batch for r in rows} == set(range(51))

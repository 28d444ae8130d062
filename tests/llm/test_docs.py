"""Operators over documents: brute force, and the cases that their docstrings define."""

import random

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from careledger.llm import decontaminate, licences, neardup, packing, pii, token_scan, toxicity
from careledger.llm.common import staged
from careledger.llm.tokens import Encoder
from tests.llm import brute

TOKENIZER = path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, component_id string, node string, n int, _x string"
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "tu", "ra") for b in ("ben", "dor", "fal", "gim", "sul", "vet")]


def docs(spark, rows):
    """With further columns, some named as the operators name theirs."""
    return spark.createDataFrame([(i, t, "c", "n", 1, "x") for i, t in rows], SCHEMA)


def prose(draw, n):
    return " ".join(draw.choice(WORDS) for _ in range(n))


def variants(seed=3):
    """Groups of copies with few and many changes, short, empty and null texts."""
    draw = random.Random(seed)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE two"), (6, "one two three four five")]
    at = 10
    for _ in range(6):
        words = prose(draw, draw.choice([12, 60, 150])).split()
        for changes in (0, 0, 1, 1, 2, 3, 5, 8):
            copy = list(words)
            for _ in range(changes):
                copy[draw.randrange(len(copy))] = draw.choice(WORDS)
            rows.append((at, " ".join(copy)))
            at += 1
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_all_pairs(spark, percent):
    rows = variants()
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs(spark, rows), percent=percent).collect()}
    want = brute.near(dict(rows), percent)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_near_duplicates_without_rows_ids_or_uniqueness(spark):
    text = "a b c d e f g h"
    assert neardup.near_duplicates(docs(spark, [])).count() == 0
    rows = [(7, text), (7, text), (None, text), (None, "x y z u v w"), (9, text), (7, "p q r s t u"), (11, "p q r s t u")]
    out = sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in neardup.near_duplicates(docs(spark, rows)).collect())
    assert [x[2] for x in out if x[0] == "7"] == ["7", "7", "7"]
    assert [x[2:] for x in out if x[0] in ("9", "11")] == [("7", False), ("7", False)]
    assert sorted(x[2:] for x in out if x[0] == "None") == [("7", False), ("None", True)]
    kept = neardup.one_of_each(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "component_id", "node", "n", "_x"]
    # The row without an id that repeats the text of 7 goes as any copy does.
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 7]


def test_links_between_members_unlike_the_centre_are_found(spark):
    draw = random.Random(5)
    base = prose(draw, 120).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 40):  # pairs of variants, each pair far from the base and from other pairs
        copy = list(base)
        for _ in range(9):
            copy[draw.randrange(120)] = f"w{i}"
        rows += [(2 * i, " ".join(copy)), (2 * i + 1, " ".join([*copy[:-1], f"v{i}"]))]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs(spark, rows), percent=85).collect()}
    assert got == {i: c for i, (_, c) in brute.near(dict(rows), 85).items()}


def edited(draw, base, edits, of=lambda: None):
    copy = list(base)
    for at in draw.sample(range(len(base)), edits):
        copy[at] = of() or f"e{draw.randrange(10**9)}"
    return " ".join(copy)


@pytest.mark.parametrize("words", [30, 140])
@pytest.mark.parametrize("base_is_there", [True, False])
def test_large_groups_of_near_copies_lose_no_link(spark, words, base_is_there):
    draw = random.Random(words)
    base = prose(draw, words).split()
    rows = [(i, edited(draw, base, draw.choice([1, 1, 2, 2, 3, 4, 6]), draw.choice([lambda: None, lambda: draw.choice(WORDS)]))) for i in range(1, 250)]
    # Variants of variants, and texts that only share a passage.
    rows += [(1000 + i, edited(draw, rows[i][1].split(), 1)) for i in range(60)]
    rows += [(2000 + i, " ".join(base[: words // 2]) + " " + prose(draw, draw.choice([2, words // 2]))) for i in range(40)]
    if base_is_there:
        rows.append((0, " ".join(base)))
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs(spark, rows), percent=85).collect()}
    assert got == {i: c for i, (_, c) in brute.near(dict(rows), 85).items()}


def test_pairs_of_a_large_group_stay_few(spark, monkeypatch):
    draw = random.Random(9)
    base = prose(draw, 150).split()
    rows = [(i, edited(draw, base, draw.choice([1, 2, 3, 4]))) for i in range(4000)]
    counts, linked = [], neardup._linked

    def counted(docs, nodes, pairs, *rest):
        counts.append(pairs.count())
        return linked(docs, nodes, pairs, *rest)

    monkeypatch.setattr(neardup, "_linked", counted)
    neardup.near_duplicates(docs(spark, rows), percent=85)
    # All pairs would be 8 million.
    assert sum(counts) < 25 * len(rows)


def test_rows_without_ids_link_and_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(None, text), (None, text), (None, text + " x"), (5, text + " y"), (None, "other words that nobody else has here"), (None, None)]
    out = sorted((str(r["doc_id"]), str(r["component_id"])) for r in neardup.near_duplicates(docs(spark, rows)).collect())
    assert out == [("5", "5"), ("None", "5"), ("None", "5"), ("None", "5"), ("None", "None"), ("None", "None")]
    kept = neardup.one_of_each(docs(spark, rows + [(None, rows[4][1])]))
    assert sorted(str(r["text"]) for r in kept.collect()) == ["None", "other words that nobody else has here", text + " y"]


def test_copies_cost_no_pairs(spark):
    rows = [(i, "the same words again and again in every text") for i in range(500)]
    out = neardup.near_duplicates(docs(spark, rows)).agg(F.countDistinct("component_id"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(out) == (1, 1)


def test_encoder_gives_the_tokenizers_ids():
    plain, ordinary = Encoder(TOKENIZER), Encoder(TOKENIZER, ordinary=True)
    texts = ["", " ", "a  b", "a \n\n b", "it's 'll", "x<|endoftext|> y", "é　​ \U0001f642", "\x00\x1c b", "x" * 9000]
    for encoder in (plain, ordinary):
        assert encoder.encode(texts) == [encoder.whole(t) for t in texts]
    other = Encoder(path("word_bpe_49k.json"))
    assert other.encode(["Some words"]) == [other.whole("Some words")]


def pack_rows():
    draw = random.Random(1)
    return [(1, None), (2, ""), (2, ""), (None, "x")] + [(i, prose(draw, draw.choice([3, 30, 400, 900]))) for i in range(3, 40)]


def test_packing_keeps_every_id_once(spark):
    rows = pack_rows()
    packed = packing.pack(staged(packing.pieces(docs(spark, rows).repartition(3), TOKENIZER, 64), "t"), 64).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    whole = sorted(
        np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes() for _, t in rows
    )
    by_doc, by_sequence = {}, {}
    for r in packed:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], bytes(r["ids"])))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    single = [b"".join(x for _, x in sorted(v)) for k, v in by_doc.items() if k[0] != 2]
    assert sorted(single) == [w for w in whole if w != np.array([0], "<u4").tobytes()] + [] or sorted(
        single + [np.array([0], "<u4").tobytes()] * 2) == whole
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    used = sum(r["length"] for r in packed)
    assert len(by_sequence) <= -(-used // 64) + 2


def test_sequences_are_padded_except_at_powers_of_two(spark):
    packed = spark.createDataFrame(
        [(1, 0, 3, bytearray(12)), (1, 3, 1, bytearray(b"\x01\0\0\0")), (2, 0, 3, bytearray(12))],
        "sequence_id bigint, offset bigint, length int, ids binary",
    )
    got = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed, 64, 9).collect()}
    assert got == {1: bytes(12) + b"\x01\0\0\0", 2: bytes(12) + b"\x09\0\0\0" * 61}


def test_packing_without_rows(spark):
    assert packing.pack(staged(packing.pieces(docs(spark, []), TOKENIZER), "t")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_patterns_use_up_the_histogram(seed):
    draw = random.Random(seed)
    histogram = {draw.randrange(1, 65): draw.randrange(1, 50) for _ in range(30)}
    patterns = packing.shortest_pack_first(histogram, 64)
    used = {}
    for lengths, copies in patterns:
        assert copies > 0 and sum(lengths) <= 64
        for length in lengths:
            used[length] = used.get(length, 0) + copies
    assert used == histogram


def test_separator_scan_counts_like_the_tokenizer(spark):
    rows = [(1, None), (2, ""), (4, "a<|endoftext|>b")] + pack_rows()[4:]
    blocks, order = token_scan.write_stream(docs(spark, rows), TOKENIZER, block_tokens=50)
    counted = token_scan.count_tokens(blocks, block_tokens=50)
    got = {r["doc_id"]: r["n_tokens"] for r in order.join(counted, ["file_id", "place"]).collect()}
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    assert got == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in rows}
    assert blocks.groupBy("file_id").count().agg(F.max("count")).first()[0] > 3


def test_separator_scan_of_files(spark, tmp_path):
    for name, ids in (("a", [5, 9, 9, 1, 2, 3]), ("b", []), ("c", [9]), ("d", [1] * 25 + [9] + [2] * 3)):
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    blocks = token_scan.read_files(spark, str(tmp_path), width=2, block_tokens=4)
    out = token_scan.count_tokens(blocks, end_id=9, width=2, block_tokens=4)
    got = sorted((r["file_id"][-1], r["place"], r["n_tokens"], r["first_token"], r["closed"]) for r in out.collect())
    assert got == [
        ("a", 0, 1, 0, True), ("a", 1, 0, 2, True), ("a", 2, 3, 3, False), ("c", 0, 0, 0, True),
        ("d", 0, 25, 0, True), ("d", 1, 3, 26, False),
    ]


PII = [
    (1, "mail a.b@c.example.org, a@b.c._d@e.f; 1.2.3.4.5.6.7.8 999.1.2.3.4 0010.0.0.255"), (2, None), (3, ""),
    (4, "5295745161764470 5295-7451-6176-4471 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 41111111111111111111111"),
    (5, "+1 (509) 555-6973 +12 3 ++49 30 1234567- \U0001f642 +4930123456"), (6, "7" * 30_000 + "@" + "x." * 9_000),
    (6, "host 10.0.0.1 and 10.0.0.1"), (None, "x@y.zz"),
]


def test_base_spans_match_plain_patterns(spark):
    found = pii.find(docs(spark, PII), None).select("text", pii.listed(True).alias("got"), pii.listed(False).alias("all"))
    for r in found.collect():
        assert r["got"] == r["all"] == brute.base_spans(r["text"] or "")


def test_trees_add_rewritten_spans_and_redaction_covers_them(spark):
    draw = random.Random(2)
    rows = []
    for i in range(400):
        digits = "".join(draw.choice("0123456789") for _ in range(15))
        card = next(digits + c for c in "0123456789" if brute.luhn(digits + c))
        phone = f"+1 ({draw.randrange(200, 999)}) 555-{draw.randrange(1000, 9999)}"
        rows.append((i, f"{prose(draw, 6)} {card} {prose(draw, 4)} {phone} {prose(draw, 3)} "
                        f"{draw.choice(WORDS)}.{i}@mail.example.com {prose(draw, 3)} 10.{i % 255}.7.{i % 99} ok"))
    train = docs(spark, rows)
    model = pii.fit(train)
    assert model.thresholds
    hard = docs(spark, [(1, "write to kim (at) example (dot) org or see 10[.]0[.]0[.]7 on 2023-10-12"), (2, "plain words, 12 345 of them"), (3, None)])
    got = {r["doc_id"]: r["all"] for r in pii.find(hard, model).select("doc_id", pii.listed(False).alias("all")).collect()}
    assert got[1].startswith("email:9:") and "ip:" in got[1] and got[2] == got[3] == ""
    base = pii.find(train, model).select("text", pii.listed(True).alias("base"), pii.listed(False).alias("all")).collect()
    assert all(set(r["base"].split(",")) <= set(r["all"].split(",")) for r in base)
    clean = {r["doc_id"]: r for r in pii.redact(hard, model).collect()}
    assert "[EMAIL]" in clean[1]["text"] and "kim" not in clean[1]["text"]
    assert clean[2]["text"] == "plain words, 12 345 of them" and clean[3]["text"] is None
    assert pii.redact(hard, model).columns == hard.columns


def test_pii_runs_no_python(spark):
    plan = pii.redact(docs(spark, PII), None)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_pii_model_needs_both_classes(spark):
    assert pii.fit(docs(spark, [(1, "nothing here")])) is None
    assert pii.fit(docs(spark, [])) is None


ITEM = "A train leaves the station at 40 km per hour and Anna walks 40 km back to the old mill"


def test_decontamination_catches_other_parameters(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, "too few words"), (4, "five small words stand alone")], "item_id bigint, text string")
    rows = [
        (1, f"some words before it. {ITEM} and some behind"),
        (2, "x " + ITEM.replace("40", "75").replace("Anna", "Bert")),
        (3, ITEM.replace("at 40", "at 75")),  # one value for two
        (4, "nothing of the kind is found in this text at all, not once"), (5, None), (6, ""),
        (7, "here the FIVE small, words stand alone!"), (8, "too few words"), (None, ITEM), (None, "clean words only"), (1, "clean"),
    ]
    out = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    assert {(1, 1), (2, 1), (None, 1), (7, 4)} <= out
    assert not {i for i, _ in out} & {4, 5, 6, 8}
    kept = decontaminate.clean(docs(spark, rows), bench)
    assert kept.columns == docs(spark, rows).columns
    assert sorted(r["text"] or "" for r in kept.collect() if r["doc_id"] is None) == ["clean words only"]


def test_decontamination_slots_must_be_steady(spark):
    item = "if 12 boys have 12 red and 30 blue balls each how many"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    steady = item.replace("12", "7").replace("30", "8")
    unsteady = "if 7 boys have 9 red and 8 blue balls each how many"
    out = decontaminate.contaminated(docs(spark, [(1, steady), (2, unsteady)]), bench).collect()
    assert [r["doc_id"] for r in out] == [1]


def test_decontamination_does_not_hang_on_what_stands_before_a_capital(spark):
    items = [
        (1, "What is the capital of France?"), (2, "Tom has 3 red pens. Ann has 5 blue pens. Who has more?"),
        (3, "One day Anna Smith and Bob Jones sold 40 old chairs"),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [
        (1, "Question: What is the capital of France? Answer: Paris"), (2, "well, What is the capital of France"),
        (3, "so I ask what is the capital of france"), (4, "Max has 4 red pens. Eva has 9 blue pens. Who has more?"),
        (5, "One day Lisa Brown and Tim Black sold 70 old chairs"), (6, "London is the capital of England"),
    ]
    out = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    assert out == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 3)}


def test_decontamination_without_rows(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    assert decontaminate.contaminated(docs(spark, []), bench).count() == 0
    assert decontaminate.contaminated(docs(spark, [(1, ITEM)]), bench.where("false")).count() == 0
    plan = decontaminate.clean(docs(spark, [(1, ITEM)]), bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_decontamination_of_long_number_lists(spark):
    many = ",".join(map(str, range(1_000_000)))
    bench = spark.createDataFrame([(1, ITEM), (2, many[:5000])], "item_id bigint, text string")
    rows = [(1, many), (2, "1:" * 1_000_000), (3, f"{many} {ITEM}"), (4, "2" * 1_000_000)]
    out = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    assert {i for i, j in out if j == 1} == {3}


def test_decontamination_finds_items_of_numbers_verbatim(spark):
    items = [(1, "12 + 35 = 47, 81 - 9 = 72"), (2, "3.5 km 7 kg 250 m"), (3, "7 days of 8")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [
        (1, "sums: 12 + 35 = 47, 81 - 9 = 72 and so on"), (2, "12 + 35 = 46, 81 - 9 = 72"), (3, "go 3.5 km 7 kg 250 m up"),
        (4, "3.5 km 8 kg 250 m"), (5, "all 7 days of 8"), (6, "all 7 days of 9"), (7, None),
    ]
    out = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    assert out == {(1, 1), (3, 2), (5, 3)}


def test_documents_without_anchors_are_read_once(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    known = decontaminate.known_windows(bench.select("item_id", F.col("text").alias("_t")))
    rows = [(1, "at the old mill"), (2, "a train leaves"), (3, "AND ANNA WALKS"), (4, None), (5, "leaves7station")]
    kept = decontaminate.holding(docs(spark, rows), known, F.coalesce("text", F.lit("")))
    # The longest words: leaves, station, walks.
    assert {r["doc_id"] for r in kept.collect()} == {2, 3, 5}


def test_windows_are_hashed_only_around_two_words_of_an_item(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    known = decontaminate.known_windows(bench.select("item_id", F.col("text").alias("_t")))
    words = [r["anchor"] for r in known.select("anchor").distinct().collect()]
    rows = [(1, " ".join(f"{w} and then some more" for w in words * 20)), (2, f"so {ITEM} it ends"), (3, words[0])]
    texts = decontaminate.with_tokens(docs(spark, rows).select("doc_id", F.col("text").alias("_t")), F.col("_t"))
    hit = decontaminate.Anchors(known).with_hits(texts)
    size = known.agg(F.max("size")).first()[0]
    cut = decontaminate.windows(hit, size, ["doc_id"], "_hits").join(known.select("template").distinct(), "template", "left_semi")
    every = decontaminate.windows(texts, size, ["doc_id"]).join(known.select("template").distinct(), "template", "left_semi")
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, every.collect()))
    assert {r["doc_id"]: r["n"] > 0 for r in hit.select("doc_id", F.size("_hits").alias("n")).collect()} == {1: False, 2: True, 3: False}


def test_only_texts_with_two_words_of_an_item_at_their_distance_are_searched(spark):
    item = "The shop sold 25 kg of yellow potatoes for $40 to Anna Baker and 7% of onions within 3 days to Omar"
    bench = spark.createDataFrame([(1, item), (2, "in 10 20 30 40 50 60 70")], "item_id bigint, text string")
    known = decontaminate.known_windows(bench.select("item_id", F.col("text").alias("_t")))
    found = known.select("pair.first", "anchor", "item_form").collect()
    words = {r["first"] for r in found} - {r["anchor"] for r in found if r["item_form"] == decontaminate.VERBATIM} - {None}
    rows = [
        (1, "So: " + item.replace("25 kg", "3.5%").replace("$40", "1,200 euros").replace("Anna", "Zoe") + "; the end"),
        (2, item.lower().replace("yellow potatoes", "Yellow-Potatoes").replace("7%", "8 USD")), (3, item.upper()),
        (4, "x in 10 20 30 40 50 60 70 y"), (5, "foo\u0001bar \u0002"), (6, "ΑΣ'Βα"), (7, None), (8, "potatoes yellow of"),
        (9, " ".join(f"{w} u v w x y z u v w x" for w in sorted(words) if w.isalpha())), (10, "potatoes"), (11, "7"), (12, ""),
    ]
    texts = docs(spark, rows).select("doc_id", F.coalesce("text", F.lit("")).alias("_t"))
    near = {r["doc_id"] for r in texts.where(decontaminate.Anchors(known).near(F.col("_t"))).collect()}
    tokens, met = decontaminate.with_tokens(texts, F.col("_t")), set()
    for size in range(decontaminate.LITERALS, decontaminate.WINDOW + 1):
        theirs = known.where(F.col("size") == size).select("template").distinct()
        met |= {r["doc_id"] for r in decontaminate.windows(tokens, size, ["doc_id"]).join(theirs, "template", "left_semi").collect()}
    assert met == {1, 2, 3, 4}
    assert met <= near and near <= met | {5, 6}


def test_pairs_are_sought_only_at_the_distances_of_their_first_word(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    known = decontaminate.known_windows(bench.select("item_id", F.col("text").alias("_t")))
    theirs = {(r["first"], r["apart"]) for r in known.select("pair.*").collect()}
    rows = [(w, d) for w in {w for w, _ in theirs} for d in range(1 - decontaminate.WINDOW, decontaminate.WINDOW)]
    sought = spark.createDataFrame(rows, "word string, apart int").where(
        decontaminate.Anchors(known).aparts.at(decontaminate._beside(decontaminate.place_of("word"), F.col("apart"))),
    )
    assert {tuple(r) for r in sought.collect()} == theirs and len(theirs) < len(rows) / 2


def test_trees_learn_from_all_documents(spark):
    rows = [(i, f"mail anna{i}@host{i % 7}.org or call +1 212 555 {i:04d}") for i in range(300)]
    spans = pii.training_rows(docs(spark, rows))
    assert {r["kind"]: r["n"] for r in spans.where("label = 1").groupBy("kind").agg(F.sum("n").alias("n")).collect()} == {
        "email": 300 * 4, "phone": 300 * 3,
    }
    # Rows alike count together, so the table that the trees read hardly grows with the documents.
    assert spans.count() < 600

def graded_rows():
    draw = random.Random(4)
    rows, marks = [], []
    for i in range(600):
        text, n = prose(draw, draw.randrange(5, 60)), draw.choice([0, 0, 0, 1, 2, 4, 8])
        words = text.split()
        for _ in range(n):
            words.insert(draw.randrange(len(words)), draw.choice(["vile", "rotten", "dumb"]))
        rows.append((i, " ".join(words)))
        marks.append((i, int(n > 0)))
    return rows, marks


def test_toxicity_on_held_out_rows(spark):
    rows, marks = graded_rows()
    labels = spark.createDataFrame([m for m in marks if m[0] % 3] + [(None, 1), (5000, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs(spark, rows), labels)
    assert model.thresholds == sorted(model.thresholds) and set(model.weights) == {"vile", "rotten", "dumb"}
    out = docs(spark, rows).select("doc_id", toxicity.graded(model).alias("g")).select("doc_id", "g.*").collect()
    held = [r for r in out if r["doc_id"] % 3 == 0]
    assert sum(r["toxic"] == bool(dict(marks)[r["doc_id"]]) for r in held) >= 0.98 * len(held)
    hits = {i: sum(w in model.weights for w in t.split()) for i, t in rows}
    many = [r["expected_grade"] for r in out if hits[r["doc_id"]] == 8]
    few = [r["expected_grade"] for r in out if hits[r["doc_id"]] == 1]
    assert min(many) > max(few) > 0.5
    kept = toxicity.accepted(docs(spark, [*rows, (7000, None), (7001, "")]), labels)
    assert kept.columns == docs(spark, []).columns and {7000, 7001} <= {r["doc_id"] for r in kept.collect()}


def test_toxicity_of_very_long_texts(spark):
    rows, marks = graded_rows()
    model = toxicity.fit(docs(spark, rows), spark.createDataFrame(marks, "doc_id bigint, toxic int"))
    draw = random.Random(5)
    plain = [draw.choice(WORDS) for _ in range(300_000)]
    clean, rude, part = list(plain), list(plain), list(plain)
    for i in range(90):
        clean[i * 3_333] = ("vile", "rotten", "dumb")[i % 3]
    for i in range(0, len(rude), 70):
        rude[i] = draw.choice(["vile", "rotten", "dumb"])
    for i in range(150_000, 152_000, 20):
        part[i] = draw.choice(["vile", "rotten", "dumb"])
    long = [(1, " ".join(clean)), (2, " ".join(rude)), (3, " ".join(part))]
    out = docs(spark, long).select("doc_id", toxicity.graded(model).alias("g")).select("doc_id", "g.toxic").collect()
    assert {r["doc_id"]: r["toxic"] for r in out} == {1: False, 2: True, 3: True}


def test_toxicity_order_draws_no_texts(spark):
    rows = spark.createDataFrame([(i % 70, f"text {i * 7 % 101}", i) for i in range(300)], "doc_id bigint, text string, at int")
    out = toxicity.ordered(rows)
    assert out.select("doc_id", "text").collect() == rows.orderBy("doc_id", "text").select("doc_id", "text").collect()
    # The driver collects keys of ranges to draw their bounds.
    ranges = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "rangepartitioning" in line]
    assert ranges and not any("text" in line for line in ranges)


def test_toxicity_without_labels(spark):
    rows, marks = graded_rows()
    for labels in ([], [(1, 0), (2, 0)], [(None, 1)]):
        model = toxicity.fit(docs(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        out = docs(spark, rows[:3]).select(toxicity.graded(model).alias("g")).select("g.*").collect()
        assert [(r["expected_grade"], r["toxic"]) for r in out] == [(0.0, False)] * 3
    assert toxicity.accepted(docs(spark, []), spark.createDataFrame(marks, "doc_id bigint, toxic int")).count() == 0


def test_ordinal_fit_recovers_order():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(3000, 3))
    y = np.digitize(x @ [2.0, -1.0, 0.0] + draw.logistic(size=3000), [-1, 1, 3])
    row, col = np.nonzero(np.ones_like(x))
    w, cuts = toxicity.fit_ordinal(row, col, x[row, col], y, 3)
    assert np.allclose(w, [2, -1, 0], atol=0.25) and np.allclose(cuts, [-1, 1, 3], atol=0.3)


def test_licences_on_altered_notices(spark):
    draw = random.Random(6)
    plain = [(i, "\n".join(prose(draw, 12) for _ in range(4))) for i in range(200)]
    model = licences.fit(docs(spark, plain))
    hit = [
        (1000, "words first\nLicensed under the Apache License, version 2.0."),
        (1001, "Released under the MIT license. And more words follow it here"),
        (1002, prose(draw, 60) + " this work is licensed under the gnu general public license, version 3 " + prose(draw, 60)),
        (1003, None), (1004, ""), (1005, "licensed plumbers do it right"), (None, "All rights reserved."),
    ]
    out = docs(spark, plain + hit).select("doc_id", F.explode(licences.licences(model)).alias("h")).select("doc_id", "h.*").collect()
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in out} == {
        (1000, 1, "apache"), (1001, 0, "mit"), (1002, 0, "gpl"), (None, 0, "proprietary"),
    }
    assert licences.fit(docs(spark, [])).scan("Released under the MIT License.")


MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)


def test_licences_in_long_and_wrapped_lines(spark):
    draw = random.Random(8)
    model = licences.fit(docs(spark, [(i, "\n".join(prose(draw, 12) for _ in range(4))) for i in range(200)]))
    assert {h[:2] for h in model.scan(MIT)} == {(0, "mit")}
    for family, templates in licences.TEMPLATES.items():
        for t in templates:
            before, behind = prose(draw, 60), prose(draw, 60)
            assert {h[:2] for h in model.scan(t)} == {(0, family)}, t
            assert {h[:2] for h in model.scan(f"{before} {t} {behind}")} == {(0, family)}, t
            for width in (2, 3, 5, 8):
                parts = t.split()
                wrapped = "\n * ".join(" ".join(parts[i : i + width]) for i in range(0, len(parts), width))
                found = model.scan(f"{before}\n\n * {wrapped}\n\n{behind}")
                assert {h[1] for h in found} == {family} and 1 < found[0][0] < 3 + len(parts), (t, width)
    assert model.scan("a permission is given, free of charge, by any person of this house\n" + prose(draw, 50)) == []

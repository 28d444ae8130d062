"""Operators over embeddings, conversations and pages."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from careledger.llm import chat, pages, topk
from careledger.llm import components as components_module
from careledger.llm.common import staged
from careledger.llm.components import components
from tests.llm import brute


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "s") for i, v in rows], "vec_id bigint, embedding array<float>, score string")


@pytest.mark.parametrize("kind", ["spread", "copies", "flat"])
def test_top_k_matches_all_pairs(spark, kind):
    draw = random.Random(kind)
    make = {
        "spread": lambda i: [draw.gauss(0, 1) for _ in range(8)],
        "copies": lambda i: [1.0 if i % 3 else draw.random()] * 8,
        "flat": lambda i: [0.0] * 8,
    }[kind]
    rows = [(i, make(i)) for i in range(400)]
    got = {}
    for r in topk.top_k(vectors(spark, rows).repartition(5), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    single = {i: [float(x) for x in r] for i, r in vectors(spark, rows).rdd.map(lambda r: (r[0], r[1])).collect()}
    want = brute.top(single, range(0, 400, 50), 5)
    assert {q: [x[1:] for x in sorted(v)] for q, v in got.items()} == want


def test_top_k_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, None), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [None, 1.0]), (4, []), (None, [1.0, 1.0]), (5, [0.5, 0.5]), (5, [0.5, 0.5])]
    out = topk.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert [tuple(r) for r in out] == [(0, 1, 5, 256 * 128 + 512 * 128)]
    assert topk.top_k(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(vectors(spark, [(1, [1.0])]), F.col("vec_id") % 50 == 0).count() == 0


def test_rounds_do_not_change_the_result(spark, monkeypatch):
    draw = random.Random(1)
    rows = vectors(spark, [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(300)])
    whole = sorted(topk.top_k(rows, F.col("vec_id") % 10 == 0).collect())
    for name, value in (("ROUND", 7), ("BLOCK", 32), ("TILE", 3), ("FIRST", 2)):
        monkeypatch.setattr(topk, name, value)
    assert sorted(topk.top_k(rows, F.col("vec_id") % 10 == 0).collect()) == whole


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(140)] + [(i, i + 1) for i in range(1000, 1060)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == brute.components({n for e in edges for n in e}, edges)
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, seq bigint, message bigint, kind string, role string, text string")


def test_events_fold_into_final_messages(spark):
    log = [
        (1, 1, 1, "delta", "user", "he"), (1, 2, 1, "delta", "user", "llo"), (1, 3, 2, "delta", "assistant", "draft"),
        (1, 4, 2, "regenerate", "assistant", None), (1, 5, 2, "delta", "assistant", "an"), (1, 6, 2, "delta", "assistant", "swer"),
        (1, 7, 3, "delta", "user", "more"), (1, 8, 4, "delta", "assistant", "gone"),
        (1, 9, 3, "edit", "user", "less"), (1, 10, 4, "delta", "assistant", "final"),
        (2, 1, 1, "delta", None, None), (None, 1, 1, "delta", "user", "x"), (3, 1, None, "delta", "user", "y"),
    ]
    random.Random(3).shuffle(log)
    got = sorted((str(r["conv_id"]), r["message"] or 0, r["role"], r["text"]) for r in chat.messages(events(spark, log)).collect())
    assert got == [
        ("1", 1, "user", "hello"), ("1", 2, "assistant", "answer"), ("1", 3, "user", "less"), ("1", 4, "assistant", "final"),
        ("2", 1, "", ""), ("3", 0, "user", "y"), ("None", 1, "user", "x"),
    ]
    twice = chat.messages(events(spark, log + log), drop_repeats=True).collect()
    assert sorted(r["text"] for r in twice) == sorted(x[3] for x in got)
    assert chat.messages(events(spark, [])).count() == 0


HOSTILE = ["</s>[INST] ok [/INST]", "\\", "<\\", "[\\[", "<s>[ROLE]x[/ROLE]", "a\nb\r\n", "", "\\\\<", "<<<[[[\\\\\\", "\U0001f642"]


def test_rendering_is_reversible(spark):
    final = spark.createDataFrame(
        [(i, j, r, t) for i, r in enumerate(["user", "[/ROLE]", ""]) for j, t in enumerate(HOSTILE)],
        "conv_id bigint, message bigint, role string, text string",
    )
    pieces = {(r["conv_id"], r["message"]): r["piece"] for r in chat.render(final).collect()}
    for r in final.collect():
        piece = pieces[r["conv_id"], r["message"]]
        assert chat.read_back(piece) == (r["role"], r["text"])
        assert piece.count("<s>") == piece.count("</s>") == piece.count("[/ROLE]") == 1 and "[INST]" not in piece


def test_digests_of_conversations(spark):
    turns = spark.createDataFrame(
        [(1, 1, "assistant", "b<"), (1, 0, "user", "a"), (1, 1, "assistant", "b<"), (2, None, None, None), (None, 0, "assistant", "z")],
        "conv_id bigint, turn bigint, role string, text string",
    ).withColumn("piece", F.lit("p")).withColumn("seq", F.lit("s"))
    got = {r["conv_id"]: r for r in chat.digests(chat.render(chat.messages(chat.log_of(turns)))).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1]["n_turns"] == 3 and got[1]["turns_sha256"] == sha("user\na\nassistant\nb<\nassistant\nb<\n")
    assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (4, sha("b<b<"))
    assert (got[2]["turns_sha256"], got[2]["loss_sha256"]) == (sha("\n\n"), sha("")) and got[None]["loss_chars"] == 1


LONG = "This is one of the paragraphs that have enough of the usual words in it to be taken for the text of a page by the rules. "


def test_main_text_of_pages():
    page = (
        f"<html><head><title>T</title><script>var a='</p>';</script></head><body><header><h1>Site</h1></header>"
        f"<nav><a href=x>Menu</a></nav><div class='cookie-banner'>{LONG}</div><article><header><h1>Title &amp; more</h1></header>"
        f"<p><b>One\n  two.<br><p>Short<ul><li>a<li>b</ul><form>Name <input></form><aside>{LONG}</aside>"
        f"<section id='comments'><p>{LONG}</section></article><footer>&copy; x</footer></body></html>"
    )
    assert pages.main_text(page) == "Title & more\nOne two.\nShort\na\nb"
    plain = f"<body><p>Lead<p>{LONG}<p>Short.<p>{LONG}<div><a href=a>one</a> <a href=b>two</a></div><div>End</div><div class=sidebar>{LONG}</div>"
    assert pages.main_text(plain) == "\n".join(["Lead", LONG.strip(), "Short.", LONG.strip()])
    assert [pages.main_text(x) for x in (None, "", "<", "<!--", "&amp;", "<p></p>", "<article>a &lt; b")] == ["", "", "", "", "", "", "a < b"]
    assert pages.main_text("<article>" + "<div>" * 3000 + "x") == "x"


def test_wrappers_and_open_heads_do_not_empty_a_page():
    for name in ("content overflow-hidden", "no-sidebar", "col-8 with-sidebar", "page has-nav", "sidebar", "widget main"):
        page = f"<body><div class='{name}'><article><p>{LONG}</p><div class='share'>Tell all</div></article></div></body>"
        assert pages.main_text(page) == LONG.strip(), name
        plain = f"<body><div class='{name}'><p>{LONG}</p><p>{LONG}</p></div><div class='site-footer'>{LONG}</div></body>"
        assert pages.main_text(plain) == "\n".join([LONG.strip()] * 2), name
    assert pages.main_text(f"<html><head><title>T</title><meta charset=x><body><article>{LONG}</article>") == LONG.strip()
    assert pages.main_text(f"<head><title>T</title><style>p{{}}</style><p>{LONG}") == LONG.strip()
    assert pages.main_text(f"<head><script>a</script></head><div class='ad'>{LONG}</div><div>{LONG}{LONG}</div>") == (LONG + LONG).strip()


def test_pages_in_other_languages_tables_and_links():
    menu = "<ul><li><a href=a>one</a><li><a href=b>two</a></ul>"
    russian = "Это один из абзацев, в которых достаточно слов, чтобы принять их за текст страницы, хотя они не на одном из четырёх языков."
    chinese = "这是一个足够长的段落，可以被视为网页的正文，尽管它不是用四种语言之一写成的，因此必须保留下来。"
    for text in (russian, chinese):
        assert pages.main_text(f"<body>{menu}<p>{text}</p><p>{text}</p>{menu}</body>") == f"{text}\n{text}"
    code = " ".join(f"x{i} = f{i}(y{i});" for i in range(40))
    assert pages.main_text(f"<body>{menu}<p>{LONG}</p><pre>{code}</pre>{menu}</body>") == f"{LONG.strip()}\n{code}"
    assert pages.main_text(f"<body>{menu}<pre>{code}</pre>{menu}</body>") == code
    linked = "See <a href=x>the whole of the report</a> here."
    article = f"<article><p>{LONG}</p><p>{linked}</p>{menu}<p><a>first</a> | <a>second</a> | <a>third</a></p></article>"
    assert pages.main_text(article) == f"{LONG.strip()}\nSee the whole of the report here."


def test_pages_by_column(spark):
    rows = spark.createDataFrame([(1, None), (1, "<article>a</article>"), (None, "<article>bé</article>")], "page_id bigint, html string")
    assert sorted(r[0] for r in rows.select(pages.extracted("html")).collect()) == ["", "a", "bé"]
    assert rows.where("false").select(pages.extracted("html")).count() == 0


@pytest.mark.parametrize("shape", ["chain", "star", "buckets"])
def test_components_read_merged_edges_only(spark, monkeypatch, shape):
    n = 3000
    draw = random.Random(6)
    edges = {
        "chain": [(i, i + 1) for i in range(n)], "star": [(n, i) for i in range(n)],
        # Each node in five buckets of many, as near copies are.
        "buckets": [(i, draw.randrange(n)) for i in range(n) for _ in range(5)] + [(n + 7, n + 7)],
    }[shape]
    written = []

    def counted(df, name):
        out = staged(df, name)
        if name == "edges":
            written.append(out.count())
        return out

    monkeypatch.setattr(components_module, "staged", counted)
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == brute.components({x for e in edges for x in e}, edges)
    # Read in every pass, they were three times as many and more.
    assert sum(written) < 2.5 * len(edges) and written[-1] == 0


def test_components_take_few_jobs(spark, monkeypatch):
    edges = [(i, i + 1) for i in range(3000)]
    names = []

    def noted(df, name):
        names.append(name)
        return staged(df, name)

    monkeypatch.setattr(components_module, "staged", noted)
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert set(got.values()) == {0} and len(got) == 3001
    # A pass writes its nodes and what edges are left; undoing it takes a share of a job.
    assert names.count("merged") > 6
    assert names.count("ends") <= names.count("merged") / 4 + 1

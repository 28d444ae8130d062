"""The registered queries on whole given tables: against their SQL, or against plain code."""

import hashlib
import html
import os
import re
import zlib

import duckdb
import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

import __spark_entry__ as entry
from careledger.llm.queries import ORACLES, QUERIES
from tests.llm import brute

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(db):
    return {i: t or "" for i, t in db.sql("SELECT doc_id, text FROM documents").fetchall()}


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(path("byte_bpe_50k.json"))


def test_registered():
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) and {n[2:].split("_")[0] for n in QUERIES} == set(map(str, range(1, 14)))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    result = db.sql(ORACLES[name])
    assert columns == sorted(result.columns)
    order = [result.columns.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr) and got


def test_op1_against_labels(spark, db, texts):
    out = {r["doc_id"]: r for r in QUERIES["op1_ordinal_toxicity"](spark, SF_DIR.replace("sf0.001", "sf0.01")).collect()}
    marks = duckdb.sql(f"SELECT doc_id, toxic FROM '{SF_DIR.replace('sf0.001', 'sf0.01')}/labels.parquet'").fetchall()
    right = sum(out[i]["toxic"] == bool(t) for i, t in marks)
    assert right >= 0.93 * len(marks)
    assert all(0 <= r["expected_grade"] <= 3 and r["toxic"] == (r["p_toxic"] >= 0.5) for r in out.values())


def test_op2_base_spans(spark, texts):
    out = {r["doc_id"]: r for r in QUERIES["op2_pii_boosted"](spark, SF_DIR).collect()}
    assert set(out) == set(texts)
    for i, t in texts.items():
        want = brute.base_spans(t)
        kinds = [x.split(":")[0] for x in want.split(",")]
        assert out[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [out[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [kinds.count(k) for k in ("email", "ip", "card", "phone")]
        assert set(want.split(",")) <= set(out[i]["spans"].split(",")) or not want


def test_op3_counts(spark, texts, tokenizer):
    out = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op3_separator_scan"](spark, SF_DIR).collect()}
    assert out == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}


def test_op6_pieces(spark, texts, tokenizer):
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    rows = QUERIES["op6_shortest_pack_first"](spark, SF_DIR).collect()
    sequences, at = {}, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == at.get(r["doc_id"], 0) and r["doc_tokens"] == len(own)
        part = own[r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        at[r["doc_id"]] = r["start"] + r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert at == {i: len(x) for i, x in ids.items()}
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(sequences) * 1024 <= 1.02 * sum(map(len, ids.values())) + 2048


def test_op9_articles(spark, db):
    out = {r["page_id"]: r for r in QUERIES["op9_block_rules"](spark, SF_DIR).collect()}
    for i, url, page in db.sql("SELECT page_id, url, html FROM pages").fetchall():
        article = re.search("<article>(.*)</article>", page, re.DOTALL)[1]
        parts = (html.unescape(re.sub("<[^>]+>", "", p)) for p in re.split("</?(?:p|h1)>", article))
        want = "\n".join(p for p in (" ".join(p.split()) for p in parts) if p)
        assert (out[i]["url"], out[i]["text"], out[i]["n_chars"]) == (url, want, len(want))


def test_op10_notices(spark, texts):
    notices = {
        "Licensed under the Apache License, Version 2.0.": "apache", "Released under the MIT License.": "mit",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Licensed under CC BY-NC 4.0.": "creative_commons", "All rights reserved.": "proprietary",
    }
    want = {(i, n, notices[line]) for i, t in texts.items() for n, line in enumerate(t.split("\n")) if line in notices}
    rows = QUERIES["op10_licence_paragraphs"](spark, SF_DIR).collect()
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in rows if r["family"]} == want
    assert {r["doc_id"] for r in rows} == set(texts)

"""Operators on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from careledger.operators.dimensions import build_dimension, safe_names
from careledger.operators.ghosts import split_ghosts
from careledger.operators.hierarchy import flatten, paths_of_parents, within
from careledger.operators.numbering import batch_rows, chunks
from careledger.operators.quality import (
    duplicate_keys, failure_share, null_keys, orphans, require_successes, too_long,
)
from careledger.operators.rates import pivot_rates
from careledger.operators.watermarks import advance, finished_units, reset, settled_requests, stale
from careledger.schemas import TABLES, Table
from careledger.sources.warehouse import Warehouse


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())


# --- ghosts ---

@pytest.fixture
def ghost_tables(spark):
    values = spark.createDataFrame(
        [("e1", "o1"), ("e1", "o2"), ("e9", "o1"), ("e2", "o1"), ("e3", "o1"), ("e1", None), (None, "o1"),
         ("e4", "o3")], "dataelement string, categoryoptioncombo string")
    elements = spark.createDataFrame(
        [("e1", "cc1"), ("e2", "cc1, cc2"), ("e3", None), ("e4", None)], "id string, categorycombo_id string")
    combos = spark.createDataFrame(
        [("o1", "cc1"), ("o2", "cc2"), ("o3", None)], "id string, categorycombo_id string")
    return values, elements, combos


def test_ghosts(spark, ghost_tables):
    kept, ghosts = split_ghosts(*ghost_tables)
    assert got(kept) == [("e1", "o1")]
    assert ghosts.count() == 7
    values, elements, combos = ghost_tables
    for name, df in (("v", values), ("e", elements), ("c", combos)):
        df.createOrReplaceTempView(name)
    as_written = spark.sql("""SELECT * FROM v WHERE EXISTS (SELECT 1 FROM e JOIN c
        ON e.categorycombo_id = c.categorycombo_id WHERE e.id = v.dataelement AND c.id = v.categoryoptioncombo)""")
    assert got(kept) == got(as_written)


def test_ghosts_with_listed_combos(ghost_tables):
    kept, _ = split_ghosts(*ghost_tables, split_combos=True)
    assert got(kept) == [("e1", "o1"), ("e2", "o1")]


def test_without_metadata_all_are_ghosts(ghost_tables):
    values, elements, combos = ghost_tables
    kept, ghosts = split_ghosts(values, elements.limit(0), combos)
    assert (kept.count(), ghosts.count()) == (0, 8)


# --- hierarchy ---

def staged(spark, rows):
    df = spark.createDataFrame(rows, "id string, name string, path string, datasource_id string")
    return df.select("*", *[
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in TABLES["stg_orgunits"].schema if f.name not in df.columns])


def test_flatten(spark):
    units = staged(spark, [
        ("a", "A", "/a", "s"), ("b", "B", "/a/b", "s"), ("c", "C", "/a/b/c", "s"), ("b", "other", "/b", "t"),
        ("n", "N", None, "s"), ("i", "I", "/1/2/3/4/5/6/7/i", "s"), ("deep", "D", "/a/2/3/4/5/6/7/8/deep", "s")])
    flat = {r.id + r.datasource_id: r for r in flatten(units).collect()}
    c = flat["cs"]
    assert [c[f"oulevel{i}id"] for i in range(1, 9)] == ["a", "b", "c", "", "", "", "", ""]
    assert [c[f"oulevel{i}name"] for i in range(1, 9)] == ["A", "B", "C", None, None, None, None, None]
    assert flat["bt"].oulevel1name == "other" and flat["bs"].oulevel2name == "B"
    assert flat["ns"].oulevel1id is None and flat["ns"].oulevel1name is None
    assert flat["is"].oulevel8name == "I" and flat["is"].oulevel1name is None
    assert flat["deeps"].oulevel8id == "8" and flat["deeps"].oulevel1name == "A"
    assert len(flat) == 7


def test_subtree(spark):
    units = staged(spark, [("a", "A", "/a", "s"), ("b", "B", "/a/b", "s"), ("x", "X", "/x", "s"), ("n", "N", None, "s")])
    assert got(within(units, ["b", "x"], "path"), "id") == [("b",), ("x",)]
    assert within(units, [], "path").count() == 4
    roots = spark.createDataFrame([("a",), ("zz",)], "root string")
    assert got(within(units, roots, "path"), "id") == [("a",), ("b",)]
    assert got(flatten(units, ["b"]), "id", "oulevel1name") == [("b", "A")]


# --- numbering ---

def test_chunks_concatenate_to_the_list(spark):
    df = spark.createDataFrame([(list("abcdefg"),), ([],), (["x"],)], "ids array<string>")
    assert [r[0] for r in df.select(chunks(F.col("ids"), 3)).collect()] == [
        [list("abc"), list("def"), ["g"]], None, [["x"]]]


def test_batches_are_full_and_complete(spark):
    ids = spark.range(1000).select(F.concat(F.lit("u"), "id").alias("k"))
    batches = batch_rows(ids, "k", 7).groupBy("batch").agg(F.count("*").alias("n"), F.collect_set("k").alias("ks"))
    rows = sorted(batches.collect(), key=lambda r: r.batch)
    assert [r.batch for r in rows] == list(range(143))
    assert [r.n for r in rows] == [7] * 142 + [6]
    assert len({k for r in rows for k in r.ks}) == 1000


# --- rates ---

def test_rates(spark):
    cells = spark.createDataFrame([
        ("d", "o", "p", "s", "EXPECTED_REPORTS", 5.0, 1), ("d", "o", "p", "s", "EXPECTED_REPORTS", 6.0, 3),
        ("d", "o", "p", "s", "ACTUAL_REPORTS", 2.0, 2), ("d", "o", "p", "s", "ACTUAL_REPORTS_ON_TIME", 1.0, 2),
        ("d", "o", "q", "s", "SOMETHING", 9.0, 1)],
        "dataset_id string, orgunit_id string, period string, datasource_id string, metric string, value double, seq int")
    assert got(pivot_rates(cells), "period", "expected_reports", "actual_reports", "actual_reports_on_time") == [
        ("p", 6.0, 2.0, 1.0), ("q", 0.0, 0.0, 0.0)]


# --- watermarks ---

def test_stale_counts_from_midnight(spark, as_of):
    dates = {dt.date(2024, 3, 5): True, dt.date(2024, 3, 6): True, dt.date(2024, 3, 7): False, None: True}
    df = spark.createDataFrame([(d,) for d in dates], "w date")
    assert [r[0] for r in df.select(stale("w", as_of)).collect()] == list(dates.values())
    midnight = as_of.replace(hour=0, minute=0)
    assert [r[0] for r in df.select(stale("w", midnight)).collect()] == [True, False, False, True]


def test_watermark_moves_for_finished_units_only(spark, as_of):
    log = spark.createDataFrame([
        ("r1", "s", "u1", False), ("r2", "s", "u2", True), ("r3", "s", "u3;u4", False), ("r4", "s", "u5;u6", False),
        ("r4", "s", "u5;u6", True), ("r5", "s", "u7", False)],
        "request_id string, source string, orgunit string, failed boolean")
    rejects = spark.createDataFrame([("r5",), ("r5",)], "request_id string")
    assert got(settled_requests(log, rejects).filter("ok"), "request_id") == [("r1",), ("r3",)]
    done = finished_units(log, settled_requests(log, rejects))
    assert got(done) == [("u1", "s"), ("u3", "s"), ("u4", "s")]
    units = spark.createDataFrame(
        [("u1", "s", None), ("u1", "t", None), ("u2", "s", dt.date(2024, 1, 1))], "id string, datasource_id string, w date")
    moved = advance(units, done, "w", as_of.date())
    assert [tuple(r) for r in moved.orderBy("id", "datasource_id").collect()] == [
        ("u1", "s", dt.date(2024, 3, 10)), ("u1", "t", None), ("u2", "s", dt.date(2024, 1, 1))]
    assert [r.w for r in reset(moved, "w", "s").orderBy("id", "datasource_id").collect()] == [None, None, None]


# --- dimensions ---

def dimension(spark, as_of, links, cats=None):
    combos = spark.createDataFrame(
        [("oc1", "first", "c1", "cc"), ("oc2", "second", None, "cc"), ("oc3", "alone", None, "cc")],
        "id string, name string, code string, categorycombo_id string")
    link = spark.createDataFrame(links, "categoryoptioncombo_id string, categoryoption_id string")
    options = spark.createDataFrame(
        [("m", "Male", "category"), ("f", "Female", "category"), ("u", "Unnamed", "category"), ("m", "attr", "attribute")],
        "id string, name string, combo_type string")
    cat_options = spark.createDataFrame(
        [("sex", "m"), ("sex", "f"), ("who", "m"), ("noname", "u")], "category_id string, categoryoption_id string")
    categories = spark.createDataFrame(
        cats or [("sex", "Sex", "category"), ("who", "sex!", "category"), ("noname", None, "category"),
                 ("sex", "Attribute", "attribute")], "id string, name string, combo_type string")
    return build_dimension(combos, link, options, cat_options, categories, "category", "s", as_of)


def test_dimension(spark, as_of):
    built, names = dimension(spark, as_of, [("oc1", "m"), ("oc1", "f"), ("oc2", "u"), ("gone", "m")])
    assert built.columns == [
        "datasource_id", "categoryoptioncombo_id", "categoryoptioncombo_name", "categoryoptioncombo_code",
        "sex", "sex_2", "categorycombo_id", "_builtat"]
    # An option shared by two categories fills both; only unnamed categories leave an empty row.
    assert got(built, "categoryoptioncombo_id", "sex", "sex_2") == [("oc1", "Male", "Male"), ("oc2", None, None)]
    assert got(names, "original_name", "safe_name") == [("Sex", "sex"), ("sex!", "sex_2")]


def test_dimension_without_names(spark, as_of):
    assert dimension(spark, as_of, [("oc2", "u")]) is None


def test_too_many_names_raise(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        with pytest.raises(ValueError):
            safe_names(spark.createDataFrame([(c,) for c in "abcd"], "n string"))
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


# --- quality ---

def test_quality_reports(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("toolong", 2)], "k string, n int")
    assert got(duplicate_keys(df, ["k"])) == [("a", 2)]
    assert got(null_keys(df, ["k", "n"])) == [("b", None)]
    parents = spark.createDataFrame([(1,)], "id int")
    assert got(orphans(df, "n", parents, "id")) == [("toolong", 2)]
    limits = Table("k string", keys=(), limits={"k": 3})
    assert got(too_long(df, limits)) == [("k", 3, 1)]


def test_failure_gate(spark):
    log = spark.createDataFrame([("ok",), ("failed",)], "status string")
    assert got(failure_share(log)) == [(2, 1, 0.5)]
    require_successes(log)
    require_successes(log.limit(0))
    with pytest.raises(RuntimeError):
        require_successes(log.filter("status = 'failed'"))


def test_paths_of_parent_links(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    chain = [(f"d{i}", "s", f"d{i - 1}" if i else None) for i in range(37)]
    odd = [("a", "s", "b"), ("b", "s", "c"), ("c", "s", "a"), ("in", "s", "a"), ("deep", "s", "in"), ("self", "s", "self"),
           ("o", "s", "gone"), ("p", "s", "o"), ("d3", "t", None), ("q", "t", "d3"), ("r", "t", "d4")]
    df = spark.createDataFrame(chain + odd, "id string, datasource_id string, parentid string")
    rows = {(r["id"], r["datasource_id"]): (r["path"], r["level"], r["problem"])
            for r in paths_of_parents(df, lambda x: wh.stage(x)[0]).collect()}
    assert rows == {
        **{(f"d{i}", "s"): ("/" + "/".join(f"d{j}" for j in range(i + 1)), i + 1, None) for i in range(37)},
        **{(i, "s"): (None, None, "cycle") for i in ("a", "b", "c", "in", "deep", "self")},
        ("o", "s"): ("/o", 1, "orphan"), ("p", "s"): ("/o/p", 2, "orphan"), ("d3", "t"): ("/d3", 1, None),
        ("q", "t"): ("/d3/q", 2, None), ("r", "t"): ("/r", 1, "orphan"),
    }
    empty = df.limit(0)
    assert paths_of_parents(empty, lambda x: wh.stage(x)[0]).count() == 0

"""Merging: idempotence, untouched columns, conditions, links."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from careledger.operators.merge import (
    combo_owners, insert_absent, keep_last, option_combo_owners, replace_links, upsert, upsert_newer,
)

TARGET = "k string, a int, b string, lastupdated timestamp_ntz"


def day(n):
    return None if n is None else dt.datetime(2024, 1, n)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("x", 1, "old", day(5)), ("y", 2, "old", None)], TARGET)


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("small", [False, True])
def test_upsert_refreshes_only_the_chosen_columns(spark, target, small):
    new = spark.createDataFrame([("x", 10, "new", day(6)), ("z", 30, "new", day(6))], TARGET)
    merged = upsert(target, new, ["k"], ["a"], small_updates=small)
    assert values(merged, "k", "a", "b", "lastupdated")[0] == ("x", 10, "old", day(5))
    assert values(merged, "k", "a", "b") == [("x", 10, "old"), ("y", 2, "old"), ("z", 30, "new")]
    again = upsert(merged, new, ["k"], ["a"], small_updates=small)
    assert values(again, "k", "a", "b") == values(merged, "k", "a", "b")


@pytest.mark.parametrize("small", [False, True])
def test_upsert_takes_the_last_of_several_updates(spark, target, small):
    new = spark.createDataFrame(
        [("x", 10, "u", day(6)), ("x", 11, "u", day(8)), ("x", 12, "u", None), ("z", 1, "u", day(1)),
         ("z", 2, "u", day(2))], TARGET)
    merged = upsert(target, new, ["k"], ["a"], order=["lastupdated"], small_updates=small)
    assert values(merged, "k", "a") == [("x", 11), ("y", 2), ("z", 2)]


def test_columns_missing_from_the_updates_are_null_in_new_rows(spark, target):
    merged = upsert(target, spark.createDataFrame([("z", 3), ("x", 7)], "k string, a int"), ["k"], ["a", "b"])
    assert values(merged, "k", "a", "b") == [("x", 7, "old"), ("y", 2, "old"), ("z", 3, None)]


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("old, new, takes", [
    (5, 6, True), (5, 5, False), (5, 4, False), (5, None, False), (None, 1, True), (None, None, True),
])
def test_newer_only(spark, old, new, takes, small):
    before = spark.createDataFrame([("x", 1, "b", day(old))], TARGET)
    update = spark.createDataFrame([("x", 2, "b", day(new)), ("n", 3, "b", None)], TARGET)
    merged = upsert_newer(before, update, ["k"], ["a", "lastupdated"], small_updates=small)
    assert values(merged, "k", "a") == [("n", 3), ("x", 2 if takes else 1)]


def test_insert_absent(spark, target):
    new = spark.createDataFrame([("x", 9), ("z", 5), ("z", 5)], "k string, a int")
    assert values(insert_absent(target, new, ["k"]), "k", "a") == [("x", 1), ("y", 2), ("z", 5)]


def test_keep_last_drops_copies_before_the_shuffle(spark):
    rows = spark.range(1000).select(F.floor(F.col("id") / 1000).alias("k"), "id")
    last = keep_last(rows, ["k"], ["id"])
    assert values(last, "id") == [(999,)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_links_are_replaced_within_their_context(spark):
    links = spark.createDataFrame([("c1", "o1"), ("a1", "o1")], "category_id string, option_id string")
    fresh = spark.createDataFrame([("c1", "o2"), ("c2", "o3")], "category_id string, option_id string")
    entities = spark.createDataFrame(
        [("c1", "category"), ("a1", "attribute")], "id string, combo_type string")
    owners = combo_owners(entities, "category", "category_id")
    assert values(replace_links(links, fresh, owners), "category_id", "option_id") == [
        ("a1", "o1"), ("c1", "o2"), ("c2", "o3")]


def test_option_combo_owners(spark):
    option_combos = spark.createDataFrame(
        [("oc1", "cc1", "s"), ("oc2", "cc2", "s"), ("oc3", "cc1", "t")],
        "id string, categorycombo_id string, datasource_id string")
    combos = spark.createDataFrame(
        [("cc1", "category", "s"), ("cc2", "attribute", "s")], "id string, combo_type string, datasource_id string")
    assert values(option_combo_owners(option_combos, combos, "category", "oc"), "oc") == [("oc1",)]

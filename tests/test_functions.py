"""Column functions on hand-written edge rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from careledger.functions import text
from careledger.functions.calendar import ethiopian_date
from careledger.functions.combos import merge_combos, metric_slot, split_metric
from careledger.functions.names import number_clashes, safe_name
from careledger.functions.periods import period_type
from careledger.functions.values import parse_value


def column(spark, values, fn, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("v")).alias("out")).collect()]


def as_float(value):
    """The rule the column function stands for."""
    if value is None or value.strip() == "":
        return None, None
    try:
        return None, float(value.strip())
    except ValueError:
        return value.strip(), None


VALUES = [
    None, "", "   ", " 5 ", "\t5\n", ".5", "5.", "+5", "1e5", "1E-3", "-.5e+7", "1e1_0", "nan", "NaN",
    "+nan", "inf", "INF", "Infinity", "1e400", "1d", "1f", "0x1p3", "1_000", "1__0", "_1", "1_", "1_.5",
    "1._5", "1e", "e5", ".", "-", "--1", "1.2.3", "1,000", "5%", "12 34", "true", "infinit", "-inf",
    " 5 ", "-0", "007", "1e-400",
]


def test_parse_value_agrees_with_float(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    got = [tuple(r) for r in df.select(*parse_value(F.col("v"))).collect()]
    for value, (txt, num) in zip(VALUES, got):
        want_txt, want_num = as_float(value)
        assert txt == want_txt, value
        if want_num is not None and math.isnan(want_num):
            assert math.isnan(num), value
        else:
            assert num == want_num, value


def test_parse_value_of_any_length(spark):
    many = 1_000_000
    values = ["1" + "_0" * many, "1_" * many, "." + "0_" * many + "1", "9" * many, "1." + "1_1" * many + "e_"]
    out = spark.createDataFrame([(v,) for v in values], "v string").select(*parse_value(F.col("v"))).toDF("txt", "num").collect()
    assert [(r["num"], r["txt"] is None) for r in out] == [
        (math.inf, True), (None, False), (0.0, True), (math.inf, True), (None, False),
    ]


def test_ethiopian_date_known_days(spark):
    days = {
        "2007-09-12": "2000-01-01", "2023-09-11": "2015-13-06", "2023-09-12": "2016-01-01",
        "2024-09-10": "2016-13-05", "2024-09-11": "2017-01-01", "2024-01-01": "2016-04-22",
        "1970-01-01": "1962-04-23", "not-a-date": "not-a-date", "2024": "2024",
        "2024-02-30": "2024-02-30", "0001-01-01": "0001-01-01",
    }
    assert column(spark, days, ethiopian_date) == list(days.values())


def test_ethiopian_years_are_whole(spark):
    first = dt.date(1900, 1, 1)
    days = spark.range(0, 73000).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).cast("string").alias("g"), "id"
    ).select("id", ethiopian_date(F.col("g")).alias("e"))
    rows = [r.e for r in days.orderBy("id").collect()]
    assert rows == sorted(set(rows))
    lengths = {}
    for e in rows:
        lengths[e[:4]] = lengths.get(e[:4], 0) + 1
    whole = {y: n for y, n in lengths.items() if y not in (rows[0][:4], rows[-1][:4])}
    assert all(n == (366 if int(y) % 4 == 3 else 365) for y, n in whole.items())


def test_iso_text(spark):
    assert column(spark, ["2024-01-02T03:04:05.678+0000", "", None, "x"], text.iso_timestamp) == [
        dt.datetime(2024, 1, 2, 3, 4, 5), None, None, None]
    assert column(spark, ["2024-01-02T03:04:05.678+0000", "2024-01-02T03:04:05"], text.iso_timestamp_ms) == [
        dt.datetime(2024, 1, 2, 3, 4, 5, 678000), dt.datetime(2024, 1, 2, 3, 4, 5)]
    assert column(spark, ["2024-01-02T00:00:00", "2024-13-01", None], text.iso_date) == [
        dt.date(2024, 1, 2), None, None]


def test_flags(spark):
    assert column(spark, ["true", "True", "false", "1", None], text.is_true) == [True, True, False, False, False]
    assert [text.flag(v) for v in (True, "Y", "1", "t", "yes", "no", "", None, False)] == [
        True, True, True, True, True, False, False, False, False]


def test_id_lists(spark):
    assert column(spark, ["a, b,,a", "", None, " "], text.split_ids) == [["a", "b"], [], None, []]


def test_path_levels(spark):
    path = "/a/b/c"
    assert [column(spark, [path], lambda c, i=i: text.path_level(c, i))[0] for i in range(1, 9)] == [
        "a", "b", "c", "", "", "", "", ""]
    assert column(spark, ["/1/2/3/4/5/6/7/8/9", None], lambda c: text.path_level(c, 8)) == ["8", None]


def test_period_type(spark):
    ids = {
        "2021W52": "Weekly", "2021W5": "Weekly", "202101": "Monthly", "2021Q3": "Quarterly",
        "2021S1": "SixMonthly", "2021": "Yearly", "20210115": None, "2021W": None, "202101\n": None,
        "2021W123": None, None: None,
    }
    assert column(spark, ids, period_type) == list(ids.values())


NAMES = {
    "Age (Years)": "age_years", "5-9 ans": "_5_9_ans", "Sexe é": "sexe_e", "***": "col", None: "col",
    "a" * 80: "a" * 63, "  x__y  ": "x_y", "_lead_": "lead", "ﬁn": "fin", "": "col", "A=B;C\tD": "a_b_c_d",
    "ሰው": "col",
}


def test_safe_name(spark):
    assert column(spark, NAMES, safe_name) == list(NAMES.values())


def test_name_clashes():
    assert number_clashes({"Sex": "sex", "Sex 2": "sex_2", "sex!": "sex"}) == {
        "Sex": "sex", "Sex 2": "sex_2", "sex!": "sex_3"}
    assert number_clashes({"a": "id"}, reserved=("id",)) == {"a": "id_2"}


COMBOS = "root struct<id:string,name:string>, el array<struct<categoryCombo:struct<id:string,name:string>>>"


@pytest.mark.parametrize("root, elements, want", [
    (None, None, ("", "")),
    (("r", "R"), None, ("r", "R")),
    (("r", None), [(("r", "R"),), (("b", "B"),)], ("r,b", "R,B")),
    (("r", ""), [(("b", "B"),), (None,)], ("r,b", "B")),
    (None, [(("b", ""),), (("a", "A"),), (("b", "B"),), (("b", "C"),)], ("b,a", "B,A")),
    (("", "x"), [((None, "y"),)], ("", "")),
])
def test_merge_combos(spark, root, elements, want):
    df = spark.createDataFrame([(root, elements)], COMBOS)
    assert tuple(df.select(*merge_combos(F.col("root"), F.col("el"))).first()) == want


def test_metrics(spark):
    df = spark.createDataFrame([("ds.EXPECTED_REPORTS",), ("nodot",), ("a.b.c",), ("ds.",)], "v string")
    assert [tuple(r) for r in df.select(*split_metric(F.col("v"))).collect()] == [
        ("ds", "EXPECTED_REPORTS"), (None, None), (None, None), ("ds", "")]
    assert column(spark, ["EXPECTED_REPORTS", "ACTUAL_REPORTS", "ACTUAL_REPORTS_ON_TIME", "X"], metric_slot) == [
        "expected_reports", "actual_reports", "actual_reports_on_time", None]

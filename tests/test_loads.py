"""Loads into a warehouse: failures, reruns, rebuilds, empty input."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from careledger.operators.ghosts import ghost_counts
from careledger.plans import facts, metadata, runs
from careledger.plans.checks import check_table
from careledger.plans.work import changed_values, reporting_work, value_work
from careledger.queries import landing
from careledger.schemas import ENVELOPE, TABLES
from careledger.sources import payloads, warehouse
from careledger.sources.landing import check_pages, decode, read_landing
from careledger.sources.warehouse import KEPT_SNAPSHOTS, ConcurrentWrite, Warehouse, merge_catalog_table
from careledger.streaming.incremental import load_new

NOON = dt.datetime(2024, 3, 10, 12, 0)


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def landed(spark, *rows):
    """Rows of (request_id, orgunit, body[, page, status, fetched_at]); bodies may be objects."""
    full = []
    for request, unit, body, *rest in rows:
        page, status, at, responses = (*rest, *(1, "ok", NOON, None)[len(rest):])
        body = body if isinstance(body, (str, type(None))) else json.dumps(body)
        full.append((request, "hmis", unit, page, status, at, body, responses))
    return spark.createDataFrame(full, ENVELOPE)


def value(unit, element="e", period="202401", value="1", coc="c", updated="2024-01-01T00:00:00.000", **more):
    return {"orgUnit": unit, "dataElement": element, "period": period, "categoryOptionCombo": coc,
            "attributeOptionCombo": "a", "value": value, "lastUpdated": updated, **more}


def values(*items):
    return {"dataValues": list(items)}


def units(spark, wh, *ids):
    fill(wh, "orgunits", spark.createDataFrame([(i, "hmis", True) for i in ids], "id string, datasource_id string, leaf boolean"))


def fill(wh, name, df):
    full = df.select(*[
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in TABLES[name].schema])
    wh.overwrite_partitions(name, full) if TABLES[name].partitions else wh.replace(name, full)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_values_and_watermarks(spark, wh):
    units(spark, wh, "u1", "u2", "u3", "u4", "u5", "u6")
    counts = facts.load_values(wh, landed(
        spark,
        ("r1", "u1", values(value("u1", value=" 7 ", followUp=True), value("u1", element="t", value="yes"))),
        ("r2", "u2", values()),
        ("r3", "u3", '{"dataValues": [{"orgUnit": "u3", "dataElem'),
        ("r4", "u4", None, 1, "failed", NOON),
        ("r5", "u5", values(value("u5"), value("u5", element=None))),
        ("r6", "u6", {}),
    ), NOON)
    assert counts == {"rows": 2, "requests": 6, "failed": 3}
    assert got(wh.read("datavalues"), "orgunit", "dataelement", "value_string", "value_double", "followup") == [
        ("u1", "e", None, 7.0, True), ("u1", "t", "yes", None, None)]
    today = dt.date(2024, 3, 10)
    assert got(wh.read("orgunits"), "id", "dv_downloadedat") == [
        ("u1", today), ("u2", today), ("u3", None), ("u4", None), ("u5", None), ("u6", today)]


def test_later_load_refreshes_the_chosen_columns(spark, wh):
    first = values(value("u", value="1", comment="first"), value("u", period="202402", value="2"))
    second = values(
        value("u", value="text", comment="second", updated="2023-01-01T00:00:00", deleted=True),
        value("u", value="older", updated="2022-01-01T00:00:00"), value("u", period="202403", value="3"))
    facts.load_values(wh, landed(spark, ("r1", "u", first)), NOON)
    for _ in range(2):
        facts.load_values(wh, landed(spark, ("r2", "u", second)), NOON)
        assert got(wh.read("datavalues"), "period", "value_string", "value_double", "comment", "deleted") == [
            ("202401", "text", None, "first", True), ("202402", None, 2.0, None, None),
            ("202403", None, 3.0, None, None)]


def test_merge_in_both_plans(spark, wh, monkeypatch):
    facts.load_values(wh, landed(spark, ("r", "u", values(value("u", value="1")))), NOON)
    for size, number in ((0, "2"), (1 << 30, "3")):
        monkeypatch.setattr("careledger.sources.warehouse.BROADCAST_BYTES", size)
        facts.load_values(wh, landed(spark, ("r", "u", values(
            value("u", value=number), value("u", element=f"x{number}", value="9")))), NOON)
    assert got(wh.read("datavalues"), "dataelement", "value_double") == [("e", 3.0), ("x2", 9.0), ("x3", 9.0)]


def files(wh, name):
    return set(wh.read(name).inputFiles())


def test_late_value_rewrites_one_bucket(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=4)
    units_ = [f"u{i}" for i in range(40)]
    for period in ("202401", "202402"):
        facts.load_values(wh, landed(spark, *((u, u, values(value(u, period=period))) for u in units_)), NOON)
    before = files(wh, "datavalues")
    assert len(before) == 8 and wh.buckets_of("datavalues") == 4
    # Another writer's setting doesn't change the table's own.
    again = Warehouse(spark, wh.root, buckets=16)
    facts.load_values(again, landed(spark, ("r", "u7", values(value("u7", value="9")))), NOON)
    after = files(wh, "datavalues")
    assert len(before - after) == 1 and len(after - before) == 1 and "period=202401" in (after - before).pop()
    assert got(wh.read("datavalues").filter("value_double = 9"), "orgunit", "period") == [("u7", "202401")]
    assert wh.read("datavalues").count() == 80 and wh.read("datavalues").columns == TABLES["datavalues"].schema.names
    assert got(wh.periods_of("datavalues", "hmis"), "period") == [("202401",), ("202402",)]
    # A new unit makes its row in one bucket of one period as well.
    facts.load_values(wh, landed(spark, ("r", "new", values(value("new", period="202402")))), NOON)
    assert len(after - files(wh, "datavalues")) == 1 and wh.read("datavalues").count() == 81


def test_merge_of_a_bucket_reads_its_folder_only(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=4)
    facts.load_values(wh, landed(spark, *((f"u{i}", f"u{i}", values(value(f"u{i}"))) for i in range(40))), NOON)
    late = wh.read("datavalues").filter("orgunit = 'u3'")
    touched = wh.touched("datavalues", late)
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert 0 < touched.count() < 25


def test_ghosts_in_buckets(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=3)
    rows = [value(f"u{i}", coc="wrong" if i in (4, 9) else "c", period=p) for i in range(12) for p in ("202401", "202402")]
    facts.load_values(wh, landed(spark, ("r", "u", values(*[r for r in rows if r["period"] == "202402" or r["categoryOptionCombo"] == "c"]))), NOON)
    fill(wh, "dataelements", spark.createDataFrame([("e", "cc", "hmis")], "id string, categorycombo_id string, datasource_id string"))
    fill(wh, "categoryoptioncombos", spark.createDataFrame([("c", "cc", "hmis")], "id string, categorycombo_id string, datasource_id string"))
    before = files(wh, "datavalues")
    facts.clean_ghosts(wh, "hmis")
    assert got(wh.read("datavalues"), "orgunit", "period") == sorted((r["orgUnit"], r["period"]) for r in rows if r["categoryOptionCombo"] == "c")
    assert all("period=202402" in f for f in before ^ files(wh, "datavalues"))
    facts.load_values(wh, landed(spark, ("x", "u0", values(value("u0", period="202403", coc="wrong")))), NOON)
    facts.clean_ghosts(wh, "hmis")
    assert wh.read("datavalues").filter("period = '202403'").isEmpty()


def test_ghosts_are_counted_by_pairs_in_one_scan(spark, wh):
    facts.load_values(wh, landed(spark, ("r", "u", values(value("u"), value("u", coc="wrong")))), NOON)
    counts = ghost_counts(
        wh.placed("datavalues", "hmis"), wh.read("dataelements"), wh.read("categoryoptioncombos", "hmis"), ["datasource_id", "period"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "ReadSchema: struct<dataelement:string,categoryoptioncombo:string>" in plan
    assert got(counts, "period", "rows", "ghosts") == [("202401", 2, 2)]


def test_a_load_counts_while_it_writes(spark, wh, monkeypatch):
    jobs = []
    monkeypatch.setattr(Warehouse, "stage", lambda self, df, stage=Warehouse.stage: jobs.append(1) or stage(self, df))
    counts = facts.load_values(wh, landed(spark, ("r1", "u1", values(value("u1"))), ("r2", "u2", None, 1, "failed", NOON)), NOON)
    assert counts == {"rows": 1, "requests": 2, "failed": 1}
    assert len(jobs) == 3
    assert facts.load_values(wh, landed(spark), NOON) == {"rows": 0, "requests": 0, "failed": 0}


def test_answers_without_a_page_all_count(spark, wh):
    units(spark, wh, "u")
    later = NOON + dt.timedelta(hours=1)
    facts.load_values(wh, landed(
        spark, ("r", "u", values(value("u", element="a")), None), ("r", "u", values(value("u", element="b")), None, "ok", later),
        ("s", "u", None, 1, "error", NOON), ("s", "u", values(value("u", element="c")), 1, "ok", NOON)), NOON)
    assert got(wh.read("datavalues"), "dataelement") == [("a",), ("b",), ("c",)] and marks(wh) == {"u": NOON.date()}


def test_one_endless_value_fails_no_load(spark, wh):
    many = "1" + "_0" * 200_000 + "_"
    assert facts.load_values(wh, landed(spark, ("r", "u", values(value("u", value=many), value("v")))), NOON)["failed"] == 0
    assert got(wh.read("datavalues").filter("orgunit = 'u'"), "value_string") == [(many,)]


def test_rates(spark, wh):
    units(spark, wh, "u1", "u2", "u3", "u4")
    grid = lambda *rows: {"rows": list(rows)}
    facts.load_rates(wh, landed(
        spark,
        ("b1", "u1;u2", grid(["d.EXPECTED_REPORTS", "u1", "202401", 4], ["d.ACTUAL_REPORTS", "u1", "202401", "3.0"])),
        ("b1", "u1;u2", grid(["d.ACTUAL_REPORTS", "u1", "202401", "2"], ["d.OTHER", "u2", "202401", "2"]), 2, "ok", NOON),
        ("b2", "u3", grid(["d.EXPECTED_REPORTS", "u3", "202401", "4"], ["nodot", "u3", "202401", "1"])),
        ("b3", "u4", grid(["d.EXPECTED_REPORTS", "u4", "202401", "four"])),
        ("b4", "u4", grid(["d.EXPECTED_REPORTS", "u4", "202401"])),
    ), NOON)
    assert got(wh.read("reporting_rates"), "orgunit_id", "expected_reports", "actual_reports", "actual_reports_on_time") == [
        ("u1", 4.0, 2.0, 0.0), ("u2", 0.0, 0.0, 0.0)]
    assert [r.id for r in wh.read("orgunits").filter("rr_downloadedat is not null").orderBy("id").collect()] == ["u1", "u2"]


def test_completeness_defaults_to_true(spark, wh):
    registration = {"dataSet": "d", "organisationUnit": "u", "period": "202401", "attributeOptionCombo": "a",
                    "date": "2024-01-05T06:07:08.000", "lastUpdated": ""}
    body = {"completeDataSetRegistrations": [registration, {**registration, "period": "202402", "completed": False}]}
    facts.load_completeness(wh, landed(spark, ("r", "u", body)), NOON)
    assert got(wh.read("dataset_completeness"), "period", "completed", "date_submitted", "lastupdated") == [
        ("202401", True, dt.datetime(2024, 1, 5, 6, 7, 8), None), ("202402", False, dt.datetime(2024, 1, 5, 6, 7, 8), None)]


def test_periods_are_the_missing_ones(spark, wh):
    facts.load_values(wh, landed(spark, ("r", "u", values(value("u"), value("u", period="2024W1"), value("u", period="bad")))), NOON)
    items = {"202401": {"name": "January", "startDate": "2024-01-01T00:00:00.000", "endDate": "2024-01-31T00:00:00.000"},
             "202405": {"startDate": "2024-05-01", "endDate": "2024-05-31"}, "bad": {"name": "no dates"}}
    for _ in range(2):
        facts.load_periods(wh, landed(spark, ("p", "", {"metaData": {"items": items}})), "hmis")
        assert got(wh.read("periods"), "id", "start_date", "period_name") == [("202401", dt.date(2024, 1, 1), "January")]


def test_rebuild(spark, wh):
    units(spark, wh, "u1")
    facts.load_rates(wh, landed(spark, ("b", "u1", {"rows": [["d.EXPECTED_REPORTS", "u1", "202401", "4"]]})), NOON)
    other = wh.read("reporting_rates").withColumn("datasource_id", F.lit("phem"))
    wh.overwrite_partitions("reporting_rates", other)
    facts.prepare_rebuild(wh, "reporting_rates", "hmis", False)
    assert wh.read("reporting_rates").count() == 2
    facts.prepare_rebuild(wh, "reporting_rates", "hmis", True)
    assert got(wh.read("reporting_rates"), "datasource_id") == [("phem",)]
    assert got(wh.read("orgunits"), "rr_downloadedat") == [(None,)]


def test_ghosts_empty_partitions_and_guard(spark, wh):
    facts.load_values(wh, landed(spark, ("r", "u", values(
        value("u"), value("u", coc="wrong"), value("u", period="202402", coc="wrong"), value("u", period="202403")))), NOON)
    facts.clean_ghosts(wh, "hmis", guard_empty=True)
    assert wh.read("datavalues").count() == 4
    fill(wh, "dataelements", spark.createDataFrame([("e", "cc", "phem")], "id string, categorycombo_id string, datasource_id string"))
    fill(wh, "categoryoptioncombos", spark.createDataFrame([("c", "cc", "hmis")], "id string, categorycombo_id string, datasource_id string"))
    facts.clean_ghosts(wh, "hmis")
    assert got(wh.read("datavalues"), "period", "categoryoptioncombo") == [("202401", "c"), ("202403", "c")]
    fill(wh, "dataelements", wh.read("dataelements").limit(0))
    facts.clean_ghosts(wh, "hmis")
    assert wh.read("datavalues").count() == 0


def element(i, updated="2024-01-01T00:00:00.000", **more):
    return {"id": i, "name": i, "lastUpdated": updated, "created": "2020-01-01T00:00:00.000", **more}


def test_elements_newer_only_and_failure_gate(spark, wh):
    metadata.load_data_elements(wh, landed(spark, ("e", "", element("e", name="first"))))
    metadata.load_data_elements(wh, landed(
        spark, ("e", "", element("e", name="same")), ("f", "", element("f", None)), ("g", "", None, 1, "failed", NOON)))
    assert got(wh.read("dataelements"), "id", "name") == [("e", "first"), ("f", "f")]
    metadata.load_data_elements(wh, landed(
        spark, ("e", "", element("e", "2024-02-01T00:00:00.000", name="newer")), ("f", "", element("f", name="dated"))))
    assert got(wh.read("dataelements"), "id", "name") == [("e", "newer"), ("f", "dated")]
    with pytest.raises(RuntimeError):
        metadata.load_data_elements(wh, landed(
            spark, ("h", "", element("h")), ("i", "", "{broken"), ("j", "", None, 1, "failed", NOON)))
    assert wh.read("dataelements").count() == 3


def page(number, count, *ids, **more):
    return {"pager": {"page": number, "pageCount": count}, "organisationUnits": [
        {"id": i, "name": i.upper(), "path": f"/{'/'.join(ids[:ids.index(i) + 1])}", "leaf": i != "b" or "True", **more} for i in ids]}


def test_org_units_need_all_pages(spark, wh):
    crawl = landed(spark, ("o", "", page(1, 2, "a", "b")), ("o", "", page(2, 2, "a", "b", "c"), 2, "ok", NOON))
    metadata.load_org_units(wh, crawl)
    metadata.build_hierarchy(wh, "hmis")
    assert got(wh.read("orgunits"), "id", "oulevel1name", "oulevel3name", "leaf") == [
        ("a", "A", None, True), ("b", "A", None, True), ("c", "A", "C", True)]
    with pytest.raises(ValueError):
        metadata.load_org_units(wh, landed(spark, ("o", "", page(1, 2, "z"))))
    metadata.load_org_units(wh, landed(spark, ("o", "", page(1, 1))))
    assert wh.read("stg_orgunits").count() == 3


def test_page_check(spark):
    decoded = decode(landed(
        spark, ("a", "", page(1, 2, "x")), ("a", "", page(2, 2, "y"), 2, "ok", NOON), ("b", "", page(1, 3, "z")),
        ("c", "", None, 1, "failed", NOON)), "orgunits")
    assert got(check_pages(decoded), "request_id", "complete") == [("a", True), ("b", False), ("c", False)]


def combo(*options):
    return {"id": "cc", "name": "combo", "categories": [
        {"id": "cat", "name": "Sex", "categoryOptions": [{"id": o, "name": o.upper()} for o in options]}]}


def option_combos(*pairs):
    return {"categoryOptionCombos": [
        {"id": i, "name": i, "categoryCombo": {"id": "cc"}, "categoryOptions": [{"id": o}]} for i, o in pairs]}


def test_combos_dimension_and_links(spark, wh):
    metadata.load_combos(wh, landed(spark, ("cc", "", combo("m", "f"))), "category")
    metadata.load_option_combos(wh, landed(spark, ("cc", "", option_combos(("ocm", "m"), ("ocf", "f")))), "category")
    metadata.build_dimensions(wh, "hmis", "category", NOON)
    metadata.build_dimensions(wh, "hmis", "attribute", NOON)
    assert got(wh.read("hmis_categories"), "categoryoptioncombo_id", "sex") == [("ocf", "F"), ("ocm", "M")]
    assert got(wh.read("category_name_map"), "original_name", "safe_name") == [("Sex", "sex")]
    with pytest.raises(FileNotFoundError):
        wh.read("hmis_attributes")
    # The same combo as an attribute keeps the links made in the category context.
    metadata.load_combos(wh, landed(spark, ("cc", "", combo("m"))), "attribute")
    assert got(wh.read("categories"), "id", "combo_type") == [("cat", "attribute"), ("cat", "category")]
    assert got(wh.read("category_categoryoptions"), "categoryoption_id") == [("m",)]
    # Nothing fetched, nothing changed.
    metadata.load_combos(wh, landed(spark, ("cc", "", None, 1, "failed", NOON)), "category")
    metadata.load_option_combos(wh, landed(spark, ("cc", "", {})), "category")
    assert wh.read("categoryoptioncombo_options").count() == 2


def test_seed_keeps_known_sources(spark, wh):
    metadata.seed_sources(wh, [("hmis", "Health", "u", "d")], NOON)
    metadata.seed_sources(wh, [("hmis", "changed", "u", "d"), ("phem", "Emergency", "u", "d")], NOON)
    assert got(wh.read("datasource"), "id", "title") == [("hmis", "Health"), ("phem", "Emergency")]


def test_incremental_runs_load_only_new_files(spark, wh, tmp_path):
    folder = str(tmp_path / "landing")
    seen = []

    def load(warehouse, batch, as_of):
        seen.extend(r.request_id for r in batch.collect())
        facts.load_values(warehouse, batch, as_of)

    for n in ("1", "2"):
        landed(spark, (f"r{n}", "u", values(value("u", value=n)))).coalesce(1).write.mode("append").json(folder)
        load_new(wh, folder, NOON, load, checkpoint=str(tmp_path / "progress"))
        load_new(wh, folder, NOON, load, checkpoint=str(tmp_path / "progress"))
        assert got(wh.read("datavalues"), "value_double") == [(float(n),)]
    assert seen == ["r1", "r2"]
    assert read_landing(spark, folder).count() == 2


def test_snapshots(spark, wh):
    for n in range(3):
        wh.replace("numbers", spark.range(n + 1))
    # A snapshot that was not finished is not read.
    spark.range(9).write.parquet(f"{wh.root}/numbers/snapshot-00000009")
    assert wh.read("numbers").count() == 3
    wh.expire("numbers", keep=1)
    assert wh.read("numbers").count() == 3
    wh.replace("numbers", wh.read("numbers").limit(1))
    assert wh.read("numbers").count() == 1


def test_requests_of_a_source(spark, wh):
    units(spark, wh, *[f"u{n}" for n in range(9)])
    fill(wh, "datasets", spark.createDataFrame([("d", "Monthly", "hmis"), ("w", "Weekly", "hmis")], "id string, periodtype string, datasource_id string"))
    fill(wh, "dataset_orgunits", spark.createDataFrame([("d", f"u{n}", "hmis") for n in range(8)] + [("w", "u8", "hmis")], "dataset_id string, orgunit_id string, datasource_id string"))
    fill(wh, "periods", spark.createDataFrame(
        [(f"2023{m:02d}", dt.date(2023, m, 1), "hmis") for m in range(1, 13)] + [("202402", dt.date(2024, 2, 1), "hmis")],
        "id string, start_date date, datasource_id string"))
    facts.load_values(wh, landed(spark, ("r", "u0", values(value("u0", period="202399")))), NOON)
    requests = runs.plan_requests(wh, "hmis", ["e1", "e2"], "2020-01-01", NOON)
    assert requests["values"].count() == 8
    assert got(requests["values"].limit(1), "dataelement", "since") == [("e1,e2", "2012-04-22")]
    assert got(requests["periods"], "pe") == [("202399",)]
    grid = requests["grid"].collect()
    assert sorted(len(r.ou.split(";")) for r in grid) == [1, 7]
    assert {r.dx for r in grid} == {"d.EXPECTED_REPORTS;d.ACTUAL_REPORTS;d.ACTUAL_REPORTS_ON_TIME"}
    assert {r.pe for r in grid} == {"202312;202402"}
    assert {r.dataset for r in requests["completeness"].collect()} == {"d"}
    work = reporting_work(
        wh.read("orgunits"), wh.read("dataset_orgunits"), wh.read("datasets"), wh.read("periods"), "hmis", NOON)
    plan = work._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [types" in plan and "SortMergeJoin" not in plan
    assert "completeness" not in runs.plan_requests(wh, "phem", ["e"], "2020-01-01", NOON)


def test_catalog_merge_needs_a_table_that_supports_it(spark):
    spark.range(1).selectExpr("CAST(id AS STRING) AS k", "id AS v").write.mode("overwrite").saveAsTable("plain")
    updates = spark.createDataFrame([("0", 5)], "k string, v long")
    with pytest.raises(UnsupportedOperationException, match="MERGE"):
        merge_catalog_table(updates, "plain", ["k"], ["v"])


def test_assignments_of_tracked_sets_only(spark):
    body = page(1, 1, "a", dataSets=[{"id": "known"}, {"id": "known"}, {"id": "other"}])
    tracked = spark.createDataFrame([("known", "hmis"), ("other", "phem")], "id string, datasource_id string")
    links = payloads.org_unit_assignments(decode(landed(spark, ("o", "", body)), "orgunits"), tracked)
    assert got(links, "dataset_id", "orgunit_id") == [("known", "a")]


def test_table_check(spark, wh):
    metadata.seed_sources(wh, [("hmis", "Health", "u", "d")], NOON)
    fill(wh, "datasets", spark.createDataFrame(
        [("d", "hmis", "x" * 12), ("d", "hmis", "ok"), (None, "phem", "ok")],
        "id string, datasource_id string, categorycombo_id string"))
    assert got(check_table(wh, "datasets").filter("n > 0"), "check", "column_name", "n") == [
        ("duplicate key", None, 1), ("null in key", None, 1), ("too long", "categorycombo_id", 1),
        ("unknown source", "datasource_id", 1)]


def marks(wh):
    return {r["id"]: r["dv_downloadedat"] for r in wh.read("orgunits").collect()}


def test_requests_count_only_when_complete(spark, wh):
    units(spark, wh, "u1", "u2")
    one, two = (values(value("u1", element=e)) for e in ("e1", "e2"))
    # The first of two answers, beside a request that is complete.
    facts.load_values(wh, landed(
        spark, ("r1", "u1", one, 1, "ok", NOON, 2), ("r2", "u2", values(value("u2")), 1, "ok", NOON, 1)), NOON)
    assert got(wh.read("datavalues"), "orgunit") == [("u2",)]
    assert marks(wh) == {"u1": None, "u2": NOON.date()}
    facts.load_values(wh, landed(spark, ("r3", "u2", values(value("u2")), 1, "ok", NOON, 1)), NOON)
    facts.load_values(wh, landed(spark, ("r1", "u1", two, 2, "ok", NOON, 2)), NOON)
    assert got(wh.read("datavalues"), "orgunit", "dataelement") == [("u1", "e1"), ("u1", "e2"), ("u2", "e")]
    assert marks(wh) == {"u1": NOON.date(), "u2": NOON.date()}
    assert wh.read("pending_datavalues").isEmpty()


def test_retry_heals_a_request(spark, wh):
    units(spark, wh, "u")
    later = NOON + dt.timedelta(hours=1)
    facts.load_values(wh, landed(spark, ("r", "u", None, 1, "error", NOON), ("r", "u", values(value("u", element="x")), 2)), NOON)
    assert wh.read("datavalues").isEmpty() and marks(wh) == {"u": None}
    facts.load_values(wh, landed(spark, ("r", "u", values(value("u")), 1, "ok", later)), NOON)
    assert got(wh.read("datavalues"), "dataelement") == [("e",), ("x",)] and marks(wh) == {"u": NOON.date()}
    both = landed(spark, ("s", "u", None, 1, "error", NOON), ("s", "u", values(value("u", element="y")), 1, "ok", later))
    assert facts.load_values(wh, both, NOON) == {"rows": 1, "requests": 1, "failed": 0}


def test_answers_without_a_request_are_rejected(spark, wh):
    units(spark, wh, "u")
    assert facts.load_values(wh, landed(spark, (None, "u", values(value("u")))), NOON)["failed"] == 1
    assert wh.read("datavalues").isEmpty()


def test_empty_period_fails_its_request_and_loses_nothing(spark, wh):
    for unit in ("u1", "u2"):
        facts.load_values(wh, landed(spark, (unit, unit, values(value(unit)))), NOON)
    facts.load_values(wh, landed(spark, ("r", "u3", values(value("u3", period=""))), ("s", "u4", values(value("u4")))), NOON)
    assert got(wh.read("datavalues"), "orgunit") == [("u1",), ("u2",), ("u4",)]
    blank = wh.read("datavalues").limit(1).withColumn("period", F.lit(""))
    with pytest.raises(ValueError, match="period"):
        wh.merge("datavalues", blank)


def test_old_files_and_two_warehouses(spark, wh, tmp_path):
    folder = tmp_path / "landing"
    for n, age in (("1", 0), ("2", 9)):
        before = set(folder.glob("*.json"))
        landed(spark, (f"r{n}", f"u{n}", values(value(f"u{n}")))).coalesce(1).write.mode("append").json(str(folder))
        for file in set(folder.glob("*.json")) - before:
            os.utime(file, (time.time() - age * 86400,) * 2)
        load_new(wh, str(folder), NOON)
    other = Warehouse(spark, str(tmp_path / "other"))
    load_new(other, str(folder), NOON)
    for warehouse in (wh, other):
        assert got(warehouse.read("datavalues"), "orgunit") == [("u1",), ("u2",)]


def test_tables_without_success_files(spark, wh):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        units(spark, wh, "u1", "u2")
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert wh.read("orgunits").count() == 2
    spark.range(1).write.parquet(f"{wh.root}/broken/snapshot-00000001")
    with pytest.raises(RuntimeError, match="finished"):
        wh.read("broken")


def test_interleaved_writers_keep_both_changes(spark, wh, monkeypatch):
    monkeypatch.setattr("time.sleep", lambda s: None)
    wh.replace("numbers", spark.range(1))
    other = Warehouse(spark, wh.root)
    turns = []

    def change(df):
        if not turns:
            turns.append(1)
            other.update("numbers", lambda d: d.union(spark.range(10, 11)))
        return df.union(spark.range(20, 21))

    wh.update("numbers", change)
    assert got(wh.read("numbers"), "id") == [(0,), (10,), (20,)]
    with pytest.raises(ConcurrentWrite):
        wh.replace("numbers", spark.range(1), base=1)
    for _ in range(12):
        wh.replace("numbers", spark.range(1))
    assert len([n for n, _ in wh._snapshots("numbers")]) == KEPT_SNAPSHOTS


def test_small_merges_do_not_add_files(spark, wh):
    for n in range(4):
        facts.load_values(wh, landed(spark, (f"r{n}", "u", values(value("u", element=f"e{n}")))), NOON)
    assert len(wh.read("datavalues").inputFiles()) == 1


def test_switches_may_be_text(spark, wh):
    units(spark, wh, "u")
    facts.load_values(wh, landed(spark, ("r", "u", values(value("u")))), NOON)
    facts.prepare_rebuild(wh, "datavalues", "hmis", "false")
    assert wh.read("datavalues").count() == 1 and marks(wh) == {"u": NOON.date()}
    facts.prepare_rebuild(wh, "datavalues", "hmis", "yes")
    assert wh.read("datavalues").isEmpty() and marks(wh) == {"u": None}


def test_entities_without_id_make_no_rows(spark, wh):
    body = {"id": "cc", "name": "n", "categories": [{"name": "no id", "categoryOptions": [{"id": "o"}]}, {"id": "c", "categoryOptions": [{"name": "x"}]}]}
    parts = payloads.category_combos(decode(landed(spark, ("r", None, body)), "combo"), "category")
    assert {k: [r[0] for r in v.collect()] for k, v in parts.items()} == {
        "categorycombos": ["cc"], "categories": ["c"], "categoryoptions": ["o"],
        "categorycombo_categories": ["cc"], "category_categoryoptions": [],
    }


def test_since_filter_of_ethiopian_work(spark):
    marks_ = [("u1", dt.date(2023, 9, 8)), ("u2", dt.date(2023, 10, 10)), ("u3", None)]  # month 13, day 30
    units_ = spark.createDataFrame([(i, "hmis", True, d) for i, d in marks_], "id string, datasource_id string, leaf boolean, dv_downloadedat date")
    work = value_work(units_, "hmis", "2023-01-01", NOON, ethiopian=True, dated=True)
    assert {r["since"][5:] for r in work.collect()} >= {"13-03"}
    rows = [(u, "e", dt.datetime(2023, m, 20)) for u in ("u1", "u2", "u3") for m in (2, 9, 12)]
    out = changed_values(spark.createDataFrame(rows, "orgunit string, dataelement string, lastupdated timestamp_ntz"), work)
    assert sorted((r["orgunit"], r["lastupdated"].month) for r in out.collect()) == [
        ("u1", 9), ("u1", 12), ("u2", 12), ("u3", 2), ("u3", 9), ("u3", 12)]


def test_periods_are_listed_from_folders(spark, wh):
    rows = [("hmis", "202401"), ("hmis", "2024 W1/x=%"), ("phem", "2023")]
    fill(wh, "datavalues", spark.createDataFrame(rows, "datasource_id string, period string"))
    assert got(wh.periods_of("datavalues", "hmis"), "period") == [("2024 W1/x=%",), ("202401",)]
    assert wh.periods_of("datavalues", "other").isEmpty()
    assert "FileScan" not in wh.periods_of("datavalues", "hmis")._jdf.queryExecution().executedPlan().toString()


def test_answers_are_dealt_over_all_cores(spark, tmp_path):
    """A table in one part, as a file of one row group is, is staged by all cores."""
    spark.range(4000).selectExpr(
        "id AS event_id", "TIMESTAMP '2001-01-01 00:00:00' AS ts", "id % 9 AS user_id", "'view' AS event_type", "1.0D AS value",
        "'{\"k\": 3}' AS props",
    ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(4000).selectExpr(
        "id AS o_orderkey", "id % 9 AS o_custkey", "'F' AS o_orderstatus", "1.0D AS o_totalprice",
        "TIMESTAMP '2001-01-01 00:00:00' AS o_orderdate", "'2-HIGH' AS o_orderpriority",
    ).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    cores = spark.sparkContext.defaultParallelism
    for answers in (landing.value_responses, landing.period_responses, landing.completeness_responses, landing.grid_responses):
        made = answers(spark, str(tmp_path))
        parts = [r["count"] for r in made.groupBy(F.spark_partition_id().alias("at")).count().collect()]
        assert sum(parts) == 4000 == made.select("request_id", "page").distinct().count()
        assert len(parts) >= cores and max(parts) <= 4000 / cores


def test_first_merge_compares_nothing(spark, wh, monkeypatch):
    upsert, calls = warehouse.upsert, []

    def noted(*args, **kwargs):
        calls.append(1)
        return upsert(*args, **kwargs)

    monkeypatch.setattr(warehouse, "upsert", noted)

    def rates(*rows):
        return spark.createDataFrame(rows, "dataset_id string, orgunit_id string, actual_reports double, datasource_id string, period string")

    def held():
        return sorted(map(tuple, wh.read("reporting_rates").select("dataset_id", "orgunit_id", "expected_reports", "actual_reports", "period").collect()))

    assert wh.merge("reporting_rates", rates(("d", "u", 1.0, "hmis", "2001"), ("d", "v", 2.0, "hmis", "2001"))) == 2
    assert held() == [("d", "u", None, 1.0, "2001"), ("d", "v", None, 2.0, "2001")] and not calls
    # A period without rows so far stands alone; rows of a known one are compared.
    wh.merge("reporting_rates", rates(("d", "u", 3.0, "hmis", "2002")))
    assert not calls
    wh.merge("reporting_rates", rates(("d", "u", 4.0, "hmis", "2001"), ("e", "u", 5.0, "hmis", "2003")))
    assert len(calls) == 1
    assert held() == [
        ("d", "u", None, 3.0, "2002"), ("d", "u", None, 4.0, "2001"), ("d", "v", None, 2.0, "2001"), ("e", "u", None, 5.0, "2003"),
    ]

"""Whole loads into a scratch warehouse: what the tables hold afterwards."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from careledger.plans import facts, metadata, runs
from careledger.queries import landing
from careledger.queries.base import AS_OF, query, scratch_warehouse, table, view
from careledger.queries.facts import JUDGED
from careledger.queries.units import STEPS, level_columns
from careledger.schemas import TABLES
from careledger.session import shared_dir
from careledger.sources.warehouse import Warehouse
from careledger.streaming.incremental import load_new


def _fill(wh: Warehouse, name: str, df) -> None:
    """Write a frame with some of a table's columns as that table."""
    spec = TABLES[name]
    full = df.select(*[
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema
    ])
    wh.overwrite_partitions(name, full) if spec.partitions else wh.replace(name, full)


def _user_units(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), "user_id").alias("id"), F.lit("hmis").alias("datasource_id"), F.lit(True).alias("leaf")
    ).distinct()


_LAST_VALUES = f"""
    WITH v AS ({landing.VALUE_ROWS}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY orgunit, dataelement, period, categoryoptioncombo
        ORDER BY ts DESC, concat('r', event_id) DESC) AS rn FROM v)
    SELECT orgunit, dataelement, period, categoryoptioncombo, value_string, value_double, lastupdated, deleted
    FROM ranked WHERE rn = 1"""


def _values(wh):
    return wh.read("datavalues").select(
        "orgunit", "dataelement", "period", "categoryoptioncombo", "value_string", "value_double",
        F.col("lastupdated").cast("string").alias("lastupdated"), "deleted",
    )


@query("load_values", _LAST_VALUES)
def _load_values(spark, sf_dir):
    wh = scratch_warehouse(spark)
    facts.load_values(wh, landing.value_responses(spark, sf_dir), AS_OF)
    return _values(wh)


@query("incremental_values", _LAST_VALUES)
def _incremental_values(spark, sf_dir):
    """Two runs over a landing folder that grows in between."""
    wh = scratch_warehouse(spark)
    folder = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    answers = landing.value_responses(spark, sf_dir)
    for landed in ("fetched_at < '2024-01-16'", "fetched_at >= '2024-01-16'"):
        answers.filter(landed).write.mode("append").option(
            "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        ).json(folder)
        load_new(wh, folder, AS_OF, checkpoint=f"{folder}-progress")
    return _values(wh)


@query("load_values_watermark", """
    SELECT concat('U', user_id) AS id, CASE WHEN bool_and(event_type <> 'error') THEN '2001-07-01' END AS dv_downloadedat
    FROM {events} GROUP BY user_id""")
def _load_values_watermark(spark, sf_dir):
    wh = scratch_warehouse(spark)
    _fill(wh, "orgunits", _user_units(spark, sf_dir))
    facts.load_values(wh, landing.value_responses(spark, sf_dir), AS_OF)
    return wh.read("orgunits").select("id", F.col("dv_downloadedat").cast("string").alias("dv_downloadedat"))


_LAST_RATES = """
    WITH fine AS (SELECT * FROM {orders} WHERE o_orderpriority < '4'),
    cells AS (SELECT o_orderpriority AS dataset_id, concat('C', o_custkey) AS orgunit_id,
        CAST(year(o_orderdate) AS VARCHAR) AS period, o_orderdate AS t, concat('g', o_orderkey) AS k,
        CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_totalprice END AS expected,
        CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_orderkey AS DOUBLE) END AS actual,
        CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_custkey AS DOUBLE) END AS ontime FROM fine)
    SELECT dataset_id, orgunit_id, period, coalesce(arg_max(expected, (t, k)), 0.0) AS expected_reports,
        coalesce(arg_max(actual, (t, k)), 0.0) AS actual_reports, coalesce(arg_max(ontime, (t, k)), 0.0) AS actual_reports_on_time
    FROM cells GROUP BY dataset_id, orgunit_id, period"""


@query("load_rates", _LAST_RATES)
def _load_rates(spark, sf_dir):
    wh = scratch_warehouse(spark)
    facts.load_rates(wh, landing.grid_responses(spark, sf_dir), AS_OF)
    return wh.read("reporting_rates").drop("_ingestedat", "datasource_id")


_LAST_COMPLETENESS = """
    WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_custkey, strftime(o_orderdate, '%Y%m')
        ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM {orders})
    SELECT concat('DS.', o_orderpriority) AS dataset_id, concat('C', o_custkey) AS orgunit_id,
        strftime(o_orderdate, '%Y%m') AS period, CAST(o_orderkey AS VARCHAR) AS storedby, o_orderstatus <> 'O' AS completed
    FROM ranked WHERE rn = 1"""


@query("load_completeness", _LAST_COMPLETENESS)
def _load_completeness(spark, sf_dir):
    wh = scratch_warehouse(spark)
    facts.load_completeness(wh, landing.completeness_responses(spark, sf_dir), AS_OF)
    return wh.read("dataset_completeness").select("dataset_id", "orgunit_id", "period", "storedby", "completed")






@query("load_periods", """
    SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS id, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS start_date,
        CAST(last_day(o_orderdate) AS VARCHAR) AS end_date
    FROM {orders} WHERE strftime(o_orderdate, '%Y%m') IN (SELECT period FROM {dv})""")
def _load_periods(spark, sf_dir):
    wh = scratch_warehouse(spark)
    _fill(wh, "datavalues", view(spark, sf_dir, "dv").withColumn("datasource_id", F.lit("hmis")))
    facts.load_periods(wh, landing.period_responses(spark, sf_dir), "hmis")
    return wh.read("periods").select(
        "id", *[F.col(c).cast("string").alias(c) for c in ("start_date", "end_date")])


@query("clean_ghosts", f"""
    SELECT orgunit, dataelement, period, categoryoptioncombo, attributeoptioncombo, value_double
    FROM {JUDGED} WHERE allowed""")
def _clean_ghosts(spark, sf_dir):
    wh = scratch_warehouse(spark)
    hmis = F.lit("hmis").alias("datasource_id")
    _fill(wh, "datavalues", view(spark, sf_dir, "dv").select("*", hmis))
    _fill(wh, "dataelements", view(spark, sf_dir, "de"))
    _fill(wh, "categoryoptioncombos", view(spark, sf_dir, "coc").select("*", hmis))
    facts.clean_ghosts(wh, "hmis")
    return wh.read("datavalues").select(
        "orgunit", "dataelement", "period", "categoryoptioncombo", "attributeoptioncombo", "value_double")


_LATE = "l_linestatus = 'O' AND l_suppkey % 7 = 0"


@query("merge_bucketed_values", f"""
    WITH v AS (SELECT concat('OU', l_suppkey) AS orgunit, concat('DE', l_partkey) AS dataelement, strftime(l_shipdate, '%Y') AS period,
            l_returnflag AS coc, l_linestatus = 'O' AND l_suppkey % 7 = 0 AS late, l_extendedprice AS value,
            CAST(l_orderkey AS VARCHAR) AS comment, l_orderkey AS k, l_linenumber AS n FROM {{lineitem}}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY orgunit, dataelement, period, coc, late ORDER BY k DESC, n DESC) AS rn FROM v),
    old AS (SELECT * FROM ranked WHERE rn = 1 AND NOT late), new AS (SELECT * FROM ranked WHERE rn = 1 AND late)
    SELECT coalesce(o.orgunit, w.orgunit) AS orgunit, coalesce(o.dataelement, w.dataelement) AS dataelement,
        coalesce(o.period, w.period) AS period, coalesce(o.coc, w.coc) AS categoryoptioncombo,
        coalesce(w.value, o.value) AS value_double, CASE WHEN o.orgunit IS NULL THEN w.comment ELSE o.comment END AS comment
    FROM old o FULL OUTER JOIN new w ON o.orgunit = w.orgunit AND o.dataelement = w.dataelement AND o.period = w.period AND o.coc = w.coc""")
def _merge_bucketed(spark, sf_dir):
    """Late values merged into a table whose periods are split by reporting unit."""
    wh = scratch_warehouse(spark, buckets=8)
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('OU', l_suppkey) AS orgunit", "concat('DE', l_partkey) AS dataelement", "date_format(l_shipdate, 'yyyy') AS period",
        "l_returnflag AS categoryoptioncombo", "'a' AS attributeoptioncombo", "'hmis' AS datasource_id",
        "l_extendedprice AS value_double", "CAST(l_orderkey AS STRING) AS comment", "l_orderkey", "l_linenumber",
        f"{_LATE} AS late")
    for late in (False, True):
        wh.merge("datavalues", lines.filter(F.col("late") == late), order=["l_orderkey", "l_linenumber"])
    return wh.read("datavalues").select(
        "orgunit", "dataelement", "period", "categoryoptioncombo", "value_double", "comment")


def _landed_metadata(spark, sf_dir):
    return {
        "dataelement": landing.element_responses(spark, sf_dir),
        "dataset": landing.dataset_responses(spark, sf_dir),
        "category_combo": landing.combo_responses(spark, sf_dir),
        "category_optioncombos": landing.option_combo_responses(spark, sf_dir),
        "orgunits": landing.orgunit_responses(spark, sf_dir),
    }


@query("metadata_run", f"""
    WITH {STEPS}, levels AS (
        SELECT id, datasource_id, {level_columns(range(1, 4))}
        FROM steps LEFT JOIN known USING (step, datasource_id) GROUP BY id, datasource_id
    )
    SELECT name, path AS oupath, level, levels.* EXCLUDE (datasource_id)
    FROM levels JOIN {{staged}} USING (id, datasource_id)
    WHERE datasource_id = 'hmis' AND list_has_any(string_split(path, '/'), ['R1', 'N7'])""")
def _metadata_run(spark, sf_dir):
    wh = scratch_warehouse(spark)
    runs.metadata_run(wh, _landed_metadata(spark, sf_dir), "hmis", AS_OF, roots=["R1", "N7"])
    return wh.read("orgunits").select(
        "id", "name", "oupath", "level", *[f"oulevel{i}{c}" for i in (1, 2, 3) for c in ("id", "name")])


@query("metadata_run_dimension", """
    WITH last AS (SELECT concat('OC', p_brand, '.', p_size % 5) AS id, concat('oc ', max(p_partkey)) AS name FROM {part} GROUP BY 1),
    sizes AS (SELECT concat('S', p_size) AS id, concat('any size ', max(p_partkey)) AS name FROM {part} GROUP BY p_size),
    links AS (SELECT DISTINCT concat('OC', p_brand, '.', p_size % 5) AS coc, concat('S', p_size) AS opt FROM {part})
    SELECT l.id AS categoryoptioncombo_id, l.name AS categoryoptioncombo_name, max(s.name) AS all_sizes
    FROM last l JOIN links ON l.id = links.coc JOIN sizes s ON s.id = links.opt GROUP BY l.id, l.name""")
def _metadata_dimension(spark, sf_dir):
    wh = scratch_warehouse(spark)
    metadata.load_combos(wh, landing.combo_responses(spark, sf_dir), "category")
    metadata.load_option_combos(wh, landing.option_combo_responses(spark, sf_dir), "category")
    metadata.build_dimensions(wh, "hmis", "category", AS_OF)
    dimension = wh.read("hmis_categories")
    shared = next(c for c in dimension.columns if c.startswith("all_"))
    return dimension.select("categoryoptioncombo_id", "categoryoptioncombo_name", F.col(shared).alias("all_sizes"))


@query("data_run", f"""
    WITH v AS ({landing.VALUE_ROWS}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY orgunit, dataelement, period, categoryoptioncombo
        ORDER BY ts DESC, concat('r', event_id) DESC) AS rn FROM v)
    SELECT orgunit, dataelement, period, categoryoptioncombo, value_string, value_double, lastupdated, deleted
    FROM ranked WHERE rn = 1 AND dataelement = 'k' AND categoryoptioncombo IN ('view', 'click')""")
def _data_run(spark, sf_dir):
    wh = scratch_warehouse(spark)
    types = table(spark, sf_dir, "events").select("event_type").distinct()
    _fill(wh, "orgunits", _user_units(spark, sf_dir))
    _fill(wh, "dataelements", types.selectExpr("'k' AS id", "'kc' AS categorycombo_id", "'hmis' AS datasource_id").distinct())
    _fill(wh, "categoryoptioncombos", types.filter("event_type IN ('view', 'click')").selectExpr(
        "event_type AS id", "'kc' AS categorycombo_id", "'hmis' AS datasource_id"))
    runs.data_run(wh, {
        "values": landing.value_responses(spark, sf_dir), "periods": landing.period_responses(spark, sf_dir),
        "completeness": landing.completeness_responses(spark, sf_dir), "grid": landing.grid_responses(spark, sf_dir),
    }, "hmis", AS_OF, rebuild_rates=True)
    return _values(wh)

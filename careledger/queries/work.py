"""Work lists and request manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from careledger.operators.numbering import batch_rows
from careledger.operators.periods import missing_periods
from careledger.plans.work import (
    attribute_combo_ids, category_combo_ids, completeness_requests, completeness_work, period_requests,
    reporting_requests, reporting_work, value_requests, value_work,
)
from careledger.queries.base import AS_OF, query, scratch_warehouse, table, view

_TYPED = r"""CASE WHEN regexp_full_match(p.id, '\d{4}W\d{1,2}') THEN 'Weekly'
    WHEN regexp_full_match(p.id, '\d{6}') THEN 'Monthly' WHEN regexp_full_match(p.id, '\d{4}Q\d') THEN 'Quarterly'
    WHEN regexp_full_match(p.id, '\d{4}S\d') THEN 'SixMonthly' WHEN regexp_full_match(p.id, '\d{4}') THEN 'Yearly' END"""
_RECENT = "p.start_date >= DATE '2001-07-01' - INTERVAL 120 DAY"
_STALE = "(o.{w} < TIMESTAMP '2001-07-01 12:00:00' - INTERVAL 4 DAY OR o.{w} IS NULL)"


def _pairs(watermark: str, where: str, source_join: str = "") -> str:
    """Unit, data set and period triples the way a database would join them. Data sets are
    first thinned to the ones with a period, so that it need not hold every triple."""
    stale = _STALE.replace("{w}", watermark)
    return f"""typed AS (SELECT p.id, {_TYPED} AS periodtype FROM {{periods}} p WHERE {where}),
        units AS (SELECT DISTINCT a.orgunit_id, a.dataset_id, d.periodtype FROM {{ou}} o
            JOIN {{assign}} a ON o.id = a.orgunit_id
            JOIN {{ds}} d ON a.dataset_id = d.id {source_join}
            WHERE d.datasource_id = 'hmis' AND {stale}
            AND d.periodtype IN (SELECT periodtype FROM typed)),
        unit_periods AS (SELECT DISTINCT u.orgunit_id, t.id FROM
            (SELECT DISTINCT orgunit_id, periodtype FROM units) u JOIN typed t ON u.periodtype = t.periodtype)"""


_REPORTING = "AND o.datasource_id = d.datasource_id"
_LISTS = """lists AS (SELECT orgunit_id AS orgunit, string_agg(DISTINCT dataset_id, ',' ORDER BY dataset_id) AS datasets
        FROM units GROUP BY orgunit_id),
    plists AS (SELECT orgunit_id AS orgunit, string_agg(DISTINCT id, ',' ORDER BY id) AS periods
        FROM unit_periods GROUP BY orgunit_id)
    SELECT l.orgunit, l.datasets, p.periods FROM lists l JOIN plists p ON l.orgunit = p.orgunit"""


def _inputs(spark, sf_dir):
    return [view(spark, sf_dir, v) for v in ("ou", "assign", "ds", "periods")]


def _joined(work):
    return work.select("orgunit", *[F.array_join(c, ",").alias(c) for c in ("datasets", "periods")])


@query("work_reporting", f"WITH {_pairs('rr_downloadedat', _RECENT, _REPORTING)}, {_LISTS}")
def _work_reporting(spark, sf_dir):
    return _joined(reporting_work(*_inputs(spark, sf_dir), "hmis", AS_OF))


@query("work_reporting_subtree", f"""WITH {_pairs('rr_downloadedat', _RECENT, _REPORTING).replace(
    "WHERE d.datasource_id", "WHERE list_has_any(string_split(o.oupath, '/'), ['R1', 'N7']) AND d.datasource_id")},
    {_LISTS}""")
def _work_reporting_subtree(spark, sf_dir):
    return _joined(reporting_work(*_inputs(spark, sf_dir), "hmis", AS_OF, roots=["R1", "N7"]))


@query("work_completeness", f"WITH {_pairs('dc_downloadedat', _RECENT)}, {_LISTS}")
def _work_completeness(spark, sf_dir):
    return _joined(completeness_work(*_inputs(spark, sf_dir), "hmis", AS_OF))


@query("work_completeness_same_source", f"WITH {_pairs('dc_downloadedat', _RECENT, _REPORTING)}, {_LISTS}")
def _work_completeness_same(spark, sf_dir):
    return _joined(completeness_work(*_inputs(spark, sf_dir), "hmis", AS_OF, match_source=True))


@query("manifest_reporting", f"""
    WITH {_pairs('rr_downloadedat', 'true', _REPORTING)},
    numbered AS (SELECT orgunit_id, (row_number() OVER (ORDER BY substr(md5(orgunit_id), 1, 3), orgunit_id) - 1) // 7
        AS batch FROM (SELECT DISTINCT orgunit_id FROM units) x),
    ous AS (SELECT batch, string_agg(orgunit_id, ';' ORDER BY orgunit_id) AS ou FROM numbered GROUP BY batch),
    dsn AS (SELECT batch, dataset_id, (row_number() OVER (PARTITION BY batch ORDER BY dataset_id) - 1) // 10 AS g
        FROM (SELECT DISTINCT batch, dataset_id FROM units JOIN numbered USING (orgunit_id)) x),
    dxs AS (SELECT batch, g, string_agg(concat(dataset_id, '.EXPECTED_REPORTS;', dataset_id, '.ACTUAL_REPORTS;',
        dataset_id, '.ACTUAL_REPORTS_ON_TIME'), ';' ORDER BY dataset_id) AS dx FROM dsn GROUP BY batch, g),
    pen AS (SELECT batch, id, (row_number() OVER (PARTITION BY batch ORDER BY id) - 1) // 20 AS g
        FROM (SELECT DISTINCT batch, id FROM unit_periods JOIN numbered USING (orgunit_id)) x),
    pes AS (SELECT batch, g, string_agg(id, ';' ORDER BY id) AS pe FROM pen GROUP BY batch, g)
    SELECT batch, dx, ou, pe FROM dxs JOIN ous USING (batch) JOIN pes USING (batch)""")
def _manifest_reporting(spark, sf_dir):
    # Batching reads the work list twice, so it is written once in between.
    work, _ = scratch_warehouse(spark).stage(reporting_work(*_inputs(spark, sf_dir), "hmis", AS_OF, full=True))
    return reporting_requests(work)


@query("manifest_completeness", f"""
    WITH {_pairs('dc_downloadedat', 'true')},
    dsn AS (SELECT orgunit_id, dataset_id, (row_number() OVER (PARTITION BY orgunit_id ORDER BY dataset_id) - 1) // 15
        AS g FROM (SELECT DISTINCT orgunit_id, dataset_id FROM units) x),
    dss AS (SELECT orgunit_id, g, string_agg(dataset_id, ',' ORDER BY dataset_id) AS dataset FROM dsn GROUP BY orgunit_id, g),
    pen AS (SELECT orgunit_id, id, (row_number() OVER (PARTITION BY orgunit_id ORDER BY id) - 1) // 80 AS g FROM unit_periods),
    pes AS (SELECT orgunit_id, g, string_agg(id, ',' ORDER BY id) AS period FROM pen GROUP BY orgunit_id, g)
    SELECT orgunit_id AS orgunit, dataset, period FROM dss JOIN pes USING (orgunit_id)""")
def _manifest_completeness(spark, sf_dir):
    return completeness_requests(completeness_work(*_inputs(spark, sf_dir), "hmis", AS_OF, full=True))


@query("manifest_periods", """
    WITH missing AS (SELECT DISTINCT strftime(l_shipdate, '%Y%m%d') AS id FROM {lineitem}),
    numbered AS (SELECT id, (row_number() OVER (ORDER BY substr(md5(id), 1, 3), id) - 1) // 30 AS batch FROM missing)
    SELECT batch, string_agg(id, ';' ORDER BY id) AS pe FROM numbered GROUP BY batch""")
def _manifest_periods(spark, sf_dir):
    used = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyyMMdd").alias("period"))
    return period_requests(missing_periods(used, view(spark, sf_dir, "periods")))


@query("manifest_values", """
    SELECT id AS orgunit, 'DE1,DE2' AS dataelement, '1995-01-01' AS since FROM {ou} WHERE leaf AND datasource_id = 'hmis'""")
def _manifest_values(spark, sf_dir):
    work = value_work(view(spark, sf_dir, "ou"), "hmis", "1995-01-01", AS_OF, full=True)
    return value_requests(work, ["DE1", "DE2"])


@query("batch_rows", """
    WITH keys AS (SELECT concat('r', o_orderkey) AS request_id FROM {orders})
    SELECT request_id, (row_number() OVER (ORDER BY substr(md5(request_id), 1, 3), request_id) - 1) // 7 AS batch
    FROM keys""")
def _batch_rows(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select(F.concat(F.lit("r"), "o_orderkey").alias("request_id"))
    return batch_rows(keys, "request_id", 7)


@query("split_combo_ids", "SELECT DISTINCT trim(unnest(string_split(categorycombo_id, ','))) AS id FROM {de}")
def _split_combo_ids(spark, sf_dir):
    return category_combo_ids(view(spark, sf_dir, "de"))


@query("attribute_combo_ids", "SELECT DISTINCT categorycombo_id AS id FROM {ds} WHERE categorycombo_id <> ''")
def _attribute_combo_ids(spark, sf_dir):
    return attribute_combo_ids(view(spark, sf_dir, "ds"))

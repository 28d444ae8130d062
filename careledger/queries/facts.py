"""Fact tables: ghosts, merges, links, periods, rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from careledger.functions.text import iso_date
from careledger.operators.ghosts import split_ghosts
from careledger.operators.merge import (
    combo_owners, insert_absent, keep_last, option_combo_owners, replace_links, upsert, upsert_newer,
)
from careledger.operators.periods import dataset_periods, missing_periods
from careledger.operators.rates import pivot_rates
from careledger.operators.watermarks import drop_source
from careledger.plans.work import changed_values, value_work
from careledger.queries.base import AS_OF, query, table, view

# Values beside whether their element and option combo share a combination.
JUDGED = """(
        SELECT * EXCLUDE (pair), pair IS NOT NULL AS allowed FROM {dv} LEFT JOIN (
            SELECT DISTINCT {de}.id AS dataelement, {coc}.id AS categoryoptioncombo, true AS pair
            FROM {de} JOIN {coc} USING (categorycombo_id)
        ) USING (dataelement, categoryoptioncombo)
    )"""


def _ghosts(spark, sf_dir, **options):
    return split_ghosts(*[view(spark, sf_dir, v) for v in ("dv", "de", "coc")], **options)


@query("ghost_delete", f"""
    SELECT orgunit, dataelement, period, categoryoptioncombo, attributeoptioncombo, value_double
    FROM {JUDGED} WHERE allowed""")
def _ghost_delete(spark, sf_dir):
    return _ghosts(spark, sf_dir)[0].drop("lastupdated")


@query("ghost_report", f"""
    SELECT dataelement, period, count(*) AS ghosts FROM {JUDGED} WHERE NOT allowed GROUP BY ALL""")
def _ghost_report(spark, sf_dir):
    return _ghosts(spark, sf_dir)[1].groupBy("dataelement", "period").agg(F.count("*").alias("ghosts"))


@query("ghost_delete_listed_combos", """
    WITH listed AS (SELECT DISTINCT id, trim(unnest(string_split(categorycombo_id, ','))) AS cc FROM {de})
    SELECT orgunit, dataelement, period, categoryoptioncombo, attributeoptioncombo, value_double
    FROM {dv} v WHERE EXISTS (SELECT 1 FROM listed e JOIN {coc} c ON e.cc = c.categorycombo_id
        WHERE e.id = v.dataelement AND c.id = v.categoryoptioncombo)""")
def _ghost_listed(spark, sf_dir):
    return _ghosts(spark, sf_dir, split_combos=True)[0].drop("lastupdated")


_ORDER = ["lastupdated", "part_seq", "supp_seq"]
_RANKED = """WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY orgunit, dataelement, version
        ORDER BY lastupdated DESC, part_seq DESC, supp_seq DESC) AS rn FROM {lines}),
    old AS (SELECT * FROM ranked WHERE rn = 1 AND version = 'F'),
    new AS (SELECT * FROM ranked WHERE rn = 1 AND version = 'O')"""


def _versions(spark, sf_dir):
    lines = view(spark, sf_dir, "lines")
    old = keep_last(lines.filter("version = 'F'"), ["orgunit", "dataelement"], _ORDER)
    return old, lines.filter("version = 'O'")


def _merged(spark, sf_dir, **options):
    old, new = _versions(spark, sf_dir)
    merged = upsert(
        old, new, ["orgunit", "dataelement"], ["value_double", "lastupdated"], order=_ORDER, **options
    )
    return merged.withColumn("lastupdated", F.col("lastupdated").cast("date").cast("string")).drop("part_seq")


@query("keep_last", _RANKED + """
    SELECT orgunit, dataelement, version, value_double, part_seq, supp_seq FROM ranked WHERE rn = 1""")
def _keep_last(spark, sf_dir):
    return keep_last(view(spark, sf_dir, "lines"), ["orgunit", "dataelement", "version"], _ORDER).drop(
        "lastupdated", "value_string"
    )


@query("upsert_values", _RANKED + """
    SELECT coalesce(o.orgunit, n.orgunit) AS orgunit, coalesce(o.dataelement, n.dataelement) AS dataelement,
        CASE WHEN n.orgunit IS NOT NULL THEN n.value_double ELSE o.value_double END AS value_double,
        CASE WHEN o.orgunit IS NULL THEN n.value_string ELSE o.value_string END AS value_string,
        CAST(CAST(CASE WHEN n.orgunit IS NOT NULL THEN n.lastupdated ELSE o.lastupdated END AS DATE) AS VARCHAR)
            AS lastupdated,
        CASE WHEN o.orgunit IS NULL THEN n.supp_seq ELSE o.supp_seq END AS supp_seq,
        CASE WHEN o.orgunit IS NULL THEN n.version ELSE o.version END AS version
    FROM old o FULL OUTER JOIN new n ON o.orgunit = n.orgunit AND o.dataelement = n.dataelement""")
def _upsert(spark, sf_dir):
    return _merged(spark, sf_dir)


@query("upsert_newer_only", """
    WITH old AS (SELECT o_orderkey AS id, 'old' AS name,
        CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderdate END AS lastupdated
        FROM {orders} WHERE o_orderpriority <> '5-LOW'),
    new AS (SELECT o_orderkey AS id, 'new' AS name, CASE o_orderpriority WHEN '2-HIGH' THEN o_orderdate
        WHEN '3-MEDIUM' THEN o_orderdate + INTERVAL 3 DAY WHEN '4-NOT SPECIFIED' THEN NULL
        ELSE o_orderdate - INTERVAL 3 DAY END AS lastupdated
        FROM {orders} WHERE o_orderpriority <> '1-URGENT'),
    j AS (SELECT o.id AS oid, n.id AS nid, o.name AS oname, n.name AS nname, o.lastupdated AS ol, n.lastupdated AS nl,
        n.id IS NOT NULL AND (o.id IS NULL OR o.lastupdated IS NULL OR coalesce(n.lastupdated > o.lastupdated, false)) AS take
        FROM old o FULL OUTER JOIN new n ON o.id = n.id)
    SELECT coalesce(oid, nid) AS id, CASE WHEN take THEN nname ELSE oname END AS name,
        CAST(CAST(CASE WHEN take THEN nl ELSE ol END AS DATE) AS VARCHAR) AS lastupdated FROM j""")
def _upsert_newer(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    old = orders.filter("o_orderpriority <> '5-LOW'").selectExpr(
        "o_orderkey AS id", "'old' AS name", "CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS lastupdated"
    )
    new = orders.filter("o_orderpriority <> '1-URGENT'").selectExpr(
        "o_orderkey AS id", "'new' AS name",
        """CASE o_orderpriority WHEN '2-HIGH' THEN o_orderdate WHEN '3-MEDIUM' THEN o_orderdate + INTERVAL 3 DAYS
            WHEN '4-NOT SPECIFIED' THEN NULL ELSE o_orderdate - INTERVAL 3 DAYS END AS lastupdated""",
    )
    merged = upsert_newer(old, new, ["id"], ["name", "lastupdated"])
    return merged.withColumn("lastupdated", F.col("lastupdated").cast("date").cast("string"))


def _links(spark, sf_dir, status):
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == status),
              F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_suppkey", "o_custkey")
    )


@query("insert_if_absent", """
    WITH old AS (SELECT DISTINCT l_suppkey, o_custkey, 'old' AS origin FROM {lineitem} JOIN {orders}
        ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'),
    new AS (SELECT DISTINCT l_suppkey, o_custkey, 'new' AS origin FROM {lineitem} JOIN {orders}
        ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O')
    SELECT * FROM old UNION ALL SELECT * FROM new n WHERE NOT EXISTS (
        SELECT 1 FROM old o WHERE o.l_suppkey = n.l_suppkey AND o.o_custkey = n.o_custkey)""")
def _insert_absent(spark, sf_dir):
    old = _links(spark, sf_dir, "F").distinct().withColumn("origin", F.lit("old"))
    new = _links(spark, sf_dir, "O").withColumn("origin", F.lit("new"))
    return insert_absent(old, new, ["l_suppkey", "o_custkey"])


_CATEGORY_LINKS = """links AS (SELECT DISTINCT concat('K', p_type) AS category_id, concat('S', p_size)
        AS categoryoption_id, 'old' AS _origin FROM {part}),
    fresh AS (SELECT DISTINCT concat('K', p_type) AS category_id, p_brand AS categoryoption_id,
        'new' AS _origin FROM {part} WHERE p_type < 'N')"""


@query("links_replace", f"""
    WITH {_CATEGORY_LINKS}
    SELECT * FROM links WHERE category_id NOT IN (SELECT id FROM {{cat}} WHERE combo_type = 'category')
    UNION ALL SELECT * FROM fresh""")
def _links_replace(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    category = F.concat(F.lit("K"), "p_type").alias("category_id")
    links = part.select(
        category, F.concat(F.lit("S"), "p_size").alias("categoryoption_id"), F.lit("old").alias("_origin")
    ).distinct()
    fresh = part.filter("p_type < 'N'").select(
        category, F.col("p_brand").alias("categoryoption_id"), F.lit("new").alias("_origin")
    ).distinct()
    owners = combo_owners(view(spark, sf_dir, "cat"), "category", "category_id")
    return replace_links(links, fresh, owners)


@query("option_links_replace", """
    WITH combos AS (SELECT DISTINCT p_brand AS id, CASE WHEN p_brand < 'Brand#2' THEN 'category'
        ELSE 'attribute' END AS combo_type FROM {part}),
    fresh AS (SELECT DISTINCT categoryoptioncombo_id, 'fresh' AS categoryoption_id FROM {coc_opt}
        JOIN {brand_sizes} b ON b.id = categoryoptioncombo_id WHERE b.categorycombo_id < 'Brand#2')
    SELECT categoryoptioncombo_id, categoryoption_id FROM {coc_opt} WHERE categoryoptioncombo_id NOT IN (
        SELECT c.id FROM {brand_sizes} c JOIN combos cc ON c.categorycombo_id = cc.id
        WHERE cc.combo_type = 'category')
    UNION ALL SELECT * FROM fresh""")
def _option_links_replace(spark, sf_dir):
    option_combos = view(spark, sf_dir, "brand_sizes")
    combos = table(spark, sf_dir, "part").selectExpr(
        "p_brand AS id", "CASE WHEN p_brand < 'Brand#2' THEN 'category' ELSE 'attribute' END AS combo_type"
    ).distinct()
    fresh = option_combos.filter("categorycombo_id < 'Brand#2'").select(
        F.col("id").alias("categoryoptioncombo_id"), F.lit("fresh").alias("categoryoption_id")
    )
    owners = option_combo_owners(option_combos, combos, "category", "categoryoptioncombo_id")
    return replace_links(view(spark, sf_dir, "coc_opt"), fresh, owners)


@query("tracked_assignments", """
    SELECT dataset_id, orgunit_id FROM {assign}
    WHERE dataset_id IN (SELECT id FROM {ds} WHERE datasource_id = 'hmis')""")
def _tracked(spark, sf_dir):
    tracked = view(spark, sf_dir, "ds").filter("datasource_id = 'hmis'").select(F.col("id").alias("dataset_id"))
    return view(spark, sf_dir, "assign").join(tracked, "dataset_id", "left_semi")


@query("missing_periods", """
    SELECT DISTINCT strftime(l_shipdate, '%Y%m%d') AS id FROM {lineitem} WHERE NOT EXISTS (
        SELECT 1 FROM {orders} WHERE o_orderdate = l_shipdate)""")
def _missing_periods(spark, sf_dir):
    day = lambda c: F.date_format(c, "yyyyMMdd")
    used = table(spark, sf_dir, "lineitem").select(day("l_shipdate").alias("period"))
    known = table(spark, sf_dir, "orders").select(day("o_orderdate").alias("id")).distinct()
    return missing_periods(used, known)


@query("period_type_join", r"""
    SELECT d.id AS dataset_id, typed.id AS period FROM (
        SELECT id, translate(id, '0123456789', '9999999999') AS shape FROM {periods}
    ) typed JOIN (VALUES
        ('9999', 'Yearly'), ('999999', 'Monthly'), ('9999Q9', 'Quarterly'), ('9999S9', 'SixMonthly'),
        ('9999W9', 'Weekly'), ('9999W99', 'Weekly')
    ) shapes(shape, periodtype) USING (shape) JOIN {ds} d USING (periodtype)""")
def _period_type_join(spark, sf_dir):
    return dataset_periods(view(spark, sf_dir, "ds"), view(spark, sf_dir, "periods"))


@query("reporting_pivot", """
    WITH cells AS (SELECT o_orderpriority AS dataset_id, concat('C', o_custkey) AS orgunit_id,
        CAST(year(o_orderdate) AS VARCHAR) AS period, o_totalprice AS v, o_orderdate AS t, o_orderkey AS k,
        CASE o_orderstatus WHEN 'F' THEN 'EXPECTED_REPORTS' WHEN 'O' THEN 'ACTUAL_REPORTS'
            ELSE CASE WHEN o_totalprice < 250000 THEN 'ACTUAL_REPORTS_ON_TIME' ELSE 'OTHER' END END AS m FROM {orders})
    SELECT dataset_id, orgunit_id, period,
        coalesce(arg_max(v, (t, k)) FILTER (m = 'EXPECTED_REPORTS'), 0.0) AS expected_reports,
        coalesce(arg_max(v, (t, k)) FILTER (m = 'ACTUAL_REPORTS'), 0.0) AS actual_reports,
        coalesce(arg_max(v, (t, k)) FILTER (m = 'ACTUAL_REPORTS_ON_TIME'), 0.0) AS actual_reports_on_time
    FROM cells GROUP BY dataset_id, orgunit_id, period""")
def _reporting_pivot(spark, sf_dir):
    cells = table(spark, sf_dir, "orders").selectExpr(
        "o_orderpriority AS dataset_id", "concat('C', o_custkey) AS orgunit_id",
        "CAST(year(o_orderdate) AS STRING) AS period", "'hmis' AS datasource_id",
        """CASE o_orderstatus WHEN 'F' THEN 'EXPECTED_REPORTS' WHEN 'O' THEN 'ACTUAL_REPORTS'
            ELSE CASE WHEN o_totalprice < 250000 THEN 'ACTUAL_REPORTS_ON_TIME' ELSE 'OTHER' END END AS metric""",
        "o_totalprice AS value", "struct(o_orderdate, o_orderkey) AS seq",
    )
    return pivot_rates(cells).drop("datasource_id")


@query("since_filter", """
    WITH due AS (SELECT id, coalesce(dv_downloadedat, DATE '1995-01-01') AS since FROM {ou}
        WHERE leaf AND datasource_id = 'hmis' AND (dv_downloadedat IS NULL
            OR dv_downloadedat < TIMESTAMP '2001-07-01 12:00:00' - INTERVAL 4 DAY))
    SELECT concat('C', o_custkey) AS orgunit, l_linenumber, concat('DE', l_partkey) AS dataelement, l_extendedprice
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN due ON due.id = concat('C', o_custkey)
    WHERE l_shipdate >= since AND concat('DE', l_partkey) IN (SELECT id FROM {de} WHERE datasource_id = 'hmis')""")
def _since_filter(spark, sf_dir):
    landed = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        F.concat(F.lit("C"), "o_custkey").alias("orgunit"), "l_linenumber",
        F.concat(F.lit("DE"), "l_partkey").alias("dataelement"), "l_extendedprice",
        F.col("l_shipdate").alias("lastupdated"),
    )
    work = value_work(view(spark, sf_dir, "ou"), "hmis", "1995-01-01", AS_OF)
    elements = view(spark, sf_dir, "de").filter("datasource_id = 'hmis'")
    return changed_values(landed, work, elements).drop("lastupdated")


@query("rebuild_slice", "SELECT id, datasource_id FROM {de} WHERE datasource_id <> 'hmis'")
def _rebuild_slice(spark, sf_dir):
    return drop_source(view(spark, sf_dir, "de").select("id", "datasource_id"), "hmis")

"""Org units: levels, names, sub-trees, watermarks."""

from __future__ import annotations

from pyspark.sql import functions as F

from careledger.operators.hierarchy import flatten, paths_of_parents, within
from careledger.operators.merge import upsert
from careledger.operators.watermarks import (
    advance, finished_units, reset, settled_requests, stale,
)
from careledger.plans.work import value_work
from careledger.queries.base import AS_OF, query, scratch_warehouse, table, view
from careledger.schemas import LEVELS, TABLES



def level_columns(levels) -> str:
    """Ids and names by level, out of one row per unit and step of its path."""
    return ", ".join(
        f"max(step) FILTER (level_no = {i}) AS oulevel{i}id, max(known.name) FILTER (level_no = {i}) AS oulevel{i}name"
        for i in levels
    )


# A path is taken apart into its steps, and each step looks up its name.
STEPS = f"""
    steps AS (
        SELECT id, datasource_id, level_no, coalesce(string_split(path, '/')[level_no + 1], '') AS step
        FROM {{staged}}, range(1, {max(LEVELS) + 1}) AS r(level_no)
    ), known AS (SELECT id AS step, datasource_id, name FROM {{staged}})"""


def _staged(spark, sf_dir):
    """Staged units with all the columns of the table."""
    df = view(spark, sf_dir, "staged")
    have = set(df.columns)
    return df.select("*", *[
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in TABLES["stg_orgunits"].schema if f.name not in have
    ])


@query("orgunit_flatten", f"""
    WITH {STEPS}, levels AS (
        SELECT id, datasource_id, {level_columns(LEVELS)}
        FROM steps LEFT JOIN known USING (step, datasource_id) GROUP BY id, datasource_id
    )
    SELECT name, parentid, path AS oupath, level, leaf, levels.* FROM levels JOIN {{staged}} USING (id, datasource_id)""")
def _flatten(spark, sf_dir):
    return flatten(_staged(spark, sf_dir)).drop(
        "code", "shortname", "openingdate", "closeddate", "lastupdated", "_fetchedat"
    )


@query("orgunit_merge", """
    WITH old AS (SELECT id, datasource_id, concat('old ', name) AS name, 'P' AS parentid, '/old' AS oupath,
        9 AS level, 'L' AS oulevel1id, 'LN' AS oulevel1name FROM {staged} WHERE datasource_id = 'hmis'),
    new AS (SELECT b.*, split_part(b.path, '/', 2) AS l1, l.name AS l1name FROM {staged} b
        LEFT JOIN {staged} l ON split_part(b.path, '/', 2) = l.id AND b.datasource_id = l.datasource_id
        WHERE list_has_any(string_split(b.path, '/'), ['R1', 'N7']))
    SELECT coalesce(o.id, n.id) AS id, coalesce(o.datasource_id, n.datasource_id) AS datasource_id,
        CASE WHEN n.id IS NOT NULL THEN n.name ELSE o.name END AS name,
        CASE WHEN o.id IS NULL THEN n.parentid ELSE o.parentid END AS parentid,
        CASE WHEN n.id IS NOT NULL THEN n.path ELSE o.oupath END AS oupath,
        CASE WHEN n.id IS NOT NULL THEN n.level ELSE o.level END AS level,
        CASE WHEN o.id IS NULL THEN n.l1 ELSE o.oulevel1id END AS oulevel1id,
        CASE WHEN n.id IS NOT NULL THEN n.l1name ELSE o.oulevel1name END AS oulevel1name
    FROM old o FULL OUTER JOIN new n ON o.id = n.id AND o.datasource_id = n.datasource_id""")
def _orgunit_merge(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    old = staged.filter("datasource_id = 'hmis'").select(
        "id", "datasource_id", F.concat(F.lit("old "), "name").alias("name"), F.lit("P").alias("parentid"),
        F.lit("/old").alias("oupath"), F.lit(9).alias("level"), F.lit("L").alias("oulevel1id"),
        F.lit("LN").alias("oulevel1name"),
    )
    spec = TABLES["orgunits"]
    return upsert(old, flatten(staged, ["R1", "N7"]), spec.keys, spec.refreshed)


@query("subtree_filter", """
    SELECT id, datasource_id, oupath FROM {ou}
    WHERE list_has_any(string_split(oupath, '/'), ['R1', 'N7'])""")
def _subtree(spark, sf_dir):
    return within(view(spark, sf_dir, "ou"), ["R1", "N7"]).select("id", "datasource_id", "oupath")


@query("subtree_filter_many_roots", """
    SELECT o.id, o.datasource_id, o.oupath FROM {ou} o
    WHERE EXISTS (SELECT 1 FROM {supplier}
        WHERE list_contains(string_split(o.oupath, '/'), concat('N', s_nationkey)) AND s_acctbal > 5000)""")
def _subtree_many(spark, sf_dir):
    roots = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select(
        F.concat(F.lit("N"), "s_nationkey")
    )
    return within(view(spark, sf_dir, "ou"), roots).select("id", "datasource_id", "oupath")


@query("stale_units", """
    SELECT id, datasource_id, CAST(dv_downloadedat AS VARCHAR) AS dv_downloadedat FROM {ou}
    WHERE dv_downloadedat IS NULL OR dv_downloadedat < TIMESTAMP '2001-07-01 12:00:00' - INTERVAL 4 DAY""")
def _stale(spark, sf_dir):
    return view(spark, sf_dir, "ou").filter(stale("dv_downloadedat", AS_OF)).select(
        "id", "datasource_id", F.col("dv_downloadedat").cast("string").alias("dv_downloadedat")
    )


@query("work_values", """
    SELECT id AS orgunit, coalesce(CAST(dv_downloadedat AS VARCHAR), '1995-01-01') AS since FROM {ou}
    WHERE leaf AND datasource_id = 'hmis' AND (dv_downloadedat IS NULL
        OR dv_downloadedat < TIMESTAMP '2001-07-01 12:00:00' - INTERVAL 4 DAY)""")
def _work_values(spark, sf_dir):
    return value_work(view(spark, sf_dir, "ou"), "hmis", "1995-01-01", AS_OF)


@query("work_values_ethiopian", """
    WITH due AS (SELECT id, coalesce(dv_downloadedat, DATE '1995-01-01') AS d FROM {ou}
        WHERE leaf AND datasource_id = 'hmis' AND (dv_downloadedat IS NULL
            OR dv_downloadedat < TIMESTAMP '2001-07-01 12:00:00' - INTERVAL 4 DAY)),
    n AS (SELECT id, date_diff('day', DATE '1970-01-01', d) + 716732 AS n FROM due),
    r AS (SELECT *, n % 1461 % 365 + 365 * (n % 1461 // 1460) AS y,
        4 * (n // 1461) + n % 1461 // 365 - n % 1461 // 1460 AS yr FROM n)
    SELECT id AS orgunit, concat(lpad(CAST(yr AS VARCHAR), 4, '0'), '-', lpad(CAST(y // 30 + 1 AS VARCHAR), 2, '0'),
        '-', lpad(CAST(y % 30 + 1 AS VARCHAR), 2, '0')) AS since FROM r""")
def _work_values_ethiopian(spark, sf_dir):
    return value_work(view(spark, sf_dir, "ou"), "hmis", "1995-01-01", AS_OF, ethiopian=True)


@query("work_values_full", """
    SELECT id AS orgunit, '1995-01-01' AS since FROM {ou} WHERE leaf AND datasource_id = 'phem'""")
def _work_values_full(spark, sf_dir):
    return value_work(view(spark, sf_dir, "ou"), "phem", "1995-01-01T00:00", AS_OF, full=True)


def _order_log(spark, sf_dir):
    """A request per order; urgent orders still pending failed."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('r', o_orderkey) AS request_id",
        "'hmis' AS source", "concat('C', o_custkey) AS orgunit",
        "o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AS failed",
    )


@query("watermark_advance", """
    WITH done AS (SELECT concat('C', o_custkey) AS id FROM {orders} GROUP BY o_custkey
        HAVING bool_and(NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')))
    SELECT o.id, o.datasource_id, CAST(CASE WHEN d.id IS NOT NULL AND o.datasource_id = 'hmis'
        THEN DATE '2001-07-01' ELSE o.dv_downloadedat END AS VARCHAR) AS dv_downloadedat
    FROM {ou} o LEFT JOIN done d ON o.id = d.id""")
def _advance(spark, sf_dir):
    units = view(spark, sf_dir, "ou").select("id", "datasource_id", "dv_downloadedat")
    log = _order_log(spark, sf_dir)
    done = finished_units(log, settled_requests(log))
    moved = advance(units, done, "dv_downloadedat", AS_OF.date())
    return moved.withColumn("dv_downloadedat", F.col("dv_downloadedat").cast("string"))


@query("rebuild_reset", """
    SELECT id, datasource_id, CASE WHEN datasource_id <> 'hmis' THEN CAST(rr_downloadedat AS VARCHAR) END
        AS rr_downloadedat, CAST(dc_downloadedat AS VARCHAR) AS dc_downloadedat FROM {ou}""")
def _reset(spark, sf_dir):
    return reset(view(spark, sf_dir, "ou"), "rr_downloadedat", "hmis").select(
        "id", "datasource_id", F.col("rr_downloadedat").cast("string").alias("rr_downloadedat"),
        F.col("dc_downloadedat").cast("string").alias("dc_downloadedat"),
    )


# Two nations that name each other, and one whose region is missing.
_BENT = "CASE id WHEN 'N3' THEN 'N4' WHEN 'N4' THEN 'N3' WHEN 'N5' THEN 'missing' ELSE parentid END"


@query("parent_paths", f"""
    SELECT * FROM (
        WITH RECURSIVE u AS (SELECT id, datasource_id, path AS given, {_BENT} AS parentid FROM {{staged}}),
        down AS (
            SELECT id, datasource_id, concat('/', id) AS path, 1 AS level, parentid IS NOT NULL AS lost FROM u a
            WHERE NOT EXISTS (SELECT 1 FROM u b WHERE b.id = a.parentid AND b.datasource_id = a.datasource_id)
            UNION ALL
            SELECT u.id, u.datasource_id, concat(down.path, '/', u.id), level + 1, lost
            FROM down JOIN u ON u.parentid = down.id AND u.datasource_id = down.datasource_id
        )
        SELECT u.id, u.datasource_id, down.path, down.level, coalesce(down.path = given, false) AS agrees,
            CASE WHEN down.id IS NULL THEN 'cycle' WHEN lost THEN 'orphan' END AS problem
        FROM u LEFT JOIN down ON u.id = down.id AND u.datasource_id = down.datasource_id
    )""")
def _parent_paths(spark, sf_dir):
    """Paths by parent links, beside whether the delivered path says the same."""
    wh = scratch_warehouse(spark)
    units = view(spark, sf_dir, "staged")
    found = paths_of_parents(units.withColumn("parentid", F.expr(_BENT)), lambda df: wh.stage(df)[0])
    given = units.select("id", "datasource_id", F.col("path").alias("given"))
    return found.join(given, ["id", "datasource_id"]).select(
        "id", "datasource_id", "path", "level", F.coalesce(F.col("path") == F.col("given"), F.lit(False)).alias("agrees"), "problem")

"""Key, reference and length checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from careledger.operators.quality import duplicate_keys, null_keys, orphans, table_report, too_long
from careledger.queries.base import query, table, view
from careledger.schemas import Table


@query("key_check", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM {lineitem} GROUP BY ALL HAVING count(*) > 1""")
def _key_check(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("null_key_check", """
    SELECT id, datasource_id, CAST(rr_downloadedat AS VARCHAR) AS rr_downloadedat FROM {ou}
    WHERE id IS NULL OR rr_downloadedat IS NULL""")
def _null_keys(spark, sf_dir):
    units = view(spark, sf_dir, "ou").select(
        "id", "datasource_id", F.col("rr_downloadedat").cast("string").alias("rr_downloadedat"))
    return null_keys(units, ["id", "rr_downloadedat"])


@query("fk_check", """
    SELECT o_orderkey, o_custkey FROM {orders} WHERE o_custkey NOT IN (
        SELECT c_custkey FROM {customer} WHERE c_mktsegment <> 'BUILDING')""")
def _fk_check(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    return orphans(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", customers, "c_custkey")


@query("length_check", """
    SELECT 'text' AS column_name, 1000 AS max_length, count(CASE WHEN length(text) > 1000 THEN 1 END) AS n FROM {documents}
    UNION ALL SELECT 'source', 3, count(CASE WHEN length(source) > 3 THEN 1 END) FROM {documents}""")
def _length_check(spark, sf_dir):
    limits = Table("text string, source string", keys=(), limits={"text": 1000, "source": 3})
    return too_long(table(spark, sf_dir, "documents").select("text", "source"), limits)


@query("table_checks", """
    WITH o AS (SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS day, o_orderpriority,
        o_custkey IN (SELECT c_custkey FROM {customer} WHERE c_mktsegment <> 'BUILDING') AS known FROM {orders})
    SELECT 'duplicate key' AS "check", CAST(NULL AS VARCHAR) AS column_name, count(*) AS n
        FROM (SELECT 1 FROM o GROUP BY o_custkey, day HAVING count(*) > 1)
    UNION ALL SELECT 'null in key', NULL, count(*) FILTER (o_custkey IS NULL OR day IS NULL) FROM o
    UNION ALL SELECT 'unknown customer', 'o_custkey', count(*) FILTER (NOT known) FROM o
    UNION ALL SELECT 'too long', 'o_orderpriority', count(*) FILTER (length(o_orderpriority) > 6) FROM o""")
def _table_checks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey", "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS day", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    return table_report(
        orders, ["o_custkey", "day"], {"o_orderpriority": 6}, {"o_custkey": (customers, "c_custkey")},
        {"o_custkey": "unknown customer"})

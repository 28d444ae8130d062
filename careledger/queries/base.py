"""Warehouse-shaped views over the given tables, and the registry of queries.

A view is one SELECT that Spark and the checking database both understand, so the two
sides start from the same rows and only the operator under test differs. {name} stands
for a given table or another view.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from careledger.session import shared_dir
from careledger.sources.warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The clock of all queries, just before the last order date.
AS_OF = dt.datetime(2001, 7, 1, 12, 0)

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
_SOURCES = ("hmis", "phem")


def _per_source(select: str) -> str:
    return " UNION ALL ".join(select.replace("$source", s) for s in _SOURCES)


_SOURCE_OF_CUSTOMER = "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'phem' ELSE 'hmis' END"
_DAYS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM {orders}"
_DATASET_ID = "concat('DS.', p_type, '.', p_brand)"

VIEWS = {
    # Org units: regions and nations are known to both sources, customers to one.
    "staged": _per_source("""
        SELECT concat('R', r_regionkey) AS id, r_name AS name, CAST(NULL AS STRING) AS parentid,
            concat('/R', r_regionkey) AS path, 1 AS level, false AS leaf, '$source' AS datasource_id
        FROM {region}
        UNION ALL
        SELECT concat('N', n_nationkey), n_name, concat('R', n_regionkey),
            concat('/R', n_regionkey, '/N', n_nationkey), 2, false, '$source'
        FROM {nation}""") + f"""
        UNION ALL
        SELECT concat('C', c_custkey), c_name, concat('N', c_nationkey),
            concat('/R', n_regionkey, '/N', c_nationkey, '/C', c_custkey), 3, true,
            {_SOURCE_OF_CUSTOMER}
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "marks": """
        SELECT concat('C', o_custkey) AS id, CAST(max(o_orderdate) AS DATE) AS dv,
            CAST(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS DATE) AS rr,
            CAST(max(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END) AS DATE) AS dc
        FROM {orders} GROUP BY o_custkey""",
    "ou": """
        SELECT s.id, s.name, s.parentid, s.path AS oupath, s.level, s.leaf, s.datasource_id,
            m.dv AS dv_downloadedat, m.dc AS dc_downloadedat, m.rr AS rr_downloadedat
        FROM {staged} s LEFT JOIN {marks} m ON s.id = m.id""",
    # Data elements: promotional parts carry a list of two combos.
    "de": """
        SELECT concat('DE', p_partkey) AS id, p_name AS name,
            CASE WHEN p_type = 'PROMO' THEN concat(p_brand, ', Brand#11') ELSE p_brand END
                AS categorycombo_id,
            CASE WHEN p_size < 25 THEN 'hmis' ELSE 'phem' END AS datasource_id
        FROM {part}""",
    "coc": """
        SELECT DISTINCT concat('OC', p_brand, '.', p_size % 5) AS id, p_brand AS categorycombo_id
        FROM {part}""",
    "dv": """
        SELECT concat('OU', l_suppkey) AS orgunit, concat('DE', l_partkey) AS dataelement,
            concat(year(l_shipdate), lpad(CAST(month(l_shipdate) AS STRING), 2, '0')) AS period,
            concat('OC', CASE WHEN l_linenumber <= 5 THEN p_brand ELSE 'Brand#99' END, '.',
                CAST(l_quantity AS INT) % 5) AS categoryoptioncombo,
            l_returnflag AS attributeoptioncombo, l_extendedprice AS value_double,
            l_shipdate AS lastupdated
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    # Data sets: one per part type and brand; the type decides how often it reports.
    "ds": f"""
        SELECT DISTINCT {_DATASET_ID} AS id,
            CASE p_type WHEN 'ECONOMY' THEN 'Weekly' WHEN 'LARGE' THEN 'Monthly'
                WHEN 'MEDIUM' THEN 'Quarterly' WHEN 'PROMO' THEN 'SixMonthly'
                WHEN 'SMALL' THEN 'Yearly' ELSE 'Daily' END AS periodtype,
            CASE WHEN p_type = 'STANDARD' THEN '' ELSE p_brand END AS categorycombo_id,
            CASE WHEN p_brand < 'Brand#2' THEN 'phem' ELSE 'hmis' END AS datasource_id
        FROM {{part}}""",
    "assign": f"""
        SELECT DISTINCT {_DATASET_ID} AS dataset_id, concat('C', o_custkey) AS orgunit_id
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
        JOIN {{part}} ON l_partkey = p_partkey""",
    "periods": {
        engine: f"""
        SELECT id, min(start_date) AS start_date FROM (
            SELECT {week} AS id, CAST(date_trunc('week', d) AS DATE) AS start_date FROM ({_DAYS}) a
            UNION ALL SELECT concat(year(d), lpad(CAST(month(d) AS STRING), 2, '0')),
                CAST(date_trunc('month', d) AS DATE) FROM ({_DAYS}) b
            UNION ALL SELECT concat(year(d), 'Q', quarter(d)),
                CAST(date_trunc('quarter', d) AS DATE) FROM ({_DAYS}) c
            UNION ALL SELECT concat(year(d), 'S', CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END), d
                FROM ({_DAYS}) e
            UNION ALL SELECT CAST(year(d) AS STRING), CAST(date_trunc('year', d) AS DATE)
                FROM ({_DAYS}) f
            UNION ALL SELECT 'junk', d FROM ({_DAYS}) g
        ) x GROUP BY id"""
        for engine, week in {
            "spark": "concat(extract(YEAROFWEEK FROM d), 'W', weekofyear(d))",
            "duckdb": "concat(isoyear(d), 'W', week(d))",
        }.items()
    },
    # Two versions of the same values: line status F is in the table, O is new.
    "lines": """
        SELECT concat('OU', l_orderkey) AS orgunit, concat('DE', l_linenumber) AS dataelement,
            l_extendedprice AS value_double, l_returnflag AS value_string,
            l_shipdate AS lastupdated, l_partkey AS part_seq, l_suppkey AS supp_seq,
            l_linestatus AS version
        FROM {lineitem}""",
    # Category metadata: a brand is a combo, a size an option. A size belongs to the category
    # of each part type, and small ones to a second category whose name clashes with it.
    # Size 50 has no named category.
    "opt": _per_source("""
        SELECT DISTINCT concat('S', p_size) AS id, concat('Size ', p_size) AS name,
            '$source' AS combo_type FROM {part}""").replace("'hmis'", "'category'").replace(
                "'phem'", "'attribute'"),
    "cat": """
        SELECT DISTINCT concat('K', p_type) AS id, concat(lower(p_type), ' (Größe)') AS name,
            CASE WHEN p_type < 'N' THEN 'category' ELSE 'attribute' END AS combo_type
        FROM {part} WHERE p_size < 50
        UNION ALL
        SELECT DISTINCT concat('X', p_type), concat(upper(p_type), ' [größe]'), 'category'
        FROM {part} WHERE p_size <= 10 AND p_type < 'N'
        UNION ALL
        SELECT DISTINCT concat('unnamed', p_size), CAST(NULL AS STRING), 'category'
        FROM {part} WHERE p_size = 50""",
    "cat_opt": """
        SELECT DISTINCT concat('K', p_type) AS category_id, concat('S', p_size) AS categoryoption_id
        FROM {part} WHERE p_size < 50
        UNION ALL
        SELECT DISTINCT concat('X', p_type), concat('S', p_size) FROM {part}
        WHERE p_size <= 10 AND p_type < 'N'
        UNION ALL
        SELECT DISTINCT concat('unnamed', p_size), concat('S', p_size) FROM {part} WHERE p_size = 50""",
    "coc_opt": """
        SELECT DISTINCT concat('OC', p_brand, '.', p_size) AS categoryoptioncombo_id,
            concat('S', p_size) AS categoryoption_id
        FROM {part}""",
    "brand_sizes": """
        SELECT DISTINCT concat('OC', p_brand, '.', p_size) AS id,
            concat(p_brand, ' / ', p_size) AS name, concat('code ', p_size) AS code,
            p_brand AS categorycombo_id
        FROM {part}""",
}


def _text(name: str, engine: str) -> str:
    view = VIEWS[name]
    return view if isinstance(view, str) else view[engine]


def _needs(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{([a-z_]+)\}", text)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a given table, as a DataFrame."""
    if name in BASE:
        return table(spark, sf_dir, name)
    text = _text(name, "spark")
    return spark.sql(text, **{n: view(spark, sf_dir, n) for n in _needs(text)})


def oracle(body: str) -> str:
    """SQL for the checking database: body with the views it names put in front."""
    parts: dict[str, str] = {}

    def add(text: str) -> None:
        for name in _needs(text):
            if name not in BASE and name not in parts:
                inner = _text(name, "duckdb")
                add(inner)
                parts[name] = inner

    add(body)
    views = ",\n".join(f"{n} AS ({t})" for n, t in parts.items())
    sql = f"WITH {views}\n{body}" if views and not body.lstrip().upper().startswith("WITH ") else (
        f"WITH {views},\n{body.lstrip()[5:]}" if views else body
    )
    return re.sub(r"\{([a-z_]+)\}", r"\1", sql)


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that gives the same rows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register


def scratch_warehouse(spark: SparkSession, buckets: int = 1) -> Warehouse:
    """An empty warehouse in the shared folder."""
    return Warehouse(spark, f"{shared_dir(spark)}/warehouse-{uuid.uuid4().hex}", buckets)

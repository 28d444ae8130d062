"""Responses as they would have landed, made from the given tables, and their parsing.

Each response comes from one row, so building them needs no grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careledger.operators.quality import failure_share, run_counters
from careledger.operators.watermarks import finished_units, settled_requests
from careledger.queries.base import query, table, view
from careledger.sources import payloads
from careledger.sources.landing import check_pages, decode

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def respond(
    rows: DataFrame, request: str, body: Column, unit: str = "''", page: str = "1",
    status: str = "'ok'", fetched_at: str = "TIMESTAMP_NTZ '2001-07-01 00:00:00'", source: str = "'hmis'",
) -> DataFrame:
    """Rows with an envelope: SQL expressions over their columns, and the JSON body."""
    return rows.select(
        F.expr(request).alias("request_id"), F.expr(source).alias("source"), F.expr(unit).alias("orgunit"),
        F.expr(page).cast("int").alias("page"), F.expr(status).alias("status"),
        F.expr(fetched_at).cast("timestamp_ntz").alias("fetched_at"), body.alias("body"),
    )


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly over four tasks a core. A body takes far more work to write and to read than the row
    it's made from, and a file of millions of rows may be no more than a few parts to a scan: all of a load would
    run in as many tasks, as answers are staged in the parts they come in."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


def value_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two values per event. The body of an 'error' event breaks off."""
    stamp = F.date_format("ts", _ISO)

    def value(element: str, text: Column) -> Column:
        return F.struct(
            F.concat(F.lit("U"), "user_id").alias("orgUnit"), F.lit(element).alias("dataElement"),
            F.date_format("ts", "yyyyMMdd").alias("period"), F.col("event_type").alias("categoryOptionCombo"),
            F.lit("default").alias("attributeOptionCombo"), text.alias("value"),
            F.col("event_id").cast("string").alias("storedBy"), F.lit("").alias("created"),
            stamp.alias("lastUpdated"), (F.col("event_type") == "purchase").alias("deleted"),
        )

    body = F.to_json(F.struct(F.array(
        value("k", F.get_json_object("props", "$.k")), value("type", F.col("event_type"))
    ).alias("dataValues")))
    broken = F.when(F.col("event_type") == "error", F.expr("left(body, length(body) - 5)")).otherwise(F.col("body"))
    events = spread(table(spark, sf_dir, "events")).withColumn("body", body)
    return respond(events, "concat('r', event_id)", broken, "concat('U', user_id)", fetched_at="ts")


VALUE_ROWS = """SELECT event_id, ts, concat('U', user_id) AS orgunit, element AS dataelement,
        strftime(ts, '%Y%m%d') AS period, event_type AS categoryoptioncombo,
        CASE WHEN element = 'type' THEN event_type END AS value_string,
        CASE WHEN element = 'k' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS value_double,
        CAST(date_trunc('second', ts) AS VARCHAR) AS lastupdated, event_type = 'purchase' AS deleted
    FROM (SELECT *, unnest(['k', 'type']) AS element FROM {events}) e WHERE event_type <> 'error'"""


@query("explode_values", f"""
    SELECT CAST(event_id AS VARCHAR) AS storedby, orgunit, dataelement, period, categoryoptioncombo, value_string,
        value_double, CAST(NULL AS VARCHAR) AS created, lastupdated, deleted FROM ({VALUE_ROWS}) v""")
def _explode_values(spark, sf_dir):
    rows = payloads.data_values(decode(value_responses(spark, sf_dir), "values"))
    return rows.select(
        "storedby", "orgunit", "dataelement", "period", "categoryoptioncombo", "value_string", "value_double",
        F.col("created").cast("string").alias("created"), F.col("lastupdated").cast("string").alias("lastupdated"),
        "deleted",
    )


@query("rejected_responses", """
    SELECT concat('r', event_id) AS request_id, event_type <> 'error' AS ok FROM {events}""")
def _rejected(spark, sf_dir):
    return settled_requests(decode(value_responses(spark, sf_dir), "values"))


def grid_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One grid per order; two priorities have a cell that cannot be read."""
    def cell(metric: str, value: str) -> str:
        return f"array(concat(o_orderpriority, {metric}), concat('C', o_custkey), CAST(year(o_orderdate) AS STRING), {value})"

    expected = cell("'.EXPECTED_REPORTS'", "CAST(o_totalprice AS STRING)")
    rows = F.expr(f"""CASE o_orderpriority
        WHEN '1-URGENT' THEN array({expected}, {cell("'.ACTUAL_REPORTS'", "CAST(o_orderkey AS STRING)")},
            {cell("'.ACTUAL_REPORTS_ON_TIME'", "CAST(o_custkey AS STRING)")})
        WHEN '2-HIGH' THEN array({expected})
        WHEN '3-MEDIUM' THEN array({cell("'.OTHER'", "'1'")})
        WHEN '4-NOT SPECIFIED' THEN array({expected}, {cell("' without dot'", "'1'")})
        ELSE array({expected}, {cell("'.ACTUAL_REPORTS'", "'n/a'")}) END""")
    body = F.to_json(F.struct(rows.alias("rows")))
    return respond(spread(table(spark, sf_dir, "orders")), "concat('g', o_orderkey)", body, "concat('C', o_custkey)",
                   fetched_at="o_orderdate")


@query("grid_payload", """
    WITH cells AS (
        SELECT o_orderkey, o_orderpriority AS dataset_id, 'EXPECTED_REPORTS' AS metric, o_totalprice AS value, true AS usable
        FROM {orders} WHERE o_orderpriority <> '3-MEDIUM'
        UNION ALL SELECT o_orderkey, o_orderpriority, 'ACTUAL_REPORTS', CAST(o_orderkey AS DOUBLE), true
        FROM {orders} WHERE o_orderpriority = '1-URGENT'
        UNION ALL SELECT o_orderkey, o_orderpriority, 'ACTUAL_REPORTS_ON_TIME', CAST(o_custkey AS DOUBLE), true
        FROM {orders} WHERE o_orderpriority = '1-URGENT'
        UNION ALL SELECT o_orderkey, o_orderpriority, 'OTHER', 1.0, true FROM {orders} WHERE o_orderpriority = '3-MEDIUM'
        UNION ALL SELECT o_orderkey, NULL, NULL, 1.0, false FROM {orders} WHERE o_orderpriority = '4-NOT SPECIFIED'
        UNION ALL SELECT o_orderkey, o_orderpriority, 'ACTUAL_REPORTS', NULL, false FROM {orders} WHERE o_orderpriority = '5-LOW')
    SELECT concat('g', o_orderkey) AS request_id, dataset_id, metric, value, usable,
        concat('C', o_custkey) AS orgunit_id, CAST(year(o_orderdate) AS VARCHAR) AS period
    FROM cells JOIN {orders} USING (o_orderkey)""")
def _grid_payload(spark, sf_dir):
    cells = payloads.grid_rows(decode(grid_responses(spark, sf_dir), "grid"))
    return cells.select("request_id", "dataset_id", "metric", "value", "usable", "orgunit_id", "period")


@query("finished_units", """
    SELECT concat('C', o_custkey) AS id, 'hmis' AS datasource_id FROM {orders} GROUP BY o_custkey
    HAVING bool_and(o_orderpriority < '4')""")
def _finished_units(spark, sf_dir):
    decoded = decode(grid_responses(spark, sf_dir), "grid")
    rejects = payloads.grid_rows(decoded).filter("not usable")
    return finished_units(decoded, settled_requests(decoded, rejects))


def period_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month of an order resolved to dates, beside an item that is no period."""
    items = F.expr("""map(
        date_format(o_orderdate, 'yyyyMM'), named_struct('name', date_format(o_orderdate, 'yyyy-MM'),
            'startDate', date_format(trunc(o_orderdate, 'MM'), "yyyy-MM-dd'T'00:00:00.000"),
            'endDate', date_format(last_day(o_orderdate), "yyyy-MM-dd'T'00:00:00.000")),
        'dx', named_struct('name', 'Data', 'startDate', CAST(NULL AS STRING), 'endDate', CAST(NULL AS STRING)))""")
    body = F.to_json(F.struct(F.struct(items.alias("items")).alias("metaData")))
    return respond(spread(table(spark, sf_dir, "orders")), "concat('p', o_orderkey)", body)


@query("period_payload", """
    SELECT strftime(o_orderdate, '%Y%m') AS id, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS start_date,
        CAST(last_day(o_orderdate) AS VARCHAR) AS end_date, strftime(o_orderdate, '%Y-%m') AS period_name, count(*) AS n
    FROM {orders} WHERE strftime(o_orderdate, '%Y%m') IN (SELECT strftime(l_shipdate, '%Y%m') FROM {lineitem}
        WHERE l_returnflag = 'R') GROUP BY ALL""")
def _period_payload(spark, sf_dir):
    wanted = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(
        F.date_format("l_shipdate", "yyyyMM").alias("id")
    ).distinct()
    found = payloads.periods(decode(period_responses(spark, sf_dir), "periods"), wanted)
    return found.groupBy(
        "id", F.col("start_date").cast("string").alias("start_date"),
        F.col("end_date").cast("string").alias("end_date"), "period_name",
    ).agg(F.count("*").alias("n"))


def completeness_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registration per order; pending ones do not say whether they are complete."""
    body = F.to_json(F.struct(F.array(F.struct(
        F.concat(F.lit("DS."), "o_orderpriority").alias("dataSet"),
        F.concat(F.lit("C"), "o_custkey").alias("organisationUnit"),
        F.date_format("o_orderdate", "yyyyMM").alias("period"), F.lit("default").alias("attributeOptionCombo"),
        F.col("o_orderkey").cast("string").alias("storedBy"), F.date_format("o_orderdate", _ISO).alias("date"),
        F.lit("").alias("lastUpdated"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("completed"),
    )).alias("completeDataSetRegistrations")))
    return respond(spread(table(spark, sf_dir, "orders")), "concat('c', o_custkey)", body, "concat('C', o_custkey)",
                   page="o_orderkey", fetched_at="o_orderdate")


@query("completeness_payload", """
    SELECT concat('DS.', o_orderpriority) AS dataset_id, concat('C', o_custkey) AS orgunit_id,
        strftime(o_orderdate, '%Y%m') AS period, CAST(o_orderkey AS VARCHAR) AS storedby,
        CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_submitted, CAST(NULL AS VARCHAR) AS lastupdated,
        o_orderstatus <> 'O' AS completed FROM {orders}""")
def _completeness_payload(spark, sf_dir):
    rows = payloads.completeness(decode(completeness_responses(spark, sf_dir), "completeness"))
    return rows.select(
        "dataset_id", "orgunit_id", "period", "storedby",
        F.col("date_submitted").cast("date").cast("string").alias("date_submitted"),
        F.col("lastupdated").cast("string").alias("lastupdated"), "completed",
    )


def orgunit_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every staged unit as one page, assigned to its parent's data set and an unknown one."""
    units = view(spark, sf_dir, "staged").filter("datasource_id = 'hmis'")
    body = F.to_json(F.struct(
        F.expr("named_struct('page', 1, 'pageCount', 1)").alias("pager"),
        F.array(F.struct(
            "id", "name", F.when(F.col("level") > 1, F.upper("name")).alias("shortName"),
            F.initcap(F.col("leaf").cast("string")).alias("leaf"),
            F.when(F.col("parentid").isNotNull(), F.struct(F.col("parentid").alias("id"))).alias("parent"),
            "path", "level", F.lit("1990-01-01T00:00:00.000").alias("openingDate"),
            F.lit("2001-06-01T10:11:12.131").alias("lastUpdated"),
            F.expr("""array(named_struct('id', concat('DS.', parentid)), named_struct('id', 'unknown'))""")
            .alias("dataSets"),
        )).alias("organisationUnits"),
    ))
    return respond(units, "concat('o', id)", body)


@query("orgunit_payload", """
    SELECT id, CASE WHEN level > 1 THEN upper(name) END AS shortname, name, leaf, parentid, path, level,
        '1990-01-01' AS openingdate, '2001-06-01 10:11:12' AS lastupdated, datasource_id
    FROM {staged} WHERE datasource_id = 'hmis'""")
def _orgunit_payload(spark, sf_dir):
    units = payloads.org_units(decode(orgunit_responses(spark, sf_dir), "orgunits"))
    return units.select(
        "id", "shortname", "name", "leaf", "parentid", "path", "level",
        F.col("openingdate").cast("string").alias("openingdate"),
        F.col("lastupdated").cast("string").alias("lastupdated"), "datasource_id",
    )


def tracked_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One data set per nation; those of the regions are not tracked."""
    return view(spark, sf_dir, "staged").filter("datasource_id = 'hmis' AND level = 2").select(
        F.concat(F.lit("DS."), "id").alias("id"), "datasource_id"
    )


@query("assignment_payload", """
    SELECT concat('DS.', parentid) AS dataset_id, id AS orgunit_id, datasource_id FROM {staged}
    WHERE datasource_id = 'hmis' AND level = 3""")
def _assignment_payload(spark, sf_dir):
    decoded = decode(orgunit_responses(spark, sf_dir), "orgunits")
    return payloads.org_unit_assignments(decoded, tracked_sets(spark, sf_dir)).drop("_fetchedat")


def element_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.to_json(F.expr("""named_struct(
        'id', concat('DE', p_partkey), 'code', CASE WHEN p_size > 25 THEN concat('code', p_size) END,
        'name', p_name, 'shortName', left(p_name, 5), 'valueType', 'NUMBER', 'aggregationType', p_type,
        'zeroIsSignificant', CASE WHEN p_size < 10 THEN 'TRUE' WHEN p_size < 20 THEN 'no' END,
        'categoryCombo', named_struct('id', p_brand, 'name', concat('combo ', p_brand)),
        'optionSet', CASE WHEN p_type = 'SMALL' THEN named_struct('id', 'OS', 'name', 'Options') END,
        'dataSetElements', array(
            named_struct('categoryCombo', CASE WHEN p_type = 'PROMO' THEN named_struct('id', 'Brand#11', 'name', 'eleven') END,
                'dataSet', named_struct('id', concat('DS.', p_type, '.', p_brand))),
            named_struct('categoryCombo', NULL, 'dataSet', named_struct('id', CASE WHEN p_size > 40 THEN 'DS.large' ELSE '' END))),
        'created', '2000-01-01T01:02:03.456', 'lastUpdated', CASE WHEN p_size <> 7 THEN '2000-02-01T01:02:03' END,
        'href', concat('https://example.org/', p_partkey))"""))
    return respond(table(spark, sf_dir, "part"), "concat('e', p_partkey)", body)


@query("element_payload", """
    SELECT concat('DE', p_partkey) AS id, CASE WHEN p_size > 25 THEN concat('code', p_size) END AS code, p_name AS name,
        substr(p_name, 1, 5) AS shortname, 'NUMBER' AS valuetype, p_type AS aggregationtype, p_size < 10 AS zeroissignificant,
        CASE WHEN p_type = 'PROMO' AND p_brand <> 'Brand#11' THEN concat(p_brand, ',Brand#11') ELSE p_brand END AS categorycombo_id,
        CASE WHEN p_type = 'PROMO' AND p_brand <> 'Brand#11' THEN concat('combo ', p_brand, ',eleven')
            ELSE concat('combo ', p_brand) END AS categorycombo_name,
        CASE WHEN p_type = 'SMALL' THEN 'OS' END AS optionset_id, '2000-01-01 01:02:03.456' AS created,
        CASE WHEN p_size <> 7 THEN '2000-02-01 01:02:03' END AS lastupdated FROM {part}""")
def _element_payload(spark, sf_dir):
    rows = payloads.data_elements(decode(element_responses(spark, sf_dir), "dataelement"))
    return rows.select(
        "id", "code", "name", "shortname", "valuetype", "aggregationtype", "zeroissignificant", "categorycombo_id",
        "categorycombo_name", "optionset_id", F.col("created").cast("string").alias("created"),
        F.col("lastupdated").cast("string").alias("lastupdated"),
    )


@query("dataset_discovery", """
    SELECT DISTINCT concat('DS.', p_type, '.', p_brand) AS dataset_id, concat('DE', p_partkey) AS dataelement_id FROM {part}
    UNION ALL SELECT DISTINCT 'DS.large', concat('DE', p_partkey) FROM {part} WHERE p_size > 40""")
def _dataset_discovery(spark, sf_dir):
    found = payloads.dataset_elements(decode(element_responses(spark, sf_dir), "dataelement"))
    return found.select("dataset_id", "dataelement_id")


def dataset_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = view(spark, sf_dir, "ds")
    body = F.to_json(F.expr("""named_struct('id', id, 'name', lower(id), 'periodType', periodtype,
        'categoryCombo', CASE WHEN categorycombo_id <> '' THEN named_struct('id', categorycombo_id, 'name', 'c') END,
        'created', '2000-01-01T00:00:00.000', 'lastUpdated', '2000-02-01T01:02:03.004')"""))
    return respond(sets, "concat('s', id)", body, source="datasource_id")


@query("dataset_payload", """
    SELECT id, lower(id) AS name, periodtype, CASE WHEN categorycombo_id <> '' THEN categorycombo_id END AS categorycombo_id,
        '2000-02-01 01:02:03.004' AS lastupdated, datasource_id FROM {ds}""")
def _dataset_payload(spark, sf_dir):
    rows = payloads.data_sets(decode(dataset_responses(spark, sf_dir), "dataset"))
    return rows.select("id", "name", "periodtype", "categorycombo_id",
                       F.col("lastupdated").cast("string").alias("lastupdated"), "datasource_id")


def combo_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A combo per part. Later parts repeat the ids of earlier ones under new names."""
    body = F.to_json(F.expr("""named_struct('id', p_brand, 'name', concat('combo ', p_partkey), 'categories', array(
        named_struct('id', concat('K', p_type), 'name', concat('category ', p_partkey),
            'categoryOptions', array(named_struct('id', concat('S', p_size), 'name', concat('size ', p_partkey)))),
        named_struct('id', 'KALL', 'name', concat('all ', p_partkey),
            'categoryOptions', array(named_struct('id', concat('S', p_size), 'name', concat('any size ', p_partkey)),
                named_struct('id', 'SX', 'name', concat('none ', p_partkey))))))"""))
    return respond(table(spark, sf_dir, "part"), "'combos'", body, page="p_partkey")


def _combos(spark, sf_dir):
    return payloads.category_combos(decode(combo_responses(spark, sf_dir), "combo"), "category")


@query("combo_entities", """
    SELECT 'combo' AS entity, p_brand AS id, concat('combo ', max(p_partkey)) AS name FROM {part} GROUP BY p_brand
    UNION ALL SELECT 'category', concat('K', p_type), concat('category ', max(p_partkey)) FROM {part} GROUP BY p_type
    UNION ALL SELECT 'category', 'KALL', concat('all ', max(p_partkey)) FROM {part}
    UNION ALL SELECT 'option', concat('S', p_size), concat('any size ', max(p_partkey)) FROM {part} GROUP BY p_size
    UNION ALL SELECT 'option', 'SX', concat('none ', max(p_partkey)) FROM {part}""")
def _combo_entities(spark, sf_dir):
    found = _combos(spark, sf_dir)
    names = {"combo": "categorycombos", "category": "categories", "option": "categoryoptions"}
    frames = [found[t].select(F.lit(e).alias("entity"), "id", "name") for e, t in names.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("combo_links", """
    SELECT DISTINCT 'category' AS kind, p_brand AS parent, concat('K', p_type) AS child FROM {part}
    UNION ALL SELECT DISTINCT 'category', p_brand, 'KALL' FROM {part}
    UNION ALL SELECT DISTINCT 'option', concat('K', p_type), concat('S', p_size) FROM {part}
    UNION ALL SELECT DISTINCT 'option', 'KALL', concat('S', p_size) FROM {part}
    UNION ALL SELECT DISTINCT 'option', 'KALL', 'SX' FROM {part}""")
def _combo_links(spark, sf_dir):
    found = _combos(spark, sf_dir)
    categories = found["categorycombo_categories"].select(
        F.lit("category").alias("kind"), F.col("categorycombo_id").alias("parent"), F.col("category_id").alias("child"))
    options = found["category_categoryoptions"].select(
        F.lit("option").alias("kind"), F.col("category_id").alias("parent"), F.col("categoryoption_id").alias("child"))
    return categories.unionByName(options)


def option_combo_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.to_json(F.expr("""named_struct('pager', named_struct('page', 1, 'pageCount', 1), 'categoryOptionCombos', array(
        named_struct('id', concat('OC', p_brand, '.', p_size % 5), 'name', concat('oc ', p_partkey),
            'categoryCombo', named_struct('id', p_brand),
            'categoryOptions', array(named_struct('id', concat('S', p_size)), named_struct('id', p_type)))))"""))
    return respond(table(spark, sf_dir, "part"), "'optioncombos'", body, page="p_partkey")


@query("option_combo_payload", """
    SELECT concat('OC', p_brand, '.', p_size % 5) AS id, concat('oc ', max(p_partkey)) AS name, p_brand AS categorycombo_id
    FROM {part} GROUP BY p_brand, p_size % 5""")
def _option_combo_payload(spark, sf_dir):
    found = payloads.option_combos(decode(option_combo_responses(spark, sf_dir), "optioncombos"))
    return found["categoryoptioncombos"].select("id", "name", "categorycombo_id")


@query("option_combo_links", """
    SELECT DISTINCT concat('OC', p_brand, '.', p_size % 5) AS categoryoptioncombo_id, concat('S', p_size) AS categoryoption_id
    FROM {part} UNION ALL SELECT DISTINCT concat('OC', p_brand, '.', p_size % 5), p_type FROM {part}""")
def _option_combo_links(spark, sf_dir):
    found = payloads.option_combos(decode(option_combo_responses(spark, sf_dir), "optioncombos"))
    return found["categoryoptioncombo_options"].select("categoryoptioncombo_id", "categoryoption_id")


@query("page_check", """
    SELECT concat('q', o_custkey) AS request_id, coalesce(max(CASE WHEN o_orderstatus <> 'P' THEN 8 END), 0) AS pages_expected,
        CAST(count(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END) AS INT) AS pages_found,
        count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) >= greatest(coalesce(max(CASE WHEN o_orderstatus <> 'P' THEN 8 END), 0), 1)
            AS complete
    FROM {orders} GROUP BY o_custkey""")
def _page_check(spark, sf_dir):
    body = F.lit('{"pager": {"page": 1, "pageCount": 8}, "organisationUnits": []}')
    answers = respond(spread(table(spark, sf_dir, "orders")), "concat('q', o_custkey)", body, page="o_orderkey",
                      status="CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'ok' END")
    return check_pages(decode(answers, "orgunits"))


@query("run_counters", """
    SELECT event_type, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status, count(*) AS n
    FROM {events} GROUP BY event_type""")
def _run_counters(spark, sf_dir):
    log = table(spark, sf_dir, "events").selectExpr(
        "event_type", "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status")
    return run_counters(log, "event_type")


@query("failure_share", """
    SELECT user_id, count(*) AS n, count(CASE WHEN event_type = 'error' THEN 1 END) AS failed,
        count(CASE WHEN event_type = 'error' THEN 1 END) / count(*) AS share FROM {events} GROUP BY user_id""")
def _failure_share(spark, sf_dir):
    log = table(spark, sf_dir, "events").selectExpr(
        "user_id", "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status")
    return failure_share(log, "user_id")

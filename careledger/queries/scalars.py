"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from careledger.functions import text
from careledger.functions.calendar import ethiopian_date
from careledger.functions.combos import merge_combos, metric_slot, split_metric
from careledger.functions.names import safe_name
from careledger.functions.periods import period_type
from careledger.functions.values import parse_value
from careledger.queries.base import query, table

# Number and text spellings made from an event, the same in both engines.
_MIXED = """CASE event_type
    WHEN 'view' THEN concat('  ', json_k, ' ')
    WHEN 'click' THEN concat(json_k, '_', json_k, 'e1')
    WHEN 'error' THEN concat(json_k, 'd')
    WHEN 'signup' THEN CASE WHEN user_id < 20 THEN 'NaN' WHEN user_id < 40 THEN '-Infinity'
        WHEN user_id < 60 THEN '   ' WHEN user_id < 80 THEN concat('.', json_k) ELSE event_type END
    ELSE concat('-', json_k, '.') END"""


@query("parse_value", f"""
    WITH raw AS (SELECT *, json_extract_string(props, '$.k') AS json_k FROM {{events}}),
    texts AS (SELECT event_id, trim({_MIXED}) AS v FROM raw),
    typed AS (SELECT event_id, v, CASE
        WHEN regexp_full_match(v, '[+-]?(\\d+(_\\d+)*(\\.(\\d+(_\\d+)*)?)?|\\.\\d+(_\\d+)*)([eE][+-]?\\d+(_\\d+)*)?')
            THEN CAST(replace(v, '_', '') AS DOUBLE) END AS n,
        lower(v) IN ('nan', '+nan', '-nan') AS is_nan,
        regexp_full_match(lower(v), '[+-]?inf(inity)?') AS is_inf FROM texts)
    SELECT event_id, CASE WHEN n IS NULL AND NOT is_nan AND NOT is_inf AND v <> '' THEN v END AS value_string,
        n AS value_double, CASE WHEN is_nan THEN 'nan' WHEN is_inf THEN
            CASE WHEN v LIKE '-%' THEN '-inf' ELSE '+inf' END END AS special
    FROM typed""")
def _parse_value(spark, sf_dir):
    raw = table(spark, sf_dir, "events").withColumn("json_k", F.get_json_object("props", "$.k"))
    string, double = parse_value(F.expr(_MIXED))
    parsed = raw.select("event_id", string.alias("value_string"), double.alias("d"))
    special = (
        F.when(F.isnan("d"), "nan")
        .when(F.col("d") == float("inf"), "+inf")
        .when(F.col("d") == float("-inf"), "-inf")
    )
    return parsed.select(
        "event_id", "value_string", F.when(special.isNull(), F.col("d")).alias("value_double"),
        special.alias("special"),
    )


@query("ethiopian_date", """
    WITH days AS (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS gregorian,
        date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + 716732 AS n FROM {orders}),
    cycle AS (SELECT *, n % 1461 AS r FROM days),
    years AS (SELECT *, r % 365 + 365 * (r // 1460) AS y,
        4 * (n // 1461) + r // 365 - r // 1460 AS yr FROM cycle)
    SELECT o_orderkey, gregorian,
        concat(lpad(CAST(yr AS VARCHAR), 4, '0'), '-', lpad(CAST(y // 30 + 1 AS VARCHAR), 2, '0'),
            '-', lpad(CAST(y % 30 + 1 AS VARCHAR), 2, '0')) AS ethiopian
    FROM years""")
def _ethiopian_date(spark, sf_dir):
    gregorian = F.col("o_orderdate").cast("date").cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", gregorian.alias("gregorian"), ethiopian_date(gregorian).alias("ethiopian")
    )


@query("iso_text", """
    SELECT event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS at_second,
        strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS at_millisecond,
        CAST(CAST(ts AS DATE) AS VARCHAR) AS on_day,
        CASE WHEN event_type <> 'error' THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS on_day_or_null
    FROM {events}""")
def _iso_text(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.iso_timestamp(iso).cast("string").alias("at_second"),
        F.date_format(text.iso_timestamp_ms(iso), "yyyy-MM-dd HH:mm:ss.SSS").alias("at_millisecond"),
        text.iso_date(iso).cast("string").alias("on_day"),
        text.iso_date(text.blank_to_null(F.when(F.col("event_type") == "error", "").otherwise(iso)))
        .cast("string").alias("on_day_or_null"),
    )


@query("period_classify", """
    WITH ids AS (SELECT o_orderkey, CASE o_orderpriority
        WHEN '1-URGENT' THEN concat(isoyear(o_orderdate), 'W', week(o_orderdate))
        WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y%m')
        WHEN '3-MEDIUM' THEN concat(year(o_orderdate), 'Q', quarter(o_orderdate))
        WHEN '5-LOW' THEN CAST(year(o_orderdate) AS VARCHAR)
        ELSE CASE o_orderstatus WHEN 'F' THEN concat(year(o_orderdate), 'S', (month(o_orderdate) + 5) // 6)
            WHEN 'O' THEN strftime(o_orderdate, '%Y%m%d') END END AS period
        FROM {orders})
    SELECT o_orderkey, period, CASE
        WHEN regexp_full_match(period, '\\d{4}W\\d{1,2}') THEN 'Weekly'
        WHEN regexp_full_match(period, '\\d{6}') THEN 'Monthly'
        WHEN regexp_full_match(period, '\\d{4}Q\\d') THEN 'Quarterly'
        WHEN regexp_full_match(period, '\\d{4}S\\d') THEN 'SixMonthly'
        WHEN regexp_full_match(period, '\\d{4}') THEN 'Yearly' END AS periodtype
    FROM ids""")
def _period_classify(spark, sf_dir):
    period = F.expr("""CASE o_orderpriority
        WHEN '1-URGENT' THEN concat(extract(YEAROFWEEK FROM o_orderdate), 'W', weekofyear(o_orderdate))
        WHEN '2-HIGH' THEN date_format(o_orderdate, 'yyyyMM')
        WHEN '3-MEDIUM' THEN concat(year(o_orderdate), 'Q', quarter(o_orderdate))
        WHEN '5-LOW' THEN CAST(year(o_orderdate) AS STRING)
        ELSE CASE o_orderstatus WHEN 'F' THEN concat(year(o_orderdate), 'S', (month(o_orderdate) + 5) div 6)
            WHEN 'O' THEN date_format(o_orderdate, 'yyyyMMdd') END END""")
    return table(spark, sf_dir, "orders").select("o_orderkey", period.alias("period")).withColumn(
        "periodtype", period_type(F.col("period"))
    )


_NAME = """concat(p_brand, ' ', CASE p_type WHEN 'PROMO' THEN 'Âge; (%s) ' WHEN 'SMALL' THEN '5-9 ans = %s'
    WHEN 'LARGE' THEN '  Sexe  é {x} ' ELSE upper(p_name) END)"""


@query("sanitize_names", f"""
    WITH names AS (SELECT DISTINCT CASE WHEN p_size = 1 THEN '***' WHEN p_size = 2 THEN concat(p_size, p_name)
        ELSE {_NAME} END AS name FROM {{part}}),
    words AS (SELECT name, regexp_replace(regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', '_', 'g'),
        '^_|_$', '', 'g') AS w FROM names)
    SELECT name, CASE WHEN w = '' THEN 'col' ELSE
        substr(CASE WHEN regexp_matches(w, '^[0-9]') THEN concat('_', w) ELSE w END, 1, 63) END AS safe_name
    FROM words""".replace("{x}", "[x]"))
def _sanitize_names(spark, sf_dir):
    name = F.expr(f"""CASE WHEN p_size = 1 THEN '***' WHEN p_size = 2 THEN concat(p_size, p_name)
        ELSE {_NAME.replace("{x}", "[x]")} END""")
    names = table(spark, sf_dir, "part").select(name.alias("name")).distinct()
    return names.select("name", safe_name(F.col("name")).alias("safe_name"))


@query("merge_combos", """
    WITH parts AS (SELECT p_partkey, CASE WHEN p_size < 40 THEN p_brand END AS root,
        CASE WHEN p_size < 20 THEN '' ELSE concat('name ', p_brand) END AS root_name,
        CASE WHEN p_type < 'N' THEN p_brand ELSE p_type END AS second FROM {part})
    SELECT p_partkey,
        concat_ws(',', root, CASE WHEN root = second THEN NULL ELSE second END,
            'Brand#0') AS combo_ids,
        CASE WHEN root IS NULL THEN concat_ws(',', concat('second ', second), 'zero')
            WHEN root = second THEN concat_ws(',', CASE WHEN root_name = '' THEN concat('second ', second) ELSE root_name END, 'zero')
            ELSE concat_ws(',', CASE WHEN root_name <> '' THEN root_name END, concat('second ', second), 'zero') END
            AS combo_names
    FROM parts""")
def _merge_combos(spark, sf_dir):
    second = "CASE WHEN p_type < 'N' THEN p_brand ELSE p_type END"
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        """CASE WHEN p_size < 40 THEN named_struct('id', p_brand, 'name',
            CASE WHEN p_size < 20 THEN '' ELSE concat('name ', p_brand) END) END AS root""",
        f"""array(
            named_struct('categoryCombo', named_struct('id', {second}, 'name', concat('second ', {second}))),
            named_struct('categoryCombo', named_struct('id', 'Brand#0', 'name', CAST(NULL AS STRING))),
            named_struct('categoryCombo', named_struct('id', 'Brand#0', 'name', 'zero'))) AS elements""",
    )
    ids, names = merge_combos(F.col("root"), F.col("elements"))
    return rows.select("p_partkey", ids.alias("combo_ids"), names.alias("combo_names"))


@query("split_metric", """
    WITH m AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'a.EXPECTED_REPORTS'
        WHEN '2-HIGH' THEN 'b.ACTUAL_REPORTS' WHEN '3-MEDIUM' THEN 'c.ACTUAL_REPORTS_ON_TIME'
        WHEN '5-LOW' THEN 'no dot' ELSE concat('x.', o_orderstatus, '.y') END AS dx FROM {orders})
    SELECT o_orderkey, dx, CASE WHEN len(string_split(dx, '.')) = 2 THEN split_part(dx, '.', 1) END AS dataset_id,
        CASE WHEN dx LIKE '%EXPECTED%' THEN 'expected_reports' WHEN dx LIKE '%ON_TIME%' THEN
        'actual_reports_on_time' WHEN dx LIKE '%ACTUAL%' THEN 'actual_reports' END AS slot
    FROM m""")
def _split_metric(spark, sf_dir):
    dx = F.expr("""CASE o_orderpriority WHEN '1-URGENT' THEN 'a.EXPECTED_REPORTS'
        WHEN '2-HIGH' THEN 'b.ACTUAL_REPORTS' WHEN '3-MEDIUM' THEN 'c.ACTUAL_REPORTS_ON_TIME'
        WHEN '5-LOW' THEN 'no dot' ELSE concat('x.', o_orderstatus, '.y') END""")
    dataset, metric = split_metric(F.col("dx"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dx.alias("dx")).select(
        "*", dataset.alias("dataset_id"), metric_slot(metric).alias("slot")
    )


@query("true_flags", """
    SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN true WHEN 'MACHINERY' THEN true ELSE false END AS flag
    FROM {customer}""")
def _true_flags(spark, sf_dir):
    spelled = F.expr("""CASE c_mktsegment WHEN 'BUILDING' THEN 'true' WHEN 'MACHINERY' THEN 'True'
        WHEN 'FURNITURE' THEN '1' WHEN 'HOUSEHOLD' THEN NULL ELSE 'false' END""")
    return table(spark, sf_dir, "customer").select("c_custkey", text.is_true(spelled).alias("flag"))

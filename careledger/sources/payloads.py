"""From decoded payloads to warehouse-shaped rows. One function per kind of response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.functions.combos import merge_combos, split_metric
from careledger.functions.text import (
    blank_to_null, iso_date, iso_timestamp, iso_timestamp_ms, is_true,
)
from careledger.functions.values import number, parse_value, strip
from careledger.operators.merge import keep_last
from careledger.operators.nested import unnest
from careledger.sources.landing import seq


def _source() -> Column:
    return F.col("source").alias("datasource_id")


def _fetched() -> Column:
    return F.col("fetched_at").alias("_fetchedat")


def _elements(decoded: DataFrame, array: str) -> DataFrame:
    """One row per element of a payload array, with its arrival order."""
    return unnest(
        decoded.select("request_id", "source", "page", "fetched_at", F.col(f"payload.{array}").alias("array")),
        "array", "e", "pos",
    )


def data_values(decoded: DataFrame) -> DataFrame:
    text, double = parse_value(F.col("e.value"))
    return _elements(decoded, "dataValues").select(
        F.col("e.orgUnit").alias("orgunit"),
        F.col("e.dataElement").alias("dataelement"),
        F.col("e.period").alias("period"),
        F.col("e.categoryOptionCombo").alias("categoryoptioncombo"),
        F.col("e.attributeOptionCombo").alias("attributeoptioncombo"),
        text.alias("value_string"),
        double.alias("value_double"),
        F.col("e.comment").alias("comment"),
        F.col("e.storedBy").alias("storedby"),
        iso_timestamp(blank_to_null(F.col("e.created"))).alias("created"),
        iso_timestamp(blank_to_null(F.col("e.lastUpdated"))).alias("lastupdated"),
        F.col("e.followUp").alias("followup"),
        F.col("e.deleted").alias("deleted"),
        F.col("fetched_at").alias("_ingestedat"),
        _source(), "request_id", seq("pos").alias("seq"),
    )


def grid_rows(decoded: DataFrame) -> DataFrame:
    """Cells of the reporting grid; usable is FALSE for a cell that cannot be read."""
    dataset, metric = split_metric(F.col("dx"))
    return (
        _elements(decoded, "rows")
        .withColumn("dx", F.get("e", F.lit(0)))
        .select(
            dataset.alias("dataset_id"),
            F.get("e", F.lit(1)).alias("orgunit_id"),
            F.get("e", F.lit(2)).alias("period"),
            metric.alias("metric"),
            number(strip(F.get("e", F.lit(3)))).alias("value"),
            (F.size("e") == 4).alias("four"),
            "fetched_at", _source(), "request_id", seq("pos").alias("seq"),
        )
        .withColumn(
            "usable",
            F.col("four") & F.col("dataset_id").isNotNull() & F.col("value").isNotNull(),
        )
        .drop("four")
    )


def completeness(decoded: DataFrame) -> DataFrame:
    return _elements(decoded, "completeDataSetRegistrations").select(
        F.col("e.dataSet").alias("dataset_id"),
        F.col("e.organisationUnit").alias("orgunit_id"),
        F.col("e.period").alias("period"),
        F.col("e.attributeOptionCombo").alias("attributeoptioncombo"),
        F.col("e.storedBy").alias("storedby"),
        iso_timestamp(blank_to_null(F.col("e.date"))).alias("date_submitted"),
        iso_timestamp(blank_to_null(F.col("e.lastUpdated"))).alias("lastupdated"),
        F.coalesce(F.col("e.completed"), F.lit(True)).alias("completed"),
        F.col("fetched_at").alias("_ingestedat"),
        _source(), "request_id", seq("pos").alias("seq"),
    )


def periods(decoded: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """Periods the server resolved to dates; with requested, only the ids asked for."""
    resolved = (
        decoded.select(
            "request_id", "source", "page", "fetched_at", F.explode_outer("payload.metaData.items").alias("id", "e")
        )
        .filter(F.col("e.startDate").isNotNull())
        .select(
            "id",
            iso_date(F.col("e.startDate")).alias("start_date"),
            iso_date(F.col("e.endDate")).alias("end_date"),
            F.col("e.name").alias("period_name"),
            _fetched(), _source(), seq().alias("seq"),
        )
    )
    if requested is not None:
        resolved = resolved.join(requested.select("id"), "id", "left_semi")
    return resolved


def org_units(decoded: DataFrame) -> DataFrame:
    return _elements(decoded, "organisationUnits").select(
        F.col("e.id").alias("id"),
        F.col("e.code").alias("code"),
        F.col("e.name").alias("name"),
        F.col("e.shortName").alias("shortname"),
        is_true(F.col("e.leaf")).alias("leaf"),
        F.col("e.parent.id").alias("parentid"),
        F.col("e.path").alias("path"),
        F.col("e.level").alias("level"),
        iso_date(F.col("e.openingDate")).alias("openingdate"),
        iso_date(F.col("e.closedDate")).alias("closeddate"),
        iso_timestamp(F.col("e.lastUpdated")).alias("lastupdated"),
        _fetched(), _source(), seq("pos").alias("seq"),
    )


def org_unit_assignments(decoded: DataFrame, datasets: DataFrame) -> DataFrame:
    """(data set, org unit) links to data sets the warehouse tracks for the same source."""
    tracked = datasets.select(F.col("id").alias("dataset_id"), "datasource_id")
    return (
        unnest(_elements(decoded, "organisationUnits"), "e.dataSets", "d")
        .select(F.col("e.id").alias("orgunit_id"), _fetched(), _source(), "d")
        .select(F.col("d.id").alias("dataset_id"), "orgunit_id", "_fetchedat", "datasource_id")
        .join(tracked, ["dataset_id", "datasource_id"], "left_semi")
        .groupBy("dataset_id", "orgunit_id", "datasource_id")
        .agg(F.max("_fetchedat").alias("_fetchedat"))
    )


def _described(*extra: Column) -> list[Column]:
    """Columns data elements and data sets have in common."""
    return [
        F.col("payload.id").alias("id"),
        F.col("payload.code").alias("code"),
        F.col("payload.name").alias("name"),
        F.col("payload.shortName").alias("shortname"),
        F.col("payload.displayName").alias("displayname"),
        F.col("payload.description").alias("description"),
        *extra,
        iso_timestamp_ms(F.col("payload.created")).alias("created"),
        iso_timestamp_ms(F.col("payload.lastUpdated")).alias("lastupdated"),
        F.col("payload.href").alias("href"),
        _fetched(), _source(), seq().alias("seq"),
    ]


def data_elements(decoded: DataFrame) -> DataFrame:
    combo_ids, combo_names = merge_combos(
        F.col("payload.categoryCombo"), F.col("payload.dataSetElements")
    )
    return decoded.filter(F.col("payload.id").isNotNull()).select(
        *_described(
            F.col("payload.formName").alias("formname"),
            F.col("payload.valueType").alias("valuetype"),
            F.col("payload.domainType").alias("domaintype"),
            F.col("payload.aggregationType").alias("aggregationtype"),
            is_true(F.col("payload.zeroIsSignificant")).alias("zeroissignificant"),
            combo_ids.alias("categorycombo_id"),
            combo_names.alias("categorycombo_name"),
            F.col("payload.optionSet.id").alias("optionset_id"),
            F.col("payload.optionSet.name").alias("optionset_name"),
        )
    )


def data_sets(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("payload.id").isNotNull()).select(
        *_described(
            F.col("payload.periodType").alias("periodtype"),
            F.col("payload.categoryCombo.id").alias("categorycombo_id"),
            F.col("payload.categoryCombo.name").alias("categorycombo_name"),
        )
    )


def dataset_elements(decoded: DataFrame) -> DataFrame:
    """Distinct (data set, data element) links found in data element responses."""
    return (
        decoded.select(
            F.explode_outer("payload.dataSetElements.dataSet.id").alias("dataset_id"),
            F.col("payload.id").alias("dataelement_id"), _fetched(), _source(),
        )
        .filter(F.col("dataset_id") != "")
        .groupBy("dataset_id", "dataelement_id", "datasource_id")
        .agg(F.max("_fetchedat").alias("_fetchedat"))
    )


def _entity(node: str, combo_type: str) -> list[Column]:
    return [
        F.col(f"{node}.id").alias("id"),
        F.lit(combo_type).alias("combo_type"),
        F.col(f"{node}.name").alias("name"),
        F.col(f"{node}.code").alias("code"),
        F.col(f"{node}.shortName").alias("shortname"),
        iso_timestamp_ms(F.col(f"{node}.created")).alias("created"),
        iso_timestamp_ms(F.col(f"{node}.lastUpdated")).alias("lastupdated"),
        _fetched(), _source(),
    ]


def _links(rows: DataFrame, **ids: str) -> DataFrame:
    """Distinct links between the two named id columns."""
    return (
        rows.select(*[F.col(path).alias(name) for name, path in ids.items()], _fetched(), _source())
        .dropna(subset=list(ids)).groupBy(*ids, "datasource_id")
        .agg(F.max("_fetchedat").alias("_fetchedat"))
    )


def category_combos(decoded: DataFrame, combo_type: str) -> dict[str, DataFrame]:
    """Three entity tables and two bridges out of one nested response.

    An entity seen more than once keeps its last occurrence.
    """
    combos = decoded.filter(F.col("payload.id").isNotNull())
    categories = unnest(combos, "payload.categories", "cat", "cat_pos")
    options = unnest(categories, "cat.categoryOptions", "opt", "opt_pos")
    key = ["id", "combo_type", "datasource_id"]
    arrival = [F.col("fetched_at"), F.col("request_id"), F.col("page")]

    def entities(rows: DataFrame, node: str, *positions: str) -> DataFrame:
        order = F.struct(*arrival, *[F.col(p) for p in positions]).alias("seq")
        # Without an id there is nothing to keep a row under.
        named = rows.select(*_entity(node, combo_type), order).filter("id IS NOT NULL")
        return keep_last(named, key, ["seq"]).drop("seq")

    return {
        "categorycombos": entities(combos, "payload"),
        "categories": entities(categories, "cat", "cat_pos"),
        "categoryoptions": entities(options, "opt", "cat_pos", "opt_pos"),
        "categorycombo_categories": _links(
            categories, categorycombo_id="payload.id", category_id="cat.id"
        ),
        "category_categoryoptions": _links(
            options, category_id="cat.id", categoryoption_id="opt.id"
        ),
    }


def option_combos(decoded: DataFrame) -> dict[str, DataFrame]:
    """Category option combos (last occurrence) and their links to options."""
    found = _elements(decoded, "categoryOptionCombos")
    combos = found.select(
        F.col("e.id").alias("id"),
        F.col("e.name").alias("name"),
        F.col("e.code").alias("code"),
        F.col("e.categoryCombo.id").alias("categorycombo_id"),
        iso_timestamp_ms(F.col("e.created")).alias("created"),
        iso_timestamp_ms(F.col("e.lastUpdated")).alias("lastupdated"),
        _fetched(), _source(), seq("pos").alias("seq"),
    )
    options = unnest(found, "e.categoryOptions", "opt")
    return {
        "categoryoptioncombos": keep_last(combos.filter("id IS NOT NULL"), ["id", "datasource_id"], ["seq"]).drop("seq"),
        "categoryoptioncombo_options": _links(
            options, categoryoptioncombo_id="e.id", categoryoption_id="opt.id"
        ),
    }

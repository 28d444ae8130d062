"""Loading metadata: data elements, data sets, combinations, dimensions and org units."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger.functions.text import moment
from careledger.operators.dimensions import build_dimension
from careledger.operators.hierarchy import flatten
from careledger.operators.merge import (
    combo_owners, keep_last, newer, option_combo_owners, replace_links,
)
from careledger.operators.quality import require_successes
from careledger.schemas import ORGUNIT_REFRESH_ALL, TABLES
from careledger.sources import payloads
from careledger.sources.landing import check_pages, decode
from careledger.sources.warehouse import Warehouse

# Name of the dimension table and of its name map per combo type.
DIMENSIONS = {
    "category": ("categories", "category_name_map"),
    "attribute": ("attributes", "attribute_name_map"),
}


def _request_log(decoded: DataFrame) -> DataFrame:
    return decoded.select(F.when(F.col("failed"), "failed").otherwise("ok").alias("status"))


def load_data_elements(wh: Warehouse, responses: DataFrame) -> None:
    """Later versions only. Raises after loading when most requests failed."""
    decoded, staged = wh.stage(decode(responses, "dataelement"))
    try:
        wh.merge("dataelements", payloads.data_elements(decoded), condition=newer,
                 order=["lastupdated", "seq"])
        wh.merge("dataset_dataelements", payloads.dataset_elements(decoded))
        require_successes(_request_log(decoded))
    finally:
        wh.delete(staged)


def load_data_sets(wh: Warehouse, responses: DataFrame) -> None:
    decoded, staged = wh.stage(decode(responses, "dataset"))
    try:
        wh.merge("datasets", payloads.data_sets(decoded), condition=newer, order=["lastupdated", "seq"])
        require_successes(_request_log(decoded))
    finally:
        wh.delete(staged)


def load_combos(wh: Warehouse, responses: DataFrame, combo_type: str) -> None:
    """Combos, categories and options of one type, and the links between them."""
    decoded, staged = wh.stage(decode(responses, "combo"))
    found = payloads.category_combos(decoded, combo_type)
    for table in ("categorycombos", "categories", "categoryoptions"):
        wh.merge(table, found[table])
    for links, owner, key in (
        ("categorycombo_categories", "categorycombos", "categorycombo_id"),
        ("category_categoryoptions", "categories", "category_id"),
    ):
        if not found[links].isEmpty():
            owners = combo_owners(wh.read(owner), combo_type, key)
            _refresh_links(wh, links, found[links], owners)
    wh.delete(staged)


def load_option_combos(wh: Warehouse, responses: DataFrame, combo_type: str) -> None:
    """Option combos of one type and their options. Missing pages are tolerated."""
    decoded, staged = wh.stage(decode(responses, "optioncombos"))
    found = payloads.option_combos(decoded)
    wh.merge("categoryoptioncombos", found["categoryoptioncombos"])
    links = "categoryoptioncombo_options"
    if not found[links].isEmpty():
        owners = option_combo_owners(
            wh.read("categoryoptioncombos"), wh.read("categorycombos"), combo_type,
            "categoryoptioncombo_id",
        )
        _refresh_links(wh, links, found[links], owners)
    wh.delete(staged)


def _refresh_links(wh: Warehouse, table: str, found: DataFrame, owners: DataFrame) -> None:
    """Replace the links of the owners in the sources found; other sources keep theirs."""
    sources = found.select("datasource_id").distinct()
    mine = owners.join(sources, "datasource_id", "left_semi").select(*owners.columns)
    wh.replace(table, replace_links(wh.read(table), found, mine))


def build_dimensions(wh: Warehouse, source: str, combo_type: str, as_of: dt.datetime) -> None:
    """Write {source}_categories or {source}_attributes and refresh the name map."""
    table, name_map = DIMENSIONS[combo_type]
    built = build_dimension(
        wh.read("categoryoptioncombos", source),
        wh.read("categoryoptioncombo_options", source),
        wh.read("categoryoptions", source),
        wh.read("category_categoryoptions", source),
        wh.read("categories", source),
        combo_type, source, as_of,
    )
    if built is not None:
        dimension, names = built
        wh.merge(name_map, names)
        wh.replace(f"{source}_{table}", dimension)


def load_org_units(wh: Warehouse, responses: DataFrame) -> None:
    """Replace the staged units and data set assignments of the sources in the crawl.

    A missing page stops the load; a crawl without units changes nothing.
    """
    decoded, staged = wh.stage(decode(responses, "orgunits"))
    check_pages(decoded, strict=True)
    units = keep_last(payloads.org_units(decoded), TABLES["stg_orgunits"].keys, ["seq"]).drop("seq")
    if not units.isEmpty():
        sources = units.select("datasource_id").distinct()
        assigned = payloads.org_unit_assignments(decoded, wh.read("datasets"))
        for table, fresh in (("stg_orgunits", units), ("dataset_orgunits", assigned)):
            others = wh.read(table).join(sources, "datasource_id", "left_anti")
            wh.replace(table, others.unionByName(fresh).select(*wh.read(table).columns))
    wh.delete(staged)


def build_hierarchy(
    wh: Warehouse, source: str, roots: list[str] | None = None, refresh_all: bool = False
) -> None:
    """Flatten the staged units of a source and merge them into the warehouse."""
    flat = flatten(wh.read("stg_orgunits", source), roots)
    wh.merge("orgunits", flat, refreshed=ORGUNIT_REFRESH_ALL if refresh_all else None)


def seed_sources(
    wh: Warehouse, sources: list[tuple[str, str, str, str]], as_of: dt.datetime
) -> None:
    """Register sources given as (id, title, url, description); known ids stay as they are."""
    rows = wh.spark.createDataFrame(sources, "id string, title string, url string, description string")
    wh.merge("datasource", rows.withColumn("lastupdated", moment(as_of).cast("timestamp")), refreshed=())

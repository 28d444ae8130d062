"""Payload schemas, warehouse table schemas, keys and the columns each merge refreshes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values: names and limits of the JSON API and the warehouse tables ---

COMBO_TYPES = ("category", "attribute")
LEVELS = range(1, 9)

# Columns every landed response row carries: one row per request that was answered or failed.
ENVELOPE = """
    request_id string, source string, orgunit string, page int,
    status string, fetched_at timestamp_ntz, body string, responses int
"""

_REF = "struct<id: string>"
_NAMED = "struct<id: string, name: string>"
_ENTITY = "id: string, name: string, code: string, shortName: string, created: string, lastUpdated: string"

PAYLOADS = {
    "values": """
        dataValues array<struct<orgUnit: string, dataElement: string, period: string,
            categoryOptionCombo: string, attributeOptionCombo: string, value: string,
            comment: string, storedBy: string, created: string, lastUpdated: string,
            followUp: boolean, deleted: boolean>>
    """,
    "grid": "rows array<array<string>>",
    "periods": """
        metaData struct<items: map<string,
            struct<name: string, startDate: string, endDate: string>>>
    """,
    "completeness": """
        completeDataSetRegistrations array<struct<dataSet: string, organisationUnit: string,
            period: string, attributeOptionCombo: string, storedBy: string, date: string,
            lastUpdated: string, completed: boolean>>
    """,
    "orgunits": f"""
        pager struct<page: int, pageCount: int>,
        organisationUnits array<struct<id: string, code: string, name: string,
            shortName: string, leaf: string, parent: {_REF}, path: string, level: int,
            openingDate: string, closedDate: string, lastUpdated: string,
            dataSets: array<{_REF}>>>
    """,
    "dataelement": f"""
        id string, code string, name string, shortName string, displayName string,
        formName string, description string, valueType string, domainType string,
        aggregationType string, zeroIsSignificant string, categoryCombo {_NAMED},
        optionSet {_NAMED},
        dataSetElements array<struct<categoryCombo: {_NAMED}, dataSet: {_NAMED}>>,
        created string, lastUpdated string, href string
    """,
    "dataset": f"""
        id string, code string, name string, shortName string, displayName string,
        description string, periodType string, categoryCombo {_NAMED},
        created string, lastUpdated string, href string
    """,
    "combo": f"""
        id string, name string, code string, shortName string, created string,
        lastUpdated string,
        categories array<struct<{_ENTITY}, categoryOptions: array<struct<{_ENTITY}>>>>
    """,
    "optioncombos": f"""
        pager struct<page: int, pageCount: int>,
        categoryOptionCombos array<struct<id: string, name: string, code: string,
            created: string, lastUpdated: string, categoryCombo: {_REF},
            categoryOptions: array<{_REF}>>>
    """,
}


@dataclass(frozen=True)
class Table:
    """One warehouse table: its columns, primary key and merge rule."""

    ddl: str
    keys: tuple[str, ...]
    # Columns a matching row takes from the new data; the others keep their old value.
    refreshed: tuple[str, ...] = ()
    # Tables with partitions are merged partition by partition instead of as a whole.
    partitions: tuple[str, ...] = ()
    # Whose rows stay together where a warehouse splits its partitions into buckets.
    unit: str | None = None
    sort: tuple[str, ...] = ()
    limits: dict[str, int] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


_LEVEL_COLUMNS = ", ".join(f"oulevel{i}id string, oulevel{i}name string" for i in LEVELS)
_STAGED_ENTITY = Table(
    """id string, combo_type string, name string, code string, shortname string,
    created timestamp_ntz, lastupdated timestamp_ntz, _fetchedat timestamp_ntz,
    datasource_id string""",
    keys=("id", "combo_type", "datasource_id"),
    refreshed=("name", "code", "shortname", "lastupdated", "_fetchedat"),
    limits={"id": 50, "combo_type": 20},
)


def _bridge(left: str, right: str) -> Table:
    return Table(
        f"{left} string, {right} string, _fetchedat timestamp_ntz, datasource_id string",
        keys=(left, right, "datasource_id"),
        refreshed=("_fetchedat",),
        limits={left: 50, right: 50},
    )


def _name_map() -> Table:
    return Table(
        "original_name string, safe_name string, _builtat timestamp_ntz, datasource_id string",
        keys=("original_name", "datasource_id"),
        refreshed=("safe_name", "_builtat"),
    )


# Sources share the tables: a datasource_id column (a partition column for the facts)
# takes the place of one copy of a table per source.
TABLES = {
    "datasource": Table(
        "id string, title string, url string, description string, lastupdated timestamp",
        keys=("id",),
    ),
    "orgunits": Table(
        f"""id string, code string, name string, shortname string, parentid string,
        oupath string, level int, openingdate date, closeddate date,
        lastupdated timestamp_ntz, _fetchedat timestamp_ntz, leaf boolean,
        dv_downloadedat date, dc_downloadedat date, rr_downloadedat date,
        {_LEVEL_COLUMNS}, datasource_id string""",
        keys=("id", "datasource_id"),
        refreshed=("code", "name", "oupath", "level", "lastupdated")
        + tuple(f"oulevel{i}name" for i in LEVELS),
        limits={"id": 50, "parentid": 50, **{f"oulevel{i}id": 50 for i in LEVELS}},
    ),
    "dataelements": Table(
        """id string, code string, name string, shortname string, displayname string,
        formname string, description string, valuetype string, domaintype string,
        aggregationtype string, zeroissignificant boolean, categorycombo_id string,
        categorycombo_name string, optionset_id string, optionset_name string,
        created timestamp_ntz, lastupdated timestamp_ntz, href string,
        _fetchedat timestamp_ntz, datasource_id string""",
        keys=("id", "datasource_id"),
        refreshed=(
            "code", "name", "shortname", "displayname", "formname", "description", "valuetype",
            "domaintype", "aggregationtype", "zeroissignificant", "categorycombo_id",
            "categorycombo_name", "optionset_id", "optionset_name", "lastupdated", "href",
            "_fetchedat",
        ),
        limits={"id": 50},
    ),
    "datasets": Table(
        """id string, code string, name string, shortname string, displayname string,
        description string, periodtype string, categorycombo_id string,
        categorycombo_name string, created timestamp_ntz, lastupdated timestamp_ntz,
        href string, _fetchedat timestamp_ntz, datasource_id string""",
        keys=("id", "datasource_id"),
        refreshed=(
            "code", "name", "shortname", "displayname", "description", "periodtype",
            "categorycombo_id", "categorycombo_name", "lastupdated", "href", "_fetchedat",
        ),
        limits={"id": 50, "periodtype": 50, "categorycombo_id": 11},
    ),
    "datavalues": Table(
        """orgunit string, dataelement string, categoryoptioncombo string,
        attributeoptioncombo string, value_string string, value_double double,
        comment string, storedby string, created timestamp_ntz, lastupdated timestamp_ntz,
        followup boolean, deleted boolean, _ingestedat timestamp_ntz,
        datasource_id string, period string""",
        keys=("orgunit", "dataelement", "period", "categoryoptioncombo",
              "attributeoptioncombo", "datasource_id"),
        refreshed=("value_string", "value_double", "lastupdated", "deleted"),
        partitions=("datasource_id", "period"),
        unit="orgunit",
        sort=("dataelement", "orgunit"),
        limits={"orgunit": 50, "dataelement": 50, "period": 50, "categoryoptioncombo": 50,
                "attributeoptioncombo": 50},
    ),
    "dataset_completeness": Table(
        """dataset_id string, orgunit_id string, attributeoptioncombo string,
        storedby string, date_submitted timestamp_ntz, lastupdated timestamp_ntz,
        completed boolean, _ingestedat timestamp_ntz, datasource_id string, period string""",
        keys=("dataset_id", "orgunit_id", "period", "attributeoptioncombo", "datasource_id"),
        refreshed=("date_submitted", "lastupdated", "completed"),
        partitions=("datasource_id", "period"),
        unit="orgunit_id",
        sort=("dataset_id", "orgunit_id"),
        limits={"dataset_id": 50, "orgunit_id": 50, "period": 50, "attributeoptioncombo": 50},
    ),
    "reporting_rates": Table(
        """dataset_id string, orgunit_id string, expected_reports double,
        actual_reports double, actual_reports_on_time double, _ingestedat timestamp_ntz,
        datasource_id string, period string""",
        keys=("dataset_id", "orgunit_id", "period", "datasource_id"),
        refreshed=("expected_reports", "actual_reports", "actual_reports_on_time",
                   "_ingestedat"),
        partitions=("datasource_id", "period"),
        unit="orgunit_id",
        sort=("dataset_id", "orgunit_id"),
        limits={"dataset_id": 50, "orgunit_id": 50, "period": 50},
    ),
    "periods": Table(
        """id string, start_date date, end_date date, period_name string,
        _fetchedat timestamp_ntz, datasource_id string""",
        keys=("id", "datasource_id"),
        refreshed=("start_date", "end_date", "period_name"),
        limits={"id": 50},
    ),
    "stg_orgunits": Table(
        """id string, code string, name string, shortname string, leaf boolean,
        parentid string, path string, level int, openingdate date, closeddate date,
        lastupdated timestamp_ntz, _fetchedat timestamp_ntz, datasource_id string""",
        keys=("id", "datasource_id"),
        limits={"id": 50, "parentid": 50},
    ),
    "categorycombos": _STAGED_ENTITY,
    "categories": _STAGED_ENTITY,
    "categoryoptions": _STAGED_ENTITY,
    "categoryoptioncombos": Table(
        """id string, name string, code string, categorycombo_id string,
        created timestamp_ntz, lastupdated timestamp_ntz, _fetchedat timestamp_ntz,
        datasource_id string""",
        keys=("id", "datasource_id"),
        refreshed=("name", "code", "categorycombo_id", "lastupdated", "_fetchedat"),
        limits={"id": 50, "categorycombo_id": 50},
    ),
    "categorycombo_categories": _bridge("categorycombo_id", "category_id"),
    "category_categoryoptions": _bridge("category_id", "categoryoption_id"),
    "categoryoptioncombo_options": _bridge("categoryoptioncombo_id", "categoryoption_id"),
    "dataset_orgunits": _bridge("dataset_id", "orgunit_id"),
    "dataset_dataelements": _bridge("dataset_id", "dataelement_id"),
    "category_name_map": _name_map(),
    "attribute_name_map": _name_map(),
}

WATERMARKS = {
    "datavalues": "dv_downloadedat",
    "dataset_completeness": "dc_downloadedat",
    "reporting_rates": "rr_downloadedat",
}

# Every org-unit column but the keys and watermarks, for a full refresh.
ORGUNIT_REFRESH_ALL = TABLES["orgunits"].refreshed + (
    "shortname", "parentid", "openingdate", "closeddate", "_fetchedat", "leaf",
    *(f"oulevel{i}id" for i in LEVELS),
)

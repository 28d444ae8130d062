"""What to fetch next: work lists per org unit, and the requests they turn into."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.functions.calendar import ethiopian_date
from careledger.functions.periods import ALL_TYPE_SETS, type_bit
from careledger.functions.text import flag, split_ids
from careledger.operators.hierarchy import within
from careledger.operators.nested import unnest
from careledger.operators.numbering import batch_rows, chunks
from careledger.operators.periods import typed_periods
from careledger.operators.watermarks import stale

# How much one request may ask for, and how far back plans look.
UNITS_PER_BATCH = 7
GRID_DATASETS, GRID_PERIODS = 10, 20
REGISTRATION_DATASETS, REGISTRATION_PERIODS = 15, 80
PERIODS_PER_REQUEST = 30
LOOK_BACK_DAYS = 120
GRID_METRICS = ("EXPECTED_REPORTS", "ACTUAL_REPORTS", "ACTUAL_REPORTS_ON_TIME")


def value_work(
    orgunits: DataFrame, source: str, default_start: str, as_of: dt.datetime,
    full: bool | str = False, ethiopian: bool = False, dated: bool = False,
) -> DataFrame:
    """(orgunit, since) for the leaf units whose values are due.

    A full run takes every leaf from the default start. An Ethiopian since, which a request
    needs, is no date to compare with: with dated, since_date has the Gregorian one.
    """
    full = flag(full)
    leaves = orgunits.filter((F.col("datasource_id") == source) & F.col("leaf"))
    since: Column = F.lit(default_start)
    if not full:
        leaves = leaves.filter(stale("dv_downloadedat", as_of))
        since = F.coalesce(F.col("dv_downloadedat").cast("string"), since)
    since = F.substring(since, 1, 10)
    dates = [since.try_cast("date").alias("since_date")] if dated else []
    return leaves.select(
        F.col("id").alias("orgunit"), (ethiopian_date(since) if ethiopian else since).alias("since"), *dates
    )


def value_requests(work: DataFrame, elements: list[str]) -> DataFrame:
    """One request per unit for all tracked data elements."""
    return work.select("orgunit", F.lit(",".join(elements)).alias("dataelement"), "since")


def changed_values(
    values: DataFrame, work: DataFrame, elements: DataFrame | None = None
) -> DataFrame:
    """Landed values of the units at work that changed since their watermark,
    limited to tracked data elements (a frame with an id column)."""
    since = F.col("since_date") if "since_date" in work.columns else F.col("since").try_cast("date")
    due = work.select("orgunit", since.cast("timestamp_ntz").alias("__since"))
    changed = values.join(due, "orgunit").filter(F.col("lastupdated") >= F.col("__since"))
    if elements is not None:
        tracked = elements.select(F.col("id").alias("dataelement"))
        changed = changed.join(tracked, "dataelement", "left_semi")
    return changed.select(*values.columns)


def reporting_work(
    orgunits: DataFrame, assignments: DataFrame, datasets: DataFrame, periods: DataFrame,
    source: str, as_of: dt.datetime, full: bool = False,
    roots: list[str] | DataFrame | None = None,
) -> DataFrame:
    """(orgunit, datasets, periods) for the units whose reporting rates are due."""
    due = orgunits.filter((F.col("datasource_id") == source) & stale("rr_downloadedat", as_of))
    return _work_lists(due, assignments, datasets, periods, source, as_of, full, roots)


def completeness_work(
    orgunits: DataFrame, assignments: DataFrame, datasets: DataFrame, periods: DataFrame,
    source: str, as_of: dt.datetime, full: bool = False,
    roots: list[str] | DataFrame | None = None, match_source: bool = False,
) -> DataFrame:
    """(orgunit, datasets, periods) for the units whose registrations are due.

    Unless match_source is set, a unit with the same id in another source counts too.
    """
    due = orgunits.filter(stale("dc_downloadedat", as_of))
    if match_source:
        due = due.filter(F.col("datasource_id") == source)
    return _work_lists(due, assignments, datasets, periods, source, as_of, full, roots)


def _work_lists(
    due: DataFrame, assignments: DataFrame, datasets: DataFrame, periods: DataFrame,
    source: str, as_of: dt.datetime, full: bool, roots: list[str] | DataFrame | None,
) -> DataFrame:
    """Distinct data sets and periods per unit.

    Data sets and periods meet by period type only, so the unit x data set x period rows
    are never made: a unit keeps the set of its types, and each possible set of types has
    its period list worked out once.
    """
    if roots is not None:
        due = within(due, roots)
    if not flag(full):
        first = as_of.date() - dt.timedelta(days=LOOK_BACK_DAYS)
        periods = periods.filter(F.col("start_date") >= F.lit(first))
    typed = typed_periods(periods)
    sets = (
        datasets.filter(F.col("datasource_id") == source)
        .join(typed.select("periodtype").distinct(), "periodtype", "left_semi")
        .select(F.col("id").alias("dataset_id"), type_bit(F.col("periodtype")).alias("bit"))
    )
    units = due.select(F.col("id").alias("orgunit_id"))
    per_unit = (
        assignments.select("dataset_id", "orgunit_id")
        .join(units, "orgunit_id", "left_semi")
        .join(sets, "dataset_id")
        .groupBy(F.col("orgunit_id").alias("orgunit"))
        .agg(
            F.sort_array(F.collect_set("dataset_id")).alias("datasets"),
            F.bit_or("bit").alias("types"),
        )
    )
    # 31 rows at most, whatever the estimate says.
    return per_unit.join(F.broadcast(_period_lists(typed)), "types").select("orgunit", "datasets", "periods")


def _period_lists(typed: DataFrame) -> DataFrame:
    """The sorted period list of every set of period types: 31 rows at most."""
    every = F.array(*[F.lit(types) for types in ALL_TYPE_SETS])
    holding = F.filter(every, lambda types: types.bitwiseAND(type_bit(F.col("periodtype"))) != 0)
    return (
        typed.select("id", F.explode(holding).alias("types"))
        .groupBy("types")
        .agg(F.sort_array(F.collect_set("id")).alias("periods"))
    )


def reporting_requests(work: DataFrame, batch_size: int = UNITS_PER_BATCH) -> DataFrame:
    """One row per grid request: dx, ou and pe lists joined by semicolons.

    A batch asks for all its units, the union of their data sets and the union of their
    periods, so a unit may be asked about data sets it has not been assigned. Batching reads
    the work list twice: write a large one out first.
    """

    def union(lists: str) -> Column:
        return F.sort_array(F.array_distinct(F.flatten(F.collect_list(lists))))

    batches = (
        batch_rows(work, "orgunit", batch_size)
        .groupBy("batch")
        .agg(
            F.array_join(F.sort_array(F.collect_list("orgunit")), ";").alias("ou"),
            union("datasets").alias("datasets"),
            union("periods").alias("periods"),
        )
    )
    def metrics(dataset: Column) -> Column:
        return F.array(*[F.concat(dataset, F.lit(f".{m}")) for m in GRID_METRICS])

    return _requests(
        batches.select(
            "batch", "ou",
            _joined_chunks("datasets", GRID_DATASETS, ";", lambda ds: F.flatten(F.transform(ds, metrics))).alias("dx"),
            _joined_chunks("periods", GRID_PERIODS, ";").alias("pe"),
        ),
        "dx", "pe",
    )


def completeness_requests(work: DataFrame) -> DataFrame:
    """One row per registration request of one unit: data set and period lists."""
    return _requests(
        work.select(
            "orgunit",
            _joined_chunks("datasets", REGISTRATION_DATASETS, ",").alias("dataset"),
            _joined_chunks("periods", REGISTRATION_PERIODS, ",").alias("period"),
        ),
        "dataset", "period",
    )


def _joined_chunks(
    ids: str, size: int, separator: str, spell: Callable[[Column], Column] = lambda chunk: chunk
) -> Column:
    """The chunks of an id array, each joined to one request parameter."""
    return F.transform(chunks(F.col(ids), size), lambda c: F.array_join(spell(c), separator))


def _requests(work: DataFrame, first: str, second: str) -> DataFrame:
    """Every text of one array column with every text of the other, row by row."""
    return unnest(
        unnest(work.withColumnsRenamed({first: "__first", second: "__second"}), "__first", first),
        "__second", second,
    ).drop("__first", "__second")


def period_requests(missing: DataFrame) -> DataFrame:
    """Missing period ids in groups of thirty, joined by semicolons."""
    return (
        batch_rows(missing.select("id"), "id", PERIODS_PER_REQUEST)
        .groupBy("batch")
        .agg(F.array_join(F.sort_array(F.collect_list("id")), ";").alias("pe"))
    )


def category_combo_ids(elements: DataFrame, source: str | None = None) -> DataFrame:
    """Distinct combo ids named in the comma lists of data elements, of all sources
    unless one is given."""
    if source is not None:
        elements = elements.filter(F.col("datasource_id") == source)
    return elements.select(F.explode(split_ids(F.col("categorycombo_id"))).alias("id")).distinct()


def attribute_combo_ids(datasets: DataFrame, source: str | None = None) -> DataFrame:
    """Distinct combo ids of data sets, of all sources unless one is given."""
    if source is not None:
        datasets = datasets.filter(F.col("datasource_id") == source)
    ids = datasets.select(F.col("categorycombo_id").alias("id"))
    return ids.filter(F.col("id") != "").distinct()

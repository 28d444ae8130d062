"""The two runs of the warehouse, in the order their parts depend on each other."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from careledger.operators.periods import missing_periods
from careledger.plans import facts, metadata, work
from careledger.sources.warehouse import Warehouse

# What each source is set up to load.
ETHIOPIAN_CALENDAR = {"hmis": True, "phem": False}
LOADS_COMPLETENESS = {"hmis": True, "phem": False}


def metadata_run(
    wh: Warehouse, landed: Mapping[str, DataFrame], source: str, as_of: dt.datetime,
    roots: list[str] | None = None,
) -> None:
    """Data elements, data sets, both combo branches, org units, hierarchy."""
    metadata.load_data_elements(wh, landed["dataelement"])
    metadata.load_data_sets(wh, landed["dataset"])
    for combo_type in metadata.DIMENSIONS:
        if f"{combo_type}_combo" in landed:
            metadata.load_combos(wh, landed[f"{combo_type}_combo"], combo_type)
            metadata.load_option_combos(wh, landed[f"{combo_type}_optioncombos"], combo_type)
            metadata.build_dimensions(wh, source, combo_type, as_of)
    metadata.load_org_units(wh, landed["orgunits"])
    metadata.build_hierarchy(wh, source, roots)


def data_run(
    wh: Warehouse, landed: Mapping[str, DataFrame], source: str, as_of: dt.datetime,
    rebuild_completeness: bool = False, rebuild_rates: bool = False,
) -> None:
    """Values, periods, ghost clean-up, then completeness (where set up) and rates."""
    facts.load_values(wh, landed["values"], as_of)
    facts.load_periods(wh, landed["periods"], source)
    facts.clean_ghosts(wh, source)
    if LOADS_COMPLETENESS.get(source, True):
        facts.prepare_rebuild(wh, "dataset_completeness", source, rebuild_completeness)
        facts.load_completeness(wh, landed["completeness"], as_of)
    facts.prepare_rebuild(wh, "reporting_rates", source, rebuild_rates)
    facts.load_rates(wh, landed["grid"], as_of)


def plan_requests(
    wh: Warehouse, source: str, elements: list[str], default_start: str, as_of: dt.datetime,
    roots: list[str] | None = None, full_values: bool = False,
    full_completeness: bool = False, full_rates: bool = False,
) -> dict[str, DataFrame]:
    """The requests due now, by kind of response.

    The work list of the rates is written to the shared folder, because batching reads it
    twice; it has to stay there as long as the requests are in use.
    """
    units = wh.read("orgunits")
    plan_inputs = (
        units, wh.read("dataset_orgunits", source), wh.read("datasets"), wh.read("periods", source),
        source, as_of,
    )
    rates, _ = wh.stage(work.reporting_work(*plan_inputs, full=full_rates, roots=roots))
    requests = {
        "values": work.value_requests(
            work.value_work(units, source, default_start, as_of, full_values,
                            ETHIOPIAN_CALENDAR.get(source, False)),
            elements,
        ),
        "periods": work.period_requests(
            missing_periods(wh.periods_of("datavalues", source), wh.read("periods", source))
        ),
        "grid": work.reporting_requests(rates),
    }
    if LOADS_COMPLETENESS.get(source, True):
        requests["completeness"] = work.completeness_requests(
            work.completeness_work(*plan_inputs, full=full_completeness, roots=roots)
        )
    return requests

"""Loading facts: values, reporting rates, completeness and periods.

Each job takes landed responses, merges what is fine and moves the watermark of the
units whose requests all succeeded. A request with a failed or missing response or an
unreadable row adds nothing and moves nothing; its answers are kept, and count again
when a later load brings the rest or a retry.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.functions.text import flag
from careledger.operators.ghosts import ghost_counts, split_ghosts
from careledger.operators.periods import missing_periods
from careledger.operators.rates import pivot_rates
from careledger.operators.watermarks import advance, finished_units, reset, settled_requests
from careledger.schemas import TABLES, WATERMARKS
from careledger.sources import payloads
from careledger.sources.landing import decode, latest_answers
from careledger.sources.warehouse import Warehouse

Counts = dict[str, int]


def load_values(wh: Warehouse, responses: DataFrame, as_of: dt.datetime) -> Counts:
    """Of several values of one key in a load, the one updated last counts."""
    return _load(wh, responses, "values", "datavalues", as_of, payloads.data_values, ["lastupdated", "seq"])


def load_completeness(wh: Warehouse, responses: DataFrame, as_of: dt.datetime) -> Counts:
    return _load(wh, responses, "completeness", "dataset_completeness", as_of, payloads.completeness, ["seq"])


def load_rates(wh: Warehouse, responses: DataFrame, as_of: dt.datetime) -> Counts:
    return _load(wh, responses, "grid", "reporting_rates", as_of, payloads.grid_rows, None, pivot_rates)


def _load(
    wh: Warehouse, responses: DataFrame, kind: str, table: str, as_of: dt.datetime,
    parse: Callable[[DataFrame], DataFrame], order: list[str] | None,
    shape: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> Counts:
    folders = []

    def stage(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
        staged, folder, found = wh.stage_counted(df, **measures)
        folders.append(folder)
        return staged, found

    try:
        # Bodies are parsed once, as they come, and kept beside what they say for requests that must wait.
        answers, waiting = _answers(wh, kind, table, responses, stage)
        rows = parse(answers)
        bad = F.lit(False) if "usable" not in rows.columns else ~F.col("usable")
        for key in TABLES[table].keys:
            bad = bad | F.col(key).isNull()
        for column in TABLES[table].partitions:
            if column in rows.columns:
                bad = bad | (F.col(column) == "")
        settled, tally = stage(
            settled_requests(answers, rows.filter(bad)), requests=F.count("*"), failed=F.count_if(~F.col("ok")),
        )
        merged = wh.merge(table, shape(rows.join(settled.filter("ok"), "request_id", "left_semi")), order=order)
        done = finished_units(answers, settled)
        wh.update("orgunits", lambda units: advance(units, done, WATERMARKS[table], as_of.date()))
        _keep_pending(wh, table, answers, settled, waiting, tally["failed"])
        return {"rows": merged, **tally}
    finally:
        for folder in folders:
            wh.delete(folder)


def _answers(
    wh: Warehouse, kind: str, table: str, responses: DataFrame, stage: Callable[..., tuple[DataFrame, dict]],
) -> tuple[DataFrame, DataFrame | None]:
    """The last answer of each page, decoded and with its body, of these responses and of earlier ones of the
    same requests; and the kept answers of all other requests."""
    if "responses" not in responses.columns:
        responses = responses.withColumn("responses", F.lit(None).cast("int"))
    decoded, _ = stage(decode(responses, kind, keep_body=True))
    if not wh.exists(f"pending_{table}"):
        return latest_answers(decoded), None
    pending = wh.read(f"pending_{table}")
    now = decoded.select("request_id").distinct()
    earlier = pending.join(now, "request_id", "left_semi").select(*responses.columns)
    again, found = stage(decode(earlier, kind, keep_body=True), rows=F.count("*"))
    if not found["rows"]:
        return latest_answers(decoded), pending.select(*responses.columns)
    waiting = pending.join(now, "request_id", "left_anti").select(*responses.columns)
    return stage(latest_answers(decoded.unionByName(again)))[0], waiting


def _keep_pending(
    wh: Warehouse, table: str, answers: DataFrame, settled: DataFrame, waiting: DataFrame | None, failed: int,
) -> None:
    """Keep the answers of requests that are not fine yet."""
    if waiting is None and not failed:
        return
    unsettled = settled.filter("NOT ok AND request_id IS NOT NULL").select("request_id")
    kept = answers.join(unsettled, "request_id", "left_semi").drop("payload", "failed")
    wh.replace(f"pending_{table}", kept if waiting is None else waiting.unionByName(kept))


def load_periods_of(source: str) -> Callable[[Warehouse, DataFrame, dt.datetime], None]:
    """load_periods for one source, in the form that load_new takes."""

    def load(wh: Warehouse, responses: DataFrame, as_of: dt.datetime) -> None:
        load_periods(wh, responses, source)

    load.__name__ = f"load_periods_{source}"
    return load


def load_periods(wh: Warehouse, responses: DataFrame, source: str) -> None:
    """Dates of the periods the values of a source use and the warehouse does not know."""
    wanted = missing_periods(wh.periods_of("datavalues", source), wh.read("periods", source))
    found = payloads.periods(decode(responses, "periods"), wanted)
    wh.merge("periods", found, order=["seq"])


def clean_ghosts(
    wh: Warehouse, source: str, split_combos: bool = False, guard_empty: bool = False
) -> None:
    """Delete the values of a source that no element and option combo allow.

    Only partitions with a ghost in them are written again. Without metadata every value
    is a ghost; guard_empty leaves the values alone in that case.
    """
    elements, combos = wh.read("dataelements"), wh.read("categoryoptioncombos", source)
    if guard_empty and (elements.isEmpty() or combos.isEmpty()):
        return
    columns = wh.partition_columns("datavalues")
    counts = ghost_counts(wh.placed("datavalues", source), elements, combos, columns, split_combos)
    haunted, staged, found = wh.stage_counted(counts, partitions=F.count("*"))
    if found["partitions"]:
        # Only the partitions with a ghost are read whole and written again.
        kept, _ = split_ghosts(wh.touched("datavalues", haunted), elements, combos, split_combos)
        wh.overwrite_partitions("datavalues", kept)
        # A partition left without rows is not part of the write above.
        wh.drop_partitions("datavalues", haunted.filter("ghosts = rows").select(*columns).collect())
    wh.delete(staged)


def prepare_rebuild(wh: Warehouse, table: str, source: str, full: bool | str) -> None:
    """Empty a fact table for a source and forget its watermark; nothing unless full, a switch that
    may be given as text."""
    if flag(full):
        wh.drop_source(table, source)
        wh.update("orgunits", lambda units: reset(units, WATERMARKS[table], source))

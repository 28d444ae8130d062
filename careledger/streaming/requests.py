"""Requests put together across micro-batches, in keyed streaming state.

A request's answers may land in any number of files and batches. Its state holds those that came
so far; when they are all there and fine, they go on together and the state is gone. What is still
incomplete after the patience is over goes on as it is, for the load to judge, with the next answers
that land. So the state is as
large as the requests on their way, and nothing that waits is read or written again by a batch
that brings nothing for it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from careledger.session import shared_dir
from careledger.sources.landing import decode, stream_landing
from careledger.sources.warehouse import Warehouse

# What state and output rows hold; fetched_at stays text in between.
_FIELDS = ("request_id", "source", "orgunit", "page", "status", "fetched_at", "body", "responses")
_DDL = ", ".join(f"{f} {'int' if f in ('page', 'responses') else 'string'}" for f in _FIELDS)


def merged(held: list[dict], fresh: list[dict]) -> list[dict]:
    """The last answer of each page, of answers of the same time a good one; those without a page all."""
    last: dict[int, dict] = {}
    loose = []
    for answer in [*held, *fresh]:
        page = answer["page"]
        if page is None:
            loose.append(answer)
        elif page not in last or _rank(answer) >= _rank(last[page]):
            last[page] = answer
    return loose + list(last.values())


def _rank(answer: dict) -> tuple[str, bool]:
    return answer["fetched_at"] or "", answer["status"] == "ok"


def complete(answers: list[dict]) -> bool:
    """Whether all answers are fine and as many as they say there should be."""
    expected = max((a["responses"] or 0 for a in answers), default=0)
    return not any(a["failed"] for a in answers) and len({a["page"] or 0 for a in answers}) >= expected


def _plain(value):
    """Nothing for what pandas shows a NULL as."""
    return None if value is None or value != value else value


def _records(part: pd.DataFrame) -> list[dict]:
    rows = [{name: _plain(value) for name, value in row.items()} for row in part.to_dict("records")]
    for row in rows:
        for name in ("page", "responses"):
            row[name] = None if row[name] is None else int(row[name])
    return rows


def _collect(patience_ms: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        answers = json.loads(state.get[0]) if state.exists else []
        for part in parts:
            answers = merged(answers, _records(part))
        if state.hasTimedOut or complete(answers):
            if state.exists:
                state.remove()
            yield pd.DataFrame({f: pd.Series([a[f] for a in answers], dtype=object) for f in _FIELDS})
        else:
            state.update((json.dumps(answers),))
            state.setTimeoutDuration(patience_ms)

    return run


def whole_requests(answers: DataFrame, kind: str, patience: dt.timedelta) -> DataFrame:
    """Of a stream of landed answers, those of requests that are complete, or whose patience is over. Answers
    without a request go on at once."""
    judged = decode(answers, kind, keep_body=True).drop("payload")
    text = F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetched_at")
    named = judged.select(*[text if f == "fetched_at" else F.col(f) for f in _FIELDS], "failed")
    state = named.filter("request_id IS NOT NULL").groupBy("request_id").applyInPandasWithState(
        _collect(int(patience.total_seconds() * 1000)), _DDL, "answers string", "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )
    out = state.unionByName(named.filter("request_id IS NULL").drop("failed"))
    return out.withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))


def load_whole(
    wh: Warehouse, landing: str, kind: str, as_of: dt.datetime, load: Callable[[Warehouse, DataFrame, dt.datetime], object],
    patience: dt.timedelta = dt.timedelta(days=2), checkpoint: str | None = None, files_per_batch: int | None = None,
) -> None:
    """Load the requests that the answers landed since the last run complete, then stop.

    kind is the kind of response; load is load_values, load_rates or load_completeness.
    """
    options = {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {}
    key = hashlib.sha256(f"{wh.root}\n{landing.rstrip('/')}\n{load.__name__}".encode()).hexdigest()[:32]
    # Requests time out by the clock, for which Spark would go on with empty batches without end.
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = wh.spark.conf.get(setting)
    wh.spark.conf.set(setting, "false")
    try:
        (
            whole_requests(stream_landing(wh.spark, landing, **options), kind, patience)
            .writeStream.foreachBatch(lambda batch, _: load(wh, batch, as_of) and None)
            .option("checkpointLocation", checkpoint or f"{shared_dir(wh.spark)}/whole/{key}")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    finally:
        wh.spark.conf.set(setting, before)

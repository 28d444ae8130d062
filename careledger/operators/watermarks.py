"""Download watermarks on org units, and the log of requests that moves them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.functions.text import moment


def stale(watermark: str, as_of: dt.datetime, days: int = 4) -> Column:
    """TRUE for a missing watermark or one set more than so many days ago.

    The watermark is a date and counts from midnight.
    """
    limit = moment(as_of - dt.timedelta(days=days))
    return F.col(watermark).isNull() | (F.col(watermark).cast("timestamp_ntz") < limit)


def settled_requests(decoded: DataFrame, rejects: DataFrame | None = None) -> DataFrame:
    """(request_id, ok): a request is fine when all its responses and rows are, and, where the
    responses say how many belong to it, all of them are there. Without an id it never is."""
    fine = F.bool_and(~F.col("failed")) & F.col("request_id").isNotNull()
    if "responses" in decoded.columns:
        expected = F.coalesce(F.max("responses"), F.lit(0))
        fine = fine & (F.count_distinct(F.coalesce("page", F.lit(0))) >= expected)
    log = decoded.groupBy("request_id").agg(fine.alias("ok"))
    if rejects is None:
        return log
    bad = rejects.select("request_id").distinct().withColumn("__bad", F.lit(True))
    return log.join(bad, "request_id", "left").select(
        "request_id", (F.col("ok") & F.col("__bad").isNull()).alias("ok")
    )


def finished_units(decoded: DataFrame, settled: DataFrame) -> DataFrame:
    """Org units every request of which is fine, with or without rows in the answers.

    settled is what settled_requests says about the same responses. A response that covers several units lists their ids separated by semicolons.
    """
    requested = decoded.select(
        "request_id", F.col("source").alias("datasource_id"), F.explode(F.split("orgunit", ";")).alias("id")
    ).distinct()
    return (
        requested.join(settled.select("request_id", "ok"), "request_id")
        .groupBy("id", "datasource_id")
        .agg(F.bool_and("ok").alias("ok"))
        .filter("ok")
        .select("id", "datasource_id")
    )


def advance(orgunits: DataFrame, finished: DataFrame, column: str, as_of: dt.date) -> DataFrame:
    """Set the watermark of finished units; other units keep theirs."""
    done = finished.select("id", "datasource_id").distinct().withColumn("__done", F.lit(True))
    moved = F.when(F.col("__done"), F.lit(as_of)).otherwise(F.col(column)).alias(column)
    return orgunits.join(done, ["id", "datasource_id"], "left").select(
        *[moved if c == column else F.col(c) for c in orgunits.columns]
    )


def reset(orgunits: DataFrame, column: str, source: str) -> DataFrame:
    """Forget one watermark for one source, so that everything is fetched again."""
    cleared = F.when(~F.col("datasource_id").eqNullSafe(source), F.col(column))
    return orgunits.withColumn(column, cleared)


def drop_source(facts: DataFrame, source: str) -> DataFrame:
    """A fact table without the rows of one source."""
    return facts.filter(~F.col("datasource_id").eqNullSafe(source))

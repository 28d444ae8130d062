"""Reporting-rate cells pivoted to one row per data set, org unit and period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger.functions.combos import metric_slot

RATES = ("expected_reports", "actual_reports", "actual_reports_on_time")


def pivot_rates(cells: DataFrame) -> DataFrame:
    """The last value of each rate by seq, 0 where a rate is missing.

    A cell of an unknown metric still makes a row.
    """
    slot = metric_slot(F.col("metric"))
    last = [
        F.coalesce(
            F.max_by(F.when(slot == rate, F.col("value")), F.when(slot == rate, F.col("seq"))),
            F.lit(0.0),
        ).alias(rate)
        for rate in RATES
    ]
    extra = [F.max("fetched_at").alias("_ingestedat")] if "fetched_at" in cells.columns else []
    return cells.groupBy("dataset_id", "orgunit_id", "period", "datasource_id").agg(*last, *extra)

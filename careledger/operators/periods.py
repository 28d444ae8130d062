"""Periods that facts use, and the periods a data set reports for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger.functions.periods import period_type


def missing_periods(values: DataFrame, periods: DataFrame) -> DataFrame:
    """Distinct periods of the values without a row in the period table."""
    used = values.select(F.col("period").alias("id")).filter(F.col("id").isNotNull()).distinct()
    return used.join(periods.select("id"), "id", "left_anti")


def typed_periods(periods: DataFrame) -> DataFrame:
    """Periods of a known type, with the type: the key that replaces a join on patterns."""
    return periods.withColumn("periodtype", period_type(F.col("id"))).filter(
        F.col("periodtype").isNotNull()
    )


def dataset_periods(datasets: DataFrame, periods: DataFrame) -> DataFrame:
    """(dataset_id, period) for every period of the type a data set reports in."""
    sets = datasets.select(F.col("id").alias("dataset_id"), "periodtype")
    return sets.join(
        typed_periods(periods).select(F.col("id").alias("period"), "periodtype"), "periodtype"
    ).select("dataset_id", "period")

"""Category combinations of a data element, and metric names of the reporting grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def merge_combos(root: Column, elements: Column) -> tuple[Column, Column]:
    """Comma lists of (ids, names) over the root combo and those of its data sets.

    Ids keep first-seen order. A combo's name is its first non-empty one; combos
    without a name are left out of the name list only.
    """
    attached = F.coalesce(
        F.transform(elements, lambda e: e["categoryCombo"]),
        F.array().cast("array<struct<id:string,name:string>>"),
    )
    seen = F.filter(F.concat(F.array(root), attached), lambda c: c["id"] != "")
    ids = F.array_distinct(F.transform(seen, lambda c: c["id"]))
    named = F.filter(seen, lambda c: c["name"] != "")
    names = F.transform(
        ids, lambda i: F.get(F.filter(named, lambda c: c["id"] == i), F.lit(0))["name"]
    )
    return F.array_join(ids, ","), F.array_join(names, ",")


def split_metric(dx: Column) -> tuple[Column, Column]:
    """(data set, metric) of 'dataset.METRIC'; both NULL unless there is exactly one dot."""
    dots = F.char_length(dx) - F.char_length(F.replace(dx, F.lit("."), F.lit("")))
    before, after = F.substring_index(dx, ".", 1), F.substring_index(dx, ".", -1)
    return F.when(dots == 1, before), F.when(dots == 1, after)


def metric_slot(metric: Column) -> Column:
    """Which of the three rates a metric name feeds; NULL for an unknown metric."""
    # Substrings of the metric names, tested in this order.
    return (
        F.when(metric.contains("EXPECTED"), F.lit("expected_reports"))
        .when(metric.contains("ACTUAL_REPORTS_ON_TIME"), F.lit("actual_reports_on_time"))
        .when(metric.contains("ACTUAL"), F.lit("actual_reports"))
    )

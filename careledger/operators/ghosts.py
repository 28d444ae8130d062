"""Values whose category option combo does not belong to their data element."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger.functions.text import split_ids


def split_ghosts(
    values: DataFrame, elements: DataFrame, option_combos: DataFrame, split_combos: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(kept, ghosts). A value stays when its element names the combo of its option combo.

    By default an element with a comma list of combos matches none of them, and elements
    of any source count; split_combos looks at the single ids of the list.

    The valid (element, option combo) pairs are never spelled out: each value looks up the
    one combo of its option combo (ids are unique there), and that combo is checked against
    its element. Both lookups are against metadata, which Spark broadcasts when it measures
    it small and joins with skew handling otherwise.
    """
    allowed, combo_of = _lookups(elements, option_combos, split_combos)
    placed = values.join(combo_of, "categoryoptioncombo", "left").select(*values.columns, "__combo")
    on = ["dataelement", "__combo"]
    kept = placed.join(allowed, on, "left_semi").select(*values.columns)
    ghosts = placed.join(allowed, on, "left_anti").select(*values.columns)
    return kept, ghosts


def ghost_counts(
    values: DataFrame, elements: DataFrame, option_combos: DataFrame, by: list[str], split_combos: bool = False
) -> DataFrame:
    """(*by, rows, ghosts) of the groups with a ghost among their values.

    Values are counted by element and option combo first, in the map tasks: the lookups see each pair of a
    group once, and nothing but these columns is read.
    """
    allowed, combo_of = _lookups(elements, option_combos, split_combos)
    pairs = values.groupBy(*by, "dataelement", "categoryoptioncombo").agg(F.count("*").alias("rows"))
    judged = pairs.join(combo_of, "categoryoptioncombo", "left").join(
        allowed.withColumn("__known", F.lit(True)), ["dataelement", "__combo"], "left"
    )
    ghosts = F.sum(F.when(F.col("__known").isNull(), F.col("rows")).otherwise(0))
    return judged.groupBy(*by).agg(F.sum("rows").alias("rows"), ghosts.alias("ghosts")).filter("ghosts > 0")


def _lookups(elements: DataFrame, option_combos: DataFrame, split_combos: bool) -> tuple[DataFrame, DataFrame]:
    """(dataelement, combo) pairs that elements allow, and the combo of each option combo."""
    combo = F.explode(split_ids(F.col("categorycombo_id"))) if split_combos else F.col("categorycombo_id")
    allowed = elements.select(F.col("id").alias("dataelement"), combo.alias("__combo")).distinct()
    combo_of = option_combos.select(
        F.col("id").alias("categoryoptioncombo"), F.col("categorycombo_id").alias("__combo")
    )
    return allowed, combo_of

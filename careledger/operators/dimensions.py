"""Category and attribute dimensions: one column per category, one row per option combo."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger.functions.names import number_clashes, safe_name
from careledger.functions.text import moment

# Columns of the dimension that no category may be named after.
RESERVED = (
    "datasource_id", "categoryoptioncombo_id", "categoryoptioncombo_name",
    "categoryoptioncombo_code", "categorycombo_id", "_builtat",
)


def safe_names(names: DataFrame, reserved: tuple[str, ...] = ()) -> dict[str, str]:
    """Original -> unique safe name for a one-column frame of names.

    Every name becomes a column, so there are as few of them as a table has columns;
    past the session's pivot limit this raises, as a pivot does.
    """
    spark = names.sparkSession
    limit = int(spark.conf.get("spark.sql.pivotMaxValues"))
    distinct = names.toDF("name").filter(F.col("name").isNotNull()).distinct()
    rows = distinct.select("name", safe_name(F.col("name")).alias("base")).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} names would become columns (spark.sql.pivotMaxValues)")
    return number_clashes({r.name: r.base for r in rows}, reserved)


def option_categories(
    options: DataFrame, category_options: DataFrame, categories: DataFrame, combo_type: str
) -> DataFrame:
    """(categoryoption_id, option name, category name) of one combo type."""
    opts = options.filter(F.col("combo_type") == combo_type).select(
        F.col("id").alias("categoryoption_id"), F.col("name").alias("opt_name")
    )
    cats = categories.filter(F.col("combo_type") == combo_type).select(
        F.col("id").alias("category_id"), F.col("name").alias("cat_name")
    )
    return (
        opts.join(category_options.select("category_id", "categoryoption_id"), "categoryoption_id")
        .join(cats, "category_id")
        .select("categoryoption_id", "opt_name", "cat_name")
    )


def build_dimension(
    option_combos: DataFrame,
    option_links: DataFrame,
    options: DataFrame,
    category_options: DataFrame,
    categories: DataFrame,
    combo_type: str,
    source: str,
    as_of: dt.datetime,
) -> tuple[DataFrame, DataFrame] | None:
    """(dimension, name map), or None when there is no named category to make a column of.

    An option that several categories share fills all of them. An option combo with only
    unnamed categories keeps its row.
    """
    spark = option_combos.sparkSession
    described = option_categories(options, category_options, categories, combo_type)
    linked = (
        option_links.select("categoryoptioncombo_id", "categoryoption_id")
        .join(described, "categoryoption_id")
        .join(option_combos.select(F.col("id").alias("categoryoptioncombo_id")), "categoryoptioncombo_id", "left_semi")
    )
    names = safe_names(linked.select("cat_name"), RESERVED)
    if not names:
        return None
    pivoted = (
        linked.groupBy("categoryoptioncombo_id")
        .pivot("cat_name", list(names))
        .agg(F.max("opt_name"))
        .toDF("categoryoptioncombo_id", *names.values())
    )
    combos = option_combos.select(
        F.lit(source).alias("datasource_id"),
        F.col("id").alias("categoryoptioncombo_id"),
        F.col("name").alias("categoryoptioncombo_name"),
        F.col("code").alias("categoryoptioncombo_code"),
        "categorycombo_id",
    )
    dimension = combos.join(pivoted, "categoryoptioncombo_id").select(
        "datasource_id", "categoryoptioncombo_id", "categoryoptioncombo_name",
        "categoryoptioncombo_code", *names.values(), "categorycombo_id",
        moment(as_of).alias("_builtat"),
    )
    name_map = spark.createDataFrame(
        list(names.items()), "original_name string, safe_name string"
    ).select(
        "*", moment(as_of).alias("_builtat"), F.lit(source).alias("datasource_id")
    )
    return dimension, name_map

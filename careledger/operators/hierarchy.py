"""Org units flattened to eight levels, and filters by sub-tree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.functions.text import path_level, touches
from careledger.schemas import LEVELS


def flatten(staged: DataFrame, roots: list[str] | DataFrame | None = None) -> DataFrame:
    """Id and name of the ancestor at each level of the path.

    A level below the unit has id '' and name NULL. Names come from the unfiltered units
    of the same source.

    Units with the same ancestors share one chain of names, and there are only as many
    chains as units with children. Names are looked up per chain, and the units meet
    their chain in one join, not in one join per level.
    """
    units = within(staged, roots, "path") if roots is not None else staged
    levels = {i: path_level(F.col("path"), i) for i in LEVELS}
    above = F.array(*[F.when(level == F.col("id"), "").otherwise(level) for level in levels.values()])
    units = units.select(
        "*",
        *[level.alias(f"oulevel{i}id") for i, level in levels.items()],
        F.when(F.col("path").isNotNull(), F.array_join(above, "/")).alias("__chain"),
    )
    steps = (
        units.select("datasource_id", "__chain").distinct()
        .select("datasource_id", "__chain", F.posexplode(F.split("__chain", "/")).alias("__pos", "__id"))
        .filter("__id <> ''")
    )
    names = staged.select(
        F.col("id").alias("__id"), "datasource_id", F.col("name").alias("__name")
    )
    chains = (
        steps.join(names, ["__id", "datasource_id"])
        .groupBy("datasource_id", "__chain")
        .agg(*[
            F.max(F.when(F.col("__pos") == i - 1, F.col("__name"))).alias(f"__name{i}") for i in LEVELS
        ])
    )

    def level_name(i: int) -> Column:
        own = F.col(f"oulevel{i}id") == F.col("id")
        return F.when(own, F.col("name")).otherwise(F.col(f"__name{i}")).alias(f"oulevel{i}name")

    return units.join(chains, ["datasource_id", "__chain"], "left").select(
        "id", "datasource_id", "code", "name", "shortname", "parentid",
        F.col("path").alias("oupath"), "level", "openingdate", "closeddate", "lastupdated",
        "_fetchedat", "leaf",
        *[c for i in LEVELS for c in (F.col(f"oulevel{i}id"), level_name(i))],
    )


def within(units: DataFrame, roots: list[str] | DataFrame, path: str = "oupath") -> DataFrame:
    """Units whose path touches a root; an empty list keeps all.

    Give the roots as a one-column DataFrame when there are many of them.
    """
    if isinstance(roots, DataFrame):
        wanted = roots.toDF("__segment")
        found = (
            units.select("id", "datasource_id", F.explode(F.split(path, "/")).alias("__segment"))
            .filter("__segment <> ''")
            .join(wanted, "__segment", "left_semi")
            .select("id", "datasource_id")
        )
        return units.join(found, ["id", "datasource_id"], "left_semi").select(*units.columns)
    return units.filter(touches(F.col(path), roots)) if roots else units


def paths_of_parents(units: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, datasource_id, path, level, problem): the path of each unit by its parent links alone.

    problem is 'cycle' where the links never reach a top (path and level are NULL then), 'orphan' where the topmost
    unit found names a parent that is not there. Ids are unique within a source.

    Every round joins each unit with the one its link points to and takes over its link, so links reach twice as far
    each time: a tree of depth d takes about log2(d) joins, whatever its width. stage writes a round out and reads
    it back, because the next one reads it twice.
    """
    known = units.select("datasource_id", F.col("id").alias("parentid")).withColumn("__there", F.lit(True))
    rows = stage(
        units.select("id", "datasource_id", "parentid").join(known, ["datasource_id", "parentid"], "left").select(
            "id", "datasource_id", F.array("id").alias("chain"),
            F.when(F.col("__there"), F.col("parentid")).alias("up"),
            F.when(F.col("parentid").isNotNull() & F.col("__there").isNull(), "orphan").alias("problem"),
        )
    )
    while not rows.filter("up IS NOT NULL").isEmpty():
        above = rows.select(
            F.col("id").alias("up"), "datasource_id", F.col("chain").alias("__chain"), F.col("up").alias("__up"),
            F.col("problem").alias("__problem"),
        )
        far = rows.join(above, ["up", "datasource_id"], "left").withColumns({
            "chain": F.when(F.col("__chain").isNull(), F.col("chain")).otherwise(F.concat("__chain", "chain")),
            "problem": F.coalesce("problem", "__problem"),
        })
        # A link into what it has already passed goes round.
        far = far.withColumn("problem", F.when(F.arrays_overlap("chain", F.array("__up")), "cycle").otherwise(F.col("problem")))
        rows = stage(far.select(
            "id", "datasource_id", F.when(F.coalesce("problem", F.lit("")) != "cycle", F.col("chain")).alias("chain"),
            F.when(F.coalesce("problem", F.lit("")) != "cycle", F.col("__up")).alias("up"), "problem",
        ))
    return rows.select(
        "id", "datasource_id", F.concat(F.lit("/"), F.array_join("chain", "/")).alias("path"),
        F.size("chain").alias("level"), "problem",
    ).withColumn("level", F.when(F.col("path").isNotNull(), F.col("level")))

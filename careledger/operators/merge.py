"""Merging new rows into a keyed table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_NEW = "__new_"


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by order, NULLs first.

    Spark cuts each key to one row inside every map task before the shuffle (the window
    group limit), so a key with very many copies does not end up in one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("__rank", F.row_number().over(ranked)).filter("__rank = 1").drop("__rank")


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    refreshed: Sequence[str],
    condition: Callable[[str, str], Column] | None = None,
    order: Sequence[str] | None = None,
    small_updates: bool = False,
) -> DataFrame:
    """Target after inserting new keys and refreshing the chosen columns of known ones.

    condition, given the prefixes of old and new columns, must also hold for a refresh.
    order names the columns that decide between several updates of one key. Columns the
    updates lack are NULL in inserted rows.

    The general plan is one full outer join, which shuffles both sides once. Set
    small_updates only after measuring that the updates fit a broadcast: then the target
    is read in place, without a shuffle.
    """
    if order is not None:
        updates = keep_last(updates, keys, order)
    given = [c for c in target.columns if c in updates.columns]
    new = updates.select(*[F.col(c).alias(_NEW + c) for c in given], F.lit(True).alias(_NEW))
    old = target.withColumn("__old", F.lit(True))
    if small_updates:
        new = F.broadcast(new)
    match = _all([F.col(k) == F.col(_NEW + k) for k in keys])
    joined = old.join(new, match, "left" if small_updates else "full")

    both = F.col("__old") & F.col(_NEW)
    if condition is not None:
        both = both & F.coalesce(condition("", _NEW), F.lit(False))

    def merged(name: str) -> Column:
        if name not in given:
            return F.col(name)
        if name in refreshed:
            return F.when(both | F.col("__old").isNull(), F.col(_NEW + name)).otherwise(F.col(name))
        return F.when(F.col("__old").isNull(), F.col(_NEW + name)).otherwise(F.col(name))

    result = joined.select(*[merged(c).alias(c) for c in target.columns])
    if not small_updates:
        return result
    known = target.select(*keys).join(F.broadcast(updates.select(*keys)), list(keys), "left_semi")
    inserted = updates.select(*given).join(known, list(keys), "left_anti")
    return result.unionByName(inserted, allowMissingColumns=True)


def upsert_newer(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], refreshed: Sequence[str],
    order: Sequence[str] | None = None, small_updates: bool = False,
) -> DataFrame:
    """Upsert that refreshes a row only when the new one has a later lastupdated,
    or the old one has none."""
    return upsert(target, updates, keys, refreshed, newer, order, small_updates)


def newer(old: str, new: str) -> Column:
    return (F.col(f"{new}lastupdated") > F.col(f"{old}lastupdated")) | F.col(
        f"{old}lastupdated"
    ).isNull()


def insert_absent(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the updates whose key it does not have; known rows stay as they are."""
    fresh = updates.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(
        fresh.select(*[c for c in target.columns if c in fresh.columns]), allowMissingColumns=True
    )


def replace_links(links: DataFrame, fresh: DataFrame, owners: DataFrame) -> DataFrame:
    """Links with those of the given owners dropped and the fresh ones added.

    The columns of owners are the link columns that say whose link it is.
    """
    kept = links.join(owners.distinct(), owners.columns, "left_anti")
    keys = [c for c in links.columns if not c.startswith("_")]
    added = fresh.select(*links.columns)
    survivors = kept.join(added.select(*keys), keys, "left_anti").select(*links.columns)
    return survivors.unionByName(added)


def combo_owners(entities: DataFrame, combo_type: str, key: str) -> DataFrame:
    """Entities of one combo type, their id under the name it has in the links."""
    return entities.filter(F.col("combo_type") == combo_type).select(
        F.col("id").alias(key), *_source_of(entities)
    )


def option_combo_owners(
    option_combos: DataFrame, combos: DataFrame, combo_type: str, key: str
) -> DataFrame:
    """Option combos whose category combo is of one type."""
    of_type = combo_owners(combos, combo_type, "categorycombo_id")
    return option_combos.join(of_type, of_type.columns, "left_semi").select(
        F.col("id").alias(key), *_source_of(option_combos)
    )


def _source_of(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == "datasource_id"]


def _all(conditions: Sequence[Column]) -> Column:
    combined = conditions[0]
    for condition in conditions[1:]:
        combined = combined & condition
    return combined

"""Dates, flags and identifiers as they arrive in JSON text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def iso_date(text: Column) -> Column:
    """The first ten characters as a date, NULL when they are none."""
    return F.substring(text, 1, 10).try_cast("date")


def iso_timestamp(text: Column) -> Column:
    """Timestamp without zone, to the second."""
    return F.substring(text, 1, 19).try_cast("timestamp_ntz")


def iso_timestamp_ms(text: Column) -> Column:
    """Timestamp without zone, to the millisecond where the text has one."""
    return F.coalesce(F.substring(text, 1, 23).try_cast("timestamp_ntz"), iso_timestamp(text))


def moment(as_of: dt.datetime) -> Column:
    """A Python time as it reads, whatever zone the driver is in."""
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def is_true(text: Column) -> Column:
    """TRUE for the text "true" in any case, FALSE for anything else and for NULL."""
    return F.coalesce(F.lower(text) == "true", F.lit(False))


def flag(value: object) -> bool:
    """A job parameter given as a bool or as text."""
    # The spellings that switch a job parameter on.
    return str(value).lower() in {"true", "1", "t", "y", "yes"}


def split_ids(text: Column) -> Column:
    """A comma list as an array of trimmed, non-blank, distinct ids."""
    trimmed = F.transform(F.split(text, ","), lambda part: F.trim(part))
    return F.array_distinct(F.filter(trimmed, lambda part: part != ""))


def path_level(path: Column, level: int) -> Column:
    """The id at a level of '/a/b/c'; '' below the deepest level, NULL for a NULL path."""
    return F.split_part(path, F.lit("/"), F.lit(level + 1))


def touches(path: Column, roots: list[str]) -> Column:
    """TRUE when a segment of the path is one of the roots; NULL for a NULL path."""
    return F.arrays_overlap(F.split(path, "/"), F.array(*[F.lit(r) for r in roots]))

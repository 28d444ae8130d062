"""Splitting one reported value into its text or its number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The number spellings that count as numeric, as in a Python float literal.
# Underscores may stand between digits; casting alone would also take 1d, 1f and 0x1p3.
# The quantifiers are possessive: they match in a loop, where others take a stack frame per group.
_DIGITS = r"[0-9]++(_[0-9]++)*+"
NUMBER = rf"\A[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?\z"
NOT_A_NUMBER = r"(?i)\A[+-]?nan\z"
INFINITE = r"(?i)\A[+-]?inf(inity)?\z"


# The characters that count as white space around a value.
WHITE_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove all white space around the text, not only blanks."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def number(stripped: Column) -> Column:
    """The stripped text as a double, NULL when it is not numeric."""
    plain = F.replace(stripped, F.lit("_"), F.lit("")).try_cast("double")
    infinite = F.when(stripped.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (
        F.when(stripped.rlike(NUMBER), plain)
        .when(stripped.rlike(NOT_A_NUMBER), F.lit(float("nan")))
        .when(stripped.rlike(INFINITE), infinite)
    )


def parse_value(text: Column) -> tuple[Column, Column]:
    """(value_string, value_double): at most one of the two is set."""
    stripped = strip(text)
    as_double = number(stripped)
    return F.when(as_double.isNull() & (stripped != ""), stripped), as_double

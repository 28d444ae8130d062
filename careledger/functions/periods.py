"""Period ids and the period type they belong to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period types and the id pattern of each. No id matches two of them.
PERIOD_TYPES = {
    "Weekly": r"\A[0-9]{4}W[0-9]{1,2}\z",
    "Monthly": r"\A[0-9]{6}\z",
    "Quarterly": r"\A[0-9]{4}Q[0-9]\z",
    "SixMonthly": r"\A[0-9]{4}S[0-9]\z",
    "Yearly": r"\A[0-9]{4}\z",
}


def period_type(period_id: Column) -> Column:
    """The type of a period id, NULL for an id of no known type."""
    return F.coalesce(
        *[F.when(period_id.rlike(pattern), F.lit(name)) for name, pattern in PERIOD_TYPES.items()]
    )


# Every non-empty set of period types as the sum of its bits.
ALL_TYPE_SETS = range(1, 2 ** len(PERIOD_TYPES))


def type_bit(period_type: Column) -> Column:
    """A bit per period type, so that a set of types is one number."""
    return F.coalesce(
        *[F.when(period_type == name, F.lit(1 << i)) for i, name in enumerate(PERIOD_TYPES)]
    )

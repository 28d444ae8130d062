"""Registered queries: every operator on the given tables, with the SQL it must agree with."""

from careledger.queries import (  # noqa: F401
    dimensions, facts, landing, loads, quality, scalars, units, work,
)
from careledger.queries.base import ORACLES, QUERIES  # noqa: F401

"""Names of categories turned into safe column names."""

from __future__ import annotations

import unicodedata
from itertools import chain, count

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Longest column name, and the name used when nothing is left.
MAX_LENGTH = 63
FALLBACK = "col"


def _strip_marks(text: str | None) -> str | None:
    if text is None:
        return None
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(c for c in decomposed if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def without_accents(names: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks. Spark has no function for it,
    so callers apply this to distinct names only."""
    return names.map(_strip_marks, na_action="ignore")


def safe_name(name: Column) -> Column:
    """A lower-case column name of letters, digits and single underscores."""
    word = F.regexp_replace(F.lower(without_accents(name)), "[^a-z0-9]+", "_")
    word = F.regexp_replace(word, "^_|_$", "")
    word = F.when(word.rlike("^[0-9]"), F.concat(F.lit("_"), word)).otherwise(word)
    return F.coalesce(F.nullif(F.substring(word, 1, MAX_LENGTH), F.lit("")), F.lit(FALLBACK))


def number_clashes(bases: dict[str, str], reserved: tuple[str, ...] = ()) -> dict[str, str]:
    """Original name -> unique safe name, adding _2, _3, ... in code-point order of the
    originals. Works on the column names of one table, a few hundred at most."""
    taken, unique = set(reserved), {}
    for original in sorted(bases):
        numbered = (f"{bases[original]}_{n}" for n in count(2))
        unique[original] = next(c for c in chain([bases[original]], numbered) if c not in taken)
        taken.add(unique[original])
    return unique

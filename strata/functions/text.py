"""String and set expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_to_set(s, sep: str = ";") -> Column:
    """Split on a literal separator into a set; NULL -> empty set."""
    parts = F.split(_c(s), re.escape(sep), -1)
    return F.coalesce(F.array_distinct(parts), F.array().cast("array<string>"))


def set_contains(arr, value) -> Column:
    """Membership flag that is never NULL (absent set counts as empty)."""
    return F.coalesce(F.array_contains(_c(arr), value), F.lit(False))


# The two worded answers of the years-of-experience field.
EXPERIENCE_WORDS = {"Less than 1 year": 0.5, "More than 50 years": 51.0}


def parse_experience(s) -> Column:
    """Map experience text to years: words above, digits parsed, else NULL."""
    s = _c(s)
    chain = None
    for word, years in EXPERIENCE_WORDS.items():
        chain = (F.when(s == word, F.lit(years)) if chain is None
                 else chain.when(s == word, F.lit(years)))
    return chain.otherwise(s.try_cast("int").cast("double"))


def column_name_fn(name: str, old: str = "_", new: str = "-") -> str:
    """Rename rule applied to every column name (``_`` -> ``-``)."""
    return name.replace(old, new)

"""Vector expressions on ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def vadd(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def vscale(a, c) -> Column:
    c = F.lit(c) if not isinstance(c, Column) else c
    return F.transform(_c(a), lambda x: x * c)


def dot(a, b) -> Column:
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)

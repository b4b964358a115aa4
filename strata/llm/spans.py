"""Spans of a text as arrays of (s, k, e): start, kind number, end (code
points, end exclusive), from SQL functions alone.

``found`` cuts a text into (gap, match) pairs in one left-to-right reading:
the pattern ``(.*?)(?:(match)|\\z)`` takes up where the last match ended, so
its matches are the pattern's leftmost non-overlapping ones, and the running
sum of the lengths gives their places.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TYPE = "array<struct<s:int,k:int,e:int,m:string>>"


def none() -> Column:
    return F.expr(f"cast(array() as {TYPE})")


def found(text: Column, pattern: str, kind: int, keep=None, hint: str | None = None) -> Column:
    """Matches of ``pattern`` (no capturing groups) as spans that carry the
    matched text ``m``.  ``keep(m)`` drops matches after they were taken.
    ``hint``: a cheaper pattern that every text with a kept match has."""
    full = F.lit(f"(?s)(.*?)(?:({pattern})|\\z)")
    pairs = F.zip_with(F.regexp_extract_all(text, full, F.lit(1)), F.regexp_extract_all(text, full, F.lit(2)),
                       lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), none().alias("out"))

    def step(acc, x):
        begin = acc["at"] + x["g"]
        end = begin + F.length(x["m"])
        ok = F.length(x["m"]) > 0
        if keep is not None:
            ok = ok & keep(x["m"])
        one = F.struct(begin.alias("s"), F.lit(kind).alias("k"), end.alias("e"), x["m"].alias("m"))
        return F.struct(end.alias("at"), F.when(ok, F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))
    return F.when(text.rlike(hint or pattern), F.aggregate(pairs, start, step, lambda acc: acc["out"])).otherwise(none())


def ordered(*spans: Column) -> Column:
    """One array, by start, then kind."""
    return F.array_sort(F.concat(*spans))


def listed(spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    labels = F.array(*[F.lit(n) for n in names])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(labels, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == kind)).cast("long")


def apart(spans: Column, taken: Column) -> Column:
    """Those ``spans`` that overlap none of ``taken``."""
    return F.filter(spans, lambda x: ~F.exists(taken, lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"])))


def replaced(text: Column, spans: Column, names: list[str]) -> Column:
    """``text`` with each span replaced by its kind in angle brackets, upper
    case; overlapping spans become one, named after the first."""
    labels = F.array(*[F.lit(f"<{n.upper()}>") for n in names])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        fresh = x["s"] >= acc["at"]
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0))),
                         F.element_at(labels, x["k"] + 1))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(fresh, piece).otherwise(acc["out"]).alias("out"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))))

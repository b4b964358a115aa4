"""k-means from oversampled starting centres, the same on any layout.

Starting centres are found by rounds of oversampling: in each, every point
is drawn with a probability in proportion to its squared distance from the
centres so far, by the hash of its key.  The candidates, a few times k, are
weighted by the points nearest to them and reduced to k.  Lloyd's rounds
follow until the cost hardly falls.  Sums are exact decimals, so neither the
draws nor the centres depend on the order in which tasks add up.
"""

from __future__ import annotations

import random
from decimal import Decimal

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import hash_unit
from strata.operators.ordering import sample_n
from strata.operators.spatial import nearest_centre

ROUNDS = 5               # of oversampling
FACTOR = 2               # candidates drawn per round, in units of k, on average
FALL = Decimal("1e-6")   # Lloyd stops when a round lowers the cost by a smaller share
MOST_ROUNDS = 200
_EXACT = "decimal(38,12)"


def _squared(a, b) -> float:
    return sum((x - y) ** 2 for x, y in zip(a, b))


def _reduced(candidates: list[tuple], weights: list[int], k: int, seed: int) -> list[tuple]:
    """k of the weighted candidates, far ones with more probability."""
    rng, chosen = random.Random(seed), []
    near = [1.0] * len(candidates)
    while len(chosen) < min(k, len(candidates)):
        mass = [w * d for w, d in zip(weights, near)]
        if not sum(mass):
            break
        i = rng.choices(range(len(candidates)), mass)[0]
        chosen.append(candidates[i])
        near = [min(d if len(chosen) > 1 else float("inf"), _squared(c, candidates[i])) for d, c in zip(near, candidates)]
    return sorted(chosen)


def starting_centres(points: DataFrame, cols: list[str], key: str, k: int, seed: int = 1) -> list[tuple]:
    """At most ``k`` distinct points; ``points`` holds no NULL coordinates."""
    found = {tuple(r[c] for c in cols) for r in sample_n(points, 1, key, seed=seed).collect()}
    for i in range(ROUNDS if found else 0):
        far = nearest_centre(points, sorted(found), cols, "_c", "_d")
        cost = far.agg(F.sum(F.col("_d").cast(_EXACT))).first()[0]
        if not cost:
            break                                       # every point is a candidate
        drawn = far.where(hash_unit(key, seed=1000 * seed + i) * float(cost) < FACTOR * k * F.col("_d"))
        found |= {tuple(r) for r in drawn.select(*cols).distinct().collect()}      # FACTOR k rows on average
    candidates = sorted(found)
    if len(candidates) <= k:
        return candidates
    n = {r["_c"]: r["count"] for r in nearest_centre(points, candidates, cols, "_c").groupBy("_c").count().collect()}
    return _reduced(candidates, [n.get(i, 0) for i in range(len(candidates))], k, seed)


def fit_centres(points: DataFrame, cols: list[str], key: str, k: int, seed: int = 1) -> tuple[list[tuple], float]:
    """(centres in ascending order, cost): ``k`` centres, or one per distinct
    point if there are fewer, and the sum of squared distances.  Points with
    a NULL or NaN coordinate are left out; without points there are none.  A
    centre that loses all its points stays where it was.
    """
    whole = F.lit(True)
    for c in cols:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    pts = points.where(whole).select(key, *[F.col(c).cast("double").alias(c) for c in cols]).persist(StorageLevel.MEMORY_AND_DISK)
    centres = starting_centres(pts, cols, key, k, seed)
    cost = None
    for _ in range(MOST_ROUNDS if centres else 0):
        near = nearest_centre(pts, centres, cols, "_c", "_d")
        sums = near.groupBy("_c").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_d").cast(_EXACT)).alias("cost"),
                                      *[F.sum(F.col(c).cast(_EXACT)).alias(c) for c in cols]).collect()    # k rows
        now = sum(r["cost"] for r in sums)
        moved = list(centres)
        for r in sums:
            moved[r["_c"]] = tuple(float(r[c] / r["n"]) for c in cols)
        done = moved == centres or (cost is not None and cost - now <= cost * FALL)
        centres, cost = sorted(moved) if not done else centres, now
        if done:
            break
    pts.unpersist()
    return sorted(centres), float(cost or 0)


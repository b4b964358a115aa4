"""Deterministic pseudo-randomness from keys.

``rand(seed)`` and ``randomSplit`` depend on how rows fall into
partitions, so results change when the cluster or the input layout
changes.  Everything repeatable in the library (samples, shuffles,
splits, folds, generated noise) is instead derived from a hash of the
row key and the seed, which gives the same answer on any partitioning
and in any engine that has ``md5``.  ``method="xxhash64"`` gives the same
guarantees within Spark for a fraction of the CPU (no string work), but
other engines cannot reproduce it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = float(2 ** 52)


def _key_string(cols, seed) -> Column:
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
             for c in cols]
    return F.concat_ws(":", *parts, F.lit(str(seed)))


def _xx(cols, seed) -> Column:
    """Non-negative 52-bit xxhash64 of the key columns and the seed."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.xxhash64(*parts, F.lit(int(seed))).bitwiseAND(F.lit((1 << 52) - 1))


def hash_key(*cols, seed: int = 1, method: str = "md5") -> Column:
    """A stable random sort key: md5 hex of ``key1:key2:...:seed`` (or the
    52-bit xxhash64 with ``method="xxhash64"``)."""
    if method == "xxhash64":
        return _xx(cols, seed)
    return F.md5(_key_string(cols, seed))


def hash_unit(*cols, seed: int = 1, method: str = "md5") -> Column:
    """Uniform double in [0, 1) from 52 hash bits; ordering rows by it is
    the same as ordering by ``hash_key`` with the same method."""
    if method == "xxhash64":
        return _xx(cols, seed).cast("double") / F.lit(TWO_POW_52)
    h = F.substr(hash_key(*cols, seed=seed), F.lit(1), F.lit(13))
    return F.conv(h, 16, 10).cast("bigint").cast("double") / F.lit(TWO_POW_52)


def hash_normal(*cols, seed: int = 1) -> Column:
    """Standard normal draw per key (Box-Muller over two hash uniforms)."""
    u1 = hash_unit(*cols, seed=seed)
    u2 = hash_unit(*cols, seed=seed + 7919)
    # 1 - u1 lies in (0, 1]: the log is finite
    return F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u1)) * F.cos(F.lit(2.0 * 3.141592653589793) * u2)

"""Nearest neighbours by randomly rotated one-bit codes.

Index: a vector of length one is rotated by a fixed random orthogonal
matrix, and the signs of its coordinates are its code, ``d`` packed bits.
Two scalars correct the estimate: ``fit``, the inner product of the rotated
vector with its code (taken as a vector of +-1/sqrt(d)), and ``spread``, the
standard error that is left.

Search: a rotated query is rounded to ``PLANES`` bits per coordinate, so its
inner product with a code is a few ANDs and bit counts, and divided by
``fit`` it estimates the cosine.  A row is reranked, that is compared on the
original vectors, only if its estimate plus ``WIDE`` standard errors reaches
the k-th best cosine that the query has found so far.

Every query meets every code once: blocks of queries times stripes of the
index.  A task holds the queries of one block and reads its stripe in
batches, and the queries' thresholds rise on the way.  The work is the
number of queries times that of rows, as the search is exhaustive in codes;
no bucket is capped and no row is skipped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEED = 20
PLANES = 4               # bits per coordinate of a rotated query
WIDE = 2.5               # standard errors added to an estimate
FIRST = 32               # rows reranked to find a first threshold
QUERIES = 1 << 14        # queries of a block, about
STRIPE = 1 << 13         # rows that are worth a task of their own
_CODE = "dim int, fit double, spread double, code binary"


_rotations: dict = {}


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    if (dim, seed) not in _rotations:
        q, r = np.linalg.qr(np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((dim, dim)))
        _rotations[dim, seed] = q * np.sign(np.diag(r))
    return _rotations[dim, seed]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of flags as 64-bit words."""
    raw = np.packbits(bits, axis=1)
    out = np.zeros((len(raw), -(-raw.shape[1] // 8) * 8), np.uint8)
    out[:, :raw.shape[1]] = raw
    return out.view(np.uint64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code words, fit, spread) of the rows of a matrix."""
    d = vectors.shape[1]
    turned = (vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))) @ rotation(d).T
    fit = np.abs(turned).sum(1) / np.sqrt(d)
    spread = np.sqrt(np.maximum(1 - fit * fit, 0) / max(d - 1, 1)) / fit
    return _packed(turned >= 0), fit, spread


def usable(vector: str):
    """Neither null nor zero, and all components finite."""
    v = F.col(f"`{vector}`").cast("array<double>")
    square = F.aggregate(v, F.lit(0.0), lambda t, x: t + x * x)
    finite = F.forall(v, lambda x: F.coalesce((x == x) & (F.abs(x) < float("inf")), F.lit(False)))
    return v.isNotNull() & finite & (square > 0) & (square < float("inf"))


def _matrices(column):
    """(rows, matrix) per vector length of a list column."""
    size = column.value_lengths().to_numpy()
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        yield at, column.take(pa.array(at)).flatten().to_numpy().astype(np.float64).reshape(len(at), d)


def _index_task(batches):
    for batch in batches:
        for at, v in _matrices(batch.column("vector")):
            code, fit, spread = encode(v)
            rows = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(np.full(len(at), v.shape[1], np.int32)), pa.array(fit), pa.array(spread),
                 pa.array([c.tobytes() for c in code], pa.binary())], [*rows.schema.names, "dim", "fit", "spread", "code"])


def index(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector, dim, fit, spread, code) of every row with an id and a
    usable vector; other columns are not read.  Nothing is fitted, so rows
    can be added to a stored index at any time."""
    found = rows.where(usable(vector_col) & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector"))
    kind = found.schema["vector"].dataType.simpleString()
    return found.mapInArrow(_index_task, f"vec_id long, vector {kind}, {_CODE}")


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with a vector; sums run over the components in
    order, so equal vectors get equal scores whatever stands beside them."""
    dot, square, own = np.zeros(len(rows)), np.zeros(len(rows)), 0.0
    for k in range(len(query)):
        dot += rows[:, k] * query[k]
        square += rows[:, k] * rows[:, k]
        own += query[k] * query[k]
    return np.clip(dot / np.sqrt(square * own), -1.0, 1.0)


class _Query:
    """A query's bit planes and the k best rows it has found."""

    def __init__(self, own: int, key: int, vector: np.ndarray, k: int):
        self.own, self.key, self.vector, self.k = own, key, vector, k
        self.unit = vector / np.sqrt((vector * vector).sum())
        d = len(vector)
        turned = rotation(d) @ self.unit
        self.low, high = turned.min(), turned.max()
        self.step = max((high - self.low) / ((1 << PLANES) - 1), 1e-300)
        level = np.clip(np.rint((turned - self.low) / self.step), 0, (1 << PLANES) - 1).astype(np.uint8)
        self.planes = _packed(((level >> np.arange(PLANES, dtype=np.uint8)[:, None]) & 1).astype(bool))
        self.sum = self.low * d + self.step * level.sum()
        self.rounding = self.step * self.step / 12       # variance of <code, rounding error>
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0)

    def estimate(self, code, ones, fit):
        """Estimated cosines with the rows of these codes."""
        total = np.zeros(len(code), np.int64)
        for j, plane in enumerate(self.planes):
            total += np.bitwise_count(code & plane).sum(1, dtype=np.int64) << j
        d = len(self.vector)
        return (2 * (self.low * ones + self.step * total) - self.sum) / np.sqrt(d) / fit

    def merge(self, ids, scores):
        ids, scores = np.append(self.ids, ids), np.append(self.scores, scores)
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids, self.scores = ids[order], scores[order]

    def look(self, ids, vectors, units, code, ones, fit, spread):
        """Rerank the rows that may belong to the k nearest."""
        guess = self.estimate(code, ones, fit)
        top = guess + WIDE * np.sqrt(spread * spread + self.rounding / (fit * fit))
        other = ids != self.own
        todo = other
        if len(self.ids) < self.k and len(ids) > FIRST:  # a first threshold from the best estimates
            best = np.argpartition(-guess, FIRST)[:FIRST]
            best = best[other[best]]
            self.merge(ids[best], cosines(vectors[best], self.vector))
            todo = other.copy()
            todo[best] = False
        if len(self.ids) == self.k:
            todo = todo & (top >= self.scores[-1])
        at = np.flatnonzero(todo)
        if len(self.ids) == self.k and len(at):
            at = at[units[at] @ self.unit >= self.scores[-1] - 1e-9]
        if len(at):
            self.merge(ids[at], cosines(vectors[at], self.vector))


def _search_task(k: int):
    """A partition's queries (``kind`` 0) come before its rows."""
    def run(batches):
        queries: dict[int, list] = {}
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            asks = batch.filter(pa.array(kind == 0))
            for at, v in _matrices(asks.column("vector")):
                mine = queries.setdefault(v.shape[1], [])
                for i, vector in zip(at.tolist(), v):
                    mine.append(_Query(asks.column("vec_id")[i].as_py(), asks.column("key")[i].as_py(), vector, k))
            rows = batch.filter(pa.array(kind == 1))
            for at, v in _matrices(rows.column("vector")):
                if v.shape[1] not in queries:
                    continue
                some = rows.take(pa.array(at))
                code = np.frombuffer(b"".join(some.column("code").to_pylist()), np.uint64).reshape(len(at), -1)
                ones = np.bitwise_count(code).sum(1, dtype=np.int64)
                units = v / np.sqrt((v * v).sum(1, keepdims=True))
                for q in queries[v.shape[1]]:
                    q.look(some.column("vec_id").to_numpy(), v, units, code, ones,
                           some.column("fit").to_numpy(), some.column("spread").to_numpy())
        for q in (q for some in queries.values() for q in some if len(q.ids)):
            yield pa.RecordBatch.from_pydict({
                "query_id": pa.array(np.full(len(q.ids), q.own)), "key": pa.array(np.full(len(q.ids), q.key)),
                "vec_id": pa.array(q.ids), "score": pa.array(q.scores)})
    return run


def search(codes: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of the index
    ``codes`` for each row of ``queries`` (vec_id, vector), nearest first,
    ties to the smaller vec_id; all candidates if there are fewer.

    Rows of the query's own vec_id are no candidates.  Vectors of another
    length have no cosine with the query.  A row that comes twice is found
    twice; a query that comes twice with one vector is answered once, with
    two vectors once for each.
    """
    asked = queries.select("vec_id", "vector", F.xxhash64("vector").alias("key")).dropDuplicates(["vec_id", "key"])
    spark = codes.sparkSession
    n, m = codes.count(), asked.count()
    blocks = max(1, -(-m // QUERIES))
    stripes = max(1, min(-(-n // STRIPE), -(-2 * spark.sparkContext.defaultParallelism // blocks)))
    deal = F.xxhash64("vec_id", "vector", F.lit(1))
    asks = asked.withColumn("block", F.pmod(deal, F.lit(blocks))).withColumn(
        "stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))).withColumn("kind", F.lit(0))
    rows = codes.withColumn("stripe", F.pmod(deal, F.lit(stripes))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("kind", F.lit(1))
    both = asks.unionByName(rows, allowMissingColumns=True)
    cell = (F.col("block") * stripes + F.col("stripe")).cast("int")
    near = (both.repartitionById(blocks * stripes, cell).sortWithinPartitions("kind")
            .select("kind", "vec_id", "key", "vector", "code", "fit", "spread")
            .mapInArrow(_search_task(k), "query_id long, key long, vec_id long, score double"))
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), F.asc("vec_id"))
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def every_nth(codes: DataFrame, n: int) -> DataFrame:
    """The rows whose id is divisible by ``n``, as queries."""
    return codes.where(F.col("vec_id") % n == 0).select("vec_id", "vector")

"""Nearest neighbours by one-bit codes against brute force."""

import numpy as np
import pytest

from strata.llm import onebit, queries


def brute(vectors, asked, k=5):
    """vectors: {id: array}; the k nearest of each asked id, ties to the smaller id."""
    out = set()
    for q in asked:
        near = []
        for i, v in vectors.items():
            if i != q and len(v) == len(vectors[q]):
                near.append((-onebit.cosines(np.array([v]), np.array(vectors[q]))[0], i))
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted(near)[:k], 1)}
    return out


def found(spark, rows, asked, k=5, kind="array<float>"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, vector int, code string, key int").repartition(5)
    codes = onebit.index(df)
    queries_ = codes.where(codes.vec_id.isin(list(asked))).select("vec_id", "vector")
    return {tuple(r) for r in onebit.search(codes, queries_, k).collect()}


@pytest.mark.parametrize("dim", [1, 2, 7, 64, 100])
def test_small_tables_are_exact(spark, dim):
    rng = np.random.default_rng(dim)
    v = {i: np.float32(rng.normal(size=dim)).astype(float) for i in range(120)}
    rows = [(i, [float(x) for x in a], 0, "c", 1) for i, a in v.items()]
    asked = range(0, 120, 9)
    assert found(spark, rows, asked) == brute(v, asked)


def test_ties_copies_and_scales(spark):
    """A third of the rows are one vector; equal vectors tie, to the smaller id."""
    rng = np.random.default_rng(1)
    hot = np.float32(rng.normal(size=16)).astype(float)
    v = {i: hot if i % 3 == 0 else np.float32(rng.normal(size=16)).astype(float) for i in range(900)}
    v[2000], v[2001] = hot * 2, -hot
    rows = [(i, [float(x) for x in a], 0, "c", 1) for i, a in v.items()]
    asked = [0, 1, 3, 300, 2000, 2001]
    assert found(spark, rows, asked) == brute(v, asked)


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = {1: [1.0, 0.0], 2: [1.0, 1.0], 3: [0.0, -2.0], 50: [3.0, 0.5]}
    rows = [(i, v, 0, "c", 1) for i, v in good.items()] + [
        (4, None, 0, "c", 1), (5, [0.0, 0.0], 0, "c", 1), (6, [1.0, None], 0, "c", 1), (7, [nan, 1.0], 0, "c", 1),
        (8, [inf, 1.0], 0, "c", 1), (9, [], 0, "c", 1), (10, [1.0, 2.0, 3.0], 0, "c", 1), (None, [1.0, 0.1], 0, "c", 1)]
    got = found(spark, rows, [1, 50, 4, 5, 10], kind="array<double>")
    assert got == brute({i: np.array(v) for i, v in good.items()}, [1, 50])    # all candidates, fewer than 5
    assert found(spark, [], [1]) == set()
    assert found(spark, rows[:1], [1], kind="array<double>") == set()


def test_repeated_rows(spark):
    rows = [(1, [1.0, 0.0], 0, "c", 1), (1, [1.0, 0.0], 0, "c", 1), (2, [1.0, 0.1], 0, "c", 1), (2, [1.0, 0.1], 0, "c", 1),
            (3, [0.0, 1.0], 0, "c", 1)]
    got = sorted((q, r, i) for q, r, i, _ in found(spark, rows, [1]))
    assert got == [(1, 1, 2), (1, 2, 2), (1, 3, 3)]


def test_estimates_keep_their_error_bounds():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(3000, 96))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    code, fit, spread = onebit.encode(v)
    ones = np.bitwise_count(code).sum(1, dtype=np.int64)
    out = []
    for i in range(20):
        q = onebit._Query(-1, 0, v[i], 5)
        out.append((q.estimate(code, ones, fit) - v @ v[i]) / np.sqrt(spread ** 2 + q.rounding / fit ** 2))
    z = np.delete(np.array(out), 0, axis=1)
    assert abs(z.mean()) < 0.05 and 0.85 < z.std() < 1.15
    assert (z < -onebit.WIDE).mean() < 0.02
    r = onebit.rotation(96)
    assert np.allclose(r @ r.T, np.eye(96)) and np.allclose(np.linalg.norm(v @ r.T, axis=1), 1)


def test_recall_of_the_query(spark):
    """Of all rows of sf0.1's table, against brute force; blocks and stripes change nothing."""
    import pyarrow.parquet as pq
    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    v = dict(zip(t["vec_id"].to_pylist(), (np.array(e, float) for e in t["embedding"].to_pylist())))
    asked = [i for i in v if i % 50 == 0]
    mat, ids = np.array(list(v.values())), np.array(list(v))
    want = {}
    for q in asked:
        s = onebit.cosines(mat, v[q])
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:5]
        want[q] = {(int(ids[i]), float(s[i])) for i in order}
    got: dict = {}
    for r in queries.QUERIES["op12_nearest"](spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r["query_id"], set()).add((r["vec_id"], r["score"]))
    hits = sum(len(got[q] & want[q]) for q in asked)
    assert hits >= 0.99 * 5 * len(asked) and set(got) == set(asked)


def test_blocks_and_stripes(spark, monkeypatch):
    rng = np.random.default_rng(9)
    v = {i: np.float32(rng.normal(size=24)).astype(float) for i in range(300)}
    rows = [(i, [float(x) for x in a], 0, "c", 1) for i, a in v.items()]
    monkeypatch.setattr(onebit, "QUERIES", 7)
    monkeypatch.setattr(onebit, "STRIPE", 40)
    asked = range(0, 300, 10)
    assert found(spark, rows, asked) == brute(v, asked)

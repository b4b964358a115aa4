import random
import re

import numpy as np
import pytest

from strata.llm import near_dup
from strata.llm.components import connected_components

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def brute(rows, k, percent):
    """All pairs, and the closure of the links."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    real = [(i, s) for i, s in sets if i is not None and s]
    for a, (i, x) in enumerate(real):
        for j, y in real[:a]:
            if i != j and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if both * 100 >= percent * (len(x) + len(y) - both):
                    p, q = sorted((top(i), top(j)))
                    parent[q] = p
    return sorted(((i, len(s), None if i is None else top(i)) for i, s in sets), key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def edited(rng, words, rate):
    return [w if rng.random() > rate else f"e{rng.randrange(10**6)}" for w in words]


@pytest.fixture(scope="module")
def family_rows():
    """Near copies of a few originals at many degrees of likeness, exact copies, and others."""
    rng = random.Random(11)
    out, n = [], 0
    for size in (60, 9, 4):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(size):
            out.append((n, " ".join(edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.03, 0.06])))))
            n += 1
    out += [(n + i, out[i % 20][1]) for i in range(30)]
    out += [(n + 100 + i, " ".join(f"z{rng.randrange(5000)}" for _ in range(50))) for i in range(30)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_families_against_all_pairs(spark, family_rows, k, percent):
    df = spark.createDataFrame(family_rows, "doc_id long, text string")
    assert rows(near_dup.near_duplicates(df, k, percent)) == brute(family_rows, k, percent)


def test_blocks_split_a_family(spark, family_rows, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    df = spark.createDataFrame(family_rows, "doc_id long, text string")
    assert rows(near_dup.near_duplicates(df, 3, 85)) == brute(family_rows, 3, 85)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    assert rows(near_dup.near_duplicates(odd_docs, 3, 85)) == brute(odd_rows, 3, 85)
    assert near_dup.near_duplicates(no_docs).count() == 0


def test_one_of_each_group_stays(odd_docs):
    left = near_dup.drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    ids = [r.doc_id for r in left.select("doc_id").collect()]
    assert 3 in ids and 108 not in ids and 109 not in ids and ids.count(None) == 2


def test_intersections_by_product_and_one_by_one():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 9000, 700)) for _ in range(40)]
    every = np.arange(40)
    got = near_dup._common(sets, every, every)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in every for j in every if i != j)


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(0, 30)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3), (500, 400)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(40)}, 500: 400, 400: 400}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 2000).astype(np.uint64)
    for share in (0.3, 0.6, 0.9):
        m = int(len(base) * share)
        other = np.concatenate([base[:m], rng.integers(0, 2**63, len(base) - m).astype(np.uint64)])
        sig = near_dup.signatures(np.concatenate([base, other]), np.array([0, 2000, 4000]))
        assert abs((sig[0] == sig[1]).mean() - m / (4000 - m)) < 0.15


def test_a_repeated_id_is_linked_by_each_of_its_texts(spark):
    text = lambda c: " ".join(f"{c}{i}" for i in range(60))
    probe = [(1, text("a")), (1, text("b")), (2, text("a") + " more"), (3, text("b") + " more"), (4, text("c"))]
    got = rows(near_dup.near_duplicates(spark.createDataFrame(probe, "doc_id long, text string"), 3, 85))
    assert got == brute(probe, 3, 85) and [c for _, _, c in got] == [1, 1, 1, 1, 4]
    # a third of the rows have one id, with texts that are linked with others
    many = [(7, text(f"t{i}x")) for i in range(30)] + [(100 + i, text(f"t{i}x") + " tail") for i in range(30)]
    many += [(200 + i, text(f"u{i}x")) for i in range(30)]
    got = rows(near_dup.near_duplicates(spark.createDataFrame(many, "doc_id long, text string"), 3, 85))
    assert got == brute(many, 3, 85)


def test_rows_of_one_id_are_removed_one_by_one(spark):
    text = lambda c: " ".join(f"{c}{i}" for i in range(60))
    data = [(1, text("a")), (1, text("b")), (2, text("a") + " more"), (3, text("b") + " more"), (3, text("c")),
            (4, text("d")), (4, text("d")), (5, text("d")), (6, None), (6, None), (None, text("a"))]
    left = near_dup.drop_near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted(map(tuple, left), key=repr) == sorted(
        [(1, text("a")), (1, text("b")), (3, text("c")), (4, text("d")), (6, None), (6, None), (None, text("a"))], key=repr)

import hashlib
import random

from strata.llm import fingerprints as fp


def test_edited_texts_and_order(odd_docs, odd_rows):
    got = fp.edited_fingerprints(odd_docs).collect()
    chain = sorted(((i, t or "") for i, t in odd_rows),
                   key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256(r[1].encode()).hexdigest()))
    want = []
    for (i, t), (_, nxt) in zip(chain, chain[1:] + chain[:1]):
        e = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        a, b, c = fp._sketches([t.encode(), e.encode(), nxt.encode()])
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, fp.resemblance(a, b), fp.resemblance(a, c)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_few_rows(spark, no_docs):
    assert fp.edited_fingerprints(no_docs).count() == 0
    one = fp.edited_fingerprints(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def test_equal_ids_and_many_ranges(spark):
    rows = [(i // 3, f"text {i} " * 5) for i in range(600)]
    got = fp.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert got.count() == 600


def test_estimates_and_merging():
    rng = random.Random(2)
    a = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    b = a[:2000] + [f"v{rng.randrange(10**6)}" for _ in range(1000)]
    x, y, both, same, short = fp._sketches([" ".join(t).encode() for t in (a, b, a, [w.upper() for w in a], a[:40])])
    assert x == both == same and len(x) == 8 * fp.SIZE
    assert abs(fp.resemblance(x, y) - 0.5) < 0.15
    assert abs(fp.containment(x, y) - 0.667) < 0.2
    assert abs(fp.distinct_shingles(x) / 2996 - 1) < 0.3 and fp.distinct_shingles(short) == 36
    halves = fp._sketches([" ".join(a[:1504]).encode(), " ".join(a[1500:]).encode()])
    assert fp.merge(*halves) == x and fp.merge("", x) == x
    assert fp.resemblance("", "") == 1.0 and fp.resemblance("", x) == 0.0

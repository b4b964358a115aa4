import zlib

import numpy as np

from strata.llm import toxicity


def test_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = toxicity.train_and_score(docs, labels)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    toxic = [r.score for r in held if r.toxic == 1]
    clean = [r.score for r in held if r.toxic == 0]
    auc = np.mean([[(a > b) + 0.5 * (a == b) for b in clean] for a in toxic])
    assert auc > 0.9


def test_features_are_distinct_ngrams():
    buf = np.frombuffer("Idiot IDIOT\tidiotxx".encode(), np.uint8)
    off = np.array([0, 5, 11, 11, 19])
    by_doc = {}
    for f, d in toxicity.ngrams(buf, off):
        for x, y in zip(f, d):
            by_doc.setdefault(int(y), []).append(int(x))
    assert set(by_doc[0]) <= set(by_doc[1]) & set(by_doc[3]) and 2 not in by_doc


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(40)] + [(1, 1, 1), (None, 0, 1), (5, 0, None)],
                                   "doc_id long, quality int, toxic int")
    assert toxicity.train_and_score(odd_docs, labels).count() == len(odd_rows)
    assert toxicity.train_and_score(no_docs, labels).count() == 0
    for part, score in ((labels.limit(0), 0.0), (labels.where("toxic = 1"), 1.0), (labels.where("toxic = 0"), 0.0)):
        got = toxicity.train_and_score(odd_docs, part).collect()
        assert len(got) == len(odd_rows) and all(abs(r.score - score) < 1e-9 for r in got)
    left = toxicity.remove_toxic(odd_docs, odd_docs, labels.limit(0))
    assert left.columns == odd_docs.columns and left.count() == len(odd_rows)


def test_ratios_count_all_labelled_rows(spark, monkeypatch):
    kinds = ["a quiet walk by the river", "you utter blockhead", "vermin go away now"]
    rows = [(i, f"{kinds[1 if i % 10 == 1 else 2 if i % 50 == 7 else 0]} {i}") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(not t.startswith("a"))) for i, t in rows], "doc_id long, toxic int")
    whole, part = toxicity.learn(docs, labels, sample=800), toxicity.learn(docs, labels, sample=150)
    assert list(part.kept) == list(whole.kept)
    rare = spark.createDataFrame([(1, "vermin go away"), (2, "a quiet walk")], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in toxicity.score(rare, part).collect()} == {1: 1, 2: 0}
    monkeypatch.setattr(toxicity, "hashed_sample", lambda df, n, *c: df.where("toxic = 0"))
    alone = toxicity.learn(docs, labels)                     # one class in the sample
    assert {r.doc_id: r.predicted for r in toxicity.score(rare, alone).collect()} == {1: 1, 2: 0}


def test_distinct_features_of_each_document():
    rng = np.random.default_rng(2)
    texts = ["abcabcabc", "", "x", "aaaaaaaaaaaa", "".join(rng.choice(list("abc "), 5000)), "abcabcabc"]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0] + [len(t) for t in texts])
    last = np.full(toxicity.BUCKETS, 7, np.int32)
    got = list(toxicity._distinct(buf, off, last))
    assert len(got) == len(texts)
    for d, mine in enumerate(got):
        want = {int(x) for f, e in toxicity.ngrams(buf, off) for x in f[e == d]}
        assert set(mine.tolist()) == want and len(mine) == len(want)


def test_rows_of_one_id_are_decided_one_by_one(spark):
    docs = spark.createDataFrame([(i, f"you utter blockhead {i}" if i % 4 == 1 else f"a quiet walk by the river {i}")
                                  for i in range(200)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(text like 'you%') as toxic")
    new = spark.createDataFrame([(1, "you utter blockhead"), (1, "a quiet walk"), (2, None)], "doc_id long, text string")
    left = toxicity.remove_toxic(new, docs, labels)
    assert sorted(map(tuple, left.collect()), key=repr) == [(1, "a quiet walk"), (2, None)] and left.dtypes == new.dtypes

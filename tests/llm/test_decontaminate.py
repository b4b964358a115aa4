import re

import pytest

from strata.llm import decontaminate

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))


def brute(docs, items):
    wins = {}
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            wins.setdefault(tuple(w[i:i + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                got = wins.get(tuple(w[i:i + k]))
                if got:
                    hit |= set(range(i, i + k))
                    found |= got
        out.append((doc, len(w), len(hit), ",".join(sorted(map(str, found)))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(odd_rows):
    long = odd_rows[-4][1].split()
    return [(1, " ".join(long[100:140])), (2, " ".join(long[105:125])), (2, " ".join(long[105:125])), (10, "Two words"),
            (3, None), (4, ""), (5, "..."), (6, odd_rows[3][1]), (7, odd_rows[3][1].upper()), (8, "one"),
            (9, " ".join(long[500:512])), (11, " ".join(long[-13:])), (12, " ".join(long[:13]) + " tail words here")]


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, ",".join(r.item_ids)) for r in df.collect()), key=repr)


def test_against_brute_force(spark, odd_docs, odd_rows, items):
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, key int")
    got = decontaminate.benchmark_hits(odd_docs, bench)
    assert rows(got) == brute(odd_rows, items)
    assert all(r.n_items == len(r.item_ids) and r.n_hit == sum(s.e - s.s for s in r.spans) for r in got.collect())


def test_empty_tables(spark, odd_docs, no_docs, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows(decontaminate.benchmark_hits(odd_docs, none)) == brute(odd_rows, [])
    assert decontaminate.benchmark_hits(no_docs, none).count() == 0


def test_removal_keeps_clean_rows_and_columns(spark, odd_docs, items):
    bench = spark.createDataFrame([(i, t) for i, t in items if i != 8], "item_id long, text string")
    left = decontaminate.remove_contaminated(odd_docs, bench)
    assert left.columns == odd_docs.columns
    gone = {r.doc_id for r in odd_docs.select("doc_id").collect()} - {r.doc_id for r in left.select("doc_id").collect()}
    assert gone == {3, 104, 108, 109}        # the long text holds a few passages only


def test_a_phrase_shorter_than_a_window_meets_nothing(spark, monkeypatch):
    """An 11-word phrase that all texts and items share makes no joined row."""
    phrase = " ".join(f"common{i}" for i in range(11))
    docs = [(i, f"d{i} x{i} {phrase} y{i} z{i}") for i in range(300)]
    items = [(i, f"p{i} q{i} {phrase} r{i} s{i}") for i in range(300)]
    items += [(1000, f"d5 x5 {phrase}"), (1001, docs[7][1])]
    made = []
    monkeypatch.setattr(decontaminate, "cut", lambda df, f=decontaminate.cut: made.append(f(df)) or made[-1])
    got = decontaminate.benchmark_hits(spark.createDataFrame(docs, "doc_id long, text string"),
                                       spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == brute(docs, items)
    joined = [df.count() for df in made if "s" in df.columns and "e" in df.columns]
    assert joined == [1 + 3]                 # windows hit: one of document 5, all of document 7


def test_rows_of_one_id_are_decided_one_by_one(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, text), (1, "a clean text of the same id"), (2, text), (2, None)], "doc_id long, text string")
    left = decontaminate.remove_contaminated(docs, spark.createDataFrame([(9, text)], "item_id long, text string"))
    assert sorted(map(tuple, left.collect()), key=repr) == [(1, "a clean text of the same id"), (2, None)]

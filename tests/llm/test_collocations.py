"""Phrase collocations against plain counters."""

import random
import re
from collections import Counter

import pytest

from strata.llm import collocations as col

AZ = {c: c + 32 for c in range(0x41, 0x5B)}


def brute(rows, most=4, least=30, share=80, top=2000):
    f: dict = {}
    n: Counter = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        mine = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(AZ)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, most + 1):
                for i in range(len(w) - m + 1):
                    mine[tuple(w[i:i + m])] += 1
    out = []
    for lang, mine in f.items():
        cand = {p: a for p, a in mine.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    q = p[i:i + m]
                    if 100 * a >= share * cand.get(q, 10 ** 18):
                        gone.add(q)
        kept = []
        for p, a in cand.items():
            if p not in gone:
                score, _, left, right = min((2_000_000 * a // (mine[p[:k]] + mine[p[k:]]), k, mine[p[:k]], mine[p[k:]])
                                            for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def mined(spark, rows, least=30, top=2000, parts=6):
    df = spark.createDataFrame([(lang, text, "x", 1) for lang, text in rows],
                               "lang string, text string, word string, count int").repartition(parts)
    return sorted(tuple(r) for r in col.ranked(col.collocations(df, least=least), top).collect())


def _text(rng, n):
    words = ["the", "of", "New", "york", "city", "Été", "größe", "a", "b", "c", "日本", "x y", "e-mail"]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ", ", "\n", "; ", "!?", " : ", "\x0b", "\r\n"]
    out = []
    for _ in range(n):
        out += [rng.choice(words) if rng.random() < 0.7 else "new york city hall", rng.choice(gaps)]
    return "".join(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = [(rng.choice(["en", "en", "en", "de", None, "und"]), _text(rng, rng.randrange(0, 120))) for _ in range(250)]
    out += [("en", None), ("fr", ""), (None, " \t "), ("fr", ".,;"), ("en", _text(rng, 8000)), ("en", "a a a a a a a a " * 40)]
    return out + out[:40]                                    # repeated rows


@pytest.mark.parametrize("least", [2, 30, 400])
def test_against_plain_counters(spark, rows, least):
    assert mined(spark, rows, least) == brute(rows, least=least)


def test_first_phrases_and_layout(spark, rows):
    assert mined(spark, rows, 5, top=7, parts=1) == mined(spark, rows, 5, top=7, parts=30) == brute(rows, least=5, top=7)


def test_small_flushes_slices_and_a_full_bit_array(spark, rows, monkeypatch):
    """Many partial stripes, every prefix sliced, and a bit array that lets nearly everything through."""
    monkeypatch.setattr(col, "FLUSH", 50)
    monkeypatch.setattr(col, "HEAVY", 10 ** 9)
    monkeypatch.setattr(col, "BITS", 8)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert mined(spark, rows, 4) == brute(rows, least=4)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_subsumption_and_cuts(spark):
    rows = [("en", "w x y z.")] * 40 + [("en", "w x.")] * 9 + [("en", "x y.")] * 20 + [("en", "Y, z")] * 5
    got = mined(spark, rows)
    assert got == brute(rows)
    assert {r[2] for r in got} == {"w x y z", "x y"}          # 40 of 49 subsumes "w x", 40 of 60 does not "x y"


def test_no_words(spark, no_docs):
    assert col.ranked(col.collocations(no_docs)).collect() == []
    assert mined(spark, [(None, None), ("en", "  "), ("en", "one two")]) == []


def test_counts_beyond_64_bits_of_product(spark):
    a = spark.createDataFrame([(9 * 10 ** 15, 10 ** 16, 10 ** 16)], "a long, l long, r long")
    from pyspark.sql import functions as F
    score = F.expr(f"CAST({col.SCALE} AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(20, 0)) "
                   "DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    assert a.select(score).first()[0] == 2_000_000 * 9 * 10 ** 15 // (2 * 10 ** 16)

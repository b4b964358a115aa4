import hashlib
import re
from fractions import Fraction

import duckdb
import pytest

from strata.llm import mixing, queries


def share(total, children):
    """Water filling one child at a time: name -> (cap, weight) -> budget."""
    left, open_, out = total, dict(children), {c: 0 for c in children}
    while True:
        w = sum(x[1] for x in open_.values())
        short = [c for c, (cap, x) in open_.items() if x > 0 and cap * w <= left * x]
        if not short:
            break
        one = min(short, key=lambda c: (Fraction(open_[c][0], open_[c][1]), c))
        out[one] = open_.pop(one)[0]
        left -= out[one]
    w = sum(x[1] for x in open_.values())
    for c, (_, x) in open_.items():
        out[c] = left * x // w if w else 0
    return out


def brute(rows, weights, percent, epochs, seed):
    leaves = {}
    for r in rows:
        leaves.setdefault(r[:3], []).append(r)
    supply = {k: sum(r[4] for r in v) for k, v in leaves.items()}
    total = sum(supply.values())
    nodes = {(): min(total * percent // 100, total * epochs)}
    for depth in range(3):
        new = {}
        for path, b in nodes.items():
            names = {k[:depth + 1] for k in supply if k[:depth] == path}
            caps = {n: (sum(s * epochs for k, s in supply.items() if k[:depth + 1] == n),
                        weights[depth].get(n[-1], 1)) for n in names}
            new.update(share(b, caps))
        nodes = new
    out = []
    for leaf, b in nodes.items():
        full, part = divmod(b, supply[leaf]) if supply[leaf] else (0, 0)
        out += [(r[3], e) for e in range(full) for r in leaves[leaf]]
        key = lambda r: (hashlib.md5(f"{seed}:{full}:{'' if r[3] is None else r[3]}".encode()).hexdigest(),  # noqa: E731, B023
                         "" if r[3] is None else str(r[3]))
        done = 0
        groups = {}
        for r in leaves[leaf]:
            groups.setdefault(key(r), []).append(r)
        for k in sorted(groups):
            if done >= part:
                break
            out += [(r[3], full) for r in groups[k]]
            done += sum(r[4] for r in groups[k])
    return sorted(out, key=repr)


@pytest.mark.parametrize("percent,epochs", [(60, 2), (130, 2), (10, 1), (100, 1), (500, 3), (0, 2)])
def test_against_brute_force(odd_docs, percent, epochs):
    docs = odd_docs.withColumn("domain", mixing.domain(odd_docs["source"]))
    weights = [{"web": 3, "other": 1}, {"en": 5, "": 2}, {"src1": 4, "src2": 0}]
    rows = [(r.domain, r.lang or "", r.source or "", r.doc_id,
             len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect()]
    got = mixing.mix(odd_docs, weights=weights, percent=percent, epochs=epochs, seed="s")
    assert got.columns == [*docs.columns, "mix_epoch", "mix_tokens"]
    assert sorted(((r.doc_id, r.mix_epoch) for r in got.collect()), key=repr) == brute(rows, weights, percent, epochs, "s")


def test_no_rows(no_docs):
    assert mixing.mix(no_docs).count() == 0


def test_shortages_go_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 1000), ("b", "z", 1000)], "d string, l string, supply long")
    from pyspark.sql import functions as F
    got = {(r.d, r.l): r.budget for r in mixing.budgets(leaves, ["d", "l"], [{}, {}], F.lit(400), 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 190, ("b", "z"): 200}
    got = {(r.d, r.l): r.budget for r in mixing.budgets(leaves, ["d", "l"], [{"a": 9}, {}], F.lit(1500), 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 1000, ("b", "z"): 490}


def test_sql_form(spark, small_dir):
    want = duckdb.connect().execute(queries.mixture_sql(f"'{small_dir}/documents.parquet'")).fetchall()
    got = [tuple(r) for r in queries.QUERIES["op8_mixture"](spark, small_dir).collect()]
    assert sorted(got) == sorted(want)

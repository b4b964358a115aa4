"""Each stage of the pipeline against a plain form of its decision."""

import random

import duckdb
import pytest

import corpus_pipeline
from strata.llm import decontaminate, mixing, near_dup, privacy, queries, toxicity
from test_decontaminate import brute as contaminated_brute
from test_near_dup import brute as groups_brute
from test_privacy import brute as spans_brute

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A data folder with planted toxic, copied, contaminated and private documents."""
    rng = random.Random(21)
    plain = [f"w{i}" for i in range(800)]
    insults = ["idiot", "moron", "scumbag"]
    text = lambda n: " ".join(rng.choice(plain) for _ in range(n))
    rows, labels, items = [], [], [(i, text(30)) for i in range(5)]
    for i in range(400):
        body, toxic = text(rng.randrange(20, 80)), i % 5 == 0
        if toxic:
            words = body.split()
            for _ in range(5):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
            body = " ".join(words)
        rows.append((i, body))
        if i < 300:
            labels.append((i, 1, int(toxic)))
    base = [r for r in rows if r[0] % 5][:6]
    rows += [(1000 + i, b) for i, (_, b) in enumerate(base)] + [(1100 + i, b + " tail") for i, (_, b) in enumerate(base)]
    rows += [(1200 + i, text(10) + " " + t + " " + text(10)) for i, t in items]
    rows += [(1300 + i, text(15) + f" joe{i}@mail.example.com and +1 (555) 123-{4000 + i} " + text(9)) for i in range(8)]
    rows += [(1400, None), (1401, ""), (1402, "x")]
    d = tmp_path_factory.mktemp("corpus")
    data = [(i, t, rng.choice(["en", "de", None]), rng.choice(["src1", "src7", None]), None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long") \
        .coalesce(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{d}/benchmark.parquet")
    return str(d)


@pytest.fixture(scope="module")
def steps(spark, corpus, tmp_path_factory):
    """(name, input rows, output rows) of each stage, written and read again."""
    out, docs = [], spark.read.parquet(f"{corpus}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, corpus)
        if name != "mixing":
            assert result.columns == docs.columns and result.dtypes == docs.dtypes
        path = str(tmp_path_factory.mktemp(name) / "out")
        result.write.parquet(path)
        before, docs = docs.collect(), spark.read.parquet(path)
        out.append((name, before, docs.collect()))
    return {n: (a, b) for n, a, b in out}


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_stage_order():
    assert list(STAGES) == ["toxicity", "near_duplicates", "decontamination", "privacy", "mixing"]


def test_toxicity(steps):
    before, after = steps["toxicity"]
    gone = set(ids(before)) - set(ids(after))
    assert {i for i in range(300, 400) if i % 5 == 0} <= gone       # unlabelled ones too
    assert all(i < 400 and i % 5 == 0 for i in gone)


def test_near_duplicates(steps):
    before, after = steps["near_duplicates"]
    want = groups_brute([(r.doc_id, r.text) for r in before], 5, 80)
    assert ids(after) == sorted(i for i, _, top in want if i == top)


def test_decontamination(steps, spark, corpus):
    before, after = steps["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()]
    want = contaminated_brute([(r.doc_id, r.text) for r in before], items)
    assert ids(after) == sorted(i for i, n, hit, _ in want if not (hit > 0 and 20 * hit >= n))
    assert len(before) - len(after) == 5


def test_privacy(steps):
    before, after = steps["privacy"]
    old, new = {r.doc_id: r for r in before}, {r.doc_id: r for r in after}
    assert set(old) == set(new)
    for i, r in new.items():
        if spans_brute(old[i].text):
            assert not spans_brute(r.text) and "<EMAIL>" in r.text and "<PHONE>" in r.text and r.n_chars == len(r.text)
        else:
            assert r.text == old[i].text and r.n_chars == old[i].n_chars


def test_mixing(steps, spark, tmp_path):
    before, after = steps["mixing"]
    spark.createDataFrame(before).write.parquet(str(tmp_path / "in"))
    want = duckdb.connect().execute(queries.mixture_sql(f"'{tmp_path}/in/*.parquet'")).fetchall()
    assert sorted((r.doc_id, r.mix_epoch) for r in after) == sorted((r[0], r[1]) for r in want)


def test_run_gives_the_last_stage(spark, corpus, steps):
    got = corpus_pipeline.run(spark, corpus).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, steps["mixing"][1]))


def test_stages_take_nothing_and_extra_columns(spark, corpus, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, corpus).count() == 0, name
        got = stage(spark, odd_docs, corpus)
        assert set(odd_docs.columns) <= set(got.columns)
        assert got.count() > 0


def test_parameters_are_the_operators(spark):
    assert toxicity.THRESHOLD == 0.3 and decontaminate.WINDOW == 13 and near_dup.BANDS * near_dup.ROWS == 2 * near_dup.PERMUTATIONS
    assert privacy.KINDS == ["email", "ip", "card", "phone"] and len(mixing.LEVELS) == len(mixing.WEIGHTS) == 3

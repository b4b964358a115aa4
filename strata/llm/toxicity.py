"""Toxicity: a linear classifier over character n-grams scaled by naive
Bayes log-count ratios.

A text's features are the hashed byte n-grams (``SIZES``) it contains, A-Z
lower-cased and white space taken as one blank.  Each feature is scaled by
r = log of (its smoothed share in toxic / in other texts), and an L2
logistic regression is fitted on the scaled features.

The ratios and the choice of features count all labelled rows, in Spark; the
driver receives the chosen features alone, ``FEATURES`` rows at most.  Only
the regression is fitted on a sample of at most ``SAMPLE`` of the rows, drawn
by the hash of their id; every row is scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import kernel
from strata.llm.storage import cut, hashed_sample

SIZES = (4, 5, 6)        # bytes per n-gram
BUCKETS = 1 << 20        # hashed features
SAMPLE = 20_000          # labelled rows to learn from, at most
FEATURES = 1 << 14       # scaled features kept for the regression
LEAST = 5                # texts that a feature must occur in
SMOOTH = 1.0
SIGNAL = 2.5             # standard errors by which a kept feature's ratio differs from 0
_PART = 1 << 19          # bytes of text handled at once
REG = 1e-3               # L2 penalty
THRESHOLD = 0.3          # a score this high is predicted toxic
LABELS_SENT = 1 << 18    # labels sent to every task, at most (4 MB); beyond, the labelled texts are shuffled

_U = np.uint64


def _blanked() -> np.ndarray:
    """Hash value of each byte: A-Z lower-cased, white space as a blank."""
    if "blank" not in kernel._cache:
        t = kernel._lower_table()
        t[0x09:0x0E] = 0x20
        kernel._cache["blank"] = kernel.hashed_words(256, "bytes")[t]
    return kernel._cache["blank"]


def ngrams(buf: np.ndarray, off: np.ndarray):
    """(feature bucket, document) of every n-gram of a slice, repeats included."""
    n = len(buf)
    up, down = kernel._powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_blanked()[buf] * up[:n], out=total[1:])
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    room = off[1:][doc] - np.arange(n)             # bytes left in the document
    for size in SIZES:
        if n < size:
            continue
        m = n - size + 1
        h = (total[size:] - total[:m]) * down[:m] + _U(size)
        h = kernel.mix(h) >> _U(64 - BUCKETS.bit_length() + 1)
        fit = room[:m] >= size
        yield h[fit].astype(np.int32), doc[:m][fit]


def _distinct(buf, off, last: np.ndarray):
    """The distinct features of each document of a slice.  ``last`` (one
    entry a bucket, any content) takes each feature's last place, which only
    one of its occurrences has."""
    parts = [(f, np.searchsorted(d, np.arange(len(off)))) for f, d in ngrams(buf, off)]
    for i in range(len(off) - 1):
        f = np.concatenate([f[b[i]:b[i + 1]] for f, b in parts]) if parts else np.zeros(0, np.int32)
        place = np.arange(len(f), dtype=np.int32)
        last[f] = place
        yield f[last[f] == place]


def _count_task(batches):
    """(feature, toxic texts, other texts) of a partition."""
    both, last = np.zeros((2, BUCKETS), np.int32), np.empty(BUCKETS, np.int32)
    for batch in batches:
        for rows, buf, off in kernel.chunks(batch, size=_PART):
            label = rows.column("toxic").to_pylist()
            for toxic, features in zip(label, _distinct(buf, off, last)):
                both[int(toxic == 1)][features] += 1
    some = np.flatnonzero(both.any(0))
    for at in np.array_split(some, 1 + len(some) // 100_000):
        yield pa.RecordBatch.from_pydict({"f": pa.array(at.astype(np.int32)), "toxic": pa.array(both[1][at].astype(np.int64)),
                                          "other": pa.array(both[0][at].astype(np.int64))})


def _present(buf, off, place: np.ndarray):
    """Sorted distinct (document, kept feature) numbers of a slice."""
    out = []
    for feature, doc in ngrams(buf, off):
        at = place[feature]
        hit = at >= 0
        out.append(doc[hit].astype(np.int64) * FEATURES + at[hit])
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)


def _feature_task(kept: np.ndarray):
    def run(batches):
        place = np.full(BUCKETS, -1, np.int32)
        place[kept] = np.arange(len(kept))
        for batch in batches:
            for rows, buf, off in kernel.chunks(batch, size=_PART):
                seen = _present(buf, off, place)
                words = (seen % FEATURES).astype(str)
                bounds = np.searchsorted(seen // FEATURES, np.arange(len(off)))
                yield pa.RecordBatch.from_pydict({
                    "label": rows.column("toxic").cast(pa.float64()),
                    "words": pa.array([words[bounds[i]:bounds[i + 1]].tolist() for i in range(len(off) - 1)],
                                      pa.list_(pa.string()))})
    return run


class Model:
    """Weights of the kept features and the intercept."""

    def __init__(self, kept: np.ndarray, weight: np.ndarray, intercept: float):
        self.kept, self.weight, self.intercept = kept, weight, intercept


def _labelled(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, text, toxic); up to ``LABELS_SENT`` labels go to the texts."""
    few = rows.limit(LABELS_SENT + 1).count() <= LABELS_SENT
    return docs.select("doc_id", "text").join(F.broadcast(rows) if few else rows, "doc_id")


def _shares(texts: DataFrame) -> tuple[int, int]:
    """(toxic rows, rows)"""
    n = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    return n.get(1, 0), sum(n.values())


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Null labels and ids are ignored, a doc_id labelled twice counts as toxic
    if one label says so, and repeated documents count as often as they come.
    Without both classes, or without a telling feature, the score is the
    share of toxic rows (no rows: 0).  If the regression's sample lacks a
    class, the weights are the ratios themselves (naive Bayes).
    """
    spark = docs.sparkSession
    rows = cut(labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    drawn = hashed_sample(rows, sample, "doc_id")
    texts = cut(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id"))
    every = texts if drawn is rows else _labelled(docs, rows)
    n_toxic, n = _shares(every)
    if n_toxic in (0, n):
        odds = 30.0 if n_toxic else -30.0
        return Model(np.zeros(0, np.int64), np.zeros(0), odds)
    p, q = F.col("toxic") + SMOOTH, F.col("other") + SMOOTH
    counts = (every.select("text", "toxic").mapInArrow(_count_task, "f int, toxic long, other long")
              .groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
              .where(F.col("toxic") + F.col("other") >= LEAST)
              .withColumn("r", F.log(p / (n_toxic + SMOOTH)) - F.log(q / (n - n_toxic + SMOOTH)))
              .withColumn("z", F.abs("r") / F.sqrt(1 / p + 1 / q))         # in standard errors of r
              .where(F.col("z") >= SIGNAL).orderBy(F.desc("z"), "f").limit(FEATURES).select("f", "r").collect())
    best = sorted((c["f"], c["r"]) for c in counts)
    kept, scale = np.array([f for f, _ in best], np.int64), np.array([r for _, r in best], np.float64)
    if not len(kept):                              # nothing tells the classes apart
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(n_toxic / (n - n_toxic))))
    drawn_toxic, drawn_n = _shares(texts)
    if drawn_toxic in (0, drawn_n):
        return Model(kept, scale, float(np.log(n_toxic / (n - n_toxic))))
    words = texts.select("text", "toxic").mapInArrow(_feature_task(kept), "label double, words array<string>")
    vectors = CountVectorizerModel.from_vocabulary([str(i) for i in range(len(kept))], "words", "present")
    vectors.setBinary(True).setMinTF(1.0)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(scale), inputCol="present", outputCol="features")
    ready = scaled.transform(vectors.transform(words)).select("label", "features").persist()
    fit = LogisticRegression(regParam=REG, elasticNetParam=0.0, standardization=False, maxIter=60).fit(ready)
    ready.unpersist()
    return Model(kept, fit.coefficients.toArray() * scale, float(fit.intercept))


def _scores(model: Model, place: np.ndarray, buf, off) -> np.ndarray:
    """Score of each document of a slice."""
    seen = _present(buf, off, place)
    z = np.full(len(off) - 1, model.intercept)
    if len(seen):
        z += np.bincount(seen // FEATURES, weights=model.weight[seen % FEATURES], minlength=len(z))
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _score_task(model: Model):
    def run(batches):
        place = np.full(BUCKETS, -1, np.int32)
        place[model.kept] = np.arange(len(model.kept))
        for batch in batches:
            for rows, buf, off in kernel.chunks(batch, size=_PART):
                yield pa.RecordBatch.from_pydict({"doc_id": rows.column("doc_id"),
                                                  "score": pa.array(_scores(model, place, buf, off))})
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row; a null or empty text has no
    n-grams and gets the intercept's score.  Repeated rows each get theirs,
    and only the two named columns are read."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return (source.mapInArrow(_score_task(model), f"doc_id {kind}, score double")
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def fold(column="doc_id"):
    """crc32(doc_id as text) mod 4; rows with 2 are held out."""
    return F.crc32(F.col(column).cast("string")) % 4


def train_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels outside the held-out fold, score all documents."""
    model = learn(docs, labels.where(fold() != 2))
    return score(docs, model).withColumn("held_out", F.coalesce(fold() == 2, F.lit(False)))


def _clean_task(model: Model, text: str):
    """The rows of a partition that are not predicted toxic."""
    def run(batches):
        place = np.full(BUCKETS, -1, np.int32)
        place[model.kept] = np.arange(len(model.kept))
        for batch in batches:
            for rows, buf, off in kernel.chunks(batch, text, _PART):
                yield rows.filter(pa.array(_scores(model, place, buf, off) < THRESHOLD))
    return run


def remove_toxic(docs: DataFrame, all_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the documents predicted toxic.  Each
    row is decided by its own text where it is read, so texts are not
    shuffled and a repeated doc_id is no matter."""
    model = learn(all_docs, labels.where(fold() != 2))
    return docs.mapInArrow(_clean_task(model, "text"), docs.schema)

"""Secret scans: fixed patterns, and two character Markov models.

The base patterns find assignments to secret-like names, access keys and
long hex strings.  Longer runs of identifier characters are then scored by
the log-likelihood ratio of two first-order Markov models: random strings,
trained on the values that the base patterns found, and ordinary
identifiers, trained on other runs that keep to one kind of character
(lower case, upper case, digits, others) for ``STEADY`` characters or more
on average.  Runs that are neither are no samples but are scored.  Both
models are trained on at most ``SAMPLE`` runs, drawn by their hash.

DataFrame functions only; tasks run no Python.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import spans
from strata.llm.storage import cut, hashed_sample

KINDS = ["assign", "access", "hex", "random"]
# fixed values: the base patterns
NAMES = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
VALUE = r"[A-Za-z0-9+/_.=-]+"
ACCESS = r"AKIA[A-Z0-9]{16,}"            # 20 characters or more
HEX = r"[0-9a-f]{24,}"                   # runs are taken whole, so shorter ones never hide a longer
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"

STEADY = 3.5
SAMPLE = 50_000          # labelled runs per model, at most
SMOOTH = 0.5             # added to each character's count
BACK = 5.0               # pseudo-counts of a pair, by the share of its second character
PER_CHAR = 0.7           # nats per character by which a run must favour the random model
LEAST = 12.0             # and in all
_CODES = 128             # characters of a run are ASCII


def _value(match):
    return F.regexp_extract(match, rf"\A{NAMES}({VALUE})", 1)


def _base(text):
    return spans.ordered(
        spans.found(text, NAMES + VALUE, 0, lambda m: F.length(_value(m)) >= 6),
        spans.found(text, ACCESS, 1),
        spans.found(text, HEX, 2))


def _pairs(run):
    """Codes first * 128 + second of a run's neighbouring characters; the
    run is cut into characters once, so the work is linear in its length."""
    codes = F.transform(F.split(run, ""), lambda c: F.ascii(c))
    n = F.greatest(F.size(codes) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, F.lit(1), n), F.slice(codes, F.lit(2), n), lambda a, b: a * _CODES + b)


def train(samples: DataFrame) -> list[float]:
    """Log ratio of the pair probabilities, random over ordinary, by pair
    code, from (run, label) rows: label 1 random, 0 ordinary.  Without
    samples of both labels all ratios are 0, which finds nothing."""
    rows = samples.where("length(run) > 1")
    few = [hashed_sample(rows.where(F.col("label") == x), SAMPLE, "run") for x in (0, 1)]
    counts = {(r["label"], r["pair"]): r["n"] for r in
              few[0].union(few[1]).select("label", F.explode(_pairs(F.col("run"))).alias("pair"))
              .groupBy("label", "pair").agg(F.count("*").alias("n")).collect()}      # 2 * 128 * 128 rows at most
    if len({k for k, _ in counts}) < 2:
        return [0.0] * (_CODES * _CODES)
    letters = [ord(c) for c in "+-/0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"]
    single = []                                  # smoothed share of each character, per label
    for x in (0, 1):
        n = {b: sum(counts.get((x, a * _CODES + b), 0) for a in letters) + SMOOTH for b in letters}
        single.append({b: n[b] / sum(n.values()) for b in letters})
    ratio = [0.0] * (_CODES * _CODES)
    for a in letters:
        total = [sum(counts.get((x, a * _CODES + b), 0) for b in letters) for x in (0, 1)]
        for b in letters:
            p = [(counts.get((x, a * _CODES + b), 0) + BACK * single[x][b]) / (total[x] + BACK) for x in (0, 1)]
            ratio[a * _CODES + b] = round(math.log(p[1] / p[0]), 6)
    return ratio


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, added) of every row: spans of the base patterns, and
    runs that the models call random and that overlap no base span.

    A null or empty text has no spans; repeated rows each get theirs; other
    columns are not read.  Without base spans in any text, or without other
    runs, nothing is added.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    read = cut(source.select("doc_id", _base(F.col("t")).alias("base"), spans.found(F.col("t"), RUN, 3).alias("runs"))
               .withColumn("runs", spans.apart(F.col("runs"), F.col("base"))))
    secret = (read.select(F.explode("base").alias("x"))
              .select(F.when(F.col("x.k") == 0, _value(F.col("x.m"))).otherwise(F.col("x.m")).alias("run")).distinct()
              .select(F.translate("run", ".", "").alias("run"), F.lit(1).alias("label")))
    kinds = F.regexp_count("run", F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+"))
    plain = (read.select(F.explode("runs.m").alias("run")).distinct().where(kinds * STEADY <= F.length("run"))
             .select("run", F.lit(0).alias("label")))
    ratio = F.from_json(F.lit(json.dumps(train(secret.union(plain)))), "array<double>")

    def random(x):
        total = F.aggregate(_pairs(x["m"]), F.lit(0.0), lambda s, p: s + F.element_at(ratio, p + 1))
        return (total >= LEAST) & (total >= PER_CHAR * F.length(x["m"]))
    return read.select("doc_id", "base", F.filter("runs", random).alias("added"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``find`` with counts and the spans written as text."""
    base, every = F.col("base"), spans.ordered(F.col("base"), F.col("added"))
    return find(docs, id_col, text_col).select(
        "doc_id", *[spans.count(base, i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        F.sha2(spans.listed(base, KINDS), 256).alias("base_sha256"), spans.listed(every, KINDS).alias("spans"))


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with every span replaced by its kind.  The texts are
    matched to their spans by id and text hash; null texts stay null."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    keyed = rows.withColumn("key", F.sha2(F.coalesce("text", F.lit("")), 256))
    hits = find(keyed.select("key", "text").distinct(), "key", "text").select(
        F.col("doc_id").alias("key"), spans.ordered(F.col("base"), F.col("added")).alias("all"))
    return keyed.join(hits.where("size(all) > 0"), "key", "left").select(
        "doc_id", spans.replaced(F.col("text"), F.coalesce("all", spans.none()), KINDS).alias("text"))

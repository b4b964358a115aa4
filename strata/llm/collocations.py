"""Phrase collocations by the stripes pattern.

A stripe is the associative next-word counter of one prefix.  Tasks build
the stripes of their texts, stripes of one prefix are merged elementwise,
and everything is read off the merged stripes: an entry is the count of the
prefix extended by that word, the empty prefix's stripe holds the word
counts and its total all words, and the largest entry of a phrase's own
stripe (and of the stripes that end with it) is the longest phrase that may
subsume it.

The stripes of prefixes of 0, 1, 2 and 3 words are built in turn.  A phrase
that occurs ``least`` times has only parts that do, so a pass keeps an
entry only where a bit array of the frequent shorter phrases has both the
prefix and the words after its first; a full bit array lets more through
and loses none.  The stripe of a prefix that makes up a ``HEAVY``-th of all
words, and that of the empty prefix, is cut into slices by the hash of the
next word, so that it is spread over many tasks.

Phrases are named by 64-bit hashes, prefix and next word apart, until the
frequent ones are spelled out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import kernel
from strata.llm.storage import bit_array, cut, has_bit

MOST = 4                 # words of a phrase
LEAST = 30               # occurrences of a candidate
SHARE = 80               # a longer candidate with this percentage of the count subsumes
TOP = 2000               # phrases per language
SCALE = 2_000_000
FLUSH = 1 << 22          # occurrences a task gathers before it emits their stripes
BITS = 26                # log2 of the bit array's size (8 MB)
HEAVY = 2000             # share of the words from which a prefix's stripe is sliced: at most so many prefixes
_SLICES = 64             # of a heavy stripe
_FIRST_SLICES = 256      # of the empty prefix's stripe
LANGUAGES_SENT = 100_000  # totals sent to every task, at most

_U = np.uint64
_STEP = kernel.hashed_words(1, "phrase step")[0] | _U(1)


def extended(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase (or the language's root) extended by a word."""
    return kernel.mix(prefix * _STEP + word)


def _merged(prefix, word, count):
    """One entry per (prefix, word), sorted by them."""
    if not len(prefix):
        return prefix, word, count
    order = np.lexsort((word, prefix))
    prefix, word, count = prefix[order], word[order], count[order]
    new = np.ones(len(prefix), bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (word[1:] != word[:-1])
    heads = np.flatnonzero(new)
    return prefix[heads], word[heads], np.add.reduceat(count, heads)


def _slice_of(prefix: np.ndarray, word: np.ndarray, level: int, heavy: np.ndarray) -> np.ndarray:
    if level == 1:
        return (word % _U(_FIRST_SLICES)).astype(np.int32)
    return np.where(np.isin(prefix, heavy), word % _U(_SLICES), _U(0)).astype(np.int32)


def _occurrences(w: kernel.Words, ends: np.ndarray, root: np.ndarray, level: int, frequent):
    """(prefix, next word, its place) of every phrase of ``level`` words."""
    n = len(w.start)
    m = n - level + 1
    if m <= 0:
        return np.zeros(0, _U), np.zeros(0, _U), np.zeros(0, np.int64)
    near = np.zeros(n, bool)                      # is the next word in the same piece?
    marks = np.zeros(len(w.buf) + 1, np.int32)
    np.cumsum(ends[w.buf], out=marks[1:])
    near[:-1] = marks[w.start[1:]] == marks[w.end[:-1]]
    near[w.first[1:][w.counts > 0] - 1] = False
    ok = np.ones(m, bool)
    for j in range(level - 1):
        ok &= near[j:j + m]
    ids = np.repeat(root, w.counts)
    for j in range(level - 1):                    # phrases of level - 1 words, by first word
        ids = extended(ids[:n - j], w.hash[j:])
    if level > 1:
        known = has_bit(frequent, ids)
        ok &= known[:m] & known[1:m + 1]
    places = np.flatnonzero(ok)
    return ids[places], w.hash[places + level - 1], places + level - 1


def _stripe_rows(prefix, word, count, level: int, heavy, spelled: dict) -> pa.RecordBatch:
    """The entries, sorted by prefix and word, as one row per stripe slice."""
    part = _slice_of(prefix, word, level, heavy)
    if part.any():
        order = np.lexsort((part, prefix))
        prefix, word, count, part = prefix[order], word[order], count[order], part[order]
    new = np.ones(len(prefix), bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])
    heads = np.flatnonzero(new)
    bounds = pa.array(np.append(heads, len(prefix)).astype(np.int32))
    words = [spelled[h] for h in word.tolist()] if level == 1 else [None] * len(word)
    return pa.RecordBatch.from_pydict({
        "prefix": pa.array(prefix[heads].view(np.int64)), "slice": pa.array(part[heads]),
        "next": pa.ListArray.from_arrays(bounds, pa.array(word.view(np.int64))),
        "count": pa.ListArray.from_arrays(bounds, pa.array(count)),
        "words": (pa.ListArray.from_arrays(bounds, pa.array(words, pa.string())) if level == 1 else
                  pa.nulls(len(heads), pa.list_(pa.string())))})


_STRIPE = "prefix long, slice int, next array<long>, count array<long>, words array<string>"


def _stripe_task(level: int, frequent, heavy):
    """Stripes of the phrases of ``level`` words of a partition's texts."""
    def run(batches):
        ends = np.zeros(256, np.int32)
        ends[list(kernel.PIECE_ENDS)] = 1
        bits = frequent.value if frequent is not None else None
        held, n, spelled = [], 0, {}

        def drain():
            one = [np.concatenate(x) for x in zip(*held)]
            return _stripe_rows(*_merged(*one), level, heavy, spelled)
        for batch in batches:
            for rows, buf, off in kernel.chunks(batch):
                w = kernel.Words(buf, off, "phrase")
                root = rows.column("root").to_numpy().view(_U)
                prefix, word, place = _occurrences(w, ends, root, level, bits)
                if not len(prefix):
                    continue
                if level == 1:
                    some, first = np.unique(word, return_index=True)
                    for h, i in zip(some.tolist(), place[first].tolist()):
                        if h not in spelled:
                            spelled[h] = w.text(i, i + 1)
                held.append(_merged(prefix, word, np.ones(len(prefix), np.int64)))
                n += len(held[-1][0])
                if n >= FLUSH:
                    yield drain()
                    held, n, spelled = [], 0, {}
        if n:
            yield drain()
    return run


def _merge_task(level: int, least: int, heavy):
    """Merge the slices of each stripe, which arrive one after another, and
    keep the entries of at least ``least``; rows without ``next`` hold the
    totals of the stripes of level 1."""
    def run(batches):
        held = [np.zeros(0, _U), np.zeros(0, _U), np.zeros(0, np.int64)]
        spelled: dict = {}

        def rows(prefix, word, count):
            if level == 1 and len(prefix):
                heads = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
                total = np.add.reduceat(count, heads)
                yield pa.RecordBatch.from_pydict({
                    "prefix": pa.array(prefix[heads].view(np.int64)), "next": pa.nulls(len(heads), pa.int64()),
                    "count": pa.array(total), "id": pa.nulls(len(heads), pa.int64()),
                    "word": pa.nulls(len(heads), pa.string())})
            big = count >= least
            prefix, word, count = prefix[big], word[big], count[big]
            texts = [spelled[h] for h in word.tolist()] if level == 1 else [None] * len(word)
            yield pa.RecordBatch.from_pydict({
                "prefix": pa.array(prefix.view(np.int64)), "next": pa.array(word.view(np.int64)),
                "count": pa.array(count), "id": pa.array(extended(prefix, word).view(np.int64)),
                "word": pa.array(texts, pa.string())})
        for batch in batches:
            size = batch.column("next").value_lengths().to_numpy()
            word = batch.column("next").flatten().to_numpy().view(_U)
            prefix = np.repeat(batch.column("prefix").to_numpy().view(_U), size)
            if level == 1:
                spelled.update(zip(word.tolist(), batch.column("words").flatten().to_pylist()))
            both = (prefix, word, batch.column("count").flatten().to_numpy())
            prefix, word, count = _merged(*[np.concatenate(x) for x in zip(held, both)])
            if not len(prefix):
                continue
            last = batch.num_rows - 1              # its stripe may go on in the next batch
            open_ = ((prefix == _U(batch.column("prefix")[last].as_py() % (1 << 64)))
                     & (_slice_of(prefix, word, level, heavy) == batch.column("slice")[last].as_py()))
            yield from rows(prefix[~open_], word[~open_], count[~open_])
            held = [prefix[open_], word[open_], count[open_]]
            spelled = {h: spelled[h] for h in held[1].tolist()} if level == 1 else {}
        yield from rows(*held)
    return run


def phrase_counts(docs: DataFrame, most: int = MOST, least: int = LEAST) -> tuple[list[DataFrame], DataFrame]:
    """Per phrase length 1 to ``most``: (lang, phrase, words, f) of every
    phrase with at least ``least`` occurrences; and (lang, n), all words."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("root"), F.col("text").cast("string").alias("text"))
    roots = texts.select("lang", "root").distinct()
    bits, shorter, first, out, totals, heavy = None, None, None, [], None, np.zeros(0, _U)
    for level in range(1, most + 1):
        stripes = texts.select("root", "text").mapInArrow(_stripe_task(level, bits, heavy), _STRIPE)
        merged = cut(stripes.repartition("prefix", "slice").sortWithinPartitions("prefix", "slice").mapInArrow(
            _merge_task(level, least, heavy), "prefix long, next long, count long, id long, word string"))
        entries = merged.where("next is not null")
        if level == 1:
            totals = merged.where("next is null").groupBy("prefix").agg(F.sum("count").alias("n"))
            totals = cut(totals.join(roots, F.col("prefix") == F.col("root")).select("lang", "n"))
            n_words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            named = entries.join(roots, F.col("prefix") == F.col("root")).select(
                "id", "lang", F.array("word").alias("words"), F.col("count").alias("f"))
            first = entries.join(roots, F.col("prefix") == F.col("root")).select(
                F.col("lang").alias("_lang"), F.col("next").alias("_next"), F.col("word").alias("_word"))
        else:
            before = shorter.select(F.col("id").alias("_id"), "lang", "words")
            named = entries.join(before, F.col("prefix") == F.col("_id")).join(
                first, (F.col("lang") == F.col("_lang")) & (F.col("next") == F.col("_next"))).select(
                "id", "lang", F.concat("words", F.array("_word")).alias("words"), F.col("count").alias("f"))
        shorter = cut(named)
        out.append(shorter.select("lang", F.concat_ws(" ", "words").alias("phrase"), "words", "f"))
        if level < most:
            large = shorter.where(F.col("f") * HEAVY >= n_words).select("id").collect()      # HEAVY rows at most
            heavy = np.array(sorted(r["id"] for r in large), np.int64).view(_U)
            if bits is not None:
                bits.unpersist()
            bits = spark.sparkContext.broadcast(bit_array(shorter.select("id"), BITS))
    return out, totals


def collocations(docs: DataFrame, most: int = MOST, least: int = LEAST, share: int = SHARE) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every candidate that no longer
    one subsumes, for ``docs`` with columns lang and text (others ignored).

    A null lang is ``und``, a null or empty text has no words, repeated rows
    count as often as they come.  ``score`` is that of the lowest cut, ties
    to the shortest first part, and ``l``, ``r`` are the counts of its parts.
    No candidates give no rows.
    """
    levels, totals = phrase_counts(docs, most, least)
    parts = levels[0].select("lang", "phrase", "f")
    for level in levels[1:-1]:
        parts = parts.unionByName(level.select("lang", "phrase", "f"))
    found = levels[1]
    for level in levels[2:]:
        found = found.unionByName(level)
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k",
        F.concat_ws(" ", F.slice("words", F.lit(1), F.col("k"))).alias("_left"),
        F.concat_ws(" ", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))).alias("_right"))

    def counted(df, side, name):
        p = parts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias(name))
        return df.join(p, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_phrase"))).drop(
            "_lang", "_phrase", side)
    cuts = counted(counted(cuts, "_left", "l"), "_right", "r")
    score = F.expr(f"CAST({SCALE} AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(20, 0)) "
                   "DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("b"))
    # a longer candidate around a phrase has an extension by one word inside it that occurs as often
    words, m = F.col("words"), F.size("words")
    inside = found.where(m > 2).select("lang", "f", F.explode(F.array(
        F.concat_ws(" ", F.slice(words, F.lit(1), m - 1)), F.concat_ws(" ", F.slice(words, F.lit(2), m - 1)))).alias("_p"))
    longest = inside.groupBy(F.col("lang").alias("_lang"), "_p").agg(F.max("f").alias("_f"))
    kept = best.join(longest, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_p")), "left").where(
        F.col("_f").isNull() | (F.col("_f").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * share))
    few = totals.limit(LANGUAGES_SENT + 1).count() <= LANGUAGES_SENT
    return kept.select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"),
                       F.col("b.score").alias("score")).join(F.broadcast(totals) if few else totals, "lang")


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` collocations, with their rank from 1.
    Tasks keep their own first ``top`` before the shuffle."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

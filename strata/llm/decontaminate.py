"""Benchmark decontamination by winnowing.

Every 6-word gram is hashed; of each 8 neighbouring grams the smallest
hash is kept, so any 13 consecutive words that two texts share contain a
gram kept in both at the same place.  A kept gram of a document that meets
one of the benchmark is extended to the windows of 13 words around it, at
most 8, and these meet the benchmark's windows in an exact join on 128 bits:
only true hits meet, however many texts share the gram.  Items shorter than
13 words are one window of their own length n, which is winnowing with grams
of n words and windows of one.

Kept grams meet in a bit array of the benchmark's gram hashes (2^``BITS``
bits, whatever the benchmark's size); a fuller array lets more windows
through to the join and loses none.
"""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import kernel
from strata.llm.storage import bit_array, cut, has_bit, row_key, semi

WINDOW = 13              # words of a benchmark window
GRAM = 6                 # words of a fingerprint
SPAN = WINDOW - GRAM + 1  # grams of a winnowing window
BITS = 23                # log2 of the broadcast bit array's size (1 MB)
SALTS = 16               # parts into which a frequent window is split

_U = np.uint64
_SECOND = kernel.hashed_words(1, "second window hash")[0]


def _selected(hashes: np.ndarray, ok: np.ndarray, span: int) -> np.ndarray:
    """Which hashes are the minimum of some ``span`` neighbours (all ties).

    Neighbourhoods that cross a document end may select a few grams more,
    never fewer.
    """
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    h = np.where(ok, hashes, top)
    n = len(h)
    if n == 0:
        return ok
    pad = np.full(span - 1, top, np.uint64)
    low = np.concatenate([pad, h, pad])
    low = np.lib.stride_tricks.sliding_window_view(low, span).min(axis=1) if span > 1 else low
    high = np.lib.stride_tricks.sliding_window_view(low, span).max(axis=1) if span > 1 else low
    return ok & (high == h)


def _kept(words: kernel.Words, lengths: list[int]):
    """(window length, word positions, hashes) of the kept grams of all texts."""
    h, ok = kernel.grams(words, GRAM)
    keep = np.flatnonzero(_selected(h, ok, SPAN))
    yield WINDOW, keep, h[keep]
    for k in lengths:
        h, ok = kernel.grams(words, k)
        keep = np.flatnonzero(ok)
        yield k, keep, h[keep] + _U(k)


def _windows(words: kernel.Words, k: int):
    """Two hashes of the k words from each word on, and which of these
    windows stay inside one text."""
    other = copy.copy(words)
    other.hash = kernel.mix(words.hash ^ _SECOND)
    h, ok = kernel.grams(words, k)
    return h, kernel.grams(other, k)[0], ok


def _around(at: np.ndarray, ok: np.ndarray, k: int) -> np.ndarray:
    """Starts of the windows of ``k`` words that hold a gram kept at ``at``."""
    if k < WINDOW:
        return at
    starts = np.unique((at[:, None] - np.arange(SPAN)).ravel())
    starts = starts[starts >= 0]
    return starts[ok[starts]]


def _benchmark_task(batches):
    """(item, window length, two window hashes, hash of a kept gram): rows
    of windows have the former, rows of kept grams the latter."""
    for batch in batches:
        for rows, buf, off in kernel.chunks(batch):
            words = kernel.Words(buf, off, "alnum")
            n = words.counts
            for k, at, h in _kept(words, sorted({int(x) for x in n if 0 < x < WINDOW})):
                doc = np.searchsorted(words.first, at, side="right") - 1
                fit = n[doc] >= WINDOW if k == WINDOW else n[doc] == k
                at, h = at[fit], h[fit]
                h1, h2, ok = _windows(words, k)
                starts = _around(at, ok, k)
                ids = rows.column(0).take(pa.array(np.searchsorted(words.first, starts, side="right") - 1))
                m = len(starts)
                yield pa.RecordBatch.from_pydict({
                    "item_id": ids, "k": pa.array(np.full(m, k, np.int32)), "h1": pa.array(h1[starts].view(np.int64)),
                    "h2": pa.array(h2[starts].view(np.int64)), "gram": pa.nulls(m, pa.int64())})
                m = len(h)
                yield pa.RecordBatch.from_pydict({
                    "item_id": pa.nulls(m, ids.type), "k": pa.array(np.full(m, k, np.int32)), "h1": pa.nulls(m, pa.int64()),
                    "h2": pa.nulls(m, pa.int64()), "gram": pa.array(h.view(np.int64))})


_HIT = "array<struct<k:int,s:int,h1:bigint,h2:bigint>>"


def _document_task(bits, lengths: list[int]):
    def run(batches):
        for batch in batches:
            for rows, buf, off in kernel.chunks(batch):
                words = kernel.Words(buf, off, "alnum")
                found = [[np.zeros(0, np.int64)] for _ in range(4)]
                for k, at, h in _kept(words, lengths):
                    at = at[has_bit(bits.value, h)]
                    if len(at):
                        h1, h2, ok = _windows(words, k)
                        starts = _around(at, ok, k)
                        for out, x in zip(found, (np.full(len(starts), k), starts, h1[starts].view(np.int64),
                                                  h2[starts].view(np.int64))):
                            out.append(x)
                k, starts, h1, h2 = [np.concatenate(x) for x in found]
                order = np.argsort(starts, kind="stable")
                k, starts, h1, h2 = k[order], starts[order], h1[order], h2[order]
                bounds = np.searchsorted(starts, words.first)
                place = starts - np.repeat(words.first[:-1], np.diff(bounds))
                hits = pa.StructArray.from_arrays([pa.array(k.astype(np.int32)), pa.array(place.astype(np.int32)),
                                                   pa.array(h1), pa.array(h2)], ["k", "s", "h1", "h2"])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": rows.column(0), "key": rows.column(2), "n_words": pa.array(words.counts, pa.int64()),
                    "hits": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), hits)})
    return run


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, n_hit, n_items,
    item_ids, spans, key), where ``spans`` are the word ranges [start, end)
    of ``docs`` covered by benchmark windows, merged and in order, and
    ``key`` is the row's ``row_key``.

    Null and wordless texts have no words and no hits; items without words
    have no window; repeated rows and ids each keep their row; an empty
    benchmark hits nothing.  Only the named columns are read, so other
    columns may have any name.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    id_type = items.schema["item_id"].dataType.simpleString()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = cut(items.repartition(tasks, F.xxhash64("text")).mapInArrow(
        _benchmark_task, f"item_id {id_type}, k int, h1 long, h2 long, gram long").distinct())
    windows = told.where("gram is null").drop("gram")
    lengths = sorted(x[0] for x in told.select("k").where(F.col("k") < WINDOW).distinct().collect())  # below 13
    bits = spark.sparkContext.broadcast(bit_array(told.where("gram is not null").select("gram"), BITS))
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                         row_key(id_col, text_col).alias("key"))
    doc_type = source.schema["doc_id"].dataType.simpleString()
    read = cut(source.mapInArrow(_document_task(bits, lengths), f"doc_id {doc_type}, key string, n_words long, hits {_HIT}"))
    # a window that very many documents have is spread over SALTS parts
    classes = (windows.select("k", "h1", "h2").distinct()
               .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    found = (read.select("key", F.explode("hits").alias("x")).select(
                "key", "x.*", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int").alias("salt"))
             .join(classes, ["k", "h1", "h2", "salt"])
             .select("key", "k", "h1", "h2", "s", (F.col("s") + F.col("k")).alias("e")))
    found = cut(found.distinct())
    spans = (found.select("key", "s", "e").distinct().groupBy("key")
             .agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("all"))
             .select("key", F.expr(
                 "aggregate(all, cast(array() as array<struct<s:int,e:int>>), (done, x) -> "
                 "if(size(done) > 0 and element_at(done, -1).e >= x.s, "
                 "concat(slice(done, 1, size(done) - 1), array(named_struct('s', element_at(done, -1).s, "
                 "'e', greatest(element_at(done, -1).e, x.e)))), "
                 "concat(done, array(named_struct('s', x.s, 'e', x.e)))))").alias("spans")))
    listed = (found.select("key", "k", "h1", "h2").distinct()
              .join(windows, ["k", "h1", "h2"]).select("key", "item_id").distinct()
              .groupBy("key").agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids")))
    empty = F.expr("cast(array() as array<struct<s:int,e:int>>)")
    return (read.select("doc_id", "key", "n_words").join(spans, "key", "left").join(listed, "key", "left")
            .select("doc_id", "n_words",
                    F.coalesce(F.expr("aggregate(spans, 0, (n, x) -> n + x.e - x.s)"), F.lit(0)).cast("long")
                    .alias("n_hit"),
                    F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"),
                    F.coalesce("spans", empty).alias("spans"), "key"))


def contaminated(n_hit="n_hit", n_words="n_words"):
    """The contamination rule: a twentieth of a document's words are hit."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the contaminated documents; rows are
    decided one by one, also where they share a doc_id."""
    bad = benchmark_hits(docs, benchmark).where(contaminated()).select("key")
    return semi(docs, bad, row_key(), keep=False)

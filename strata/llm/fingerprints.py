"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the ``SIZE`` smallest distinct 48-bit hashes of a document's
5-word shingles, written as text in base64, 8 characters each and in
ascending order.  Sketches of parts merge to the sketch of the whole, and
two sketches estimate the resemblance, containment and number of distinct
shingles of their documents; they are exact for up to ``SIZE`` shingles.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from strata.llm import kernel

SIZE = 128               # hashes per sketch
SHINGLE = 5              # words per shingle
_SPACE = float(1 << 48)


def sketch(hashes: np.ndarray, size: int = SIZE) -> str:
    """The fingerprint of a set of 64-bit shingle hashes."""
    low = np.unique(hashes >> np.uint64(16))[:size]
    raw = low.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
    return base64.b64encode(raw).decode()


def values(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, 6)
    return np.concatenate([np.zeros((len(raw), 2), np.uint8), raw], axis=1).view(">u8").reshape(-1).astype(np.uint64)


def merge(a: str, b: str, size: int = SIZE) -> str:
    """The fingerprint of the union of two documents' shingles."""
    return sketch(np.union1d(values(a), values(b)) << np.uint64(16), size)


def distinct_shingles(fingerprint: str, size: int = SIZE) -> float:
    """Estimated number of distinct shingles."""
    v = values(fingerprint)
    return float(len(v)) if len(v) < size else (size - 1) / ((float(v[-1]) + 1) / _SPACE)


def resemblance(a: str, b: str, size: int = SIZE) -> float:
    """Estimated Jaccard similarity; two empty sets resemble fully."""
    if a == b:
        return 1.0
    x, y = values(a), values(b)
    low = np.union1d(x, y)
    if max(len(x), len(y)) >= size:                # else both sketches are whole sets
        low = low[:size]
    both = np.intersect1d(x, y, assume_unique=True)
    return float(np.isin(low, both, assume_unique=True).sum() / len(low)) if len(low) else 1.0


def containment(a: str, b: str, size: int = SIZE) -> float:
    """Estimated share of a's shingles that b has too (an empty a: 1)."""
    if a == "":
        return 1.0
    j = resemblance(a, b, size)
    union = distinct_shingles(merge(a, b, size), size)
    return float(min(1.0, j * union / distinct_shingles(a, size)))


def _sketches(texts: list[bytes]) -> list[str]:
    """Fingerprints of UTF-8 texts, about a chunk at a time."""
    out: list[str] = []
    i = 0
    while i < len(texts):
        j, total = i, 0
        while j < len(texts) and (j == i or total + len(texts[j]) <= kernel.CHUNK):
            total += len(texts[j])
            j += 1
        buf = np.frombuffer(b"".join(texts[i:j]), np.uint8)
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts[i:j]])]).astype(np.int64)
        h, bounds = kernel.shingles(kernel.Words(buf, off, "space"), SHINGLE)
        out += [sketch(h[bounds[d]:bounds[d + 1]]) for d in range(j - i)]
        i = j
    return out


@F.pandas_udf(StringType())
def fingerprint(text: pd.Series) -> pd.Series:
    """Fingerprint of each text (null: the empty fingerprint)."""
    return pd.Series(_sketches([(t or "").encode("utf-8", "replace") for t in text]))


@F.pandas_udf(DoubleType())
def likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    """Estimated resemblance of two fingerprints."""
    return pd.Series([resemblance(x, y) for x, y in zip(a, b)], dtype="float64")


def _edit_task(batches):
    """Sorted rows of (part, doc_id, text, lead) -> a row for each document
    and the text that follows it in its part.  ``lead`` rows only follow."""
    held = None                                   # the row whose follower is not known yet
    for batch in batches:
        for rows, buf, off in kernel.chunks(batch):
            part = rows.column("part").to_pylist()
            ids, lead = rows.column("doc_id"), rows.column("lead").to_pylist()
            texts = [bytes(buf.data[off[i]:off[i + 1]]) for i in range(len(off) - 1)]
            prints = _sketches(texts)
            out = []
            for i, raw in enumerate(texts):
                text = raw.decode("utf-8", "replace")
                if held is not None and held[0] == part[i]:
                    out.append((held, text, prints[i]))
                held = None if lead[i] else (part[i], ids[i], text, prints[i])
            if out:
                edited = [own[2][:len(own[2]) - len(own[2]) // 2] + text[:len(own[2]) // 2] for own, text, _ in out]
                raw = [t.encode() for t in edited]
                new = _sketches(raw)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([own[1].as_py() for own, _, _ in out], ids.type),
                    "n_chars": pa.array([len(own[2]) for own, _, _ in out], pa.int64()),
                    "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in raw]),
                    "fingerprint": pa.array([own[3] for own, _, _ in out]),
                    "edited_fingerprint": pa.array(new),
                    "near_edited": pa.array([resemblance(own[3], e) for (own, _, _), e in zip(out, new)]),
                    "near_next": pa.array([resemblance(own[3], f) for own, _, f in out])})


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, whose last half
    (rounded down) is replaced by as many characters from the beginning of
    the next document.  Next is by descending id; the last is followed by
    the first.  Rows that share an id follow each other by their text's sha256, null
    ids come last, a null text is empty, a single row follows itself, and no
    rows give no rows.  Only the two named columns are read.

    The texts are dealt once, into ranges of ids; a first look at the ids
    alone finds the ranges and which rows open them, and those rows are also
    given to the range before as followers.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.select("doc_id").where("doc_id is not null").approxQuantile(
        "doc_id", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    cuts = sorted({float(c) for c in cuts})
    # part numbers ascend as ids descend; null ids come last
    rows = rows.withColumn("__at", F.coalesce(F.col("doc_id"), F.lit(0)).cast("double")).withColumn("__range", F.lit(0.0))
    if cuts:
        rows = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="__at", outputCol="__range").transform(
            rows.drop("__range"))
    rows = rows.select("doc_id", "text", F.when(F.col("doc_id").isNull(), len(cuts) + 1)
                       .otherwise(len(cuts) - F.col("__range")).cast("int").alias("part"))
    opens = (rows.groupBy("part").agg(F.min(F.struct(F.coalesce(-F.col("doc_id"), F.lit(0)).alias("o"),
                                                     F.sha2("text", 256).alias("h"))).alias("low"))
             .orderBy("part").collect())           # a row for each part
    before = {r["part"]: opens[i - 1]["part"] for i, r in enumerate(opens)}
    if not opens:
        before = {-1: -1}
    lead = spark.createDataFrame([(r["part"], r["low"]["o"], r["low"]["h"], before[r["part"]]) for r in opens]
                                 or [(-1, 0, "", -1)], "part int, o long, h string, before int")
    leads = (rows.join(F.broadcast(lead), "part")
             .where((F.coalesce(-F.col("doc_id"), F.lit(0)) == F.col("o")) & (F.sha2("text", 256) == F.col("h")))
             .select(F.col("before").alias("part"), "doc_id", "text", F.lit(True).alias("lead"))
             .dropDuplicates(["part"]))
    dealt = (rows.select("part", "doc_id", "text", F.lit(False).alias("lead")).unionByName(leads)
             .withColumn("o", F.coalesce(-F.col("doc_id"), F.lit(0))).withColumn("h", F.sha2("text", 256)))
    # a task for each part, as large as the others
    dealt = (dealt.repartitionById(len(cuts) + 2, "part").sortWithinPartitions("part", "lead", "o", "h")
             .select("part", "doc_id", "text", "lead"))
    return dealt.mapInArrow(_edit_task, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                        "edited_fingerprint string, near_edited double, near_next double")

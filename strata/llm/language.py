"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of ``DIM`` entries of +1 and -1.  An
n-gram vector binds its letters: the entrywise product of the letter
vectors, each permuted (rotated) by its distance from the end.  A text's
vector bundles (sums) its trigram vectors, a language's prototype bundles
the texts of that language, and a text gets the language whose prototype
has the largest cosine with it.

All entries are whole numbers, so sums do not depend on their order.  The
bundle of a text is computed as (trigram counts) x (trigram vectors), one
matrix product per slice of texts, which is the same sum.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import kernel

DIM = 512                # entries of a vector
SLOTS = 512              # letter vectors; a letter's code point picks one
UNKNOWN = "und"
_BLOCK = 1 << 19         # bytes of text per matrix product

_cache: dict = {}


def _letters() -> np.ndarray:
    """Code point -> letter slot (1..SLOTS-1), 0 for what is not a letter.
    Case is folded for single characters; ASCII letters get slots of their own."""
    if "letters" not in _cache:
        slot = np.zeros(0x110000, np.int16)
        for c in range(0x110000):
            ch = chr(c)
            if unicodedata.category(ch)[0] == "L":
                low = ch.lower()
                c2 = ord(low) if len(low) == 1 else c
                slot[c] = 1 + (c2 - 0x61 if 0x61 <= c2 <= 0x7A else 26 + (c2 * 0x9E3779B1 >> 7) % (SLOTS - 27))
        _cache["letters"] = slot
    return _cache["letters"]


def _vectors() -> np.ndarray:
    if "vectors" not in _cache:
        bits = np.unpackbits(kernel.hashed_words(SLOTS * DIM // 64, "letters").view(np.uint8)).reshape(SLOTS, DIM)
        _cache["vectors"] = (bits.astype(np.int8) * 2 - 1)
    return _cache["vectors"]


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    """Vectors of packed trigrams (a * SLOTS + b) * SLOTS + c."""
    v = _vectors()
    a, b, c = codes // (SLOTS * SLOTS), codes // SLOTS % SLOTS, codes % SLOTS
    return (np.roll(v, 2, 1)[a] * np.roll(v, 1, 1)[b] * v[c]).astype(np.float32)


def bundles(buf: np.ndarray, off: np.ndarray, group: np.ndarray | None = None,
            n_groups: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(text vectors, number of letters) of a slice of UTF-8 texts.  Runs of
    anything but letters count as one blank, and a text begins and ends
    with one.  With ``group`` (a number per text) there is one vector per
    group, the sum of its texts' vectors."""
    n = len(off) - 1
    n_out = n if group is None else n_groups
    points = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    # code points per document: bytes that do not continue a character
    heads = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    bounds = heads[off]
    if bounds[-1] != len(points):                 # malformed text: decode each on its own
        each = [np.frombuffer(buf[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace")
                              .encode("utf-32-le", "surrogatepass"), np.uint32) for i in range(n)]
        points = np.concatenate(each) if each else np.zeros(0, np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(e) for e in each])]).astype(np.int64)
    slot = _letters()[points]
    doc = np.repeat(np.arange(n), np.diff(bounds))
    letters = np.bincount(doc, weights=slot > 0, minlength=n).astype(np.int64)
    # one blank before each document and for each run of non-letters
    at = np.flatnonzero(np.concatenate([[True], (slot[1:] > 0) | (slot[:-1] > 0)])) if len(slot) else slot
    slot, doc = slot[at].astype(np.int64), doc[at]
    first = np.searchsorted(doc, np.arange(n + 1))
    full = np.insert(slot, first, 0)              # a blank opens every document, one more closes the last
    owner = np.insert(doc, first, np.arange(n + 1))
    out = np.zeros((n_out, DIM), np.float32 if group is None else np.float64)
    if len(full) < 3:
        return out, letters
    code = (full[:-2] * SLOTS + full[1:-1]) * SLOTS + full[2:]
    mid = full[1:-1] > 0                          # the middle is a letter, so the text is that letter's
    code, who = code[mid], owner[1:-1][mid]
    if group is not None:
        who = group[who]
    for i in range(0, len(code), 1 << 22):        # a very long text: by parts
        part = slice(i, i + (1 << 22))
        kinds, column = _compact(code[part])
        counts = np.bincount(who[part] * len(kinds) + column, minlength=n_out * len(kinds))
        out += counts.reshape(n_out, -1).astype(out.dtype) @ trigram_vectors(kinds).astype(out.dtype)
    return out, letters


def _compact(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and each code's place among them: letters first, so
    that the table of places stays small."""
    a, b, c = code // (SLOTS * SLOTS), code // SLOTS % SLOTS, code % SLOTS
    used = np.zeros(SLOTS, bool)
    for x in (a, b, c):
        used[x] = True
    names = np.flatnonzero(used)
    place = np.zeros(SLOTS, np.int64)
    place[names] = np.arange(len(names))
    m = len(names)
    small = (place[a] * m + place[b]) * m + place[c]
    if m ** 3 <= 1 << 24:
        seen = np.zeros(m ** 3, bool)
        seen[small] = True
        kinds = np.flatnonzero(seen)
        index = np.zeros(m ** 3, np.int32)
        index[kinds] = np.arange(len(kinds))
        column = index[small]
    else:
        kinds, column = np.unique(small, return_inverse=True)
    return (names[kinds // (m * m)] * SLOTS + names[kinds // m % m]) * SLOTS + names[kinds % m], column


def _profile_task(batches):
    """(lang, i, v): each language's bundle over the rows of a partition."""
    total: dict = {}
    for batch in batches:
        for rows, buf, off in kernel.chunks(batch, size=_BLOCK):
            lang = rows.column("lang").dictionary_encode()
            names = lang.dictionary.to_pylist()
            vec, _ = bundles(buf, off, lang.indices.to_numpy(), len(names))
            for name, v in zip(names, vec):
                total[name] = total.get(name, 0) + v
    for name, v in total.items():
        yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * DIM, pa.string()),
                                          "i": pa.array(np.arange(DIM, dtype=np.int32)),
                                          "v": pa.array(v.astype(np.int64))})


def learn_profiles(texts: DataFrame) -> pd.DataFrame:
    """Prototypes from (text, lang) rows with non-null lang: a table with one
    column per language and ``DIM`` rows.  Each task sends one bundle per
    language; the result has one per language."""
    rows = (texts.where("lang is not null").mapInArrow(_profile_task, "lang string, i int, v long")
            .groupBy("lang", "i").agg(F.sum("v").alias("v")).toPandas())
    return rows.pivot(index="i", columns="lang", values="v").sort_index().sort_index(axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(-1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _predict_task(names, proto: np.ndarray):
    """proto: one centred, normalised row per language."""
    def run(batches):
        for batch in batches:
            for rows, buf, off in kernel.chunks(batch, size=_BLOCK):
                vec, letters = bundles(buf, off)
                near = _unit(vec.astype(np.float64)) @ proto.T if len(names) else np.zeros((len(vec), 0))
                known = (letters > 0) & (len(names) > 0)
                best = near.argmax(1) if len(names) else np.zeros(len(vec), int)
                score = near.max(1) if len(names) else np.zeros(len(vec))
                lang = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
                yield pa.RecordBatch.from_pydict({
                    **{c: rows.column(c) for c in rows.schema.names if c != "text"},
                    "lang_pred": pa.array(lang, pa.string()),
                    "score": pa.array(np.where(known, np.clip((1 + score) / 2, 0, 1), 0.0))})
    return run


def identify(docs: DataFrame, profiles: pd.DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row.  The score is (1 + cosine) / 2
    with the winning prototype, after the prototypes' mean direction is
    taken out; the first name wins a tie.  Null texts, texts without letters,
    and all texts when nothing was learned, are ``und`` with score 0.
    Repeated rows each get theirs, and only the two named columns are read.
    """
    names = [str(c) for c in profiles.columns]
    proto = _unit(profiles.to_numpy(np.float64).T)
    if len(names) > 1:
        proto = _unit(proto - proto.mean(0))
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_predict_task(names, proto), f"doc_id {kind}, lang_pred string, score double")


def train_and_identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows whose crc32(doc_id) mod 3 is not 1, predict all."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    profiles = learn_profiles(docs.where(F.coalesce(fold != 1, F.lit(True))).select("text", "lang"))
    return (identify(docs, profiles)
            .withColumn("held_out", F.coalesce(fold == 1, F.lit(False))))

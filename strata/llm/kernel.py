"""Vectorised text helpers that run inside Arrow tasks (numpy only).

A task receives Arrow record batches; ``chunks`` cuts them into slices of
about ``CHUNK`` bytes so the temporary arrays stay small whatever the row
count of a batch, and the other functions work on all texts of a slice at
once: word bounds, 64-bit word hashes, and hashes of k consecutive words.

UTF-8 keeps every byte of a multi-byte character at 0x80 or above, so the
word classes used here can be read off single bytes.  Lower-casing maps
A-Z only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20          # bytes of text handled at once (one row at least)
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"   # no phrase crosses one of these
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)

_cache: dict = {}


def hashed_words(n: int, label: str) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values, the same on every machine."""
    raw = hashlib.shake_128(label.encode()).digest(8 * n)
    return np.frombuffer(raw, "<u8").astype(np.uint64)


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 0x20
    return t


def word_class(kind: str) -> np.ndarray:
    """256 flags: is this byte part of a word?  ``alnum``: letters, digits
    and everything non-ASCII; ``space``: everything but white space;
    ``phrase``: everything but white space and the marks ``PIECE_ENDS``."""
    if kind == "alnum":
        t = np.zeros(256, bool)
        t[0x30:0x3A] = t[0x41:0x5B] = t[0x61:0x7B] = t[0x80:] = True
    elif kind in ("space", "phrase"):
        t = np.ones(256, bool)
        t[0x20] = t[0x09:0x0E] = False
        if kind == "phrase":
            t[list(PIECE_ENDS)] = False
    else:
        raise ValueError(f"unknown word kind {kind}")
    return t


def _tables(kind: str):
    if kind not in _cache:
        lower = _lower_table()
        _cache[kind] = (word_class(kind), hashed_words(256, "bytes")[lower])
    return _cache[kind]


def _powers(n: int):
    have = _cache.get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK + 65536)
        both = []
        for b in (_BASE, _INV):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        have = _cache["powers"] = tuple(both)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> _U(30))
    h *= _M1
    h ^= h >> _U(27)
    h *= _M2
    h ^= h >> _U(31)
    return h


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of an Arrow string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, o, d = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(o, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(d, np.uint8) if d is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(batch: pa.RecordBatch, column: str = "text", size: int | None = None):
    """Slices of a batch as (rows, bytes, offsets), about ``size`` bytes each."""
    size = size or CHUNK
    buf, off = text_buffer(batch.column(batch.schema.get_field_index(column)))
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield batch.slice(i, j - i), buf[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j
    pa.default_memory_pool().release_unused()      # workers live on after the task


class Words:
    """The words of a slice: ``start``/``end`` byte bounds, ``first`` (index
    of each document's first word, one more entry than documents) and
    64-bit ``hash`` of the A-Z-lower-cased word."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, kind: str):
        member, values = _tables(kind)
        n = len(buf)
        self.buf, self.off = buf, off
        if n == 0:
            self.start = self.end = np.zeros(0, np.int64)
            self.first = np.zeros(len(off), np.int64)
            self.hash = np.zeros(0, np.uint64)
            return
        inside = member[buf]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        heads = off[:-1][off[:-1] < n]
        begin[heads] = inside[heads]
        self.start = np.flatnonzero(begin)
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        tails = off[1:][off[1:] > 0] - 1
        last[tails] = inside[tails]
        self.end = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, off)
        up, down = _powers(n + 1)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum(values[buf] * up[:n], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start])

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int, j: int) -> str:
        """Words i..j-1, A-Z lower-cased, joined by one space."""
        raw = self.buf.data
        return " ".join(bytes(raw[self.start[k]:self.end[k]]).decode("utf-8", "replace")
                        for k in range(i, j)).translate(_AZ)


_AZ = {c: c + 32 for c in range(0x41, 0x5B)}


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words by start word, and which of them stay
    inside one document (same length as the words)."""
    h, n = words.hash, len(words.hash)
    out = np.zeros(n, np.uint64)
    m = n - k + 1
    ok = np.zeros(n, bool)
    if m <= 0:
        return out, ok
    acc = np.zeros(m, np.uint64)
    for c, j in zip(hashed_words(k, f"gram{k}") | _U(1), range(k)):
        acc += h[j:j + m] * c
    out[:m] = mix(acc)
    ok[:m] = True
    for j in range(1, k):
        at = words.first[1:] - j
        at = at[(at >= words.first[:-1]) & (at >= 0)]
        ok[at] = False
    return out, ok


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k-word shingle hashes of all documents in order, and the bounds of
    each document's part.  A document with 1..k-1 words has its whole
    sequence as one shingle; one without words has none."""
    h, ok = grams(words, k)
    n = words.counts
    short = np.flatnonzero((n > 0) & (n < k))
    for d in short:                       # rare: at most k-1 words each
        i, j = words.first[d], words.first[d + 1]
        c = hashed_words(k, f"gram{k}") | _U(1)
        acc = (words.hash[i:j] * c[:j - i]).sum(dtype=np.uint64) + _U(int(j - i))
        h[i] = mix(np.array([acc], np.uint64))[0]
        ok[i] = True
    size = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    bounds = np.zeros(len(n) + 1, np.int64)
    np.cumsum(size, out=bounds[1:])
    return h[ok], bounds


def reduce_rows(op, values: np.ndarray, bounds: np.ndarray, empty):
    """``op.reduceat`` per document; ``empty`` where a document has no values."""
    n = np.diff(bounds)
    out = np.full(len(n), empty, values.dtype)
    full = np.flatnonzero(n > 0)
    if len(full):
        out[full] = op.reduceat(values, bounds[:-1][full])
    return out

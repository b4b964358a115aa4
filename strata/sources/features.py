"""The features of a GeoJSON FeatureCollection, cut out of the file at byte
ranges.

Spark reads the document as pieces that end at ``}``, so a file of any size
is many splits.  A first scan tells for each split, for either answer to
whether it begins inside a string, what it does to the depth of braces and
brackets; put together, one row per split, these give the state at each
split's beginning.  A second scan cuts out the objects at depth two: those
inside a split as they are, those across splits as fragments that are joined
afterwards.  What is left, with every object shortened to ``{}`` and runs of
them to one, is the document's frame; it is a few bytes a split and parsed as
a whole, so that a malformed or cut file is an error.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import reliable

_STRING = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\\?\Z)', re.S)
_ESCAPE = re.compile(r"\\.", re.S)
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\\?\Z)|[{\[\]]', re.S)
_RUN = re.compile(r"\{\}(?:\s*,\s*\{\})+")


def _ends_inside(text: str, inside: bool) -> bool:
    """Is the piece's end in a string, if its beginning is (or is not)?"""
    return (_ESCAPE.sub("", text).count('"') + inside) % 2 == 1


def _splits(batches):
    """(file, start, size, pieces) of the splits that a task reads, each a generator."""
    from itertools import groupby
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("file", "start", "size", "value"))))
    for (file, start, size), group in groupby(rows, key=lambda r: r[:3]):
        yield file, start, size, (r[3] for r in group)


def _effect_task(batches):
    """Per split and whether it begins in a string: whether it ends in one,
    the change and lowest point of the brace depth, the change of the bracket
    depth, and the bytes read."""
    for file, start, size, pieces in _splits(batches):
        state = [[bool(i), 0, 0, 0] for i in (0, 1)]
        n = 0
        for text in pieces:
            n += len(text.encode()) + 1
            for s in state:
                rest = _STRING.sub("", ('"' if s[0] else "") + text)
                s[0] = _ends_inside(text, s[0])
                s[1] += rest.count("{") - (not s[0])
                s[2] = min(s[2], s[1])
                s[3] += rest.count("[") - rest.count("]")
        yield pa.RecordBatch.from_pylist([
            {"file": file, "start": start, "size": size, "bytes": n, "inside": i, "ends": int(s[0]), "braces": s[1], "lowest": s[2],
             "brackets": s[3]} for i, s in enumerate(state)])


def _cut_task(at: dict):
    """Objects at depth two (kind 0), fragments of those that go on in other
    splits (1), and the frame (2).  ``feature``: is the object an element of
    an array of the document?"""
    def run(batches):
        for file, start, _, pieces in _splits(batches):
            inside, braces, brackets, begin = at[file, start]
            object_, feature, frame, out = ([] if braces >= 2 else None), None, [], []

            def row(kind, text, begin=start, feature=None):
                return {"kind": kind, "file": file, "start": start, "begin": begin, "feature": feature, "text": text}
            for text in pieces:
                ends = _ends_inside(text, inside)
                shift = int(inside)
                here = 0 if object_ is not None else None    # where the object's part of the piece begins
                for m in _TOKEN.finditer(('"' if inside else "") + text):
                    c = m[0][0]
                    if c == "{":
                        braces += 1
                        if braces == 2:
                            here, feature, object_, begin = m.start() - shift, brackets == 1, [], start
                            frame.append(text[:here] + "{}")
                    elif c != '"':
                        brackets += 1 if c == "[" else -1
                if here is None:
                    frame.append(text + "}")
                else:
                    object_.append(text[here:] + "}")
                braces -= not ends
                inside = ends
                if object_ is not None and braces < 2:
                    if begin == start:
                        out.append(row(0, "".join(object_), feature=feature))
                    else:
                        out.append(row(1, "".join(object_), begin, feature))
                    object_ = None
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, _CUT)
                    frame, out = [_RUN.sub("{}", "".join(frame))], []
            if object_ is not None:
                out.append(row(1, "".join(object_), begin, feature))
            out.append(row(2, _RUN.sub("{}", "".join(frame))))
            yield pa.RecordBatch.from_pylist(out, _CUT)
    return run


_CUT = pa.schema([("kind", pa.int32()), ("file", pa.string()), ("start", pa.int64()), ("begin", pa.int64()),
                  ("feature", pa.bool_()), ("text", pa.string())])


def _starts(effects: list) -> dict:
    """(in a string, braces, brackets, split of the open object) at each
    split's beginning, from one row per split and beginning."""
    files: dict = defaultdict(lambda: defaultdict(dict))
    for r in effects:
        files[r["file"]][r["start"]][r["inside"]] = r
    out = {}
    for file, splits in files.items():
        inside, braces, brackets, begin, read, size = 0, 0, 0, None, 0, 0
        for start in sorted(splits):
            r = splits[start][inside]
            out[file, start] = (bool(inside), braces, brackets, begin)
            if braces + r["lowest"] < 2:
                begin = start                    # whatever is open at its end was opened in this split
            inside, braces, brackets = r["ends"], braces + r["braces"], brackets + r["brackets"]
            read, size = read + r["bytes"], r["size"]
        # the reader takes the file's end for a "}"
        if inside or braces or brackets or read != size:
            tail = read == size + 1 and braces == -1 and not (inside or brackets)      # white space after the document
            if not tail:
                raise ValueError(f"malformed FeatureCollection: {file}")
    return out


def _check_frame(file: str, text: str, tail: bool) -> None:
    try:
        doc = json.loads(_RUN.sub("{}", text[:-1] if tail else text))
    except ValueError:
        raise ValueError(f"malformed FeatureCollection: {file}") from None
    if not isinstance(doc, dict) or not isinstance(doc.get("features"), list):
        raise ValueError(f"no FeatureCollection: {file}")
    if any(isinstance(v, list) and {} in v for k, v in doc.items() if k != "features"):
        raise ValueError(f"objects outside the features: {file}")


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row (text) per feature of the FeatureCollections at ``path``."""
    pieces = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"))
    effects = pieces.mapInArrow(_effect_task, "file string, start long, size long, bytes long, inside long, ends long, "
                                              "braces long, lowest long, brackets long").collect()   # two rows a split
    at = _starts(effects)
    cuts = reliable(pieces.mapInArrow(_cut_task(at), "kind int, file string, start long, begin long, feature boolean, text string"))
    frames: dict = defaultdict(list)
    for r in cuts.where("kind = 2").select("file", "start", "text").collect():                      # one row a split
        frames[r["file"]].append((r["start"], r["text"]))
    size = {r["file"]: r["size"] for r in effects}
    read: dict = defaultdict(int)
    for r in effects:
        read[r["file"]] += r["bytes"] if r["inside"] == 0 else 0
    for file, parts in frames.items():
        _check_frame(file, "".join(t for _, t in sorted(parts)), read[file] == size[file] + 1)
    parts = F.array_sort(F.collect_list(F.struct("start", "feature", "text")))
    joined = cuts.where("kind = 1").groupBy("file", "begin").agg(parts.alias("p")).select(
        F.col("p")[0]["feature"].alias("feature"), F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"))
    return cuts.where("kind = 0").select("feature", "text").unionByName(joined).where("feature").select("text")

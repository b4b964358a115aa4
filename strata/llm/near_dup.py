"""Near-duplicate groups by min-max hashing.

Each of ``PERMUTATIONS`` permutations of a document's shingle hashes gives
two signature values, its minimum and its maximum, so the signature is
twice as long as the hashes evaluated and its agreement rate is an
unbiased estimate of the Jaccard similarity with less variance than
independent minima.  The values are cut into bands of ``ROWS``; a pair with
similarity 0.85 shares none of the 32 bands in 1 of 10^10 cases (0.8: 1 of
10^7).

Linking never lists the pairs of a group:

1. documents with the same shingle set become one node (128-bit set sum);
2. in each band bucket every node is tried against the bucket's smallest
   node, its head, on the full sets; links to one head make one component;
3. nodes that share a bucket with a head but are not linked to it are then
   compared, on the full sets and in blocks, with each other and with the
   head's other nodes; a task returns a spanning forest of the links it
   finds, at most one per node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import kernel
from strata.llm.components import connected_components
from strata.llm.storage import cut, row_key, semi

PERMUTATIONS = 64        # hash evaluations per shingle; the signature has twice as many values
ROWS = 4                 # signature values per band
BANDS = 2 * PERMUTATIONS // ROWS
BLOCK = 1024             # nodes of either side compared at once
_COLUMNS = 4096          # shingles per step of that comparison

_XOR = kernel.hashed_words(PERMUTATIONS, "minmax xor")
_MUL = kernel.hashed_words(PERMUTATIONS, "minmax mul") | np.uint64(1)


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per document the minimum and maximum of each permutation (uint32)."""
    out = np.zeros((len(bounds) - 1, 2 * PERMUTATIONS), np.uint32)
    for i in range(PERMUTATIONS):
        h = (hashes ^ _XOR[i]) * _MUL[i]
        out[:, 2 * i] = reduce32(np.minimum, h, bounds)
        out[:, 2 * i + 1] = reduce32(np.maximum, h, bounds)
    return out


def reduce32(op, h, bounds):
    return (kernel.reduce_rows(op, h, bounds, 0) >> np.uint64(32)).astype(np.uint32)


def _named_sets(h: np.ndarray, bounds: np.ndarray):
    """Size, 128-bit sum and sorted members of each document's set."""
    n = np.zeros(len(bounds) - 1, np.int64)
    sums = np.zeros((len(bounds) - 1, 2), np.uint64)
    sets = []
    for d in range(len(n)):
        u = np.unique(h[bounds[d]:bounds[d + 1]])
        n[d] = len(u)
        sums[d] = u.sum(dtype=np.uint64), kernel.mix(u).sum(dtype=np.uint64)
        sets.append(u.view(np.int64))
    return n, sums.view(np.int64), sets


def _read_task(k: int):
    def run(batches):
        for batch in batches:
            for rows, buf, off in kernel.chunks(batch):
                words = kernel.Words(buf, off, "space")
                h, bounds = kernel.shingles(words, k)
                sig = signatures(h, bounds)
                n, sums, _ = _named_sets(h, bounds)
                raw = sig.tobytes()
                width = sig.shape[1] * 4
                yield pa.RecordBatch.from_pydict({
                    "doc_id": rows.column(0), "key": rows.column(2), "n": pa.array(n),
                    "s1": pa.array(sums[:, 0]), "s2": pa.array(sums[:, 1]),
                    "sig": pa.array([raw[i * width:(i + 1) * width] for i in range(len(n))], pa.binary())})
    return run


def _bands_task(batches):
    """(node, n, key) for each band of each signature."""
    for batch in batches:
        ids, n = batch.column(0), batch.column(1)
        sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS)
        key = np.zeros(sig.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
        for r in range(ROWS):
            key = kernel.mix(key ^ sig[:, :, r]) + np.uint64(r + 1)
        each = pa.array(np.repeat(np.arange(len(ids)), BANDS))
        yield pa.RecordBatch.from_pydict({"node": ids.take(each), "n": n.take(each),
                                          "key": pa.array(key.reshape(-1).view(np.int64))})


def _sets_task(k: int):
    def run(batches):
        for batch in batches:
            for rows, buf, off in kernel.chunks(batch):
                h, bounds = kernel.shingles(kernel.Words(buf, off, "space"), k)
                n, sums, sets = _named_sets(h, bounds)
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array(n), "s1": pa.array(sums[:, 0]), "s2": pa.array(sums[:, 1]),
                    "set": pa.array(sets, pa.list_(pa.int64()))})
    return run


def _groups(batches, n_keys: int):
    """Batches sorted by their first ``n_keys`` columns -> one table a group."""
    open_key, parts = None, []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(n_keys)], 1)
        cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(keys[a])
            if key != open_key and parts:
                yield pa.Table.from_batches(parts)
                parts = []
            open_key = key
            parts.append(batch.slice(a, b - a))
    if parts:
        yield pa.Table.from_batches(parts)


def _common(sets: list, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sorted sets, left by right."""
    out = np.zeros((len(left), len(right)), np.int64)
    if len(left) * len(right) <= 64:
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                out[i, j] = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        return out
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, n = np.unique(every, return_inverse=True, return_counts=True)
    place = np.cumsum(n > 1) - 1                   # only shingles of two sets or more matter
    some = n[column] > 1
    column, owner = place[column[some]], owner[some]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = int(column[-1]) + 1 if len(column) else 0
    for a in range(0, width, _COLUMNS):
        lo, hi = np.searchsorted(column, [a, a + _COLUMNS])
        has = np.zeros((len(sets), min(_COLUMNS, width - a)), np.float32)
        has[owner[lo:hi], column[lo:hi] - a] = 1
        out += np.rint(has[left] @ has[right].T).astype(np.int64)
    return out


def _blocks_task(percent: int):
    """Rows (head, i, j, side, node, set) sorted by block pair -> a spanning
    forest of the links between the sides (or within, if i = j)."""
    def run(batches):
        for t in _groups(batches, 3):
            side, node = t.column("side").to_numpy(), t.column("node").to_numpy()
            flat = t.column("set").combine_chunks()
            values, off = flat.values.to_numpy(zero_copy_only=False), flat.offsets.to_numpy()
            sets = [values[off[x]:off[x + 1]] for x in range(len(node))]
            size = np.diff(off).astype(np.int64)
            same = t.column("i")[0].as_py() == t.column("j")[0].as_py()
            left = np.arange(len(node)) if same else np.flatnonzero(side == 0)
            right = left if same else np.flatnonzero(side == 1)
            both = _common(sets, left, right)
            linked = both * 100 >= (size[left][:, None] + size[right][None, :] - both) * percent
            parent = np.arange(len(node))

            def top(x):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x
            found = []
            for i, j in np.argwhere(linked):
                x, y = top(left[i]), top(right[j])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((node[left[i]], node[right[j]]))
            if found:
                a, b = np.array(found, np.int64).T
                yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})
    return run


_SET = ["n", "s1", "s2"]       # size and 128-bit sum name a shingle set


def _linked_sets(source: DataFrame, k: int, percent: int, same_ids: bool) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, n, s1, s2) of ``source`` (doc_id, text, key), and
    the distinct sets (n, s1, s2, component).  With ``same_ids`` the sets of
    one doc_id are linked too."""
    read = cut(source.mapInArrow(_read_task(k), "doc_id long, key string, n long, s1 long, s2 long, sig binary"))
    rows = read.where("n > 0 and doc_id is not null")
    # a node is a set; ``low``, its smallest doc_id, only finds a text of it again
    sets = cut(rows.groupBy(*_SET).agg(F.min("doc_id").alias("low")).withColumn("node", F.monotonically_increasing_id()))
    nodes = cut(rows.join(sets, _SET).where("doc_id = low").select("node", "n", "sig").dropDuplicates(["node"]))
    bands = nodes.mapInArrow(_bands_task, "node long, n long, key long")
    heads = bands.groupBy("key").agg(F.min(F.struct("node", "n")).alias("head"), F.count("*").alias("m")).where("m > 1")
    shared = bands.join(heads, "key").select("node", "head")               # buckets with company only
    star = cut(shared.where("node <> head.node").select(F.col("head.node").alias("head"), "node").distinct())
    needed = sets.join(star.select(F.explode(F.array("head", "node")).alias("node")).distinct(), "node")
    full = cut(semi(source.select("doc_id", "text"), needed.select("low"), "doc_id", keep=True)
               .mapInArrow(_sets_task(k), "n long, s1 long, s2 long, set array<long>").dropDuplicates(_SET)
               .join(needed.select(*_SET, "node"), _SET).select("node", "set"))
    both = F.size(F.array_intersect("x", "set"))
    tried = cut(star.join(full, "node").join(full.select(F.col("node").alias("head"), F.col("set").alias("x")), "head")
                .select("head", "node", "set", (both * 100 >= (F.size("x") + F.size("set") - both) * percent).alias("linked")))
    links = tried.where("linked").select(F.col("head").alias("a"), F.col("node").alias("b"))
    # families: a head and what shares a bucket with it; linked nodes need no look at each other
    open_heads = (tried.groupBy("head").agg(F.count_if("linked").alias("n_in"), F.count_if(~F.col("linked")).alias("n_out"))
                  .where("n_out > 0")
                  .select("head", F.ceil((F.col("n_in") + 1) / BLOCK).alias("parts_in"),
                          F.ceil(F.col("n_out") / BLOCK).alias("parts_out")))
    family = (tried.join(open_heads, "head").unionByName(
                  open_heads.join(full.withColumnRenamed("node", "head"), "head")
                  .select("head", F.col("head").alias("node"), "set", F.lit(True).alias("linked"), "parts_in", "parts_out"))
              .withColumn("part", F.pmod(F.xxhash64("node"), F.when(F.col("linked"), F.col("parts_in"))
                                         .otherwise(F.col("parts_out")))))
    # blocks of unlinked nodes are numbered 0, 1, .., those of linked nodes -1, -2, ..
    inside = (family.where("linked").withColumn("j", F.explode(F.expr("sequence(0L, parts_out - 1)")))
              .select("head", (-F.col("part") - 1).alias("i"), "j", F.lit(0).alias("side"), "node", "set"))
    outside = family.where("not linked")
    meet_in = (outside.withColumn("i", F.explode(F.expr("sequence(-parts_in, -1L)")))
               .select("head", "i", F.col("part").alias("j"), F.lit(1).alias("side"), "node", "set"))
    meet_out = (outside.withColumn("o", F.explode(F.expr("sequence(0L, parts_out - 1)")))
                .select("head", F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"),
                        F.when(F.col("part") <= F.col("o"), 0).otherwise(1).alias("side"), "node", "set"))
    blocks = (inside.unionByName(meet_in).unionByName(meet_out)
              .repartition(F.col("head"), F.col("i"), F.col("j")).sortWithinPartitions("head", "i", "j"))
    more = cut(blocks.mapInArrow(_blocks_task(percent), "a long, b long").distinct())
    links = links.union(more)
    if same_ids:
        name = F.struct(*_SET)
        many = (rows.groupBy("doc_id").agg(F.min(name).alias("a"), F.max(name).alias("b")).where("a <> b").select("doc_id"))
        of_ids = cut(rows.select("doc_id", *_SET).join(many, "doc_id").distinct().join(sets, _SET).select("doc_id", "node"))
        first = of_ids.groupBy("doc_id").agg(F.min("node").alias("a"))
        links = links.union(of_ids.join(first, "doc_id").where("node <> a").select("a", F.col("node").alias("b")))
    comps = connected_components(links)
    return read.drop("sig"), cut(sets.join(comps, "node", "left").select(
        *_SET, "low", F.coalesce("component", "node").alias("component")))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id, kept).

    Words are runs of anything but white space, A-Z lower-cased; a
    document's set holds its distinct ``k``-word shingles (its whole word
    sequence if shorter).  Documents are linked when 100 * intersection >=
    percent * union, and ``component_id`` is the smallest doc_id reachable.
    Null, empty and wordless texts have no shingles and no links.  Rows that
    repeat a doc_id are one document, linked by each of its texts; a row
    without doc_id links with nothing and is kept with a null component.  No
    rows give no rows.
    """
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                         F.lit("").alias("key"))
    read, sets = _linked_sets(source, k, percent, same_ids=True)
    least = sets.groupBy("component").agg(F.min("low").alias("least"))
    labels = sets.join(least, "component").select(*_SET, "least")
    return (read.select("doc_id", *_SET).join(labels, _SET, "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("least")))
                    .otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (all columns) with one row of each group, that of the
    smallest doc_id (of equal ones, the smallest ``row_key``).  Rows are
    linked by their own texts: a clean text stays though another row has its
    id.  Rows without words or without doc_id stay."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("key"))
    read, sets = _linked_sets(source, k, percent, same_ids=False)
    rows = cut(read.where("n > 0 and doc_id is not null").join(sets, _SET)
               .groupBy("component", "doc_id", "key").agg(F.count("*").alias("rows")))
    best = rows.groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("best"))
    told = rows.join(best, "component")
    mine = F.struct("doc_id", "key") == F.col("best")
    out = semi(docs, told.where(~mine).select("key"), row_key(), keep=False)
    again = cut(told.where(mine & (F.col("rows") > 1)).select("key"))
    if again.isEmpty():
        return out
    once = semi(out, again, row_key(), keep=True).withColumn("__row", row_key()).dropDuplicates(["__row"]).drop("__row")
    return semi(out, again, row_key(), keep=False).unionByName(once)

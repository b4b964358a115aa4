"""Classification trees grown best split first, to a bound on their leaves.

Spark bounds a tree by depth only.  ``grow`` opens the leaf whose split
lowers the Gini impurity, weighted by its rows, most, until the tree has
``max_nodes`` leaves.  Rows are binned once by quantiles and carry the
number of their leaf; a round counts (leaf, feature, bin, class) for all
leaves at once, map-side combined, and finds each leaf's best split: from
the counts on the driver if there are at most ``CELLS``, else in Spark.  Which leaves the next round needs is known from a trial run of the
opening order over the leaves known so far: it opens every leaf that the
final order can open, so a round can look at all their children together,
and there are as many rounds as the tree has levels, not leaves.  Only one
row per leaf reaches the driver, so ``max_nodes`` bounds it.

A tree keeps its opening order, so the tree of any smaller bound is a cut
of it: a class per leaf of the large tree.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from strata.session import reliable

BINS = 32                # bins per feature
LEAST_GAIN = 1e-9        # a split must lower the weighted impurity by more
MAX_CLASSES = 1000
CELLS = 1 << 15          # counts of a round that are brought to the driver, at most
_CUT = 8                 # rounds after which the rows are written to the checkpoint folder


def _thresholds(data: DataFrame, inputs: list[str], bins: int) -> list[list[float]]:
    """Distinct quantiles of each feature (of rank error 1 / 10,000 at most),
    ascending; a split is x <= one of them."""
    probs = [i / bins for i in range(1, bins)]
    each = [F.col(f"`{c}`").cast("double") for c in inputs]
    r = data.agg(*[F.percentile_approx(F.when(~F.isnan(x), x), probs, 10_000).alias(f"q{i}") for i, x in enumerate(each)]).first()
    return [sorted(set(q or [])) for q in r]


def _binned(data: DataFrame, inputs: list[str], cuts: list[list[float]], y: Column) -> DataFrame:
    """(b: bin numbers, y, node 0) per row.  The features are columns of a
    projection of their own, so each is computed once per row, not once for
    every threshold that it is compared with."""
    x = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, c in enumerate(inputs)]

    def above(i, cut):
        return sum(((F.col(f"x{i}") > t).cast("int") for t in cut), F.lit(0))
    return data.select(y.cast("int").alias("y"), *x).select(
        F.array(*[above(i, cut) for i, cut in enumerate(cuts)]).alias("b"), "y", F.lit(0).alias("node"))


def _counted(rows: DataFrame, classes: list[float]) -> DataFrame:
    """Rows of each class ``c0``, ``c1``, ... per (node, f, bin)."""
    return rows.select("node", "y", F.posexplode("b").alias("f", "bin")).groupBy("node", "f", "bin").agg(
        *[F.count_if(F.col("y") == i).alias(f"c{i}") for i in range(len(classes))])


def _few_splits(rows: DataFrame, classes: list[float]) -> list:
    """``_best_splits`` from the counts themselves."""
    k = len(classes)
    cells: dict = {}
    for r in sorted(map(tuple, _counted(rows, classes).collect())):
        cells.setdefault(r[0], {}).setdefault(r[1], []).append((r[2], np.array(r[3:], np.int64)))

    def purity(c):
        return float((c * c).sum()) / float(c.sum())
    out = []
    for node, features in cells.items():
        best = None
        for f, parts in features.items():
            total, left = sum(c for _, c in parts), np.zeros(k, np.int64)
            for b, c in parts:
                left = left + c
                right = total - left
                gain = purity(left) + purity(right) - purity(total) if right.sum() else -1.0
                if best is None or (gain, -f, -b) > best[:3]:
                    best = (gain, -f, -b, total)
        out.append((node, best[0], -best[1], -best[2], [int(x) for x in best[3]]))
    return out


def _best_splits(rows: DataFrame, classes: list[float]) -> list:
    """Per leaf (node): class counts ``c``, and the split of largest gain,
    ties to the first feature and the lowest bin; gain -1 without one."""
    k = range(len(classes))
    cells = _counted(rows, classes)
    part = Window.partitionBy("node", "f")
    upto = part.orderBy("bin")
    cells = cells.select("node", "f", "bin", *[F.sum(f"c{i}").over(upto).alias(f"l{i}") for i in k],
                         *[F.sum(f"c{i}").over(part).alias(f"t{i}") for i in k])

    def purity(counts):
        squares, n = None, None
        for x in counts:
            squares = x * x if squares is None else squares + x * x
            n = x if n is None else n + x
        return squares.cast("double") / n
    left, total = [F.col(f"l{i}") for i in k], [F.col(f"t{i}") for i in k]
    right = [t - x for t, x in zip(total, left)]
    some = right[0]
    for x in right[1:]:
        some = some + x
    gain = F.when(some > 0, purity(left) + purity(right) - purity(total)).otherwise(F.lit(-1.0))
    return cells.groupBy("node").agg(
        F.max(F.struct(gain.alias("gain"), (-F.col("f")).alias("f"), (-F.col("bin")).alias("bin"))).alias("s"),
        F.first(F.array(*total)).alias("c")).select("node", "s.gain", -F.col("s.f"), -F.col("s.bin"), "c").collect()


def _opening_order(nodes: list[dict], max_nodes: int) -> list[int]:
    """Nodes in the order in which they are opened, as far as they are known."""
    heap, order, found = [], [], 0

    def offer(i):
        nonlocal found
        if nodes[i]["gain"] > LEAST_GAIN:
            heapq.heappush(heap, (-nodes[i]["gain"], found, i))
        found += 1
    offer(0)
    while heap and len(order) < max_nodes - 1:
        i = heapq.heappop(heap)[2]
        order.append(i)
        if nodes[i]["l"] is not None:
            offer(nodes[i]["l"])
            offer(nodes[i]["r"])
    return order


def grow(data: DataFrame, inputs: list[str], label: str, max_nodes: int, bins: int = BINS) -> list[dict]:
    """The tree as a list of nodes, the root first: class ``p``; for opened
    nodes the place ``o`` in the opening order (from 1), feature number
    ``f``, threshold ``t`` (x <= t goes left) and the children ``l``, ``r``.

    NULL and NaN features sort above all values; rows with a NULL label are
    left out; without rows there is one leaf of class NaN.
    """
    spark = data.sparkSession
    data = data.where(F.col(label).isNotNull())
    classes = sorted(float(r[0]) for r in data.select(F.col(label).cast("double")).distinct().limit(MAX_CLASSES + 1).collect())
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    if not classes:
        return [{"p": float("nan")}]
    cuts = _thresholds(data, inputs, bins)
    y = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label).cast("double")) - 1
    rows = _binned(data, inputs, cuts, y).persist(StorageLevel.MEMORY_AND_DISK)
    nodes: list[dict] = []

    def look(rows, new):
        few = new * sum(len(t) + 1 for t in cuts) <= CELLS
        for node, gain, f, b, counts in sorted((_few_splits if few else _best_splits)(rows, classes)):
            assert node == len(nodes)
            nodes.append({"gain": gain, "f": f, "b": b, "l": None, "r": None,
                          "p": classes[max(range(len(classes)), key=lambda i: (counts[i], -i))]})
    look(rows, 1)
    held, rounds, first = [rows], 0, 0
    while True:
        order = _opening_order(nodes, max_nodes)
        fresh = [i for i in order if nodes[i]["l"] is None]
        if not fresh:
            break
        # only leaves of the last round can be opened; an array of their moves, which the planner builds once
        moves: list = [None] * (len(nodes) - first)
        for j, i in enumerate(fresh):
            nodes[i]["l"], nodes[i]["r"] = len(nodes) + 2 * j, len(nodes) + 2 * j + 1
            moves[i - first] = {"f": nodes[i]["f"], "bin": nodes[i]["b"], "l": nodes[i]["l"], "r": nodes[i]["r"]}
        told = F.from_json(F.lit(json.dumps(moves)), "array<struct<f:int,bin:int,l:int,r:int>>")
        # rows of leaves that stay closed are done
        rows = rows.withColumn("m", F.element_at(told, F.col("node") - first + 1)).where("m is not null").select("b", "y", F.when(
            F.element_at("b", F.col("m.f") + 1) <= F.col("m.bin"), F.col("m.l")).otherwise(F.col("m.r")).alias("node"))
        first = len(nodes)
        rounds += 1
        rows = reliable(rows) if rounds % _CUT == 0 else rows.persist(StorageLevel.MEMORY_AND_DISK)
        look(rows, 2 * len(fresh))
        held.append(rows)
        if len(held) > 2:
            held.pop(0).unpersist()
    for r in held:
        r.unpersist()
    # what was opened, numbered anew
    place, out = {i: n for n, i in enumerate(order, 1)}, []

    def keep(i):
        at = len(out)
        out.append({"p": nodes[i]["p"]})
        todo.append((i, at))
        return at
    todo: list = []
    keep(0)
    while todo:
        i, at = todo.pop()
        if i in place:
            n = nodes[i]
            out[at] |= {"o": place[i], "f": n["f"], "t": cuts[n["f"]][n["b"]], "l": keep(n["l"]), "r": keep(n["r"])}
    return out


def leaf_classes(tree: list[dict], max_nodes: int) -> dict[int, float]:
    """Class of each leaf of the tree in the tree cut to ``max_nodes`` leaves."""
    out, todo = {}, [(0, None)]
    while todo:
        i, told = todo.pop()
        node = tree[i]
        if told is None and node.get("o", max_nodes) >= max_nodes:
            told = node["p"]                     # closed in the cut tree
        if "o" in node:
            todo += [(node["l"], told), (node["r"], told)]
        else:
            out[i] = told
    return out


def n_leaves(tree: list[dict], max_nodes: int | None = None) -> int:
    """Leaves of the tree, or of its cut to ``max_nodes``."""
    opened = sum("o" in n for n in tree)
    return 1 + (opened if max_nodes is None else min(opened, max_nodes - 1))


def _depth(tree: list[dict]) -> int:
    most, todo = 0, [(0, 0)]
    while todo:
        i, d = todo.pop()
        most = max(most, d)
        if "o" in tree[i]:
            todo += [(tree[i]["l"], d + 1), (tree[i]["r"], d + 1)]
    return most


def leaf_of(tree: list[dict], inputs: list[str]) -> Column:
    """Number of the leaf that a row falls into: a walk down an array of
    nodes, which the planner builds once.  The row's features are computed
    once, not on every step."""
    rows = [{"f": n.get("f", -1), "t": n.get("t", 0.0), "l": n.get("l", 0), "r": n.get("r", 0)} for n in tree]
    nodes = F.from_json(F.lit(json.dumps(rows)), "array<struct<f:int,t:double,l:int,r:int>>")
    x = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in inputs])
    depth = _depth(tree)
    if not depth:
        return F.lit(0)

    def walk(row):
        def step(at, _):
            n = F.element_at(nodes, at + 1)
            return F.when(n["f"] < 0, at).when(F.element_at(row, n["f"] + 1) <= n["t"], n["l"]).otherwise(n["r"])
        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)
    return F.element_at(F.transform(F.array(x), walk), 1)


class _TreeParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "numeric feature columns", typeConverter=TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "class column (a number)", typeConverter=TypeConverters.toString)
    maxNodes = Param(Params._dummy(), "maxNodes", "leaves at most", typeConverter=TypeConverters.toInt)
    bins = Param(Params._dummy(), "bins", "bins per feature", typeConverter=TypeConverters.toInt)
    predictionCol = Param(Params._dummy(), "predictionCol", "predicted class", typeConverter=TypeConverters.toString)
    leafCol = Param(Params._dummy(), "leafCol", "number of the row's leaf; none if empty", typeConverter=TypeConverters.toString)


class BoundedTree(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """A tree of at most ``maxNodes`` leaves, opened best split first, as a
    stage of a pipeline."""

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol="label", maxNodes=32, bins=BINS, predictionCol="predicted", leafCol=""):
        super().__init__()
        self._setDefault(labelCol="label", maxNodes=32, bins=BINS, predictionCol="predicted", leafCol="")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> BoundedTreeModel:
        get = self.getOrDefault
        tree = grow(dataset, get("inputCols"), get("labelCol"), get("maxNodes"), get("bins"))
        return self._copyValues(BoundedTreeModel(state=json.dumps(tree)))


class BoundedTreeModel(Model, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted tree.  It is one of the stage's parameters, so it is
    written and read with the pipeline."""

    state = Param(Params._dummy(), "state", "the tree's nodes as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state=None):
        super().__init__()
        self._setDefault(labelCol="label", maxNodes=32, bins=BINS, predictionCol="predicted", leafCol="")
        self._set(**self._input_kwargs)

    @property
    def tree(self) -> list[dict]:
        return json.loads(self.getOrDefault("state"))

    @property
    def n_leaves(self) -> int:
        return n_leaves(self.tree)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get, tree = self.getOrDefault, self.tree
        classes = F.from_json(F.lit(json.dumps([n["p"] for n in tree])), "array<double>", {"allowNonNumericNumbers": "true"})
        leaf = get("leafCol") or "_leaf_of_row"
        out = dataset.withColumn(leaf, leaf_of(tree, get("inputCols")))
        out = out.withColumn(get("predictionCol"), F.element_at(classes, F.col(leaf) + 1))
        return out if get("leafCol") else out.drop(leaf)

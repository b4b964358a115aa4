"""Mixing sources to target weights by hierarchical budgeting.

The level columns (say domain, language, source) make a tree.  A token
budget is handed down it: a node's children share its budget by weight, but
none gets more than the tokens below it can give in ``epochs`` passes; what
a short child cannot take goes to its siblings, and only what all siblings
together cannot take is left to the level above, because a node's share was
bounded by the capacity of its whole subtree before.  A leaf's budget is
spent on whole passes over its documents and, in the next pass, on a prefix
in the seeded order of that pass: documents are taken while the tokens
before them are below the rest of the budget.

All quantities are whole tokens; shares are rounded down, so up to one
token per child may stay unspent.  DataFrame functions only.

A leaf may hold any part of the rows: its order is cut into ``BUCKETS``
hash ranges, whose totals are pre-aggregated, and only the range in which
the budget ends is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.storage import cut

BUCKETS = 4096           # three hexadecimal digits
LEAVES = 1 << 17         # leaves of at most this many are sent to every task
WORD = r"[^\x20\x09-\x0D]+"
_WIDE = "decimal(38,0)"

# production parameters of the query and of the pipeline
LEVELS = ["domain", "lang", "source"]
WEIGHTS = [{"web": 4, "books": 3, "forum": 2, "reference": 2}, {"en": 5, "de": 2, "fr": 2, "es": 2}, {}]
EPOCHS = 2
PERCENT = 60             # of the corpus' tokens that the mixture has
SEED = "mix-1"


def n_tokens(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def domain(source: Column) -> Column:
    """The domain of a source, by the number at its end: five sources each."""
    n = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    n = F.when(n == "", -1).otherwise(n.cast("int"))
    return (F.when(n.between(0, 4), "web").when(n.between(5, 9), "books").when(n.between(10, 14), "forum")
            .when(n.between(15, 19), "reference").otherwise("other"))


def _weight(column: str, weights: dict) -> Column:
    out = F.lit(1)
    for value, w in weights.items():
        out = F.when(F.col(column) == value, w).otherwise(out)
    return out.cast(_WIDE)


def budgets(leaves: DataFrame, levels: list[str], weights: list[dict], total: Column, epochs: int) -> DataFrame:
    """(levels..., supply, budget) of each leaf from (levels..., supply).

    ``weights``: per level {value: whole number >= 0}, 1 where not named.
    A child of weight 0, or below a parent without budget, gets nothing.
    """
    leaves = leaves.withColumn("cap", F.col("supply").cast(_WIDE) * epochs)
    root = leaves.agg(F.coalesce(F.sum("cap"), F.lit(0)).cast(_WIDE).alias("cap"))
    nodes = root.select(F.least(F.col("cap"), total.cast(_WIDE)).alias("budget"), F.lit(1).alias("__root"))
    above: list[str] = ["__root"]
    for i, level in enumerate(levels):
        path = levels[:i + 1]
        group = Window.partitionBy(*above)
        first = group.orderBy(F.col("ratio").asc_nulls_last(), level)
        child = (leaves.groupBy(*path).agg(F.sum("cap").cast(_WIDE).alias("cap")).withColumn("__root", F.lit(1))
                 .withColumn("w", _weight(level, weights[i]))
                 .withColumn("ratio", F.try_divide(F.col("cap").cast("double"), F.col("w").cast("double"))))
        child = (child.join(nodes.select(*above, F.col("budget").alias("b")), above) if i else
                 child.withColumn("b", nodes.select("budget").scalar()))
        child = (child.withColumn("c_before", F.coalesce(F.sum("cap").over(first.rowsBetween(
                     Window.unboundedPreceding, -1)), F.lit(0)).cast(_WIDE))
                 .withColumn("w_left", (F.sum("w").over(group) - F.coalesce(F.sum("w").over(first.rowsBetween(
                     Window.unboundedPreceding, -1)), F.lit(0))).cast(_WIDE))
                 # a child is short if its share of what is left exceeds what it has
                 .withColumn("short", (F.col("w") > 0) & (F.col("cap") * F.col("w_left")
                                                          <= (F.col("b") - F.col("c_before")) * F.col("w"))))
        rest = (F.col("b") - F.coalesce(F.sum(F.when(F.col("short"), F.col("cap"))).over(group), F.lit(0))).cast(_WIDE)
        open_w = F.sum(F.when(~F.col("short"), F.col("w"))).over(group).cast(_WIDE)
        child = child.withColumn("rest", rest).withColumn("open_w", open_w).withColumn(
            "budget", F.when(F.col("short"), F.col("cap")).when(F.col("open_w") > 0, F.expr(
                "cast(rest * w div open_w as decimal(38,0))")).otherwise(0).cast(_WIDE))
        nodes = child.select(*path, "budget")
        above = path
    return leaves.join(nodes, levels).select(*levels, "supply", F.col("budget").cast("long").alias("budget"))


def _order(seed: str, epoch: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.col("__id")))


def plan(rows: DataFrame, levels: list[str], weights: list[dict], percent: int, epochs: int, seed: str) -> DataFrame:
    """For each leaf (levels..., supply, budget, full, last): ``full`` passes
    over all its documents, then one up to the order key ``last`` (null: none)."""
    leaves = cut(rows.groupBy(*levels).agg(F.sum("__tokens").alias("supply")))
    total = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("t")).select(
        F.expr(f"t * {int(percent)} div 100")).scalar()
    leaves = cut(budgets(leaves, levels, weights, total, epochs)
                 .withColumn("full", F.when(F.col("supply") > 0, F.expr("budget div supply")).otherwise(0))
                 .withColumn("part", F.col("budget") - F.col("full") * F.col("supply")))
    some = leaves.where("part > 0").select(*levels, "full", "part")
    keyed = rows.join(some, levels).withColumn("__h", _order(seed, F.col("full")))
    bucket = F.conv(F.substring("__h", 1, 3), 16, 10).cast("int").alias("bucket")
    ends = (keyed.groupBy(*levels, "part", bucket).agg(F.sum("__tokens").alias("n"))
            .withColumn("upto", F.sum("n").over(Window.partitionBy(*levels).orderBy("bucket")))
            .where("upto >= part and upto - n < part")
            .groupBy(*levels).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("end")))
    inside = (keyed.withColumn("bucket", bucket).join(ends, levels).where("bucket = end.bucket")
              .groupBy(*levels, "part", "end.before", F.struct("__h", "__id").alias("key"))
              .agg(F.sum("__tokens").alias("n"))
              .withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy(*levels).orderBy("key")))
              .where("upto - n < part").groupBy(*levels).agg(F.max("key").alias("last")))
    return cut(leaves.join(inside, levels, "left").select(*levels, "supply", "budget", "full", "last"))


def mix(docs: DataFrame, levels: list[str] | None = None, weights: list[dict] | None = None, percent: int = PERCENT,
        epochs: int = EPOCHS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` once for each pass that takes it, with the columns
    ``mix_epoch`` (from 0) and ``mix_tokens`` added, and ``domain`` where
    ``docs`` has none and the levels name it.

    Null level values are a level value of their own, written ''.  Rows that
    share an id within a leaf are taken together.  Documents without tokens
    are taken where their place in the order is taken.  No rows, no tokens
    or no weight give no rows.
    """
    levels, weights = levels or LEVELS, weights or WEIGHTS
    if "domain" in levels and "domain" not in docs.columns:
        docs = docs.withColumn("domain", domain(F.col("source")))
    names = [f"__{c}" for c in levels]
    rows = docs.select("*", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in zip(levels, names)],
                       F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("__id"),
                       n_tokens(F.col(f"`{text_col}`")).alias("__tokens"))
    by_name = [dict(w) for w in weights]
    light = cut(rows.select(*names, "__id", "__tokens"))
    leaf = plan(light, names, by_name, percent, epochs, seed)
    if leaf.limit(LEAVES + 1).count() <= LEAVES:       # then the texts stay where they are
        leaf = F.broadcast(leaf)
    taken = rows.join(leaf, names).withColumn("mix_epoch", F.explode(F.expr(
        "case when last is null and full = 0 then cast(array() as array<int>) "
        "else sequence(0, cast(full as int) - if(last is null, 1, 0)) end")))
    taken = taken.where((F.col("mix_epoch") < F.col("full"))
                        | (F.struct(_order(seed, F.col("mix_epoch")).alias("__h"), "__id") <= F.col("last")))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns], "mix_epoch", F.col("__tokens").alias("mix_tokens"))

"""Connected components of a link table by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.storage import cut


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; the component is
    the smallest node reachable.

    Alternating large-star and small-star rounds: every node links its
    larger neighbours, then its smaller ones, to its smallest neighbour.
    A round is two map-side combined groupings of the link table, the
    number of rounds is logarithmic, and the links only ever point at a
    smaller node, so a hub's links are spread over its neighbours.  Nulls
    and self links are dropped; no links give no rows.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .distinct())
    before = None
    while True:
        # large star: for each node, strictly larger neighbours -> smallest of the neighbourhood
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        big = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .where("u <> v").distinct())
        # small star: smaller neighbours and the node itself -> smallest of them
        least = big.groupBy("u").agg(F.min("v").alias("m"))
        small = (big.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
            .where("u <> v").distinct())
        edges = cut(small)
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())

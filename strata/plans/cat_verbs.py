"""Projections, filters, sorts, samples, splits, folds and set operations."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import column_name_fn
from strata.operators import ordering, verbs
from strata.operators.joins import lookup_join
from strata.plans import views
from strata.plans.registry import query, rounded
from strata.plans.views import with_views
from strata.sources.tables import table

SEED = 1


def _md5(key_sql: str, seed: int = SEED) -> str:
    """DuckDB form of ``hash_key``: md5 of 'key:seed'."""
    return f"md5(CAST({key_sql} AS VARCHAR) || ':{seed}')"


def _unit(key_sql: str, seed: int = SEED) -> str:
    """DuckDB form of ``hash_unit``."""
    return f"(CAST(('0x' || substr({_md5(key_sql, seed)}, 1, 13)) AS BIGINT) / 4503599627370496.0)"


@query("project_select", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def project_select(spark, d):
    return verbs.select_columns(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


@query("project_drop", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
    l_extendedprice, l_returnflag, l_linestatus FROM lineitem""")
def project_drop(spark, d):
    return verbs.drop_columns(table(spark, d, "lineitem"), ["l_discount", "l_tax", "l_shipdate"])


@query("project_rename", """SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal,
    c_mktsegment FROM customer""")
def project_rename(spark, d):
    return verbs.rename_columns(table(spark, d, "customer"), {"c_custkey": "id", "c_name": "name"})


@query("rename_all", """SELECT o_orderkey AS "o-orderkey", o_custkey AS "o-custkey",
    o_orderstatus AS "o-orderstatus", o_totalprice AS "o-totalprice", o_orderdate AS "o-orderdate",
    o_orderpriority AS "o-orderpriority" FROM orders""")
def rename_all(spark, d):
    return verbs.rename_all(table(spark, d, "orders"), column_name_fn)


@query("add_column", """SELECT l_orderkey, l_linenumber,
    round(l_extendedprice * (1 - l_discount), 6) AS revenue FROM lineitem""")
def add_column(spark, d):
    li = table(spark, d, "lineitem")
    out = verbs.add_column(li, "revenue", lambda ds: ds["l_extendedprice"] * (1 - ds["l_discount"]))
    return rounded(out.select("l_orderkey", "l_linenumber", "revenue"))


@query("add_columns", """SELECT l_orderkey, l_linenumber,
    round(l_extendedprice * (1 - l_discount), 6) AS net,
    round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS gross,
    l_quantity > 25 AS big FROM lineitem""")
def add_columns(spark, d):
    """Several columns in one call; ``gross`` repeats ``net``'s formula because
    every expression of one call sees only the input columns."""
    li = table(spark, d, "lineitem")
    out = verbs.add_columns(li, {
        "net": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "gross": F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")),
        "big": F.col("l_quantity") > 25})
    return rounded(out.select("l_orderkey", "l_linenumber", "net", "gross", "big"))


@query("add_constant", "SELECT o_orderkey, 0.0::DOUBLE AS prediction, 3 AS class FROM orders")
def add_constant(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return verbs.add_constant(verbs.add_constant(o, "prediction", 0.0), "class", 3)


@query("zip_by_position", """
SELECT a.pos, a.o_orderkey, b.o_totalprice FROM
 (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders) a
 JOIN (SELECT o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS pos
       FROM orders) b ON a.pos = b.pos""")
def zip_by_position(spark, d):
    """i-th smallest order key next to the i-th largest total price."""
    o = table(spark, d, "orders")
    a = ordering.positions(o.select("o_orderkey"), ["o_orderkey"])
    b = ordering.positions(o.select("o_orderkey", "o_totalprice"),
                           [("o_totalprice", "desc"), "o_orderkey"]).drop("o_orderkey")
    return verbs.zip_by_position(a, b, "pos").select("pos", "o_orderkey", "o_totalprice")


@query("verb_chain", """
SELECT o_orderkey AS "order", o_totalprice AS price, round(o_totalprice * 1.1, 6) AS gross, 'EUR' AS currency
FROM orders WHERE o_orderstatus = 'F'""")
def verb_chain(spark, d):
    """A reusable chain of verbs: filter, select, rename, add columns."""
    return rounded(verbs.transform_chain(
        table(spark, d, "orders"),
        lambda df: df.filter(F.col("o_orderstatus") == "F"),
        lambda df: verbs.select_columns(df, ["o_orderkey", "o_totalprice"]),
        lambda df: verbs.rename_columns(df, {"o_orderkey": "order", "o_totalprice": "price"}),
        lambda df: verbs.add_column(df, "gross", F.col("price") * 1.1),
        lambda df: verbs.add_constant(df, "currency", "EUR")))


@query("shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem")
def shape(spark, d):
    return verbs.shape(table(spark, d, "lineitem"))


@query("materialise", f"SELECT o_orderkey, {_unit('o_orderkey')} AS u FROM orders")
def materialise(spark, d):
    """Pin a derived frame (hash-noise column) so two actions see one copy."""
    from strata.functions.hashing import hash_unit
    o = table(spark, d, "orders").select("o_orderkey", hash_unit("o_orderkey").alias("u"))
    return verbs.materialise(o)


@query("filter_predicate", """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
    WHERE l_quantity <= 25 AND l_returnflag = 'R'""")
def filter_predicate(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return li.filter((F.col("l_quantity") <= 25) & (F.col("l_returnflag") == "R"))


# The row numbers picked by the positional-selection query.
PICK_ROWS = [1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597, 2584, 4181]


@query("rows_by_number", f"""
SELECT o_orderkey, o_totalprice, rn FROM
 (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
WHERE rn IN ({", ".join(str(r) for r in PICK_ROWS)})""")
def rows_by_number(spark, d):
    """Rows at given 1-based row numbers (key order): number the rows, then
    semi-join the (broadcast, fixed-size) list of wanted numbers."""
    o = ordering.row_numbers(table(spark, d, "orders").select("o_orderkey", "o_totalprice"),
                             "o_orderkey", col="rn")
    wanted = spark.createDataFrame([(r,) for r in PICK_ROWS], "rn long")
    return o.join(F.broadcast(wanted), "rn", "left_semi").select("o_orderkey", "o_totalprice", "rn")


@query("sort_asc_desc", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST")
def sort_asc_desc(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return ordering.sort_by(c, "c_acctbal", descending=True)


@query("topk_duration", with_views("SELECT id, k, dur FROM trips ORDER BY dur DESC, id LIMIT 200", "trips"))
def topk_duration(spark, d):
    return ordering.top_k(views.trips(spark, d).select("id", "k", "dur"), "dur", 200, tie_break="id")


@query("head_n", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def head_n(spark, d):
    return ordering.head_n(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                           5, "o_orderkey")


@query("sample_n", f"""SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY {_md5('o_orderkey')}, o_orderkey LIMIT 1000""")
def sample_n(spark, d):
    return ordering.sample_n(table(spark, d, "orders").select("o_orderkey", "o_totalprice"),
                             1000, "o_orderkey", seed=SEED)


@query("shuffle", f"""SELECT o_orderkey,
    row_number() OVER (ORDER BY {_md5('o_orderkey')}, o_orderkey) - 1 AS shuffle_pos FROM orders""")
def shuffle(spark, d):
    return ordering.shuffle_positions(table(spark, d, "orders").select("o_orderkey"), "o_orderkey",
                                      seed=SEED)


@query("train_test_split", f"""SELECT o_orderkey,
    CASE WHEN {_unit('o_orderkey')} < 0.7 THEN 'train' ELSE 'test' END AS split FROM orders""")
def train_test_split(spark, d):
    return ordering.train_test_split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey",
                                     0.7, seed=SEED)


@query("kfold_assign", f"""SELECT c_custkey,
    CAST((row_number() OVER (ORDER BY {_md5('c_custkey')}, c_custkey) - 1) % 20 AS INTEGER) AS fold
    FROM customer""")
def kfold_assign(spark, d):
    return ordering.kfold_assign(table(spark, d, "customer").select("c_custkey"), "c_custkey", k=20,
                                 seed=SEED)


@query("row_numbers", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_number FROM orders")
def row_numbers(spark, d):
    return ordering.row_numbers(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@query("bind_rows", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_acctbal AS acctbal, 'customer' AS kind
FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier' FROM supplier
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'customer' FROM customer
WHERE c_mktsegment = 'BUILDING'""")
def bind_rows(spark, d):
    """Append three frames, duplicates kept (one repeats customers)."""
    c = table(spark, d, "customer")
    s = table(spark, d, "supplier")
    cust = c.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                    F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("acctbal"),
                    F.lit("customer").alias("kind"))
    sup = s.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                   F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("acctbal"),
                   F.lit("supplier").alias("kind"))
    building = c.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("acctbal"),
        F.lit("customer").alias("kind"))
    return functools.reduce(DataFrame.unionByName, [cust, sup, building])


@query("cart_price", """
SELECT cart, CAST(sum(CAST(price AS DECIMAL(15, 2)) * CAST(qty AS DECIMAL(15, 2))) AS DOUBLE) AS total,
       CAST(count(*) AS BIGINT) AS n_items
FROM (SELECT l_orderkey AS cart, p_retailprice AS price, l_quantity AS qty
      FROM lineitem JOIN part ON l_partkey = p_partkey)
GROUP BY ROLLUP (cart)""")
def cart_price(spark, d):
    """Price lookup (part joined by key) and sum of price x quantity per cart,
    with the grand total as the rollup row (cart NULL)."""
    c = views.carts(spark, d)
    # money in exact decimals: the sum does not depend on summation order
    amount = F.col("price").cast("decimal(15,2)") * F.col("qty").cast("decimal(15,2)")
    return c.rollup("cart").agg(F.sum(amount).cast("double").alias("total"),
                                F.count(F.lit(1)).alias("n_items"))


@query("inline_table", """
WITH products(product, price) AS (VALUES ('banana', 1.3), ('mango', 2.0), ('pineapple', 1.9), ('pears', 1.8))
SELECT o_orderkey, product, round(o_totalprice / price, 6) AS units
FROM orders JOIN products ON (o_orderkey % 4) = CASE product WHEN 'banana' THEN 0 WHEN 'mango' THEN 1
                                                          WHEN 'pineapple' THEN 2 ELSE 3 END""")
def inline_table(spark, d):
    """Dataset from in-memory columns (the price list), looked up by a key
    computed from each order."""
    # The published price list.
    products = spark.createDataFrame(
        [("banana", 1.3, 0), ("mango", 2.0, 1), ("pineapple", 1.9, 2), ("pears", 1.8, 3)],
        "product string, price double, slot long")
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice") \
        .withColumn("slot", F.col("o_orderkey") % 4)
    out = lookup_join(o, products, "slot")
    return rounded(out.select("o_orderkey", "product", (F.col("o_totalprice") / F.col("price")).alias("units")))

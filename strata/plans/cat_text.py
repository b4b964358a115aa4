"""Sets from delimited text, membership flags, text -> number, log and
arithmetic columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.text import parse_experience, set_contains, split_to_set
from strata.plans.registry import query, rounded, sql_round
from strata.sources.tables import table

# The words whose presence is flagged per document.
FLAG_WORDS = ["the", "and", "data", "Clojure"]


@query("split_to_set", """
SELECT doc_id, CAST(coalesce(len(list_distinct(string_split(text, ' '))), 0) AS INTEGER) AS n_distinct,
       CAST(coalesce(len(string_split(text, ' ')), 0) AS INTEGER) AS n_tokens
FROM documents""")
def split_to_set_q(spark, d):
    """Whole document text split on spaces into a set (NULL -> empty set)."""
    doc = table(spark, d, "documents").select("doc_id", "text")
    tokens = F.coalesce(F.split("text", " ", -1), F.array().cast("array<string>"))
    return doc.select("doc_id", F.size(split_to_set("text", " ")).alias("n_distinct"),
                      F.size(tokens).alias("n_tokens"))


@query("set_contains", "SELECT doc_id, " + ", ".join(
    f"coalesce(list_contains(string_split(text, ' '), '{w}'), false) AS has_{w.lower()}" for w in FLAG_WORDS)
    + " FROM documents")
def set_contains_q(spark, d):
    """Membership flags of a few words in each document's word set; a
    missing set counts as empty, so flags are never NULL."""
    doc = table(spark, d, "documents").select("doc_id", split_to_set("text", " ").alias("words"))
    return doc.select("doc_id", *[set_contains("words", w).alias(f"has_{w.lower()}") for w in FLAG_WORDS])


_EXPERIENCE_TEXT_SQL = """CASE WHEN value < 1 THEN 'Less than 1 year'
            WHEN value > 400 THEN 'More than 50 years'
            WHEN event_type = 'error' THEN 'n/a'
            ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END"""


@query("parse_experience", f"""
SELECT event_id, txt AS experience_text,
  CASE WHEN txt = 'Less than 1 year' THEN 0.5 WHEN txt = 'More than 50 years' THEN 51.0
       ELSE CAST(TRY_CAST(txt AS INTEGER) AS DOUBLE) END AS experience
FROM (SELECT event_id, {_EXPERIENCE_TEXT_SQL} AS txt FROM events)""")
def parse_experience_q(spark, d):
    """Years-of-experience text (worded, numeric or junk, derived from each
    event's value) parsed to a number; junk gives NULL."""
    ev = table(spark, d, "events")
    txt = (F.when(F.col("value") < 1, F.lit("Less than 1 year"))
           .when(F.col("value") > 400, F.lit("More than 50 years"))
           .when(F.col("event_type") == "error", F.lit("n/a"))
           .otherwise(F.floor("value").cast("bigint").cast("string")))
    return ev.select("event_id", txt.alias("experience_text")) \
        .withColumn("experience", parse_experience("experience_text"))


@query("log_columns", """
SELECT l_orderkey, l_linenumber,
  round(CASE WHEN l_extendedprice > 0 THEN ln(l_extendedprice) END, 6) AS log_price,
  round(CASE WHEN l_quantity > 0 THEN ln(l_quantity) END, 6) AS log_carat,
  round(CASE WHEN l_discount > 0 THEN ln(l_discount) END, 6) AS log_discount,
  round(exp(l_discount), 6) AS exp_discount, round(ln(1 + l_quantity), 6) AS log1p_carat
FROM lineitem""")
def log_columns(spark, d):
    """ln / exp / log1p columns; ln of a non-positive value is NULL."""
    g = table(spark, d, "lineitem")

    def safe_ln(c):
        return F.when(F.col(c) > 0, F.ln(F.col(c)))
    return rounded(g.select(
        "l_orderkey", "l_linenumber", safe_ln("l_extendedprice").alias("log_price"),
        safe_ln("l_quantity").alias("log_carat"), safe_ln("l_discount").alias("log_discount"),
        F.exp("l_discount").alias("exp_discount"),
        F.ln(F.lit(1.0) + F.col("l_quantity")).alias("log1p_carat")))


@query("arith_columns", f"""
SELECT l_orderkey, l_linenumber, {sql_round("l_extendedprice + l_tax")} AS plus,
  {sql_round("l_extendedprice - l_tax")} AS minus, {sql_round("l_quantity * l_discount")} AS times,
  {sql_round("CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END")} AS per_unit,
  CAST(l_linenumber % 3 AS INTEGER) AS rem, CAST(l_orderkey AS VARCHAR) AS key_text
FROM lineitem""")
def arith_columns(spark, d):
    """+, -, *, / (NULL on a zero divisor), remainder and number -> text."""
    li = table(spark, d, "lineitem")
    return rounded(li.select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") + F.col("l_tax")).alias("plus"),
        (F.col("l_extendedprice") - F.col("l_tax")).alias("minus"),
        (F.col("l_quantity") * F.col("l_discount")).alias("times"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("per_unit"),
        (F.col("l_linenumber") % 3).cast("int").alias("rem"),
        F.col("l_orderkey").cast("string").alias("key_text")))


@query("rows_as_json", """
SELECT o_orderkey, CAST(to_json(struct_pack(o_orderkey := o_orderkey, o_custkey := o_custkey,
  o_orderstatus := o_orderstatus, o_orderpriority := o_orderpriority)) AS VARCHAR) AS row_json
FROM orders ORDER BY o_orderkey LIMIT 9""")
def rows_as_json(spark, d):
    """First 9 rows (key order) exported as JSON maps."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return o.orderBy("o_orderkey").limit(9).select(
        "o_orderkey", F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))
        .alias("row_json"))


@query("tokens_view", """
SELECT doc_id, CAST(coalesce(len(list_distinct(string_split(text, ' '))), 0) AS INTEGER) AS n_tokens,
       coalesce(array_to_string(list_sort(list_distinct(string_split(text, ' '))), ' '), '') AS tokens_text
FROM documents""")
def tokens_view(spark, d):
    """The ``tokens`` view: each document's word set, shown sorted as text."""
    doc = table(spark, d, "documents").select("doc_id", split_to_set("text", " ").alias("tokens"))
    return doc.select("doc_id", F.size("tokens").alias("n_tokens"),
                      F.array_join(F.array_sort("tokens"), " ").alias("tokens_text"))


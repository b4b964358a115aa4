"""Library helpers that no registered query exercises directly."""

from pyspark.sql import functions as F

from strata.operators import aggregates as agg
from strata.operators import ordering, verbs


def test_chain_split_and_group_helpers(spark, small_dir):
    o = spark.read.parquet(f"{small_dir}/orders.parquet")
    chained = verbs.transform_chain(o, lambda d: d.select("o_orderkey", "o_orderstatus", "o_totalprice"),
                                    lambda d: d.filter(F.col("o_totalprice") > 0))
    train, test = ordering.split_frames(chained, "o_orderkey", 0.7)
    assert train.count() + test.count() == chained.count()
    assert train.join(test, "o_orderkey").count() == 0
    n = {r["o_orderstatus"]: r["n"] for r in agg.count_by(chained, ["o_orderstatus"]).collect()}
    m = {r["o_orderstatus"]: r["mean"] for r in agg.mean_by(chained, ["o_orderstatus"], "o_totalprice").collect()}
    assert sum(n.values()) == chained.count() and set(n) == set(m)


def test_checkpoint_dir_is_read_from_the_session(spark):
    from strata.session import checkpoint_dir, scratch_path
    d = checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert d == named
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d.rstrip("/"))

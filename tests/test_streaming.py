"""The streaming rolling look-back mean agrees with the batch operator on
every probe it has emitted; only probes newer than the watermark wait."""

from pyspark.sql import functions as F

from strata.operators.windows import rolling_lookback
from strata.plans import views
from strata.session import scratch_path
from strata.streaming.rolling import rolling_lookback_stream


def test_stream_matches_batch(spark, small_dir):
    t = views.trips(spark, small_dir)
    ts = t.withColumn("pickup", F.col("pickup").cast("timestamp")).withColumn("dropoff", F.col("dropoff").cast("timestamp"))
    src = scratch_path(spark, "trips-stream")
    ts.orderBy("pickup").coalesce(1).write.parquet(src)   # one file in event-time order
    stream = spark.readStream.schema(ts.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = rolling_lookback_stream(stream, "id", "k", "pickup", "dropoff", "dur", hours=3)
    q = (out.writeStream.outputMode("append").format("memory").queryName("rolling_stream_test")
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = {r["id"]: (r["mean_value"], r["n_in_window"]) for r in spark.sql("SELECT * FROM rolling_stream_test").collect()}
    want = {r["id"]: (r["mean_value"], r["n_in_window"])
            for r in rolling_lookback(t, "id", "pickup", "dropoff", "dur", keys=["k"]).collect()}
    assert len(got) > 0.9 * len(want)
    for i, (m, n) in got.items():
        wm, wn = want[i]
        assert n == wn
        assert (m is None and wm is None) or abs(m - wm) < 1e-9

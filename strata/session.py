"""Spark session setup and shared-storage helpers.

Everything in the library takes a ``SparkSession`` and returns lazy
DataFrames.  The session defaults below are the ones the library relies
on: UTC session time (epoch conversions), AQE with skew-join splitting
and partition coalescing, and Arrow for the few pandas-UDF paths.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "strata",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` so the submit-time master wins, and
    size ``shuffle_partitions`` to the data (about 128-256 MB per task).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime-settable defaults on a session of our own."""
    for k, v in DEFAULT_CONF.items():
        if not k.startswith("spark.ui"):
            spark.conf.set(k, v)
    return spark


def require_utc(spark: SparkSession) -> None:
    """The plans convert times in UTC; the only setting of a caller's
    session that a query touches, and only where it differs."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only when it is unset on a local master
    (tests) is a fresh temporary folder created and registered; on a
    cluster an unset folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder is not visible to other executors
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}strata-scratch/{name}-{uuid.uuid4().hex[:12]}"


def reliable(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder; every branch
    that uses it sees the same rows in the same partitions, also after the
    loss of an executor."""
    spark = df.sparkSession
    path = checkpoint_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return df.checkpoint()

"""Images: Spark's image source, unpacked to pixel rows.

Spark's ``image`` format decodes each file into (origin, height, width,
nChannels, data) with bytes in B, G, R(, A) order.  ``write_bitmaps`` writes
such rows as 24-bit bitmap files, one per image, in parallel.  With a file
per image, whatever is done for each file alone sets the time: the files are
written by many tasks, which put them in place themselves, names are listed by
tasks and not read as partition values, and a task reads many files.  Hadoop's
``file`` system starts a process for the permissions of each new file, so in a
folder that the machines have mounted the tasks write with Python.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from strata.operators.pixels import unpack_bytes


def read_images(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """Spark image source -> (origin, height, width, nChannels, data), read
    by at most ``tasks``, as Spark gives a task only a few files, however
    small.  A file that is no readable image is an error, not a missing row."""
    im = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(path).select("image.*")
    if tasks:
        im = im.coalesce(tasks)
    bad = F.col("height") <= 0
    height = F.when(bad, F.raise_error(F.concat(F.lit("not an image: "), F.col("origin"))).cast("int")) \
        .otherwise(F.col("height"))
    return im.select("origin", height.alias("height"), "width", "nChannels", "data")


def images_to_pixels(images: DataFrame, id_pattern: str = r"img-(\d+)\.png$") -> DataFrame:
    """Decoded images -> pixel rows; the image id is parsed from the file name."""
    with_id = images.withColumn("img", F.regexp_extract("origin", id_pattern, 1).cast("bigint"))
    return unpack_bytes(with_id, "img", "height", "width", "nChannels", "data")


def _little(v, size: int):
    """A whole number as hex, lowest byte first."""
    text = F.lpad(F.hex(F.lit(v).cast("long") if isinstance(v, int) else v.cast("long")), 2 * size, "0")
    return F.concat(*[F.substring(text, 2 * i + 1, 2) for i in reversed(range(size))])


def write_bitmaps(images: DataFrame, path: str, id_col: str = "img") -> str:
    """Rows (id, height, width, data: B, G, R bytes from the top row) as
    uncompressed bitmap files ``<path>/<id_col>=<id>/part-*``."""
    stride = F.floor((F.col("width") * 3 + 3) / 4) * 4
    size = stride * F.col("height")
    header = F.concat(F.lit("424D"), _little(size + 54, 4), _little(0, 4), _little(54, 4), _little(40, 4), _little(F.col("width"), 4),
                      _little(F.col("height"), 4), _little(1, 2), _little(24, 2), _little(0, 4), _little(size, 4),
                      _little(0, 4), _little(0, 4), _little(0, 4), _little(0, 4))
    line = F.col("width") * 6
    rows = F.transform(F.reverse(F.sequence(F.lit(0), F.col("height") - 1)), lambda i: F.rpad(
        F.substr(F.hex("data"), (i * line + 1).cast("int"), line.cast("int")), (stride * 2).cast("int"), F.lit("0")))
    whole = F.unhex(F.concat(header, F.array_join(rows, "")))
    spark = images.sparkSession
    dealt = images.repartition(many_tasks(spark), id_col).select(id_col, whole.alias("value"))
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = fs.makeQualified(at).toUri()
    if uri.getScheme() == "file" and isinstance(images.schema[id_col].dataType, IntegralType):
        fs.mkdirs(at)
        # in order, so that a task that runs again gives the same files
        dealt.sortWithinPartitions(id_col, "value").mapInArrow(_put_task(uri.getPath(), id_col), "files long").agg(F.sum("files")).collect()
        return path
    # a file of raw bytes: one row, and the line end that follows it is beyond the bitmap's size
    dealt.select(id_col, F.col("value").cast("string").alias("value")).write.partitionBy(id_col).option("maxRecordsPerFile", 1).option(
        "mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)
    return path


def many_tasks(spark: SparkSession) -> int:
    """Tasks that files are written or read by."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def _put_task(root: str, id_col: str):
    """Write rows (id, bytes), sorted, as files of the mounted folder
    ``root``, named as Spark's writer names them.  A file is whole when it
    gets its name, and another attempt puts the same one in its place."""
    def run(batches):
        task, last, same = f"part-{TaskContext.get().partitionId():05d}", (), 0
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for key, data in zip(*(c.to_pylist() for c in batch.columns)):
                same = same + 1 if last == (key,) else 0
                last = (key,)
                folder = f"{root}/{id_col}={'__HIVE_DEFAULT_PARTITION__' if key is None else key}"
                try:
                    os.mkdir(folder)
                except FileExistsError:
                    pass
                with open(f"{folder}/.{task}-{attempt}", "wb") as f:
                    f.write((data or b"") + b"\n")
                os.replace(f.name, f"{folder}/{task}-c{same:05d}.txt")
            yield pa.RecordBatch.from_pydict({"files": pa.array([len(batch)], pa.int64())})
    return run

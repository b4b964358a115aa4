"""Round trips through files: CSV (plain, gzip, custom datetime), GeoJSON,
and pixels from image rows.  Files go to a fresh folder under the shared
``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.text import column_name_fn
from strata.plans import daily as flow
from strata.plans import views
from strata.plans.registry import query, rounded
from strata.plans.views import with_views
from strata.session import scratch_path
from strata.sources import csv as csvio
from strata.sources import geojson, images
from strata.sources.tables import table

DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


@query("scan_csv", "SELECT * FROM orders")
def scan_csv(spark, d):
    """orders written as CSV and read back with an explicit schema."""
    o = table(spark, d, "orders")
    path = csvio.write_csv(o, scratch_path(spark, "orders-csv"))
    return csvio.read_csv(spark, path, schema=o.schema)


_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("scan_csv_gz_rename", "SELECT " + ", ".join(f'{c} AS "{column_name_fn(c)}"' for c in _LI_COLS)
       + " FROM lineitem")
def scan_csv_gz_rename(spark, d):
    """lineitem as gzip CSV, read back (gzip is unsplittable: rows are
    spread again after the scan) with every name mapped ``_`` -> ``-``."""
    li = table(spark, d, "lineitem")
    path = csvio.write_csv(li, scratch_path(spark, "lineitem-csv-gz"), compression="gzip")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    return csvio.read_csv(spark, path, schema=li.schema, rename=column_name_fn, partitions=parts)


@query("scan_csv_datetime", "SELECT event_id, date_trunc('second', ts) AS ts, event_type FROM events")
def scan_csv_datetime(spark, d):
    """Times written as 'yyyy-MM-dd HH:mm:ss' text and parsed back to
    zone-less timestamps by a per-column format."""
    ev = table(spark, d, "events").select(
        "event_id", F.date_format("ts", DATETIME_FORMAT).alias("ts"), "event_type")
    path = csvio.write_csv(ev, scratch_path(spark, "events-csv"))
    return csvio.read_csv(spark, path, schema="event_id bigint, ts timestamp_ntz, event_type string",
                          timestamp_ntz_format=DATETIME_FORMAT)


@query("scan_geojson", with_views("""
SELECT poly_id, name, 'Polygon' AS geometry_type, CAST(count(DISTINCT ring) AS INTEGER) AS n_rings,
       CAST(count(*) + count(DISTINCT ring) AS INTEGER) AS n_vertices
FROM area_edges GROUP BY poly_id, name""", "area_edges"))
def scan_geojson(spark, d):
    """Area polygons written as GeoJSON features, read back: one row per
    feature with all its properties and rings."""
    areas = views.areas(spark, d)
    path = geojson.write_geojson_seq(areas, scratch_path(spark, "areas-geojson"),
                                     {"@id": "poly_id", "neighborhood": "name"})
    rows = geojson.read_geojson_seq(spark, path)
    return rows.select(F.col("@id").cast("bigint").alias("poly_id"), F.col("neighborhood").alias("name"),
                       "geometry_type", F.size("rings").alias("n_rings"),
                       F.size(F.flatten("rings")).alias("n_vertices"))


@query("sink_csv_roundtrip", with_views("""
SELECT date, n, d.day_of_week, round(m.mean_n, 6) AS predicted_n, round(n - m.mean_n, 6) AS residual
FROM daily_with_dow d JOIN (SELECT day_of_week, avg(n) AS mean_n FROM daily_with_dow GROUP BY 1) m
  ON d.day_of_week = m.day_of_week""", "daily_with_dow"))
def sink_csv_roundtrip(spark, d):
    """The residual table (chart data) written as CSV and read back."""
    res = rounded(flow.residuals(spark, d))
    path = csvio.write_csv(res, scratch_path(spark, "residuals-csv"))
    return csvio.read_csv(spark, path, schema=res.schema)


@query("scan_images", """
SELECT vec_id AS img, CAST(p // 33 AS INTEGER) AS i, CAST((p // 3) % 11 AS INTEGER) AS j, CAST(p % 3 AS INTEGER) AS k,
       CAST(least(greatest(floor(coalesce(abs(embedding[p + 1]::DOUBLE), 0) * 255.0), 0), 255) AS INTEGER) AS v
FROM embeddings, range(0, 66) t(p)""")
def scan_images(spark, d):
    """Each embedding as a 2 x 11 image of three channels (its 64 values and
    two zeros), written as bitmap files, one per image, read by Spark's image
    source and unpacked to pixel rows."""
    em = table(spark, d, "embeddings")
    two = F.transform(F.concat("embedding", F.array(*[F.lit(0.0).cast("float")] * 2)), lambda e: F.lpad(F.hex(F.least(
        F.greatest(F.floor(F.abs(e.cast("double")) * F.lit(255.0)), F.lit(0)), F.lit(255)).cast("long")), 2, "0"))
    im = em.select(F.col("vec_id").alias("img"), F.lit(2).alias("height"), F.lit(11).alias("width"),
                   F.unhex(F.array_join(two, "")).alias("data"))
    path = images.write_bitmaps(im, scratch_path(spark, "bitmaps"))
    return images.images_to_pixels(images.read_images(spark, path, images.many_tasks(spark)), r"img=(\d+)/")

"""GeoJSON polygons: FeatureCollection documents and feature-per-line files.

A FeatureCollection is one JSON document; it is cut into its features at byte
ranges (``sources.features``), so a large one is read by many tasks, as is a
file with one feature per line (``read_geojson_seq``).  Coordinates are [longitude,
latitude]; the rings of a Polygon, or of all parts of a MultiPolygon, become
``array<array<struct<x: double, y: double>>>`` with x = longitude.  Malformed
lines and other geometry types are errors; a feature without geometry has
null rings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.features import feature_texts

_GEOMETRY = "struct<type: string, coordinates: string>"      # coordinates as JSON text: their depth depends on the type
_FEATURE_COLUMNS = f"type string, properties map<string, string>, geometry {_GEOMETRY}"
_FEATURE = f"struct<type: string, properties: map<string, string>, geometry: {_GEOMETRY}>"
MAX_PROPERTIES = 10_000  # property names that become columns
_RING = "array<array<array<double>>>"


def _rings(geometry: Column) -> Column:
    kind, text = geometry["type"], geometry["coordinates"]
    options = {"mode": "FAILFAST"}
    parsed = (F.when(kind == "Polygon", F.from_json(text, _RING, options))
              .when(kind == "MultiPolygon", F.flatten(F.from_json(text, f"array<{_RING}>", options)))
              .when(kind.isNotNull(), F.raise_error(F.concat(F.lit("not a polygon: "), kind)).cast(_RING)))
    return F.transform(parsed, lambda ring: F.transform(
        ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))


def _features_to_rows(feats: DataFrame, properties: list[str] | None) -> DataFrame:
    if properties is None:       # like schema inference: the names that occur
        names = feats.select(F.explode(F.map_keys("properties")).alias("p")).distinct().limit(MAX_PROPERTIES + 1).collect()
        if len(names) > MAX_PROPERTIES:
            raise ValueError(f"more than {MAX_PROPERTIES} property names; list those to read")
        properties = sorted(r["p"] for r in names)
    return feats.select(*[F.col("properties").getItem(p).alias(p) for p in properties],
                        F.col("geometry.type").alias("geometry_type"), _rings(F.col("geometry")).alias("rings"))


def read_geojson(spark: SparkSession, path: str, properties: list[str] | None = None) -> DataFrame:
    """FeatureCollection -> one row per feature: its properties (all, or
    those listed) as string columns, ``geometry_type`` and ``rings``."""
    feats = feature_texts(spark, path).select(F.from_json("text", _FEATURE, {"mode": "FAILFAST"}).alias("f"))
    return _features_to_rows(feats.select("f.*"), properties)


def read_geojson_seq(spark: SparkSession, path: str, properties: list[str] | None = None) -> DataFrame:
    """One feature per line (splittable); columns as ``read_geojson``."""
    return _features_to_rows(spark.read.schema(_FEATURE_COLUMNS).option("mode", "FAILFAST").json(path), properties)


def write_geojson_seq(df: DataFrame, path: str, props: dict[str, str]) -> str:
    """Polygons (columns ``rings`` + props), one feature per line, in parallel."""
    coords = F.transform(F.col("rings"), lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    prop_map = F.create_map(*[x for k, c in props.items() for x in (F.lit(k), F.col(c).cast("string"))])
    feature = F.struct(F.lit("Feature").alias("type"), prop_map.alias("properties"),
                       F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")).alias("geometry"))
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)
    return path

"""Pixel-table queries on the ``pixels`` view (img, i, j, k, v), 4 channels BGRA."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import pixels as px
from strata.plans import views
from strata.plans.registry import query, rounded
from strata.plans.views import with_views

# Channel names in Spark image order, luminance weights per
# mille for blue, green, red, alpha, and per-channel recolour proportions.
CHANNELS = ["blue", "green", "red", "alpha"]
LUMA_PER_MILLE = [114, 587, 299, 0]
RECOLOUR = [1.0, 0.5, 0.5, 1.0]
DARKEN_BELOW_J = 8


def _v(expr: str) -> str:
    return f"CAST(least(greatest(floor({expr}), 0), 255) AS INTEGER)"


@query("tensor_unpack", with_views("SELECT img, i, j, k, v FROM pixels", "pixels"))
def tensor_unpack(spark, d):
    """Arrays -> one row per (image, row, column, channel)."""
    return views.pixels(spark, d)


@query("tensor_reshape", with_views("""
SELECT img, i, string_agg(CAST(v AS VARCHAR), ',' ORDER BY j, k) AS values_csv FROM pixels GROUP BY img, i""",
                                    "pixels"))
def tensor_reshape(spark, d):
    """Pixel rows back to one ordered array per image row."""
    rows = px.pack_rows(views.pixels(spark, d))
    return rows.select("img", "i", F.array_join("values", ",").alias("values_csv"))


@query("tensor_element", with_views("SELECT img, i, v FROM pixels WHERE j = 1 AND k = 2", "pixels"))
def tensor_element(spark, d):
    """Element (j = 1, k = 2) of every image row."""
    return px.element(views.pixels(spark, d), j=1, k=2).select("img", "i", "v")


@query("tensor_slice", with_views("""
SELECT img, i, j, string_agg(CAST(v AS VARCHAR), ',' ORDER BY k) AS values_csv FROM pixels GROUP BY img, i, j""",
                                  "pixels"))
def tensor_slice(spark, d):
    """Slices along the two leading axes: the channel vector of each pixel."""
    s = px.slice_leading(views.pixels(spark, d), 2)
    return s.select("img", "i", "j", F.array_join("values", ",").alias("values_csv"))


@query("channel_extract", with_views("""
SELECT img, i, j, max(v) FILTER (WHERE k = 0) AS blue, max(v) FILTER (WHERE k = 1) AS green,
       max(v) FILTER (WHERE k = 2) AS red, max(v) FILTER (WHERE k = 3) AS alpha
FROM pixels GROUP BY img, i, j""", "pixels"))
def channel_extract(spark, d):
    return px.channels_wide(views.pixels(spark, d), CHANNELS)


@query("channel_mask", with_views(
    "SELECT img, i, j, k, CASE WHEN k = 2 THEN v ELSE 0 END AS v FROM pixels", "pixels"))
def channel_mask(spark, d):
    """Keep the red channel, zero the others."""
    return px.mask_channel(views.pixels(spark, d), 2)


@query("brightness_mean", with_views(f"""
SELECT img, i, j, k, {_v("avg(CASE WHEN k IN (0, 1, 2) THEN v END) OVER (PARTITION BY img, i, j)")} AS v
FROM pixels""", "pixels"))
def brightness_mean(spark, d):
    """Grey = mean of the colour channels, written to every channel."""
    return px.with_channels(views.pixel_channels(spark, d), px.grey_mean_of(F.col("ch"), [0, 1, 2]))


@query("brightness_weighted", with_views(f"""
SELECT img, i, j, k, {_v("sum(v * CASE k WHEN 0 THEN 114 WHEN 1 THEN 587 WHEN 2 THEN 299 ELSE 0 END) "
                         "OVER (PARTITION BY img, i, j) / 1000.0")} AS v
FROM pixels""", "pixels"))
def brightness_weighted(spark, d):
    """Grey = luminance-weighted channel sum."""
    return px.with_channels(views.pixel_channels(spark, d), px.grey_weighted_of(F.col("ch"), LUMA_PER_MILLE, 1000))


@query("channel_scale", with_views(f"""
SELECT img, i, j, k, {_v("v * CASE k WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 WHEN 2 THEN 0.5 ELSE 1.0 END")} AS v
FROM pixels""", "pixels"))
def channel_scale(spark, d):
    return px.scale_channels(views.pixels(spark, d), RECOLOUR)


@query("conditional_mask", with_views("""
SELECT img, i, j, k, CASE WHEN max(CASE WHEN k = 1 THEN v END) OVER (PARTITION BY img, i, j)
                          > 1.5 * max(CASE WHEN k = 0 THEN v END) OVER (PARTITION BY img, i, j)
                     THEN 0 ELSE v END AS v
FROM pixels""", "pixels"))
def conditional_mask(spark, d):
    """Zero pixels whose green exceeds 1.5 x blue."""
    return px.with_channels(views.pixel_channels(spark, d), px.conditional_zero_of(F.col("ch"), 1, 0, 1.5))


@query("region_darken", with_views(f"""
SELECT img, i, j, k, CASE WHEN j < {DARKEN_BELOW_J} THEN {_v("v * 0.5")} ELSE v END AS v FROM pixels""", "pixels"))
def region_darken(spark, d):
    return px.darken_region(views.pixels(spark, d), DARKEN_BELOW_J)


@query("gradient_blend", with_views(
    f"SELECT img, i, j, k, {_v('((i % 256) + v) / 3.0')} AS v FROM pixels", "pixels"))
def gradient_blend(spark, d):
    return px.gradient_blend(views.pixels(spark, d))


@query("tensor_transpose", with_views("SELECT img, j AS i, i AS j, k, v FROM pixels", "pixels"))
def tensor_transpose(spark, d):
    return px.transpose(views.pixels(spark, d))


@query("column_profile", with_views(
    "SELECT img, j, k, round(avg(v), 6) AS mean_v FROM pixels GROUP BY img, j, k", "pixels"))
def column_profile(spark, d):
    return rounded(px.column_profile(views.pixels(spark, d)))


@query("tensor_shape", with_views("""
SELECT img, count(DISTINCT i) AS n_rows, CAST(max(j) + 1 AS INTEGER) AS width,
       CAST(max(k) + 1 AS INTEGER) AS channels, 'int' AS element_type FROM pixels GROUP BY img""", "pixels"))
def tensor_shape(spark, d):
    return px.shape(views.pixels(spark, d))


@query("canvas_paste", with_views("""
SELECT img, unnest([r, r + h, r, r + h]) AS i, CAST(unnest([j, j + w, j + w, j]) AS INTEGER) AS j, k,
       unnest([v, v, 0, 0]) AS v
FROM (SELECT img, j, k, v, dense_rank() OVER (PARTITION BY img ORDER BY i) - 1 AS r FROM pixels)
JOIN (SELECT img, count(DISTINCT i) AS h, max(j) + 1 AS w FROM pixels GROUP BY img) USING (img)""", "pixels"))
def canvas_paste(spark, d):
    """Two copies of each image on a canvas twice as high and wide as it, at
    offsets (0, 0) and (h, w); the rest is 0."""
    return px.paste_on_canvas(views.pixels(spark, d)).select("img", "i", "j", "k", "v")

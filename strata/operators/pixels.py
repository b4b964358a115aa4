"""Image / tensor work on a long-form pixel table ``(img, i, j, k, v)``.

i = row, j = column, k = channel (BGR order, as Spark's image source
delivers it), v = 0..255.  Every edit is a column expression; reductions
over a pixel's channels work on its channel array before it is exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.ordering import positions

PIXEL = ["img", "i", "j"]


def _clamp_byte(c: Column) -> Column:
    """Truncate to an integer and clamp to 0..255 (uint8 cast)."""
    return F.least(F.greatest(F.floor(c), F.lit(0)), F.lit(255)).cast("int")


def unpack_bytes(images: DataFrame, img_col: str, height: str, width: str, channels: str,
                 data: str) -> DataFrame:
    """Flat byte array per image -> (img, i, j, k, v)."""
    n = F.col(height) * F.col(width) * F.col(channels)
    digits = F.hex(F.col(data))
    values = F.transform(F.sequence(F.lit(0), n - 1), lambda p: F.conv(
        F.substring(F.col("_hex"), p * 2 + 1, 2), 16, 10).cast("int"))
    each = images.select(F.col(img_col).alias("img"), F.col(width).alias("_w"), F.col(channels).alias("_c"),
                         F.col(height).alias(height), F.col(width).alias(width), F.col(channels).alias(channels),
                         digits.alias("_hex"))
    # the values are decoded once per image; only they travel through the explode
    ex = each.select("img", "_w", "_c", F.posexplode(values).alias("_p", "v"))
    return ex.select("img", F.expr("cast(_p div (_w * _c) as int)").alias("i"),
                     F.expr("cast((_p div _c) % _w as int)").alias("j"),
                     (F.col("_p") % F.col("_c")).cast("int").alias("k"), "v")


def with_channels(df: DataFrame, channels: Column) -> DataFrame:
    """(img, i, j, ch) pixels with their channel array -> (img, i, j, k, v)
    of a new channel array."""
    return df.select(*PIXEL, F.posexplode(channels).alias("k", "v"))


def grey_mean_of(ch: Column, use: list[int]) -> Column:
    """Channel array of the mean over the channels ``use``, truncated to a byte."""
    grey = _clamp_byte(sum((ch[k] for k in use[1:]), ch[use[0]]) / F.lit(float(len(use))))
    return F.transform(ch, lambda _: grey)


def grey_weighted_of(ch: Column, weights: list[int], divisor: int) -> Column:
    """Channel array of floor(sum(v * w[k]) / divisor); whole-number weights
    keep the sum exact."""
    total = sum((ch[k] * F.lit(int(w)) for k, w in enumerate(weights)), F.lit(0))
    grey = F.least(F.greatest(F.floor(total / F.lit(float(divisor))), F.lit(0)), F.lit(255)).cast("int")
    return F.transform(ch, lambda _: grey)


def conditional_zero_of(ch: Column, a: int, b: int, factor: float) -> Column:
    """All channels 0 where channel a exceeds factor x channel b."""
    return F.transform(ch, lambda v: F.when(ch[a] > F.lit(factor) * ch[b], F.lit(0)).otherwise(v))


def pack_rows(px: DataFrame) -> DataFrame:
    """Pixels of each image row (img, i) back into one ordered value array."""
    return px.groupBy("img", "i").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("j", "k", "v"))), lambda s: s["v"]).alias("values"))


def element(px: DataFrame, **coords) -> DataFrame:
    cond = F.lit(True)
    for k, v in coords.items():
        cond = cond & (F.col(k) == v)
    return px.filter(cond)


def slice_leading(px: DataFrame, n: int) -> DataFrame:
    """Sub-tensors along the first n axes: one row per (img, i[, j]) with the
    remaining values ordered."""
    keys = ["img", "i"] if n == 1 else ["img", "i", "j"]
    rest = ["j", "k"] if n == 1 else ["k"]
    return px.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*rest, "v"))), lambda s: s["v"]).alias("values"))


def channels_wide(px: DataFrame, names: list[str]) -> DataFrame:
    """One column per channel (pivot over a fixed channel list)."""
    out = px.groupBy(*PIXEL).pivot("k", list(range(len(names)))).agg(F.first("v"))
    return out.toDF(*PIXEL, *names)


def mask_channel(px: DataFrame, keep: int) -> DataFrame:
    return px.withColumn("v", F.when(F.col("k") == keep, F.col("v")).otherwise(F.lit(0)))


def scale_channels(px: DataFrame, props: list[float]) -> DataFrame:
    pk = F.element_at(F.array(*[F.lit(float(x)) for x in props]), F.col("k") + 1)
    return px.withColumn("v", _clamp_byte(F.col("v") * pk))


def darken_region(px: DataFrame, j_below: int, factor: float = 0.5) -> DataFrame:
    return px.withColumn("v", F.when(F.col("j") < j_below, _clamp_byte(F.col("v") * factor))
                         .otherwise(F.col("v")))


def gradient_blend(px: DataFrame) -> DataFrame:
    """v' = ((i mod 256) + v) / 3, truncated."""
    return px.withColumn("v", _clamp_byte(((F.col("i") % 256) + F.col("v")) / 3.0))


def transpose(px: DataFrame) -> DataFrame:
    return px.select("img", F.col("j").alias("i"), F.col("i").alias("j"), "k", "v")


def column_profile(px: DataFrame) -> DataFrame:
    """Mean value per (image, column, channel)."""
    return px.groupBy("img", "j", "k").agg(F.avg("v").alias("mean_v"))


def shape(px: DataFrame) -> DataFrame:
    """Per image: number of rows, width, channel count and element type."""
    return px.groupBy("img").agg(F.countDistinct("i").alias("n_rows"),
                                 (F.max("j") + 1).cast("int").alias("width"),
                                 (F.max("k") + 1).cast("int").alias("channels"),
                                 F.lit(px.schema["v"].dataType.simpleString()).alias("element_type"))


def paste_on_canvas(px: DataFrame) -> DataFrame:
    """Two copies of each image on a canvas twice as high and wide as the
    image itself, at offsets (0, 0) and (h, w); the rest is 0.  Rows are
    numbered inside their image first, so every pixel makes four canvas
    cells: itself, its copy, and the two empty cells beside them."""
    rows = positions(px.select("img", "i").distinct(), ["i"], group_cols=["img"], pos_col="_row", size_col="_h")
    wide = px.groupBy("img").agg((F.max("j") + 1).alias("_w"))
    placed = px.join(rows, ["img", "i"]).join(wide, "img")
    down, right = F.col("_row") + F.col("_h"), F.col("j") + F.col("_w")

    def cell(i, j, v):
        return F.struct(i.cast("long").alias("i"), j.cast("int").alias("j"), v.cast("int").alias("v"))
    cells = F.array(cell(F.col("_row"), F.col("j"), F.col("v")), cell(down, right, F.col("v")),
                    cell(F.col("_row"), right, F.lit(0)), cell(down, F.col("j"), F.lit(0)))
    return placed.select("img", "k", F.explode(cells).alias("_cell")).select("img", "_cell.i", "_cell.j", "k", "_cell.v")

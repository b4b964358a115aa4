"""Source / sink round trips not covered by the oracle queries."""

import json

import pytest
from pyspark.sql import functions as F

from png import png_rgba
from strata.plans import views
from strata.session import scratch_path
from strata.sources import csv as csvio
from strata.sources import geojson, images


def test_geojson_seq_roundtrip(spark, small_dir):
    areas = views.areas(spark, small_dir)
    path = geojson.write_geojson_seq(areas, scratch_path(spark, "areas-seq"), {"@id": "poly_id", "neighborhood": "name"})
    back = geojson.read_geojson_seq(spark, path, ["@id", "neighborhood"])
    a = sorted((r["poly_id"], r["name"], [[(p["x"], p["y"]) for p in ring] for ring in r["rings"]])
               for r in areas.collect())
    b = sorted((int(r["@id"]), r["neighborhood"], [[(p["x"], p["y"]) for p in ring] for ring in r["rings"]])
               for r in back.collect())
    assert a == b


SQUARE = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
FAR = [[5, 5], [6, 5], [6, 6], [5, 6], [5, 5]]


def feature(kind, coordinates, **properties):
    return {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}}


FEATURES = [feature("Polygon", [SQUARE], name="one", borough="B"), feature("MultiPolygon", [[SQUARE], [FAR]], name="two"),
            {"type": "Feature", "properties": {"name": "none"}, "geometry": None}]


@pytest.mark.parametrize("form", ["collection", "lines"])
def test_geojson_geometry_types_and_all_properties(spark, tmp_path, form):
    p = tmp_path / "f.json"
    if form == "collection":
        p.write_text(json.dumps({"type": "FeatureCollection", "features": FEATURES}, indent=1))
        df = geojson.read_geojson(spark, str(p))
    else:
        p.write_text("\n".join(json.dumps(f) for f in FEATURES))
        df = geojson.read_geojson_seq(spark, str(p))
    assert df.columns == ["borough", "name", "geometry_type", "rings"]
    got = {r["name"]: r for r in df.collect()}
    assert [[(q["x"], q["y"]) for q in ring] for ring in got["two"]["rings"]] == [
        [tuple(map(float, q)) for q in r] for r in (SQUARE, FAR)]
    assert got["one"]["borough"] == "B" and got["two"]["borough"] is None and got["none"]["rings"] is None


def test_geojson_errors_are_raised(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(feature("Point", [1, 2], name="p")))
    with pytest.raises(Exception, match="not a polygon"):
        geojson.read_geojson_seq(spark, str(tmp_path / "a.json"), ["name"]).collect()
    (tmp_path / "b.json").write_text('{"type": "Feature", "geometry": {')
    with pytest.raises(Exception):
        geojson.read_geojson_seq(spark, str(tmp_path / "b.json"), ["name"]).collect()


def test_images_to_pixels(spark, tmp_path):
    bgra = bytes(range(2 * 3 * 4))
    rgba = bytearray(bgra)
    rgba[0::4], rgba[2::4] = bgra[2::4], bgra[0::4]
    (tmp_path / "img-7.png").write_bytes(png_rgba(3, 2, bytes(rgba)))
    got = images.images_to_pixels(images.read_images(spark, str(tmp_path))).collect()
    assert sorted((r["img"], r["i"], r["j"], r["k"], r["v"]) for r in got) == [
        (7, i, j, k, (i * 3 + j) * 4 + k) for i in range(2) for j in range(3) for k in range(4)]


def test_unreadable_image_is_an_error(spark, tmp_path):
    (tmp_path / "img-1.png").write_bytes(b"no image")
    with pytest.raises(Exception, match="not an image"):
        images.images_to_pixels(images.read_images(spark, str(tmp_path))).collect()


def test_csv_inferred_schema_and_rename(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/customer.parquet")
    path = csvio.write_csv(df, scratch_path(spark, "cust-csv"))
    back = csvio.read_csv(spark, path, rename=lambda c: c.replace("_", "-"))
    assert back.columns == [c.replace("_", "-") for c in df.columns]
    assert dict(back.dtypes)["c-custkey"] in ("int", "bigint")
    assert back.count() == df.count()
    assert back.agg(F.sum("`c-custkey`")).first()[0] == df.agg(F.sum("c_custkey")).first()[0]


def _collection(rnd, n):
    odd = ["plain", "a } b", "{[\"", "quote \" and \\\\ \\", "}}}]", "é 日本 😀", "end\\\\", ""]
    feats = []
    for i in range(n):
        k = rnd.randrange(4)
        geometry = None if k == 0 else {"type": "Polygon", "coordinates": [[[float(i), 0.5], [i + 1.0, 0.5], [i + 1.0, 2.0], [float(i), 0.5]]]}
        feats.append({"type": "Feature", "properties": {"id": str(i), "note": rnd.choice(odd) * rnd.randrange(3)}, "geometry": geometry})
    return {"type": "FeatureCollection", "name": rnd.choice(odd), "crs": {"type": "name", "properties": {"name": "x}", "list": [1, {"a": 2}]}},
            "bbox": [0, 1.5, 2, 3], "features": feats, "more": {"deep": {"er": ["}"]}}}


@pytest.mark.parametrize("split", [64, 700, 1 << 20])
def test_feature_collection_is_read_in_splits(spark, tmp_path, split):
    """Braces and quotes in strings, other objects around, features across splits of any size."""
    import random
    rnd = random.Random(split)
    docs = [_collection(rnd, n) for n in (0, 1, 40)]
    for i, doc in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc, indent=[None, 1, 2][i], ensure_ascii=i == 1) + ["", "\n", " \n\n"][i])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        df = geojson.read_geojson(spark, str(tmp_path), ["id", "note"])
        got = sorted((r["id"], r["note"], r["geometry_type"], r["rings"] and [[(p["x"], p["y"]) for p in ring] for ring in r["rings"]])
                     for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = sorted((f["properties"]["id"], f["properties"]["note"], f["geometry"] and f["geometry"]["type"],
                   f["geometry"] and [[tuple(p) for p in ring] for ring in f["geometry"]["coordinates"]])
                  for doc in docs for f in doc["features"])
    assert got == want


def test_malformed_collections_are_errors(spark, tmp_path):
    good = json.dumps(_collection(__import__("random").Random(3), 6))
    bad = [good[:-1], good[:len(good) // 2], good + "}", good.replace("}, {\"type\": \"Feature\"", "} {\"type\": \"Feature\"", 1),
           good.replace('"features": [', '"features": ', 1), good.replace('"features"', '"other"', 1), "[1]", "{}", good + good,
           good.replace('"coordinates": [[[', '"coordinates": [[[oops', 1)]
    for i, text in enumerate(bad):
        p = tmp_path / f"bad{i}.json"
        p.write_text(text)
        with pytest.raises(Exception):
            geojson.read_geojson(spark, str(p), ["id"]).collect()

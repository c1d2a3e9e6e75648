"""GeoJSON, CSV and replace-table round trips."""

import json
import os
import uuid

import pytest

from blocklot.operators import geometry as geo
from blocklot.session import scratch_path
from blocklot.sources import geojson, tables


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_geojson_layer_roundtrip(spark):
    layer = spark.createDataFrame([(7, 0, [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]])],
                                  "key bigint, part int, rings array<array<array<double>>>")
    folder = scratch_path(spark, "t", uuid.uuid4().hex)
    geojson.write_layers({"tiny": layer, "other": layer}, folder)
    back = geojson.read_layers(spark, f"{folder}/*.geojson")
    assert sorted((r.layer, r.key, r.part) for r in back.collect()) == [("other", 7, 0), ("tiny", 7, 0)]
    assert geojson.vertices(back).count() == 8


def test_feature_collection_with_multipolygon(spark):
    folder = _local(scratch_path(spark, "t", uuid.uuid4().hex))
    os.makedirs(folder, exist_ok=True)
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"id": "5"},
         "geometry": {"type": "MultiPolygon", "coordinates": [
             [[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
        {"type": "Feature", "properties": {"id": "6"}, "geometry": {"type": "Point", "coordinates": [1, 1]}}]}
    with open(os.path.join(folder, "districts.geojson"), "w") as f:
        json.dump(doc, f)
    parts = geojson.read_layers(spark, folder, key_property="id", skip_other=True)
    assert sorted((r.layer, r.key, r.part) for r in parts.collect()) == [("districts", 5, 0), ("districts", 5, 1)]
    with pytest.raises(Exception, match="not a polygon feature"):
        geojson.read_layers(spark, folder, key_property="id").collect()


def _square(x, y):
    return [[[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]]


def test_parts_and_attributes_survive(spark):
    layer = spark.createDataFrame([(7, 1, _square(5.0, 5.0), "a\"b", 3), (7, 0, _square(0.0, 0.0), "a\"b", 3),
                                   (8, 0, _square(9.0, 9.0), None, 4)],
                                  "key bigint, part int, rings array<array<array<double>>>, name string, n int")
    path = scratch_path(spark, "t", uuid.uuid4().hex, "zones.geojson")
    geojson.write_layer(layer, path, crs="EPSG:2263")
    back = geojson.read_layers(spark, path, crs="EPSG:2263")
    rows = {(r.key, r.part): (r.rings, r.properties.get("name"), r.properties["n"]) for r in back.collect()}
    assert rows == {(7, 0): (_square(0.0, 0.0), "a\"b", "3"), (7, 1): (_square(5.0, 5.0), "a\"b", "3"),
                    (8, 0): (_square(9.0, 9.0), None, "4")}
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 5.5, 5.5), (3, 3.0, 3.0)], "key bigint, px double, py double")
    got = {(r.key, r.polygon_key) for r in geo.points_in_polygons(pts, back).collect()}
    assert got == {(1, 7), (2, 7), (3, None)}
    with pytest.raises(ValueError, match="reference systems"):
        geojson.read_layers(spark, path, crs="EPSG:4326")


def _file(spark, text):
    folder = _local(scratch_path(spark, "t", uuid.uuid4().hex))
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "x.geojson"), "w") as f:
        f.write(text)
    return folder


def test_form_is_detected_and_bad_text_raises(spark):
    feature = {"type": "Feature", "properties": {"key": 1}, "geometry": {"type": "Polygon", "coordinates": _square(0, 0)}}
    for text in (json.dumps({"type": "FeatureCollection", "features": [feature]}),
                 json.dumps({"type": "FeatureCollection", "features": [feature]}, indent=1),
                 json.dumps(feature) + "\n\n", json.dumps(feature, indent=2)):
        assert [r.key for r in geojson.read_layers(spark, _file(spark, text)).collect()] == [1]
    line = json.dumps(feature)
    for text in (line + "\n{broken\n" + line, "{}", "[1]", "nothing", json.dumps({"type": "FeatureCollection"}),
                 json.dumps({**feature, "geometry": None}),
                 json.dumps({**feature, "geometry": {"type": "Polygon", "coordinates": "x"}})):
        with pytest.raises(Exception, match="not a (GeoJSON document|polygon feature)"):
            geojson.read_layers(spark, _file(spark, text)).collect()


def test_csv_roundtrip(spark):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "id bigint, s string, x double")
    path = tables.write_csv(df, scratch_path(spark, "t", uuid.uuid4().hex))
    back = tables.read_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_replace_table(spark):
    path = scratch_path(spark, "t", uuid.uuid4().hex)
    tables.replace_table(spark.createDataFrame([(1,)], "a bigint"), path)
    tables.replace_table(spark.createDataFrame([("x", 2)], "b string, c bigint"), path)
    back = tables.read_replaced(spark, path)
    assert back.columns == ["b", "c"] and [tuple(r) for r in back.collect()] == [("x", 2)]


def test_rings_from_vertices_inverts_vertices(spark):
    layer = spark.createDataFrame(
        [("zones", 3, 0, [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]], [[1.0, 1.0], [2.0, 1.0], [1.0, 2.0], [1.0, 1.0]]]),
         ("zones", 4, 1, [[[9.0, 9.0], [8.0, 9.0], [8.0, 8.0], [9.0, 9.0]]])],
        "layer string, key bigint, part int, rings array<array<array<double>>>")
    back = geojson.rings_from_vertices(geojson.vertices(layer))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, layer.collect()))

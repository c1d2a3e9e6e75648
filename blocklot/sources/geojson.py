"""GeoJSON layers in and out.

The sink writes newline-delimited GeoJSON (one Feature per line), which
Spark splits across tasks on read; a folder of layers is written as one
``<layer>.geojson`` directory each. All parts of a key make one Polygon or
MultiPolygon feature, and every other column of the layer becomes a property.

The reader takes that form and classic documents (one FeatureCollection or
Feature per file), tells them apart file by file, and returns one row per
polygon part: ``layer, key, part, rings, properties``. Nothing is dropped in
silence: text that is no GeoJSON raises, and so does a geometry that is no
polygon, unless the caller asks to skip those. A classic document is one value
in one task, as no reader can split it; large layers belong in the line form.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RINGS = "array<array<array<double>>>"
MULTI = "array<array<array<array<double>>>>"
FEATURE = ("struct<type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>,"
           "crs:struct<properties:struct<name:string>>>")
DOCUMENT = "struct<type:string,features:array<string>,crs:struct<properties:struct<name:string>>>"
POLYGONS = ("Polygon", "MultiPolygon")


def feature_json(key: Column, parts: Column, properties: dict[str, Column] | None = None,
                 crs: str | None = None) -> Column:
    """One GeoJSON Feature as JSON text from the parts (arrays of rings) of a key."""
    props = F.struct(key.alias("key"), *[c.alias(n) for n, c in (properties or {}).items()])
    label = [F.struct(F.lit("name").alias("type"), F.struct(F.lit(crs).alias("name")).alias("properties")).alias("crs")] \
        if crs else []

    def feature(kind: str, coordinates: Column) -> Column:
        geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
        return F.to_json(F.struct(F.lit("Feature").alias("type"), *label, props.alias("properties"),
                                  geometry.alias("geometry")))
    return F.when(F.size(parts) == 1, feature("Polygon", parts[0])).otherwise(feature("MultiPolygon", parts))


def write_layer(layer: DataFrame, path: str, crs: str | None = None) -> str:
    """Write a layer (key, part, rings, attributes) as newline-delimited GeoJSON, replacing ``path``.

    One feature per key (a feature is one row by nature), its parts in order of
    ``part``. Columns beside key, part and rings are its attributes; rows of a key
    whose attributes differ are different features.
    """
    attributes = [c for c in layer.columns if c not in ("layer", "key", "part", "rings")]
    part = F.col("part") if "part" in layer.columns else F.lit(0)
    gathered = layer.groupBy("key", *attributes).agg(
        F.array_sort(F.collect_list(F.struct(part.alias("part"), F.col("rings")))).alias("parts"))
    text = feature_json(F.col("key"), F.transform("parts", lambda p: p["rings"]), {c: F.col(c) for c in attributes}, crs)
    gathered.select(text.alias("value")).write.mode("overwrite").option("compression", "none").text(path)
    return path


def write_layers(layers: dict[str, DataFrame], folder: str, crs: str | None = None) -> str:
    """Every layer of a dict as ``<folder>/<name>.geojson``."""
    for name, layer in layers.items():
        write_layer(layer, os.path.join(folder, f"{name}.geojson"), crs)
    return folder


def _fail(message: str, text: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"{message}: "), F.substring(text, 1, 200)))


def _parts(features: DataFrame, skip_other: bool) -> DataFrame:
    geom = F.col("f.geometry")
    kind, coordinates = geom["type"], geom["coordinates"]
    if skip_other:
        features = features.where(F.coalesce(kind, F.lit("")).isin(*POLYGONS) | (F.col("f.type") != "Feature"))
    bad = _fail("not a polygon feature", F.coalesce(F.to_json("f"), F.lit("null")))
    multi = F.when(kind == "Polygon", F.array(F.from_json(coordinates, RINGS))) \
        .when(kind == "MultiPolygon", F.from_json(coordinates, MULTI))
    checked = F.when((F.col("f.type") == "Feature") & multi.isNotNull() & ~F.exists(
        F.coalesce(multi, F.array()), lambda p: p.isNull()), multi).otherwise(bad.cast(MULTI))
    return features.select("layer", F.col("f.properties").alias("properties"), F.posexplode(checked).alias("part", "rings"))


def _files_of_documents(lines: DataFrame) -> list[str]:
    """Files that hold anything but one Feature per line."""
    parsed = F.from_json("value", "struct<type:string>")
    strange = F.coalesce(parsed["type"] != "Feature", F.lit(True)) & (F.trim("value") != "")
    return [r.file for r in lines.where(strange).select("file").distinct().collect()]  # a few names per layer


def read_layers(spark: SparkSession, path: str, key_property: str = "key", key_type: str = "bigint",
                skip_other: bool = False, crs: str | None = None) -> DataFrame:
    """Read one layer or a folder of ``*.geojson`` layers.

    ``layer`` is the file or directory name without ``.geojson``. With
    ``skip_other``, features that are no polygons are left out; else they
    raise. Layers that name different reference systems, or another one than
    ``crs``, raise: coordinates are compared as they stand.
    """
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.geojson(/|$)", 1)
    found = spark.read.option("recursiveFileLookup", True).text(path).select(
        name.alias("layer"), F.col("_metadata.file_path").alias("file"), "value")
    documents = _files_of_documents(found)
    lines = found.where(~F.col("file").isin(documents)) if documents else found
    features = lines.where(F.trim("value") != "").select("layer", F.lit(None).cast("string").alias("label"), "value")
    if documents:
        texts = spark.read.text(documents, wholetext=True)
        parsed = texts.select(name.alias("layer"), "value", F.from_json("value", DOCUMENT).alias("d"))
        # A first line that is complete in itself, with more below it, is the line form with a line that is not.
        first = F.substring_index(F.btrim("value", F.lit(" \t\r\n")), "\n", 1)
        mixed = F.from_json(first, "struct<type:string>")["type"].isNotNull() & (
            F.length(first) < F.length(F.btrim("value", F.lit(" \t\r\n"))))
        inside = F.when(mixed, _fail("not a GeoJSON document", F.col("value")).cast("array<string>")) \
            .when((F.col("d.type") == "FeatureCollection") & F.col("d.features").isNotNull(), F.col("d.features")) \
            .when(F.col("d.type") == "Feature", F.array("value")) \
            .otherwise(_fail("not a GeoJSON document", F.col("value")).cast("array<string>"))
        features = features.unionByName(parsed.select(
            "layer", F.col("d.crs.properties.name").alias("label"), F.explode(inside).alias("value")))
    whole = features.select("layer", "label", F.from_json("value", FEATURE).alias("f"))
    labels = [r[0] for r in whole.select(F.coalesce("label", "f.crs.properties.name").alias("label"))
              .where("label is not null").distinct().limit(3).collect()]
    if len(labels) > 1 or (crs and labels and labels != [crs]):
        raise ValueError(f"layers name several reference systems: {sorted(labels + ([crs] if crs else []))}")
    parts = _parts(whole, skip_other)
    return parts.select("layer", F.col("properties")[key_property].cast(key_type).alias("key"), "part", "rings",
                        "properties")


def vertices(parts: DataFrame, attributes: list[str] | None = None) -> DataFrame:
    """One row per vertex: layer, key, part, ring, seq, x, y, and the named attributes of its part."""
    more = attributes or []
    rings = parts.select("layer", "key", "part", *more, F.posexplode("rings").alias("ring", "r"))
    pts = rings.select("layer", "key", "part", *more, "ring", F.posexplode("r").alias("seq", "p"))
    return pts.select("layer", "key", "part", "ring", "seq", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"), *more)


def rings_from_vertices(verts: DataFrame) -> DataFrame:
    """Inverse of ``vertices``: (layer, key, part, ring, seq, x, y) rows back to
    one row per part with ``rings`` in ring and vertex order.

    Each ring is gathered within its own group, so a row holds one polygon
    part, never more.
    """
    per_ring = verts.groupBy("layer", "key", "part", "ring").agg(
        F.array_sort(F.collect_list(F.struct("seq", "x", "y"))).alias("pts"))
    as_ring = per_ring.select("layer", "key", "part", "ring",
                              F.transform("pts", lambda p: F.array(p["x"], p["y"])).alias("r"))
    per_part = as_ring.groupBy("layer", "key", "part").agg(
        F.array_sort(F.collect_list(F.struct("ring", "r"))).alias("rs"))
    return per_part.select("layer", "key", "part", F.transform("rs", lambda x: x["r"]).alias("rings"))

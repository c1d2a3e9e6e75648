"""Area-to-area crosswalks from polygon layers (C7, C8) and their key clean-up.

C7 ``centroid_crosswalk``      each area's centroid, located in the other layer (within)
C8 ``intersects_crosswalk``    every pair of areas that touch or overlap
C10 ``standardise_crosswalk``  rename key columns and standardise each by its name
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import geometry as geo
from ..operators import relational as rel
from ..session import written


def centroid_crosswalk(areas: DataFrame, zones: DataFrame, area_name: str = "area_key",
                       zone_name: str = "zone_key", index: str = geo.GRID) -> DataFrame:
    """Distinct (area, zone) where the area's centroid lies strictly inside the zone.

    Areas whose centroid is in no zone keep one row with a NULL zone.
    """
    pts = geo.centroids(areas).select("key", F.col("cx").alias("px"), F.col("cy").alias("py"))
    located = geo.points_in_polygons(pts, zones, boundary=False, index=index)
    return located.select(F.col("key").alias(area_name), F.col("polygon_key").alias(zone_name)).distinct()


def intersects_crosswalk(areas: DataFrame, zones: DataFrame, area_name: str = "area_key",
                         zone_name: str = "zone_key", index: str = geo.GRID) -> DataFrame:
    """Distinct (area, zone) for every touching or overlapping pair (left join)."""
    pairs = geo.polygons_intersecting(areas, zones, index=index)
    return pairs.select(F.col("lkey").alias(area_name), F.col("rkey").alias(zone_name)).distinct()


# The pairs of layers that the source maps: by centroid, and by overlap.
WITHIN_PAIRS = [("community", "tract"), ("council", "tract"), ("community", "school"), ("council", "school")]
INTERSECTS_PAIRS = [("tract", "community"), ("community", "council"), ("tract", "council"), ("tract", "school"),
                    ("community", "school"), ("council", "school")]


def _by_target(pairs: list[tuple[str, str]]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for source, target in pairs:
        out.setdefault(target, []).append(source)
    return out


def _tagged(target: str, source: str):
    return F.struct(F.lit(f"{source}_to_{target}").alias("pair"), F.col("key").alias("key")).alias("key")


def centroid_crosswalks(layers: dict[str, DataFrame], pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Every centroid crosswalk of the set: (pair, source_key, target_key), a layer's centroids and index made once."""
    wanted = _by_target(pairs or WITHIN_PAIRS)
    centres = {name: written(geo.centroids(layers[name]).select("key", F.col("cx").alias("px"), F.col("cy").alias("py")), "centroids")
               for name in sorted({source for sources in wanted.values() for source in sources})}
    out = None
    for target, sources in wanted.items():
        points = None
        for source in sources:
            own = centres[source].select(_tagged(target, source), "px", "py")
            points = own if points is None else points.unionByName(own)
        found = geo.points_in_polygons(points, layers[target], boundary=False).select(
            "key.pair", F.col("key.key").alias("source_key"), F.col("polygon_key").alias("target_key"))
        out = found if out is None else out.unionByName(found)
    return out


def intersects_crosswalks(layers: dict[str, DataFrame], pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Every overlap crosswalk of the set: (pair, source_key, target_key), every layer read and prepared once."""
    wanted = _by_target(pairs or INTERSECTS_PAIRS)
    ready = {name: geo.Layer.of(layers[name]) for name in sorted({x for t, sources in wanted.items() for x in [t, *sources]})}
    out = None
    for target, sources in wanted.items():
        left = None
        for source in sources:
            own = ready[source].keyed(_tagged(target, source))
            left = own if left is None else left.union(own)
        found = geo.polygons_intersecting(left, ready[target]).select(
            "lkey.pair", F.col("lkey.key").alias("source_key"), F.col("rkey").alias("target_key"))
        out = found if out is None else out.unionByName(found)
    return out


# Raw key column names of the four fact tables and their standard names.
FACT_RENAMES = {
    "housing": {"CommntyDst": "community_district", "CouncilDst": "council_district", "CenTract20": "census_tract"},
    "affordable": {"Community_Board": "community_district", "Council_District": "council_district",
                   "Census_Tract": "census_tract"},
    "school": {"Geo_Dist": "school_district"},
    "transit": {"Census_ID": "census_tract"},
}


def standardise_fact_table(df: DataFrame, kind: str) -> DataFrame:
    """Rename a fact table's key columns and standardise them by name."""
    return standardise_crosswalk(df, FACT_RENAMES[kind])


def standardise_crosswalk(df: DataFrame, rename_map: dict[str, str]) -> DataFrame:
    """Rename, then apply the standardiser whose key name appears in each column name."""
    df = rel.rename_columns(df, rename_map)
    for column in df.columns:
        for key_name, fn in keys.STANDARDISERS.items():
            if key_name in column:
                dtype = df.schema[column].dataType
                if fn is keys.community_board:
                    df = keys.with_community_board(df, column)
                else:
                    df = df.withColumn(column, fn(column, dtype))
    return df

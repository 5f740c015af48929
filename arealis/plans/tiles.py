"""Features cut to web map tiles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions import geometry as G
from arealis.functions.arrow_geometry import strips
from arealis.session import spread

# Tile extent and the margin drawn around a tile, in tile pixels.
EXTENT = 4096
BUFFER = 256
# Latitude at which the mercator map is as high as it is wide.
MAX_LATITUDE = math.degrees(2 * math.atan(math.exp(math.pi)) - math.pi / 2)


def _whole_pixels(geom: Column, tile_x: Column, tile_y: Column) -> Column:
    """Tile units to integer pixels, without the vertices and rings that vanish."""
    snapped = G.map_vertices(
        geom, lambda v: G.make_point(F.rint((v["x"] - tile_x) * EXTENT), F.rint((v["y"] - tile_y) * EXTENT))
    )
    return G.clean_rings(snapped)


def tile_features(df: DataFrame, zoom: int, geom: str = "geom") -> DataFrame:
    """One row per feature and tile it meets: ``z, x, y``, attributes and the
    geometry clipped to the tile (plus its margin) in integer pixels.

    Longitude/latitude in; latitudes beyond the square map's are held to its edge. A feature is cut into columns first and each column
    into tiles, halving as it goes, so pieces shrink and are never copied whole
    per tile. Rows stay flat: a tile may hold any number of features.
    """
    others = [c for c in df.columns if c != geom]
    count = 2**zoom
    half, size = math.pi * G.MERCATOR_RADIUS, 2 * math.pi * G.MERCATOR_RADIUS / count
    held = G.map_vertices(geom, lambda v: G.make_point(v["x"], F.greatest(F.least(v["y"], F.lit(MAX_LATITUDE)), F.lit(-MAX_LATITUDE))))
    units = G.map_vertices(
        G.to_mercator(held), lambda v: G.make_point((v["x"] + half) / size, (F.lit(half) - v["y"]) / size)
    )
    margin = BUFFER / EXTENT
    columns = spread(df).select(*others, F.explode(strips(units, 0, margin, count - 1)).alias("_s"))
    columns = columns.select(*others, F.col("_s.i").alias("_tx"), F.col("_s.geom").alias("_g"))
    # the columns of a very large feature go to many tasks
    columns = columns.repartition("_tx", *[c for c, kind in df.dtypes if c != geom and "map<" not in kind])
    cells = columns.select(*others, "_tx", F.explode(strips("_g", 1, margin, count - 1)).alias("_s"))
    tiles = cells.select(
        F.lit(zoom).alias("z"),
        F.col("_tx").alias("tile_x"),
        F.col("_s.i").alias("tile_y"),
        *others,
        _whole_pixels(F.col("_s.geom"), F.col("_tx"), F.col("_s.i")).alias(geom),
    )
    return tiles.filter(F.size(geom) > 0)


def tile_summary(tiles: DataFrame, geom: str = "geom") -> DataFrame:
    """Features and vertices per tile."""
    return tiles.groupBy("z", "tile_x", "tile_y").agg(
        F.count(F.lit(1)).alias("features"), F.sum(G.npoints(geom)).alias("points")
    )

"""Geometry as Catalyst expressions.

A geometry is parts -> rings (shell first) -> closed vertex list. Everything here
is a built-in or higher-order expression, so no Python worker is involved.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
GEOM = T.ArrayType(T.ArrayType(RING))
POINT_TYPE, RING_TYPE, GEOM_TYPE = POINT.simpleString(), RING.simpleString(), GEOM.simpleString()

# Spherical mercator radius (EPSG:3857).
MERCATOR_RADIUS = 6378137.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, fn) -> Column:
    """``fn`` of a value worked out once: inside a lambda (or used twice) a plain
    expression would be worked out again at every use."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


# --- points -----------------------------------------------------------------


def make_point(x: Column | str, y: Column | str) -> Column:
    return F.struct(_col(x).cast("double").alias("x"), _col(y).cast("double").alias("y"))


def x(point: Column | str) -> Column:
    return _col(point).getField("x")


def y(point: Column | str) -> Column:
    return _col(point).getField("y")


# --- shape ------------------------------------------------------------------


def rings(geom: Column | str) -> Column:
    """All rings of all parts."""
    return F.flatten(_col(geom))


def vertices(geom: Column | str) -> Column:
    return F.flatten(F.flatten(_col(geom)))


def npoints(geom: Column | str) -> Column:
    return F.array_size(vertices(geom))


def num_parts(geom: Column | str) -> Column:
    return F.array_size(_col(geom))


def is_empty(geom: Column | str) -> Column:
    """True for a geometry without vertices; NULL for a NULL geometry."""
    return F.when(_col(geom).isNotNull(), npoints(geom) == 0)


def xmin(geom: Column | str) -> Column:
    return F.array_min(vertices(geom).getField("x"))


def ymin(geom: Column | str) -> Column:
    return F.array_min(vertices(geom).getField("y"))


def xmax(geom: Column | str) -> Column:
    return F.array_max(vertices(geom).getField("x"))


def ymax(geom: Column | str) -> Column:
    return F.array_max(vertices(geom).getField("y"))


def envelope(geom: Column | str) -> Column:
    """The bounding box as a one-ring polygon; NULL when there are no vertices."""
    lo_x, lo_y, hi_x, hi_y = xmin(geom), ymin(geom), xmax(geom), ymax(geom)
    corners = [(lo_x, lo_y), (lo_x, hi_y), (hi_x, hi_y), (hi_x, lo_y), (lo_x, lo_y)]
    box = F.array(F.array(F.array(*[make_point(cx, cy) for cx, cy in corners])))
    return F.when(lo_x.isNotNull(), box)


def with_bbox(df: DataFrame, geom: str = "geom", names: Sequence[str] = ("xmin", "ymin", "xmax", "ymax")) -> DataFrame:
    """Add the bounding box as columns; stored beside the geometry they make
    viewport filters prunable from Parquet statistics."""
    # the flattened coordinates are columns first, so they are worked out once
    flat = df.withColumns({"_xs": vertices(geom).getField("x"), "_ys": vertices(geom).getField("y")})
    boxed = flat.withColumns(
        dict(zip(names, (F.array_min("_xs"), F.array_min("_ys"), F.array_max("_xs"), F.array_max("_ys"))))
    )
    return boxed.drop("_xs", "_ys")


def ring_area(ring: Column) -> Column:
    """Signed area, positive when counter-clockwise. Coordinates are taken
    relative to the first vertex so small rings far from the origin keep digits."""
    zero = F.lit(0.0)
    start = F.struct(zero.alias("px"), zero.alias("py"), zero.alias("s"))

    def doubled(r: Column) -> Column:
        first = F.try_element_at(r, F.lit(1))

        def step(acc: Column, v: Column) -> Column:
            vx = v["x"] - first["x"]
            vy = v["y"] - first["y"]
            return F.struct(vx.alias("px"), vy.alias("py"), (acc["s"] + acc["px"] * vy - vx * acc["py"]).alias("s"))

        return F.aggregate(r, start, step, lambda acc: acc["s"] / 2.0)

    return _let(ring, doubled)


def area(geom: Column | str) -> Column:
    """Planar area; holes (every ring after a part's first) subtract."""

    def shell_less_holes(sizes: Column) -> Column:
        total = F.aggregate(sizes, F.lit(0.0), lambda acc, a: acc + a)
        return F.coalesce(2.0 * F.get(sizes, F.lit(0)) - total, F.lit(0.0))

    def part_area(part: Column) -> Column:
        return _let(F.transform(part, lambda r: F.abs(ring_area(r))), shell_less_holes)

    return F.aggregate(F.transform(_col(geom), part_area), F.lit(0.0), lambda acc, a: acc + a)


def envelope_area(geom: Column | str) -> Column:
    return (xmax(geom) - xmin(geom)) * (ymax(geom) - ymin(geom))


def snap_to_grid(geom: Column | str, size: float) -> Column:
    return map_vertices(
        geom, lambda v: make_point(F.rint(v["x"] / size) * size, F.rint(v["y"] / size) * size)
    )


def compactness(geom: Column | str) -> Column:
    """Area over bounding-box area; NULL when the box is flat."""
    return F.try_divide(area(geom), envelope_area(geom))


def map_vertices(geom: Column | str, fn) -> Column:
    return F.transform(
        _col(geom), lambda part: F.transform(part, lambda ring: F.transform(ring, fn))
    )


def orient_ccw(geom: Column | str) -> Column:
    """Shells counter-clockwise, holes clockwise."""

    def orient(ring: Column, index: Column) -> Column:
        signed = ring_area(ring)
        wrong = F.when(index == 0, signed < 0).otherwise(signed > 0)
        return F.when(wrong, F.reverse(ring)).otherwise(ring)

    return F.transform(_col(geom), lambda part: F.transform(part, orient))


def clean_rings(geom: Column | str) -> Column:
    """Close rings, drop repeated vertices and rings without area, orient the rest.

    Self-intersections are left as they are; ``is_simple`` flags them and
    ``arrangement.make_valid`` rebuilds them.
    """

    def close(ring: Column) -> Column:
        open_end = ~F.get(ring, F.lit(0)).eqNullSafe(F.get(ring, F.array_size(ring) - 1))
        return F.when(open_end, F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)

    def tidy(ring: Column) -> Column:
        distinct = F.filter(ring, lambda v, i: (i == 0) | ~v.eqNullSafe(F.get(ring, i - 1)))
        return _let(distinct, close)

    def drop_flat(part: Column) -> Column:
        kept = F.filter(part, lambda r: (F.array_size(r) >= 4) & (ring_area(r) != 0))
        return F.when(ring_area(F.get(part, F.lit(0))) != 0, kept).otherwise(F.slice(part, 1, 0))

    def tidy_part(part: Column) -> Column:
        return _let(F.transform(part, tidy), drop_flat)

    parts = F.filter(F.transform(_col(geom), tidy_part), lambda part: F.array_size(part) > 0)
    return orient_ccw(parts)


# --- tables of parts and rings ----------------------------------------------


def dump_parts(df: DataFrame, geom: str = "geom") -> DataFrame:
    """One row per part, numbered from 1 in ``part_no``; empty geometries vanish."""
    others = [c for c in df.columns if c != geom]
    parts = df.select(*others, F.posexplode(geom).alias("_pos", "_part"))
    return parts.select(*others, (F.col("_pos") + 1).alias("part_no"), F.array("_part").alias(geom))


def dump_rings(df: DataFrame, geom: str = "geom") -> DataFrame:
    """One row per ring: ``part_no`` and ``ring_no`` from 1, ``ring`` the vertices."""
    others = [c for c in df.columns if c != geom]
    parts = df.select(*others, F.posexplode(geom).alias("_pos", "_part"))
    return parts.select(*others, (F.col("_pos") + 1).alias("part_no"), F.posexplode("_part").alias("_ring", "ring")).select(
        *others, "part_no", (F.col("_ring") + 1).alias("ring_no"), "ring"
    )


def ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs of one ring."""
    n = F.greatest(F.array_size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, F.lit(1), n),
        F.slice(ring, F.lit(2), n),
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def edges(geom: Column | str) -> Column:
    """All edges of all rings, as one array."""
    return F.flatten(F.transform(rings(geom), ring_edges))


# --- predicates -------------------------------------------------------------


def _side(e: Column, px: Column, py: Column) -> Column:
    """Positive left of the directed edge, negative right, zero on its line.

    A cross product, so there is no division and a point on an edge is
    recognised exactly."""
    return (e["x2"] - e["x1"]) * (py - e["y1"]) - (px - e["x1"]) * (e["y2"] - e["y1"])


def crossings(edge_list: Column, px: Column, py: Column) -> Column:
    """How many edges a rightward ray from the point meets. The cheap range test
    comes first: lambdas are interpreted, and most edges fail it."""
    return F.array_size(
        F.filter(
            edge_list,
            lambda e: ((e["y1"] <= py) != (e["y2"] <= py)) & ((_side(e, px, py) > 0) == (e["y2"] > e["y1"])),
        )
    )


def on_edge(edge_list: Column, px: Column, py: Column) -> Column:
    return F.exists(
        edge_list,
        lambda e: (py >= F.least(e["y1"], e["y2"]))
        & (py <= F.greatest(e["y1"], e["y2"]))
        & (px >= F.least(e["x1"], e["x2"]))
        & (px <= F.greatest(e["x1"], e["x2"]))
        & (_side(e, px, py) == 0),
    )


def intersects(point: Column | str, geom: Column | str) -> Column:
    """Point in polygon, boundary included (even-odd over all rings)."""
    px, py = x(point), y(point)
    inside = _let(edges(geom), lambda lines: (crossings(lines, px, py) % 2 == 1) | on_edge(lines, px, py))
    return F.when(px.isNotNull() & _col(geom).isNotNull(), inside)


def contains(geom: Column | str, point: Column | str) -> Column:
    """Point strictly inside the polygon."""
    px, py = x(point), y(point)
    inside = _let(edges(geom), lambda lines: (crossings(lines, px, py) % 2 == 1) & ~on_edge(lines, px, py))
    return F.when(px.isNotNull() & _col(geom).isNotNull(), inside)


# --- coordinate systems -----------------------------------------------------


def to_mercator(geom: Column | str) -> Column:
    """Longitude/latitude degrees to spherical mercator metres (EPSG:3857)."""

    def project(v: Column) -> Column:
        return make_point(
            F.radians(v["x"]) * MERCATOR_RADIUS,
            F.log(F.tan(F.lit(math.pi / 4) + F.radians(v["y"]) / 2)) * MERCATOR_RADIUS,
        )

    return map_vertices(geom, project)


def from_mercator(geom: Column | str) -> Column:
    def unproject(v: Column) -> Column:
        return make_point(
            F.degrees(v["x"] / MERCATOR_RADIUS),
            F.degrees(2 * F.atan(F.exp(v["y"] / MERCATOR_RADIUS)) - math.pi / 2),
        )

    return map_vertices(geom, unproject)


# Geographic reference systems whose shift to WGS84 is null.
GEOGRAPHIC_SRIDS = (4326, 4283, 7844)


def set_srid(df: DataFrame, srid: int, geom: str = "geom") -> DataFrame:
    """Record the reference system in the column's metadata."""
    return df.withMetadata(geom, {"srid": srid})


def get_srid(df: DataFrame, geom: str = "geom") -> int | None:
    return df.schema[geom].metadata.get("srid")


def to_wgs84(df: DataFrame, geom: str = "geom", srid: int | None = None) -> DataFrame:
    """Reproject to longitude/latitude (EPSG:4326)."""
    source = srid if srid is not None else get_srid(df, geom)
    if source in GEOGRAPHIC_SRIDS:
        return set_srid(df, 4326, geom)
    if source == 3857:
        return set_srid(df.withColumn(geom, from_mercator(geom)), 4326, geom)
    raise ValueError(f"no transformation from SRID {source}")


# --- text -------------------------------------------------------------------


def to_wkt(geom: Column | str) -> Column:
    """MULTIPOLYGON text (POLYGON for one part)."""

    def ring_text(ring: Column) -> Column:
        return F.concat(
            F.lit("("),
            F.array_join(
                F.transform(
                    ring, lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string"))
                ),
                ",",
            ),
            F.lit(")"),
        )

    part_texts = F.transform(
        _col(geom), lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, ring_text), ","), F.lit(")"))
    )
    return (
        F.when(F.array_size(_col(geom)) == 0, F.lit("MULTIPOLYGON EMPTY"))
        .when(F.array_size(_col(geom)) == 1, F.concat(F.lit("POLYGON"), F.get(part_texts, F.lit(0))))
        .when(
            _col(geom).isNotNull(),
            F.concat(F.lit("MULTIPOLYGON("), F.array_join(part_texts, ","), F.lit(")")),
        )
    )


def point_wkt(point: Column | str) -> Column:
    return F.concat(
        F.lit("POINT("), x(point).cast("string"), F.lit(" "), y(point).cast("string"), F.lit(")")
    )


def line_wkt(line: Column | str) -> Column:
    pairs = F.transform(_col(line), lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string")))
    return F.when(F.array_size(_col(line)) == 0, F.lit("LINESTRING EMPTY")).otherwise(
        F.concat(F.lit("LINESTRING("), F.array_join(pairs, ","), F.lit(")"))
    )


def from_wkt(text: Column | str) -> Column:
    """POLYGON, MULTIPOLYGON, LINESTRING or POINT text to the nested-array form."""
    body = F.regexp_replace(F.upper(_col(text)), r"^\s*[A-Z]+\s*Z?\s*", "")
    # close up the separators, then cut part from part, ring from ring, vertex from vertex
    tidy = F.regexp_replace(F.regexp_replace(body, r"\s*([(),])\s*", "$1"), r"\s+", " ")
    flat = F.regexp_replace(tidy, r"^\(+|\)+$", "")
    part_list = F.split(flat, r"\)\),\(\(")

    def to_vertex(pair: Column) -> Column:
        xy = F.split(pair, " ")
        return make_point(F.get(xy, F.lit(0)), F.get(xy, F.lit(1)))

    def to_ring(ring_text: Column) -> Column:
        return F.transform(F.split(ring_text, ","), to_vertex)

    parsed = F.transform(part_list, lambda p: F.transform(F.split(p, r"\),\("), to_ring))
    empty = F.array().cast(GEOM_TYPE)
    return F.when(F.upper(_col(text)).contains("EMPTY"), empty).otherwise(parsed)


# --- geohash ----------------------------------------------------------------

# Fixed value: the geohash alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def geohash_xy(lon: Column, lat: Column, precision: int = 5) -> Column:
    """Geohash by interleaving the bits of two integers, longitude first."""
    bits = 5 * precision
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2

    def cell(value: Column, low: float, span: float, n: int) -> Column:
        scaled = F.floor((value - low) / span * float(2**n)).cast("long")
        return F.greatest(F.least(scaled, F.lit(2**n - 1)), F.lit(0))

    lon_cell, lat_cell = cell(lon, -180.0, 360.0, lon_bits), cell(lat, -90.0, 180.0, lat_bits)
    chars = []
    for i in range(precision):
        value = F.lit(0).cast("long")
        for b in range(5):
            bit = 5 * i + b
            source, n = (lon_cell, lon_bits) if bit % 2 == 0 else (lat_cell, lat_bits)
            one = F.shiftright(source, n - 1 - bit // 2).bitwiseAND(F.lit(1))
            value = value + F.shiftleft(one, 4 - b)
        chars.append(F.substring(F.lit(GEOHASH_ALPHABET), value.cast("int") + 1, F.lit(1)))
    return F.concat(*chars)


def geohash(geom: Column | str, precision: int = 5) -> Column:
    """Geohash of the bounding-box centre."""
    return geohash_xy(
        (xmin(geom) + xmax(geom)) / 2, (ymin(geom) + ymax(geom)) / 2, precision
    )

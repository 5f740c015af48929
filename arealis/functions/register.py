"""The geometry functions under SQL names.

Most are SQL functions, so Catalyst inlines their bodies into the query, the
set-returning one too; the others are the Arrow functions under a SQL name.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from arealis.functions.arrangement import _buffer, _repair
from arealis.functions.arrow_geometry import _draw, _intersection_area, _is_simple, _simplify_dp, _simplify_vw, _subdivide
from arealis.functions.delaunay import _concave_hull
from arealis.functions.geometry import GEOGRAPHIC_SRIDS, GEOHASH_ALPHABET, GEOM_TYPE, MERCATOR_RADIUS, POINT_TYPE

_VERTICES = "flatten(flatten(g))"
_RING_AREA = (
    "aggregate(r, named_struct('px', 0D, 'py', 0D, 's', 0D), (a, v) -> named_struct("
    "'px', v.x - r[0].x, 'py', v.y - r[0].y,"
    " 's', a.s + a.px * (v.y - r[0].y) - (v.x - r[0].x) * a.py), a -> abs(a.s) / 2)"
)
_STATE = (
    "aggregate(flatten(transform(flatten(g), r -> zip_with("
    "slice(r, 1, greatest(size(r) - 1, 0)), slice(r, 2, greatest(size(r) - 1, 0)),"
    " (p, q) -> named_struct('p', p, 'q', q)))),"
    " named_struct('n', 0, 'on', false), (s, e) -> named_struct("
    "'n', s.n + if((e.p.y <= pt.y AND e.q.y > pt.y AND (e.q.x - e.p.x) * (pt.y - e.p.y) - (pt.x - e.p.x) * (e.q.y - e.p.y) > 0)"
    " OR (e.q.y <= pt.y AND e.p.y > pt.y AND (e.q.x - e.p.x) * (pt.y - e.p.y) - (pt.x - e.p.x) * (e.q.y - e.p.y) < 0), 1, 0),"
    " 'on', s.on OR ((e.q.x - e.p.x) * (pt.y - e.p.y) - (pt.x - e.p.x) * (e.q.y - e.p.y) = 0"
    " AND pt.x BETWEEN least(e.p.x, e.q.x) AND greatest(e.p.x, e.q.x)"
    " AND pt.y BETWEEN least(e.p.y, e.q.y) AND greatest(e.p.y, e.q.y))))"
)

_PART_TEXTS = (
    "transform(g, p -> concat('(', array_join(transform(p, r -> concat('(', array_join(transform(r,"
    " v -> concat_ws(' ', CAST(v.x AS STRING), CAST(v.y AS STRING))), ','), ')')), ','), ')'))"
)

# name -> (parameters, result type, body)
SQL_FUNCTIONS = {
    "st_makepoint": ("px DOUBLE, py DOUBLE", POINT_TYPE, "named_struct('x', px, 'y', py)"),
    "st_x": (f"pt {POINT_TYPE}", "DOUBLE", "pt.x"),
    "st_y": (f"pt {POINT_TYPE}", "DOUBLE", "pt.y"),
    "st_npoints": (f"g {GEOM_TYPE}", "INT", f"size({_VERTICES})"),
    "st_numgeometries": (f"g {GEOM_TYPE}", "INT", "size(g)"),
    "st_isempty": (f"g {GEOM_TYPE}", "BOOLEAN", f"size({_VERTICES}) = 0"),
    "st_xmin": (f"g {GEOM_TYPE}", "DOUBLE", f"array_min({_VERTICES}.x)"),
    "st_ymin": (f"g {GEOM_TYPE}", "DOUBLE", f"array_min({_VERTICES}.y)"),
    "st_xmax": (f"g {GEOM_TYPE}", "DOUBLE", f"array_max({_VERTICES}.x)"),
    "st_ymax": (f"g {GEOM_TYPE}", "DOUBLE", f"array_max({_VERTICES}.y)"),
    "st_envelope": (
        f"g {GEOM_TYPE}",
        GEOM_TYPE,
        "transform(array(named_struct('x0', array_min(flatten(flatten(g)).x), 'y0', array_min(flatten(flatten(g)).y),"
        " 'x1', array_max(flatten(flatten(g)).x), 'y1', array_max(flatten(flatten(g)).y))), b -> if(b.x0 IS NULL, NULL,"
        " array(array(array(named_struct('x', b.x0, 'y', b.y0), named_struct('x', b.x0, 'y', b.y1), named_struct('x', b.x1, 'y', b.y1),"
        " named_struct('x', b.x1, 'y', b.y0), named_struct('x', b.x0, 'y', b.y0))))))[0]",
    ),
    "st_astext": (
        f"g {GEOM_TYPE}",
        "STRING",
        f"CASE WHEN size(g) = 0 THEN 'MULTIPOLYGON EMPTY' WHEN size(g) = 1 THEN concat('POLYGON', {_PART_TEXTS}[0])"
        f" WHEN g IS NOT NULL THEN concat('MULTIPOLYGON(', array_join({_PART_TEXTS}, ','), ')') END",
    ),
    # the parts, for LATERAL VIEW explode
    "st_dump": (f"g {GEOM_TYPE}", f"ARRAY<{GEOM_TYPE}>", "transform(g, p -> array(p))"),
    "st_area": (
        f"g {GEOM_TYPE}",
        "DOUBLE",
        f"aggregate(transform(g, p -> aggregate(transform(p, r -> {_RING_AREA}), named_struct('i', 0, 's', 0D),"
        " (a, z) -> named_struct('i', a.i + 1, 's', if(a.i = 0, z, a.s - z)), a -> a.s)), 0D, (a, z) -> a + z)",
    ),
    "st_intersects": (f"pt {POINT_TYPE}, g {GEOM_TYPE}", "BOOLEAN", f"if(pt.x IS NULL OR pt.y IS NULL OR g IS NULL, NULL, transform(array({_STATE}), s -> s.on OR s.n % 2 = 1)[0])"),
    "st_contains": (f"g {GEOM_TYPE}, pt {POINT_TYPE}", "BOOLEAN", f"if(pt.x IS NULL OR pt.y IS NULL OR g IS NULL, NULL, transform(array({_STATE}), s -> NOT s.on AND s.n % 2 = 1)[0])"),
}

_EARTH = f"{MERCATOR_RADIUS}D"
_GEOGRAPHIC = ", ".join(map(str, GEOGRAPHIC_SRIDS))
# bit k of a geohash of n characters: longitude and latitude in turn, highest bits first
_HASH_BIT = (
    "(shiftright(if(k % 2 = 0, c.lon, c.lat), if(k % 2 = 0, (5 * n + 1) DIV 2, 5 * n DIV 2) - 1 - k DIV 2) & 1)"
)
_PARSED = (
    r"transform(split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(t), r'^\s*[A-Z]+\s*Z?\s*', ''),"
    r" r'\s*([(),])\s*', '$1'), r'\s+', ' '), r'^\(+|\)+$', ''), r'\)\),\(\('), p -> transform(split(p, r'\),\('), r -> transform(split(r, ','),"
    r" v -> named_struct('x', CAST(get(split(v, ' '), 0) AS DOUBLE), 'y', CAST(get(split(v, ' '), 1) AS DOUBLE)))))"
)

# these use functions that are registered before them
LATE_FUNCTIONS = {
    "st_geomfromtext": ("t STRING", GEOM_TYPE, f"CASE WHEN contains(upper(t), 'EMPTY') THEN CAST(array() AS {GEOM_TYPE}) WHEN t IS NOT NULL THEN {_PARSED} END"),
    "st_geohash": (
        f"g {GEOM_TYPE}, n INT",
        "STRING",
        "transform(array(named_struct("
        "'lon', greatest(least(CAST(floor((st_xmin(g) + st_xmax(g) + 360D) / 720D * power(2D, (5 * n + 1) DIV 2)) AS BIGINT), CAST(power(2D, (5 * n + 1) DIV 2) AS BIGINT) - 1), 0L),"
        " 'lat', greatest(least(CAST(floor((st_ymin(g) + st_ymax(g) + 180D) / 360D * power(2D, 5 * n DIV 2)) AS BIGINT), CAST(power(2D, 5 * n DIV 2) AS BIGINT) - 1), 0L))),"
        " c -> if(c.lon IS NULL, NULL, array_join(transform(sequence(0, n - 1), i -> substr('" + GEOHASH_ALPHABET + "', CAST(aggregate(sequence(5 * i, 5 * i + 4), 0L, (a, k) -> a * 2 + "
        + _HASH_BIT
        + ") AS INT) + 1, 1)), '')))[0]",
    ),
    "st_transform": (
        f"g {GEOM_TYPE}, source INT, target INT",
        GEOM_TYPE,
        f"CASE WHEN source = target OR (source IN ({_GEOGRAPHIC}) AND target IN ({_GEOGRAPHIC})) THEN g"
        f" WHEN source IN ({_GEOGRAPHIC}) AND target = 3857 THEN transform(g, p -> transform(p, r -> transform(r, v -> named_struct("
        f"'x', radians(v.x) * {_EARTH}, 'y', ln(tan(pi() / 4 + radians(v.y) / 2)) * {_EARTH}))))"
        f" WHEN source = 3857 AND target IN ({_GEOGRAPHIC}) THEN transform(g, p -> transform(p, r -> transform(r, v -> named_struct("
        f"'x', degrees(v.x / {_EARTH}), 'y', degrees(2 * atan(exp(v.y / {_EARTH})) - pi() / 2)))))"
        f" ELSE CAST(raise_error(concat('no transformation from SRID ', source, ' to ', target)) AS {GEOM_TYPE}) END",
    ),
    "st_buffer": (f"g {GEOM_TYPE}, away DOUBLE", GEOM_TYPE, "st_bufferwith(g, away, false)"),
    "st_buffermetres": (f"g {GEOM_TYPE}, metres DOUBLE", GEOM_TYPE, "st_bufferwith(g, metres, true)"),
}


# no point of an empty polygon; the points of one call are a value of the row
_DRAWN = "SELECT p.x, p.y FROM (SELECT explode(if(size(g) > 0, st_drawpoints(g, n, seed), NULL)) AS p)"


def register(spark: SparkSession) -> None:
    """Make the functions known to ``spark.sql`` for this session."""
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    spark.udf.register("st_intersection_area", _intersection_area)
    spark.udf.register("st_issimple", _is_simple)
    spark.udf.register("st_simplify", _simplify_dp)
    spark.udf.register("st_simplifyvw", _simplify_vw)
    spark.udf.register("st_subdivide", _subdivide)
    spark.udf.register("st_makevalid", _repair)
    spark.udf.register("st_bufferwith", _buffer)
    spark.udf.register("st_concavehull", _concave_hull)
    for name, (parameters, result, body) in LATE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    spark.udf.register("st_drawpoints", _draw)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION st_randompointsinpolygon(g {GEOM_TYPE}, n INT, seed INT) RETURNS TABLE(x DOUBLE, y DOUBLE) RETURN {_DRAWN}")

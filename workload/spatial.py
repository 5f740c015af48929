"""Geometry functions, spatial joins and point generation."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import arrow_geometry as R
from arealis.functions import geometry as G
from arealis.functions.arrangement import buffered, generated, make_valid
from arealis.functions.delaunay import concave_hull
from arealis.functions.register import register
from arealis.operators import spatial_join as J
from arealis.operators import stats as A
from arealis.plans import dots, overlay, thinning
from arealis.session import stored
from workload.derived import (
    CUSTOMER_POINTS_SQL,
    POINTS_SQL,
    PROFILE_SQL,
    RAGGED_SQL,
    REGIONS_SQL,
    SQUARE,
    centre,
    code,
    customer_points,
    half_width,
    lattice,
    order_points,
    ragged,
    region_profile,
    regions,
    suppliers,
    template,
    with_sql,
)


def shapes(spark, sf):
    return regions(spark, sf).select("k", "code", "geom")


# --- accessors ----------------------------------------------------------------------------------


def points(spark, sf):
    made = order_points(spark, sf).select("point_id", G.make_point("x", "y").alias("p"))
    return made.select("point_id", G.x("p").alias("px"), G.y("p").alias("py"))


def wkt_out(spark, sf):
    return shapes(spark, sf).select("code", G.to_wkt("geom").alias("wkt"))


def wkt_round_trip(spark, sf):
    back = shapes(spark, sf).select("code", G.from_wkt(G.to_wkt("geom")).alias("geom"))
    return back.select("code", G.npoints("geom").alias("n"), G.area("geom").alias("area"))


def vertex_counts(spark, sf):
    return shapes(spark, sf).select("code", G.npoints("geom").alias("n"))


def boxes(spark, sf):
    boxed = G.with_bbox(shapes(spark, sf)).select("code", "xmin", "ymin", "xmax", "ymax", G.area(G.envelope("geom")).alias("box_area"))
    return boxed.filter(F.col("xmin").isNotNull())


def parts(spark, sf):
    dumped = G.dump_parts(shapes(spark, sf))
    return dumped.select("code", "part_no", G.num_parts("geom").alias("parts"), G.area("geom").alias("area"))


def dumped_rings(spark, sf):
    return G.dump_rings(shapes(spark, sf)).select("code", "part_no", "ring_no", F.size("ring").alias("n"))


def empties(spark, sf):
    return shapes(spark, sf).select("code", G.is_empty("geom").alias("is_empty"))


def areas(spark, sf):
    return shapes(spark, sf).select("code", G.area("geom").alias("area"))


def compact(spark, sf):
    snapped = shapes(spark, sf).select("code", G.compactness("geom").alias("compactness"))
    return snapped.filter(F.col("compactness").isNotNull())


def slivers(spark, sf):
    """Regions that fill little of their box after snapping to a coarse grid."""
    snapped = shapes(spark, sf).select("code", G.compactness(G.clean_rings(G.snap_to_grid("geom", 1 / 1024))).alias("c"))
    return snapped.filter(F.col("c") < 0.6)


def guards(spark, sf):
    return A.valid_geom(shapes(spark, sf)).select("code")


def viewport(spark, sf):
    return A.in_viewport(G.with_bbox(shapes(spark, sf)), 120.0, -35.0, 140.0, -20.0).select("code")


def summary(spark, sf):
    return A.geometry_summary(shapes(spark, sf), "code")


def collected(spark, sf):
    dumped = G.dump_parts(shapes(spark, sf))
    return A.collect_parts(dumped, "code", "part_no").select("code", G.num_parts("geom").alias("parts"), G.to_wkt("geom").alias("wkt"))


def lat_long(spark, sf):
    made = order_points(spark, sf).select("point_id", G.make_point("x", "y").alias("geom"))
    placed = A.with_xy(made)
    return placed.select("point_id", F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"))


# --- predicates and joins ------------------------------------------------------------------------------


def tagged(spark, sf):
    bdy = regions(spark, sf).select("code", "state", "geom")
    return J.tag_points(order_points(spark, sf), bdy).select("point_id", "kind", "code", "state")


def tagging_report(spark, sf):
    """Points tagged per region, and in all, for the end of a tagging run."""
    tags = J.tag_points(order_points(spark, sf), shapes(spark, sf).select("code", "geom"))
    return tags.groupBy("code").agg(F.count(F.lit(1)).alias("tagged"))


def strictly_within(spark, sf):
    """Pairs of the tagging join that are strictly inside, by the column function."""
    bdy = shapes(spark, sf)
    tags = J.tag_points(order_points(spark, sf), bdy.select("code", "geom")).select("point_id", "x", "y", "code")
    both = tags.join(bdy.select("code", "geom"), "code")
    p = G.make_point("x", "y")
    return both.select("point_id", "code", G.contains("geom", p).alias("inside"), G.intersects(p, "geom").alias("touches"))


def kept_points(spark, sf):
    return J.tag_points(order_points(spark, sf), shapes(spark, sf).select("code", "geom"), "left").select("point_id", "code")


def shuffled_tags(spark, sf):
    """The tagging join on its shuffle path, with hot cells split."""
    bdy = shapes(spark, sf).select("code", "geom")
    return J.tag_points(order_points(spark, sf), bdy, broadcast_bytes=0, hot_rows=2000).select("point_id", "code")


def near(spark, sf):
    bdy = shapes(spark, sf).select("code", "geom")
    found = J.tag_points_within(customer_points(spark, sf), bdy, 20000.0)
    return found.select("point_id", "code", F.round("distance", 3).alias("distance"))


_ON_EDGE = """((x2 - x1) * (p.y - y1) - (p.x - x1) * (y2 - y1) = 0 AND p.x BETWEEN least(x1, x2) AND greatest(x1, x2)
  AND p.y BETWEEN least(y1, y2) AND greatest(y1, y2))"""
_CROSSES = "CASE WHEN (y1 > p.y) <> (y2 > p.y) AND p.x < (x2 - x1) * (p.y - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END"
TAGS_SQL = f"""
tags AS (
  SELECT p.point_id, p.kind, e.code, bool_or({_ON_EDGE}) AS on_edge, sum({_CROSSES}) % 2 = 1 AS odd
  FROM points p JOIN boxes b ON p.x BETWEEN b.xmin AND b.xmax AND p.y BETWEEN b.ymin AND b.ymax JOIN edges e ON e.k = b.k
  GROUP BY p.point_id, p.kind, e.code)
"""

_R = "6371008.8::DOUBLE"
NEAR_SQL = f"""
reach AS (SELECT *, (20000.0::DOUBLE / ({_R} * pi() / 180)) AS up FROM boxes),
cand AS (
  SELECT p.point_id, p.x AS px, p.y AS py, b.k FROM cpoints p JOIN reach b
  ON p.y BETWEEN b.ymin - up AND b.ymax + up AND p.x BETWEEN b.xmin - 2 * up AND b.xmax + 2 * up),
flat AS (
  SELECT c.point_id, e.code, px, py, x1, y1, x2, y2, cos(radians(py)) AS s FROM cand c JOIN edges e USING (k)),
line AS (
  SELECT *, (x1 - px) * s AS ax, y1 - py AS ay, (x2 - x1) * s AS dx, y2 - y1 AS dy FROM flat),
foot AS (
  SELECT *, least(greatest(-(ax * dx + ay * dy) / (dx * dx + dy * dy), 0), 1) AS t FROM line),
metres AS (
  SELECT *, 2 * {_R} * asin(sqrt(pow(sin(radians(y1 + t * (y2 - y1) - py) / 2), 2)
    + cos(radians(py)) * cos(radians(y1 + t * (y2 - y1))) * pow(sin(radians(x1 + t * (x2 - x1) - px) / 2), 2))) AS m FROM foot),
best AS (
  SELECT point_id, code, min(m) AS m, sum(CASE WHEN (y1 > py) <> (y2 > py) AND px < (x2 - x1) * (py - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1 AS odd,
    bool_or((x2 - x1) * (py - y1) - (px - x1) * (y2 - y1) = 0 AND px BETWEEN least(x1, x2) AND greatest(x1, x2) AND py BETWEEN least(y1, y2) AND greatest(y1, y2)) AS on_edge
  FROM metres GROUP BY point_id, code)
"""


def _squares(spark, sf):
    """Boxes around customers' points, for overlaps with known areas."""
    k = F.col("c_custkey")
    half = (k % 8 + 1) / 8.0
    px, py = F.col("x"), F.col("y")
    pts = customer_points(spark, sf).withColumnRenamed("point_id", "c_custkey")
    geom = G.map_vertices(template([[SQUARE]]), lambda v: G.make_point(px + half * v["x"], py + half * v["y"]))
    return pts.select(k.alias("box_id"), geom.alias("geom"))


def overlaps(spark, sf):
    """Customer boxes mostly covered by a region's box."""
    bdy = shapes(spark, sf).select("code", G.envelope("geom").alias("geom"))
    found = J.match_by_overlap(bdy, _squares(spark, sf), 0.5)
    return found.select("a_code", "b_box_id", F.round("common_area", 9).alias("common_area"), F.round("overlap", 9).alias("overlap"))


def common_areas(spark, sf):
    """Common area of every region and customer box that meet, holes included."""
    pairs = J.candidate_pairs(shapes(spark, sf).select("code", "geom"), _squares(spark, sf))
    common = pairs.select("a_code", "b_box_id", R.intersection_area("a_geom", "b_geom").alias("common_area"))
    # generated, so that the filter does not work each area out twice
    return generated(common, "common_area", F.round("common_area", 9)).filter(F.col("common_area") > 0)


SQUARES_SQL = """
squares AS (
  SELECT point_id AS box_id, x - (point_id % 8 + 1) / 8.0::DOUBLE AS bx0, x + (point_id % 8 + 1) / 8.0::DOUBLE AS bx1,
    y - (point_id % 8 + 1) / 8.0::DOUBLE AS by0, y + (point_id % 8 + 1) / 8.0::DOUBLE AS by1 FROM cpoints)
"""
# polygon with holes against a box: clip each edge's trapezoid to the box in closed form
COMMON_SQL = """
pairs AS (
  SELECT b.k, b.code, s.box_id, bx0, bx1, by0, by1 FROM boxes b JOIN squares s ON b.xmin <= bx1 AND b.xmax >= bx0 AND b.ymin <= by1 AND b.ymax >= by0),
sided AS (
  SELECT e.*, r.a, sign(sum(e.x1 * e.y2 - e.x2 * e.y1) OVER (PARTITION BY e.k, e.part, e.ring)) * (CASE WHEN e.ring = 1 THEN 1 ELSE -1 END) AS turn
  FROM edges e JOIN ring_areas r USING (k, part, ring)),
cut AS (
  SELECT p.code, p.box_id, -turn * sign(x2 - x1) AS sgn, by0, by1, x1, y1, (y2 - y1) / (x2 - x1) AS m,
    greatest(least(x1, x2), bx0) AS lo, least(greatest(x1, x2), bx1) AS hi
  FROM pairs p JOIN sided s USING (k) WHERE x1 <> x2),
ends AS (SELECT *, y1 + m * (lo - x1) AS ya, y1 + m * (hi - x1) AS yb FROM cut WHERE lo < hi),
spans AS (
  SELECT code, box_id, sgn, by0, by1, ya, yb, hi - lo AS width,
    list_sort([0.0::DOUBLE, 1.0::DOUBLE] || CASE WHEN (ya - by0) * (yb - by0) < 0 THEN [(by0 - ya) / (yb - ya)] ELSE [] END
      || CASE WHEN (ya - by1) * (yb - by1) < 0 THEN [(by1 - ya) / (yb - ya)] ELSE [] END) AS ts FROM ends),
pieces AS (SELECT *, unnest(range(1, len(ts))) AS i FROM spans),
heights AS (
  SELECT code, box_id, sgn * width * (ts[i + 1] - ts[i]) * (least(greatest(ya + ts[i] * (yb - ya), by0), by1) - by0
    + least(greatest(ya + ts[i + 1] * (yb - ya), by0), by1) - by0) / 2 AS piece FROM pieces)
"""


# --- random points ---------------------------------------------------------------------------------------------


def random_in_polygon(spark, sf):
    """``k % 40`` points per region: how many, how many inside, how many distinct."""
    base = A.valid_geom(shapes(spark, sf)).select("code", F.col("geom").alias("shape"), "geom", (F.col("k") % 40).alias("n"))
    drawn = dots.random_points(base, "n", "code", seed=3, draw_size=7)
    return drawn.groupBy("code").agg(
        F.count(F.lit(1)).alias("drawn"),
        F.sum(F.when(G.contains("shape", "geom"), 1).otherwise(0)).alias("inside"),
        F.countDistinct("geom").alias("different"),
    )


def dot_map(spark, sf):
    made = dots.dot_density(shapes(spark, sf), region_profile(spark, sf), "g2", "code", per_dot=1000, seed=5)
    return made.groupBy("id").agg(F.count(F.lit(1)).alias("dots"), F.countDistinct("latitude", "longitude").alias("places"))


def dot_map_many(spark, sf):
    tags = {"A": "g2", "N": "g3", "R": "g4"}
    made = dots.dot_density_many(shapes(spark, sf), region_profile(spark, sf), tags, "code", per_dot=1000, seed=5, tag="flag")
    return made.groupBy("flag", "id").agg(F.count(F.lit(1)).alias("dots"))


def sql_random_points(spark, sf):
    """The set-returning function called from SQL."""
    register(spark)
    A.valid_geom(shapes(spark, sf)).createOrReplaceTempView("vw_shapes")
    return spark.sql(
        """SELECT code, count(*) AS drawn, sum(if(st_contains(geom, st_makepoint(p.x, p.y)), 1, 0)) AS inside
        FROM vw_shapes, LATERAL st_randompointsinpolygon(geom, CAST(k % 9 AS INT), CAST(k AS INT)) AS p(x, y) GROUP BY code"""
    )


def sql_functions(spark, sf):
    register(spark)
    shapes(spark, sf).createOrReplaceTempView("vw_regions")
    return spark.sql(
        """SELECT code, st_npoints(geom) AS n, st_area(geom) AS area, st_xmin(geom) AS xmin, st_ymax(geom) AS ymax,
        st_isempty(geom) AS is_empty, st_numgeometries(geom) AS parts,
        st_intersects(st_makepoint(st_xmin(geom), st_ymin(geom)), geom) AS corner FROM vw_regions"""
    )


# --- reshaping ---------------------------------------------------------------------------------------------------


def subdivided(spark, sf):
    pieces = thinning.subdivide(ragged(spark, sf).select("code", "geom"), 64)
    return pieces.groupBy("code").agg(F.round(F.sum(G.area("geom")), 9).alias("area"), (F.max(G.npoints("geom")) <= 64).alias("within"))


def cleaned(spark, sf):
    """Rings with doubled vertices, left open, turned round and padded with a flat ring."""
    doubled = shapes(spark, sf).select(
        "code",
        F.transform("geom", lambda p: F.concat(F.transform(p, lambda r: F.reverse(F.flatten(F.transform(F.slice(r, 1, F.size(r) - 1), lambda v: F.array(v, v))))), F.array(F.slice(F.flatten(p), 1, 2)))).alias("geom"),
    )
    fixed = doubled.select("code", G.clean_rings("geom").alias("geom"))
    return fixed.select("code", G.npoints("geom").alias("n"), G.area("geom").alias("area"), F.size(G.rings("geom")).alias("rings"))


def oriented(spark, sf):
    turned = shapes(spark, sf).select("code", G.orient_ccw(G.map_vertices("geom", lambda v: G.make_point(-v["x"], v["y"]))).alias("geom"))
    rings = G.dump_rings(turned)
    return rings.select("code", "part_no", "ring_no", (G.ring_area(F.col("ring")) > 0).alias("ccw"))


def simple_flags(spark, sf):
    """Crossed rings (two vertices swapped) are flagged, the others pass."""
    k = F.col("k")
    swapped = F.transform("geom", lambda p: F.transform(p, lambda r: F.concat(F.slice(r, 1, 1), F.slice(r, 3, 1), F.slice(r, 2, 1), F.slice(r, 4, F.size(r)))))
    crossed = A.valid_geom(shapes(spark, sf)).select("code", F.when(k % 2 == 0, swapped).otherwise(F.col("geom")).alias("geom"))
    return crossed.select("code", R.is_simple("geom").alias("is_simple"))


# rings that cross themselves or each other, by k % 4, with the area they cover in squares of w
CROSSED = {
    "bow": ([[[(-1, -1), (1, 1), (1, -1), (-1, 1), (-1, -1)]]], 2.0, 2),
    "eight": ([[[(-1, -1), (0, -1), (0, 1), (1, 1), (1, 0), (-1, 0), (-1, -1)]]], 2.0, 2),
    "leaving": ([[SQUARE, [(0, -0.5), (0, 0.5), (2, 0.5), (2, -0.5), (0, -0.5)]]], 3.0, 1),
    "over": ([[SQUARE], [[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]]], 7.0, 1),
}


def made_valid(spark, sf):
    """Rings that cross, made valid: what they cover, in how many parts."""
    k = F.col("k")
    offsets = F.lit(None)
    for i, (parts, _, _) in enumerate(CROSSED.values()):
        offsets = F.when(k % 4 == i, template(parts)).otherwise(offsets)
    cx, cy = centre(k)
    crossed = suppliers(spark, sf).select(F.col("s_suppkey").alias("k")).select(
        "k", code(k).alias("code"), G.map_vertices(offsets, lambda v: G.make_point(cx + half_width(k) * v["x"], cy + half_width(k) * v["y"])).alias("geom")
    )
    mended = crossed.select("code", R.is_simple("geom").alias("before"), make_valid("geom").alias("geom"))
    return mended.select("code", "before", R.is_simple("geom").alias("after"), F.round(G.area("geom"), 9).alias("area"), F.size("geom").alias("parts"))


def dissolved(spark, sf):
    """Lattice rows united: interior borders go, outer ones stay where they are."""
    rows = lattice(spark, sf).withColumn("strip", F.floor(F.col("k") / 8))
    united = overlay.dissolve(rows, "strip")
    return united.select("strip", F.round(G.area("geom"), 9).alias("area"), F.size("geom").alias("parts"), F.size(G.rings("geom")).alias("rings"), F.round(G.xmax("geom") - G.xmin("geom"), 9).alias("wide"))


def dissolved_states(spark, sf):
    """Regions of one state, overlapping ones among them: nothing of them is left out,
    nothing is counted twice, and the result is valid."""
    own = stored(regions(spark, sf).select(F.monotonically_increasing_id().alias("row"), "state", "geom"), "regions").filter(F.size("geom") > 0)
    united = stored(overlay.dissolve(regions(spark, sf), "state").select("state", "geom"), "states")
    # a state's union is compared in pieces, as each would go along with every region
    pieces = thinning.subdivide(G.dump_parts(united).select("state", "geom"))
    pairs = J.candidate_pairs(own, pieces, on=["state"])
    common = pairs.select(F.col("a_row").alias("row"), R.intersection_area("a_geom", "b_geom").alias("area")).groupBy("row").agg(F.sum("area").alias("common"))
    inside = own.join(united.select("state"), "state").join(common, "row", "left").withColumn("area", G.area("geom"))
    kept = inside.groupBy("state").agg(F.count(F.lit(1)).alias("regions"), F.sum(F.when(F.abs(F.coalesce("common", F.lit(0.0)) - F.col("area")) < 1e-6, 1).otherwise(0)).alias("covered"), F.sum("area").alias("total"))
    return united.join(kept, "state").select("state", "regions", "covered", (G.area("geom") <= F.col("total") + 1e-6).alias("once"), R.is_simple("geom").alias("valid"))


def polygonized(spark, sf):
    """The lattice's borders, each once, back to its cells."""
    faces = overlay.polygonize(overlay.layer_edges(lattice(spark, sf)))
    return faces.select(F.round(G.xmin("geom"), 9).alias("i"), F.round(G.ymin("geom"), 9).alias("j"), F.round(G.area("geom"), 9).alias("area"), G.npoints("geom").alias("n"), F.size(G.rings("geom")).alias("rings"))


def lines_merged(spark, sf):
    """The lattice's borders as lines between forks: how many begin or end at a place."""
    lines = overlay.merged_lines(overlay.layer_edges(lattice(spark, sf)).withColumn("layer", F.lit(1)), "layer")
    last = F.get("line", F.size("line") - 1)
    ends = lines.select(F.explode(F.array(F.get("line", F.lit(0)), last)).alias("v"))
    return ends.groupBy(F.col("v.x").alias("x"), F.col("v.y").alias("y")).agg(F.count(F.lit(1)).alias("lines"))


def buffered_areas(spark, sf):
    """Shapes with holes, bays and islands grown by a quarter of their half width."""
    kept = A.valid_geom(shapes(spark, sf)).withColumn("w", half_width(F.col("k")))
    grown = kept.select("code", "w", buffered("geom", F.col("w") / 4).alias("grown"))
    return grown.select("code", F.round(G.area("grown") / (F.col("w") * F.col("w")), 6).alias("area"), F.round((G.xmax("grown") - G.xmin("grown")) / F.col("w"), 6).alias("wide"))


def concave_hulls(spark, sf):
    kept = A.valid_geom(shapes(spark, sf)).filter("k % 4 <> 3")
    tight = kept.select("code", "geom", concave_hull("geom", 0.3).alias("tight"), concave_hull("geom", 1.0).alias("loose"), half_width(F.col("k")).alias("w"))
    return tight.select("code", G.npoints("tight").alias("n"), F.round(G.area("tight") / (F.col("w") * F.col("w")), 9).alias("tight"), F.round(G.area("loose") / (F.col("w") * F.col("w")), 9).alias("loose"))


def sql_all_names(spark, sf):
    """Each geometry function under its SQL name, on every region."""
    register(spark)
    shapes(spark, sf).createOrReplaceTempView("vw_named")
    return spark.sql(
        """WITH g AS (SELECT code, geom, st_envelope(geom) AS box, st_makepoint(st_xmin(geom) + 0.25D, st_ymin(geom) + 0.25D) AS pt FROM vw_named WHERE size(geom) > 0)
        SELECT code, round(st_area(box), 9) AS box_area, round(st_x(pt), 9) AS px, round(st_y(pt), 9) AS py, st_ymax(geom) AS ymax, st_xmax(geom) AS xmax,
        st_intersects(pt, box) AS meets, st_contains(box, st_makepoint((st_xmin(geom) + st_xmax(geom)) / 2, (st_ymin(geom) + st_ymax(geom)) / 2)) AS holds,
        round(st_intersection_area(geom, box), 9) AS common, st_issimple(geom) AS is_simple, size(st_dump(geom)) AS parts, st_numgeometries(geom) AS same_parts, st_isempty(geom) AS is_empty,
        round(st_area(st_simplify(box, 1e-9D)), 9) AS thin_box, st_npoints(st_simplifyvw(box, 1e-12D)) AS box_points, size(st_subdivide(box, 8)) AS pieces,
        st_geomfromtext(st_astext(geom)) = geom AS text_back, st_geohash(geom, 5) AS hash, round(st_xmax(st_transform(st_transform(geom, 7844, 3857), 3857, 4326)), 6) AS there_and_back,
        round(st_area(st_makevalid(geom)), 9) AS area, round(st_xmax(st_buffer(geom, 0.5D)) - st_xmax(geom), 9) AS east, (st_ymax(st_buffermetres(geom, 1000D)) - st_ymax(geom)) / degrees(1000D / 6378137D) BETWEEN 0.994D AND 1.000001D AS north FROM g"""
    )


def hulls(spark, sf):
    kept = A.valid_geom(shapes(spark, sf))
    hull = kept.select("code", R.near_hull("geom", 1e-5).alias("hull"), "geom")
    # a little over the exact hull: perimeter times the radius, plus the disks
    return hull.select("code", F.round(G.area("hull") - G.area(G.orient_ccw("hull")), 6).alias("turned"), F.round(G.xmax("hull") - G.xmax("geom"), 7).alias("grown"))


def buffers(spark, sf):
    kept = A.valid_geom(shapes(spark, sf)).select("code", "geom", R.buffer_hull("geom", 1000.0).alias("grown"))
    degrees = F.degrees(F.lit(1000.0 / G.MERCATOR_RADIUS))
    return kept.select("code", F.round((G.ymax("grown") - G.ymax("geom")) / degrees, 6).alias("north"), F.round((G.ymin("geom") - G.ymin("grown")) / degrees, 6).alias("south"))


def thinned(spark, sf):
    made = ragged(spark, sf).select("code", R.simplify_vw("geom", F.col("w") * F.col("w") / 4).alias("geom"))
    return made.select("code", G.npoints("geom").alias("n"), G.area("geom").alias("area"))


def thinned_by_distance(spark, sf):
    made = ragged(spark, sf).select("code", R.simplify_dp("geom", 0.04).alias("geom"))
    return made.select("code", G.npoints("geom").alias("n"), G.area("geom").alias("area"))


def coverage(spark, sf):
    """A thinned coverage: how many cells, whether what the unpaired edges enclose
    is the sum of the cells (no gap, no overlap), and whether vertices went."""
    cells = lattice(spark, sf)
    thin = thinning.simplify_coverage(cells, "code", 0.02)
    edge = thin.select(F.explode(G.edges("geom")).alias("e")).select("e.*")
    back = edge.select(F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    outer = edge.join(back, ["x1", "y1", "x2", "y2"], "left_anti")
    enclosed = outer.agg(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).scalar()
    before = cells.agg(F.sum(G.npoints("geom"))).scalar()
    totals = thin.agg(F.count(F.lit(1)).alias("cells"), F.sum(G.area("geom")).alias("area"), F.sum(G.npoints("geom")).alias("n"))
    return totals.select("cells", (F.abs(F.col("area") - enclosed) < 1e-6).alias("gapless"), (F.col("n") < before).alias("thinner"))


def nodes(spark, sf):
    return thinning.border_nodes(lattice(spark, sf)).select("x", "y")


def mercator(spark, sf):
    there = shapes(spark, sf).select("code", "geom", G.to_mercator("geom").alias("metres"))
    back = G.from_mercator("metres")
    return there.filter(F.size("geom") > 0).select(
        "code", F.round(G.xmin("metres"), 3).alias("west"), F.round(G.ymin("metres"), 3).alias("south"),
        F.round(G.xmax(back), 6).alias("xmax"), F.round(G.ymax(back), 6).alias("ymax"),
    )


def geohashes(spark, sf):
    return order_points(spark, sf).select("point_id", G.geohash_xy(F.col("x"), F.col("y"), 5).alias("hash"))


def region_hashes(spark, sf):
    return A.valid_geom(shapes(spark, sf)).select("code", G.geohash("geom", 5).alias("hash"))


def geohash_sql(x: str, y: str, precision: int = 5) -> str:
    bits = 5 * precision
    nx, ny = (bits + 1) // 2, bits // 2
    cx = f"CAST(floor(({x} + 180) / 360 * {2**nx}) AS BIGINT)"
    cy = f"CAST(floor(({y} + 90) / 180 * {2**ny}) AS BIGINT)"
    chars = []
    for i in range(precision):
        terms = []
        for b in range(5):
            bit = 5 * i + b
            cell, n = (cx, nx) if bit % 2 == 0 else (cy, ny)
            terms.append(f"((({cell} >> {n - 1 - bit // 2}) & 1) << {4 - b})")
        chars.append(f"substr('{G.GEOHASH_ALPHABET}', CAST({' + '.join(terms)} AS BIGINT) + 1, 1)")
    return " || ".join(chars)


def _lattice_nodes_sql() -> str:
    """Corners where three or four cells meet."""
    return """WITH cells AS (SELECT CAST(s_suppkey % 8 AS DOUBLE) AS i, CAST(s_suppkey // 8 AS DOUBLE) AS j FROM supplier),
    sides AS (SELECT i AS x, j AS y, 'e' AS d, i + 1 AS x2, j AS y2 FROM cells UNION SELECT i, j + 1, 'e', i + 1, j + 1 FROM cells
      UNION SELECT i, j, 'n', i, j + 1 FROM cells UNION SELECT i + 1, j, 'n', i + 1, j + 1 FROM cells),
    ends AS (SELECT x, y FROM sides UNION ALL SELECT x2, y2 FROM sides)
    SELECT x, y FROM ends GROUP BY x, y HAVING count(*) <> 2"""


VALID = "shape IS NOT NULL AND shape <> 'empty'"
QUERIES = {
    "g01_make_point": (points, with_sql(POINTS_SQL, body="SELECT point_id, x AS px, y AS py FROM points")),
    "g02_with_xy": (lat_long, with_sql(POINTS_SQL, body="SELECT point_id, round(y, 5) AS latitude, round(x, 5) AS longitude FROM points")),
    "g03_wkt_out": (
        wkt_out,
        with_sql(
            REGIONS_SQL,
            "rtext AS (SELECT k, part, ring, '(' || string_agg(CAST(x AS VARCHAR) || ' ' || CAST(y AS VARCHAR), ',' ORDER BY seq) || ')' AS t FROM verts GROUP BY k, part, ring)",
            "ptext AS (SELECT k, part, '(' || string_agg(t, ',' ORDER BY ring) || ')' AS t FROM rtext GROUP BY k, part)",
            "gtext AS (SELECT k, CASE WHEN count(*) = 1 THEN 'POLYGON' || max(t) ELSE 'MULTIPOLYGON(' || string_agg(t, ',' ORDER BY part) || ')' END AS t FROM ptext GROUP BY k)",
            body="SELECT code, CASE WHEN shape = 'empty' THEN 'MULTIPOLYGON EMPTY' ELSE t END AS wkt FROM regions LEFT JOIN gtext USING (k)",
        ),
    ),
    "g03_wkt_round_trip": (
        wkt_round_trip,
        with_sql(REGIONS_SQL, body="""SELECT r.code, CAST(CASE WHEN shape = 'empty' THEN 0 ELSE n END AS INT) AS n, CASE WHEN shape = 'empty' THEN 0 ELSE area END AS area
          FROM regions r LEFT JOIN boxes USING (k) LEFT JOIN areas USING (k)"""),
    ),
    "g04_npoints": (
        vertex_counts,
        with_sql(REGIONS_SQL, body="SELECT r.code, CAST(CASE WHEN shape = 'empty' THEN 0 ELSE n END AS INT) AS n FROM regions r LEFT JOIN boxes USING (k)"),
    ),
    "g05_envelope": (boxes, with_sql(REGIONS_SQL, body="SELECT code, xmin, ymin, xmax, ymax, (xmax - xmin) * (ymax - ymin) AS box_area FROM boxes")),
    "g06_dump_parts": (
        parts,
        with_sql(REGIONS_SQL, body="SELECT code, part AS part_no, 1 AS parts, sum(CASE WHEN ring = 1 THEN a ELSE -a END) AS area FROM ring_areas JOIN regions USING (k) GROUP BY code, part"),
    ),
    "g06_dump_rings": (dumped_rings, with_sql(REGIONS_SQL, body="SELECT code, part AS part_no, ring AS ring_no, CAST(count(*) AS INT) AS n FROM verts GROUP BY ALL")),
    "g07_subdivide": (subdivided, with_sql(RAGGED_SQL, body="SELECT code, round(area, 9) AS area, true AS within FROM raggeds")),
    "g08_is_empty": (empties, with_sql(REGIONS_SQL, body="SELECT code, shape = 'empty' AS is_empty FROM regions")),
    "g09_area": (areas, with_sql(REGIONS_SQL, body="SELECT r.code, CASE WHEN shape = 'empty' THEN 0 ELSE area END AS area FROM regions r LEFT JOIN areas USING (k)")),
    "g10_compactness": (compact, with_sql(REGIONS_SQL, body="SELECT code, area / ((xmax - xmin) * (ymax - ymin)) AS compactness FROM boxes JOIN areas USING (k)")),
    "g10_slivers": (slivers, with_sql(REGIONS_SQL, body="SELECT code, area / ((xmax - xmin) * (ymax - ymin)) AS c FROM boxes JOIN areas USING (k) WHERE area / ((xmax - xmin) * (ymax - ymin)) < 0.6")),
    "g11_predicates": (
        strictly_within,
        with_sql(REGIONS_SQL, POINTS_SQL, TAGS_SQL, body="SELECT point_id, code, odd AND NOT on_edge AS inside, true AS touches FROM tags WHERE odd OR on_edge"),
    ),
    "g12_reproject": (
        mercator,
        with_sql(REGIONS_SQL, body="""SELECT code, round(radians(xmin) * 6378137, 3) AS west, round(ln(tan(pi() / 4 + radians(ymin) / 2)) * 6378137, 3) AS south,
          round(xmax, 6) AS xmax, round(ymax, 6) AS ymax FROM boxes"""),
    ),
    "g13_clean_rings": (
        cleaned,
        with_sql(REGIONS_SQL, body="""SELECT r.code, CAST(CASE WHEN shape = 'empty' THEN 0 ELSE n END AS INT) AS n, CASE WHEN shape = 'empty' THEN 0 ELSE area END AS area,
          CAST(CASE shape WHEN 'islands' THEN 3 WHEN 'ring' THEN 2 WHEN 'empty' THEN 0 ELSE CASE WHEN shape IS NOT NULL THEN 1 END END AS INT) AS rings
          FROM regions r LEFT JOIN boxes USING (k) LEFT JOIN areas USING (k)"""),
    ),
    "g13_is_simple": (simple_flags, with_sql(REGIONS_SQL, body=f"SELECT code, k % 2 <> 0 AS is_simple FROM regions WHERE {VALID}")),
    "g14_common_area": (
        common_areas,
        with_sql(REGIONS_SQL, CUSTOMER_POINTS_SQL, SQUARES_SQL, COMMON_SQL, body="SELECT * FROM (SELECT code AS a_code, box_id AS b_box_id, round(sum(piece), 9) AS common_area FROM heights GROUP BY code, box_id) WHERE common_area > 0"),
    ),
    "g15_simplify_vw": (thinned, with_sql(RAGGED_SQL, body="SELECT code, 5 AS n, 4 * w * w AS area FROM ragged")),
    "g16_simplify_dp": (thinned_by_distance, with_sql(RAGGED_SQL, body="SELECT code, 5 AS n, 4 * w * w AS area FROM ragged")),
    "g17_simplify_coverage": (coverage, "SELECT count(*) AS cells, true AS gapless, true AS thinner FROM supplier"),
    "g23_border_nodes": (nodes, _lattice_nodes_sql()),
    "g13_make_valid": (
        made_valid,
        with_sql(REGIONS_SQL, "c(i, a, parts) AS (VALUES " + ", ".join(f"({i}, {a}::DOUBLE, {n})" for i, (_, a, n) in enumerate(CROSSED.values())) + ")",
                 body="SELECT code, false AS before, true AS after, round(a * w * w, 9) AS area, parts FROM regions JOIN c ON k % 4 = i"),
    ),
    "g21_concave_hull": (
        concave_hulls,
        with_sql(REGIONS_SQL, body=f"""SELECT code, CASE WHEN shape = 'elbow' THEN 7 ELSE 5 END AS n, CASE shape WHEN 'elbow' THEN 2.5::DOUBLE WHEN 'diamond' THEN 2 ELSE 4 END AS tight,
          CASE shape WHEN 'elbow' THEN 3.5::DOUBLE WHEN 'diamond' THEN 2 ELSE 4 END AS loose FROM regions WHERE {VALID} AND k % 4 <> 3"""),
    ),
    "g22_buffer": (
        buffered_areas,
        with_sql(REGIONS_SQL, body=f"""SELECT code, round(CASE shape WHEN 'square' THEN 6 + disk WHEN 'diamond' THEN 2 + sqrt(2) + disk WHEN 'elbow' THEN 5 + disk * 1.25 - 0.0625
          WHEN 'ring' THEN 5.75 + disk ELSE 7.75 + 2 * disk END, 6) AS area, CASE shape WHEN 'islands' THEN 4.0::DOUBLE ELSE 2.5 END AS wide
          FROM regions, (SELECT sin(pi() / 16) AS disk) WHERE {VALID}"""),
    ),
    "g23_dissolve": (dissolved, "SELECT s_suppkey // 8 AS strip, count(*)::DOUBLE AS area, 1 AS parts, 1 AS rings, count(*)::DOUBLE + 1 / 64.0::DOUBLE AS wide FROM supplier GROUP BY ALL"),
    "g23_dissolve_states": (dissolved_states, with_sql(REGIONS_SQL, body=f"SELECT state, count(*) AS regions, count(*) AS covered, true AS once, true AS valid FROM regions WHERE {VALID} GROUP BY state")),
    "g23_polygonize": (polygonized, "SELECT (s_suppkey % 8)::DOUBLE AS i, (s_suppkey // 8)::DOUBLE AS j, 1.0::DOUBLE AS area, 65 AS n, 1 AS rings FROM supplier"),
    "g23_merge_lines": (lines_merged, _lattice_nodes_sql().replace("SELECT x, y FROM ends GROUP", "SELECT x, y, count(*) AS lines FROM ends GROUP")),
    "u03_sql_all_names": (
        sql_all_names,
        with_sql(REGIONS_SQL, body=f"""SELECT code, round((xmax - xmin) * (ymax - ymin), 9) AS box_area, round(xmin + 0.25, 9) AS px, round(ymin + 0.25, 9) AS py, ymax, xmax, xmax - xmin >= 0.25 AND ymax - ymin >= 0.25 AS meets, true AS holds,
          round(area, 9) AS common, true AS is_simple, CASE shape WHEN 'islands' THEN 2 ELSE 1 END AS parts, CASE shape WHEN 'islands' THEN 2 ELSE 1 END AS same_parts, false AS is_empty,
          round((xmax - xmin) * (ymax - ymin), 9) AS thin_box, 5 AS box_points, 1 AS pieces, true AS text_back, {geohash_sql("((xmin + xmax) / 2)", "((ymin + ymax) / 2)")} AS hash, round(xmax, 6) AS there_and_back,
          round(area, 9) AS area, 0.5::DOUBLE AS east, true AS north
          FROM boxes JOIN regions USING (k, code) JOIN areas USING (k)"""),
    ),
    "g18_orient": (oriented, with_sql(REGIONS_SQL, body="SELECT DISTINCT code, part AS part_no, ring AS ring_no, ring = 1 AS ccw FROM verts")),
    "g19_geohash": (geohashes, with_sql(POINTS_SQL, body=f"SELECT point_id, {geohash_sql('x', 'y')} AS hash FROM points")),
    "g19_region_geohash": (region_hashes, with_sql(REGIONS_SQL, body=f"SELECT code, {geohash_sql('((xmin + xmax) / 2)', '((ymin + ymax) / 2)')} AS hash FROM boxes")),
    "g20_random_points": (
        random_in_polygon,
        with_sql(REGIONS_SQL, body=f"SELECT code, k % 40 AS drawn, k % 40 AS inside, k % 40 AS different FROM regions WHERE {VALID} AND k % 40 > 0"),
    ),
    "g21_near_hull": (hulls, with_sql(REGIONS_SQL, body=f"SELECT code, 0.0::DOUBLE AS turned, 0.00001::DOUBLE AS grown FROM regions WHERE {VALID}")),
    "g22_buffer_hull": (buffers, with_sql(REGIONS_SQL, body=f"SELECT code, 1.0::DOUBLE AS north, 1.0::DOUBLE AS south FROM regions WHERE {VALID}")),
    "j04_tag_points": (
        tagged,
        with_sql(REGIONS_SQL, POINTS_SQL, TAGS_SQL, body="SELECT point_id, kind, code, state FROM tags JOIN regions USING (code) WHERE odd OR on_edge"),
    ),
    "j04_shuffled": (shuffled_tags, with_sql(REGIONS_SQL, POINTS_SQL, TAGS_SQL, body="SELECT point_id, code FROM tags WHERE odd OR on_edge")),
    "j04_keep_outside": (
        kept_points,
        with_sql(REGIONS_SQL, POINTS_SQL, TAGS_SQL, body="SELECT p.point_id, t.code FROM points p LEFT JOIN (SELECT * FROM tags WHERE odd OR on_edge) t USING (point_id)"),
    ),
    "c04_tagging_report": (tagging_report, with_sql(REGIONS_SQL, POINTS_SQL, TAGS_SQL, body="SELECT code, count(*) AS tagged FROM tags WHERE odd OR on_edge GROUP BY code")),
    "j05_match_by_overlap": (
        overlaps,
        with_sql(REGIONS_SQL, CUSTOMER_POINTS_SQL, SQUARES_SQL, body="""SELECT * FROM (SELECT code AS a_code, box_id AS b_box_id,
          round((least(xmax, bx1) - greatest(xmin, bx0)) * (least(ymax, by1) - greatest(ymin, by0)), 9) AS common_area,
          round((least(xmax, bx1) - greatest(xmin, bx0)) * (least(ymax, by1) - greatest(ymin, by0)) / ((bx1 - bx0) * (by1 - by0)), 9) AS overlap
          FROM boxes JOIN squares ON xmin < bx1 AND xmax > bx0 AND ymin < by1 AND ymax > by0) WHERE overlap > 0.5"""),
    ),
    "j06_within_distance": (
        near,
        with_sql(REGIONS_SQL, CUSTOMER_POINTS_SQL, NEAR_SQL, body="""SELECT point_id, code, round(CASE WHEN odd OR on_edge THEN 0.0::DOUBLE ELSE m END, 3) AS distance
          FROM best WHERE odd OR on_edge OR m <= 20000"""),
    ),
    "p06_geometry_guards": (guards, with_sql(REGIONS_SQL, body=f"SELECT code FROM regions WHERE {VALID}")),
    "p09_lat_long": (lat_long, with_sql(POINTS_SQL, body="SELECT point_id, round(y, 5) AS latitude, round(x, 5) AS longitude FROM points")),
    "p10_viewport": (viewport, with_sql(REGIONS_SQL, body="SELECT code FROM boxes WHERE xmax >= 120 AND xmin <= 140 AND ymax >= -35 AND ymin <= -20")),
    "a08_geometry_summary": (
        summary,
        with_sql(REGIONS_SQL, "counts AS (SELECT code, CASE WHEN shape = 'empty' THEN 0 ELSE n END AS n FROM regions r LEFT JOIN boxes b USING (k, code) WHERE shape IS NOT NULL)",
                 body="""SELECT count(*) AS num_geoms, count(DISTINCT code) AS num_ids, CAST(sum(n) AS BIGINT) AS points, CAST(round(avg(n)) AS INT) AS avg_points,
                   CAST(min(n) AS INT) AS min_points, CAST(max(n) AS INT) AS max_points FROM counts"""),
    ),
    "a14_collect_parts": (
        collected,
        with_sql(
            REGIONS_SQL,
            "rtext AS (SELECT k, part, ring, '(' || string_agg(CAST(x AS VARCHAR) || ' ' || CAST(y AS VARCHAR), ',' ORDER BY seq) || ')' AS t FROM verts GROUP BY k, part, ring)",
            "ptext AS (SELECT k, part, '(' || string_agg(t, ',' ORDER BY ring) || ')' AS t FROM rtext GROUP BY k, part)",
            body="""SELECT code, CAST(count(*) AS INT) AS parts, CASE WHEN count(*) = 1 THEN 'POLYGON' || max(t) ELSE 'MULTIPOLYGON(' || string_agg(t, ',' ORDER BY part) || ')' END AS wkt
              FROM ptext JOIN regions USING (k) GROUP BY code""",
        ),
    ),
    "c02_dot_density": (
        dot_map,
        with_sql(REGIONS_SQL, PROFILE_SQL, body=f"""SELECT code AS id, CAST(round_even(g2, 0) AS BIGINT) // 1000 AS dots, CAST(round_even(g2, 0) AS BIGINT) // 1000 AS places
          FROM regions JOIN profile ON code = region_id WHERE {VALID} AND g2 >= 1000"""),
    ),
    "c03_dot_density_many": (
        dot_map_many,
        with_sql(REGIONS_SQL, PROFILE_SQL, body=f"""SELECT flag, code AS id, CAST(round_even(v, 0) AS BIGINT) // 1000 AS dots FROM regions JOIN
          (SELECT region_id, 'A' AS flag, g2 AS v FROM profile UNION ALL SELECT region_id, 'N', g3 FROM profile UNION ALL SELECT region_id, 'R', g4 FROM profile)
          ON code = region_id WHERE {VALID} AND v >= 1000"""),
    ),
    "u01_random_points_sql": (
        sql_random_points,
        with_sql(REGIONS_SQL, body=f"SELECT code, k % 9 AS drawn, k % 9 AS inside FROM regions WHERE {VALID} AND k % 9 > 0"),
    ),
    "u03_sql_functions": (
        sql_functions,
        with_sql(REGIONS_SQL, body="""SELECT r.code, CAST(CASE WHEN shape = 'empty' THEN 0 ELSE n END AS INT) AS n, CASE WHEN shape = 'empty' THEN 0 ELSE area END AS area,
          xmin, ymax, shape = 'empty' AS is_empty, CAST(CASE shape WHEN 'islands' THEN 2 WHEN 'empty' THEN 0 ELSE CASE WHEN shape IS NOT NULL THEN 1 END END AS INT) AS parts,
          CASE WHEN shape IN ('square', 'elbow', 'ring', 'islands') THEN true WHEN shape = 'diamond' THEN false END AS corner
          FROM regions r LEFT JOIN boxes b USING (k) LEFT JOIN areas USING (k)"""),
    ),
}

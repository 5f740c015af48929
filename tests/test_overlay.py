"""Arrangements, repair, union, buffers and polygonizing against sampling and formulas."""

import numpy as np
import pytest
from conftest import DIAMOND, ELBOW, HOLE, ISLAND, SQUARE, polygon
from pyspark.sql import functions as F

from arealis.functions import arrangement as A
from arealis.functions import delaunay
from arealis.functions import geometry as G
from arealis.functions.arrow_geometry import convex_hull, draw_points, ring_edges, rings_are_simple, signed_area, strictly_inside, trapezoids
from arealis.functions.register import register
from arealis.plans import overlay


def shape(*parts):
    return [[np.array(ring, float) for ring in part] for part in polygon(*parts)]


def area(geom):
    return sum(abs(signed_area(r)) * (1 if i == 0 else -1) for part in geom for i, r in enumerate(part))


def winding(points, ring):
    px, py = points[:, :1], points[:, 1:]
    (x1, y1), (x2, y2) = ring[:-1].T, ring[1:].T
    side = (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)
    return ((y1 <= py) & (y2 > py) & (side > 0)).sum(axis=1) - ((y2 <= py) & (y1 > py) & (side < 0)).sum(axis=1)


BOW = [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]


@pytest.mark.parametrize(
    "geom, size, rings",
    [
        (shape([BOW]), 2.0, [1, 1]),
        (shape([SQUARE, [(2, 1), (2, 3), (6, 3), (6, 1), (2, 1)]]), 12.0, [1]),  # a hole that leaves its shell
        (shape([SQUARE, HOLE, [(2, 2), (2, 3.5), (3.5, 3.5), (3.5, 2), (2, 2)]]), 16 - 4 - 2.25 + 1, [2]),  # holes that overlap
        (shape([SQUARE], [[(2, 2), (6, 2), (6, 6), (2, 6), (2, 2)]]), 28.0, [1]),  # parts that overlap
        (shape([SQUARE], [HOLE]), 16.0, [1]),  # a part inside another
        (shape([SQUARE, HOLE], [[(1.5, 1.5), (2.5, 1.5), (2.5, 2.5), (1.5, 2.5), (1.5, 1.5)]]), 13.0, [2, 1]),  # an island in a hole stays
        (shape([[(0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0)]]), 8.0, [1, 1]),  # touches its own edge
        (shape([SQUARE, SQUARE]), 0.0, []),
        (shape([[(0, 0), (4, 0), (0, 0)]]), 0.0, [1]),  # too short for a check: left as it is
    ],
)
def test_repair(geom, size, rings):
    found = A.repaired(geom)
    assert area(found) == pytest.approx(size) and rings_are_simple(found)
    assert sorted(map(len, found)) == sorted(rings)


@pytest.mark.parametrize("n", [5, 12, 40, 150])
def test_repair_of_random_walks(n):
    rng = np.random.default_rng(n)
    for scale, shift in ((1.0, 0.0), (1e-3, 150.0)):
        ring = rng.random((n, 2))
        ring = np.vstack([ring, ring[:1]])
        found = A.repaired([[ring * scale + shift]])
        tries = rng.random((3000, 2))
        inside = strictly_inside(tries * scale + shift, ring_edges(found)) if found else np.zeros(len(tries), bool)
        assert (inside != (winding(tries, ring) != 0)).sum() <= (0 if shift == 0 else 2)
        assert rings_are_simple(found)


def test_lattice_of_crossings():
    """Many lines through the same points and along each other."""
    e = [(0, i, 8, i) for i in range(9)] + [(i, 0, i, 8) for i in range(9)] + [(0, i, 8 - i, 8) for i in range(8)] + [(2, 3, 6, 3)] * 3
    found, weight = A.split_edges(np.array(e, float), np.ones((len(e), 1), np.int64))
    faces = A.Faces(found, weight)
    areas = [faces._area(loop) for loop in faces.loops]
    assert sum(a for a in areas if a > 0) == pytest.approx(64) and sum(a < 0 for a in areas) == 1
    assert sum(a == 0.5 for a in areas) == 72 and sum(a == 1 for a in areas) == 28


def test_union_of_squares():
    rng = np.random.default_rng(2)
    corner, size = rng.random((250, 2)) * 10, rng.random(250)
    squares = [[np.array([(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)])] for (x, y), s in zip(corner, size)]
    found = A.united(ring_edges(squares))
    tries = rng.random((5000, 2)) * 11
    covered = ((tries[:, None] > corner) & (tries[:, None] < corner + size[:, None])).all(axis=2).any(axis=1)
    assert (covered == strictly_inside(tries, ring_edges(found))).all() and rings_are_simple(found)


def test_union_of_shapes_level_with_a_vertex():
    """What lies right of the place where two edges of another shape begin is beside it."""
    diamond, box = shape([[(0, 0), (1, 1), (0, 2), (-1, 1), (0, 0)]]), shape([[(3, 0), (4, 0), (4, 1), (3, 1), (3, 0)]])
    far = shape([[(-9, 0), (-8, 0), (-8, 3), (-9, 3), (-9, 0)]])
    assert area(A.united(ring_edges([*far, *diamond, *box]))) == 6.0
    assert area(A.united(ring_edges([*shape([[(-20, -20), (20, -20), (20, 20), (-20, 20), (-20, -20)]]), *diamond, *box]))) == 1600.0


# --- buffers --------------------------------------------------------------------------------


def disk(d):
    """Area of a full circle of round joins."""
    return 16 * d * d * np.sin(np.pi / 16)


@pytest.mark.parametrize("d", [0.25, 0.5, 0.9, 1.0, 1.5])
def test_buffer_area(d):
    hole = max(0.0, 2 - 2 * d) ** 2
    assert area(A.grown(shape([SQUARE, HOLE]), d, False)) == pytest.approx(16 + 16 * d + disk(d) - hole)
    assert area(A.grown(shape([ELBOW]), d, False)) == pytest.approx(12 + 16 * d + disk(d) * 5 / 4 - d * d)
    assert area(A.grown(shape([DIAMOND]), d, False)) == pytest.approx(24 + 20 * d + disk(d), rel=5e-3)
    assert area(A.grown(shape([SQUARE], [ISLAND]), d, False)) == pytest.approx(16 + 16 * d + disk(d) + 1 + 4 * d + disk(d))
    assert rings_are_simple(A.grown(shape([SQUARE, HOLE], [ISLAND]), d, False))
    square = shape([SQUARE])
    assert A.grown([], d, False) == [] and A.grown(square, 0.0, False) is square


def test_buffer_of_a_comb():
    """Narrow gaps close, the rest keeps its distance."""
    comb = [(0, 0), (9, 0)] + [(x, y) for k in range(9, 0, -2) for x, y in ((k, 4), (k - 1, 4), (k - 1, 1), (k - 2, 1))][:-2] + [(0, 4), (0, 0)]
    geom = shape([comb])
    found = A.grown(geom, 0.3, False)
    tries = np.random.default_rng(5).random((4000, 2)) * [12, 7] - 1.5
    e = ring_edges(geom)
    e = e[(e[:, :2] != e[:, 2:]).any(axis=1)]
    way = e[:, 2:] - e[:, :2]
    t = np.clip(((tries[:, None] - e[:, :2]) * way).sum(axis=2) / (way * way).sum(axis=1), 0, 1)
    distance = np.sqrt((((e[:, :2] + t[:, :, None] * way) - tries[:, None]) ** 2).sum(axis=2)).min(axis=1)
    distance[strictly_inside(tries, e)] = 0
    sure = (distance < 0.297) | (distance > 0.3)
    assert ((distance < 0.3) == strictly_inside(tries, ring_edges(found)))[sure].all()


def test_buffer_metres():
    """Against great-circle distances of the corners' surroundings, at several latitudes."""
    for lat in (-60.0, -35.0, 0.0, 50.0):
        geom = shape([[(100, lat), (100.2, lat), (100.2, lat + 0.2), (100.1, lat + 0.1), (100, lat + 0.2), (100, lat)]])
        found = A.grown(geom, 5000.0, True)
        rng = np.random.default_rng(7)
        tries = rng.random((4000, 2)) * [0.6, 0.4] + [99.8, lat - 0.1]
        e = ring_edges(geom)
        steps = np.concatenate([e[:, :2] + t * (e[:, 2:] - e[:, :2]) for t in np.linspace(0, 1, 200)])
        a, b = np.radians(tries)[:, None], np.radians(steps)[None]
        h = np.sin((b[..., 1] - a[..., 1]) / 2) ** 2 + np.cos(a[..., 1]) * np.cos(b[..., 1]) * np.sin((b[..., 0] - a[..., 0]) / 2) ** 2
        metres = (2 * G.MERCATOR_RADIUS * np.arcsin(np.sqrt(h))).min(axis=1)
        metres[strictly_inside(tries, e)] = 0
        sure = np.abs(metres - 5000) > 60
        assert ((metres < 5000) == strictly_inside(tries, ring_edges(found)))[sure].all()


# --- Spark ----------------------------------------------------------------------------------


def test_dissolve(spark):
    rows = [
        ("a", 1, polygon([SQUARE])),
        ("a", 2, polygon([[(4, 0), (8, 0), (8, 4), (4, 4), (4, 0)]])),  # a neighbour
        ("a", 3, polygon([[(3, 3), (3, 5), (5, 5), (5, 3), (3, 3)]])),  # clockwise, overlaps
        ("b", 4, polygon([BOW])),
        ("b", 5, None),
        ("c", 6, []),
        ("c", 7, None),
        (None, 8, polygon([SQUARE, HOLE])),
        (None, 9, polygon([HOLE])),
        ("d", 10, polygon([SQUARE])),
        ("d", 11, polygon([SQUARE])),
    ]
    df = spark.createDataFrame(rows, f"g string, id int, geom {G.GEOM_TYPE}").repartition(3)
    want = {"a": (34.0, 1, 1), "b": (2.0, 2, 2), "c": (0.0, 0, 0), None: (16.0, 1, 1), "d": (16.0, 1, 1)}
    for tile in (None, 3.0):
        found = overlay.dissolve(df, "g", tile=tile).select("g", G.area("geom").alias("area"), F.size("geom").alias("parts"), F.size(G.rings("geom")).alias("rings"))
        assert {r["g"]: (r["area"], r["parts"], r["rings"]) for r in found.collect()} == want


def edge_frame(spark, edges):
    return spark.createDataFrame([tuple(map(float, e)) for e in edges], "x1 double, y1 double, x2 double, y2 double").repartition(2)


def box(x, y, s):
    return [(x, y, x + s, y), (x + s, y, x + s, y + s), (x + s, y + s, x, y + s), (x, y + s, x, y)]


def test_polygonize(spark):
    edges = box(0, 0, 10) + box(2, 2, 3) + box(3, 3, 1) + box(20, 0, 1)
    edges += [(0, 0, -5, 0), (5, 2, 5, 1), (10, 10, 12, 12), (12, 12, 13, 10), (13, 10, 12, 12), (20, 0, 18, 0), (18, 0, 10, 0), (7, 7, 7, 7)]
    edges += [(10, 10, 0, 0)]
    found = overlay.polygonize(edge_frame(spark, edges)).select(G.area("geom").alias("area"), F.size(G.rings("geom")).alias("rings"), G.orient_ccw("geom").eqNullSafe(F.col("geom")).alias("turned"))
    # the diagonal runs over the two inner squares: lines have to be noded for it
    assert len(found.collect()) > 0
    found = overlay.polygonize(edge_frame(spark, edges[:-1])).select(G.area("geom").alias("area"), F.size(G.rings("geom")).alias("rings"))
    assert sorted(map(tuple, found.collect())) == [(1.0, 1), (1.0, 1), (8.0, 2), (91.0, 2)]
    assert overlay.polygonize(edge_frame(spark, [(0, 0, 1, 1), (1, 1, 2, 0)])).count() == 0
    assert overlay.polygonize(edge_frame(spark, box(0, 0, 1)).filter("x1 > 5")).count() == 0


def test_merged_lines(spark):
    edges = [(0, 0, 1, 0), (2, 0, 1, 0), (2, 0, 2, 1), (2, 0, 3, 0), (5, 5, 6, 5), (6, 5, 6, 6), (6, 6, 5, 5), (0, 0, 1, 0)]
    found = overlay.merged_lines(edge_frame(spark, edges).withColumn("g", F.lit(1)), "g")
    lines = sorted(sorted([[tuple(v) for v in r["line"]], [tuple(v) for v in reversed(r["line"])]])[0] for r in found.collect())
    assert lines == [[(0, 0), (1, 0), (2, 0)], [(2, 0), (2, 1)], [(2, 0), (3, 0)], [(5, 5), (6, 5), (6, 6), (5, 5)]]


def test_unions_do_not_go_along_with_regions(spark, tmp_path):
    """The comparison of regions with their state's union joins pieces of it."""
    from workload import spatial

    rows = spark.range(200).select(F.col("id").alias("s_suppkey"), F.lit("n").alias("s_name"), F.when(F.col("id") % 9 > 0, F.lit(1)).alias("s_nationkey"))
    rows.write.parquet(str(tmp_path / "supplier.parquet"))
    found, seen = spatial.R.intersection_area, []

    def measured(a, b):
        seen.append(b)
        return found(a, b) + F.when(G.npoints(b) > 256, F.raise_error(F.lit("a whole union"))).otherwise(F.lit(0.0))

    spatial.R.intersection_area = measured
    try:
        out = spatial.dissolved_states(spark, str(tmp_path)).collect()
    finally:
        spatial.R.intersection_area = found
    assert seen and [(r["state"], r["regions"] == r["covered"] > 100, r["once"], r["valid"]) for r in out] == [("S1", True, True, True)]


def test_merged_lines_gather_a_line_each(spark, monkeypatch):
    """Lines that come back to their fork begin there, and no task holds a whole group."""
    edges = [(4, 4, 3, 5), (3, 5, 3, 3), (3, 3, 4, 4), (4, 4, 9, 4)] + [(i, 20, i + 1, 20) for i in range(5)] + [(5, 20, 5, 25), (5, 20, 6, 20)]
    df = edge_frame(spark, edges).withColumn("id", F.explode(F.array(F.lit(1), F.lit(None))))
    found = [(r["id"], tuple(tuple(v) for v in r["line"])) for r in overlay.merged_lines(df, "id").collect()]
    lines = [((4, 4), (3, 3), (3, 5), (4, 4)), ((4, 4), (9, 4)), tuple((i, 20) for i in range(6)), ((5, 20), (5, 25)), ((5, 20), (6, 20))]
    assert sorted(found, key=str) == sorted([(k, line) for k in (1, None) for line in lines], key=str)
    monkeypatch.setattr(overlay, "merge_lines", lambda steps: F.array(F.size(steps)))
    assert sorted(r["line"] for r in overlay.merged_lines(df, "id").collect()) == [1] * 6 + [3, 3, 5, 5]


def test_sql_names(spark, shapes):
    register(spark)
    shapes.createOrReplaceTempView("sql_shapes")
    row = spark.sql("""SELECT st_area(st_makevalid(st_geomfromtext('POLYGON((0 0, 2 2, 2 0, 0 2, 0 0))'))) AS bow, st_geohash(st_geomfromtext('POINT(-5.6 42.6)'), 5) AS hash,
        st_area(st_buffer(st_geomfromtext('POLYGON((0 0, 4 0, 4 4, 0 4, 0 0))'), 1D)) AS grown, st_geomfromtext(NULL) AS missing, size(st_geomfromtext('POLYGON EMPTY')) AS none,
        st_ymax(st_buffermetres(st_geomfromtext('POLYGON((0 0, 1 0, 1 1, 0 1, 0 0))'), 1000D)) AS north""").first()
    assert row["bow"] == 2.0 and row["hash"] == "ezs42" and row["grown"] == pytest.approx(32 + disk(1)) and row["missing"] is None and row["none"] == 0
    assert row["north"] == pytest.approx(1 + np.degrees(1000 / G.MERCATOR_RADIUS))
    both = spark.sql("SELECT code, geom, st_geomfromtext(st_astext(geom)) AS again, st_transform(st_transform(geom, 4326, 3857), 3857, 7844) AS back, st_geohash(geom, 7) AS hash FROM sql_shapes")
    for r in both.select("*", G.geohash("geom", 7).alias("want")).collect():
        assert r["geom"] == r["again"] and r["hash"] == r["want"]
        flat = lambda g: [c for p in g for ring in p for v in ring for c in v]
        assert r["back"] is None if r["geom"] is None else flat(r["back"]) == pytest.approx(flat(r["geom"]))
    with pytest.raises(Exception, match="no transformation"):
        spark.sql("SELECT st_transform(geom, 28355, 4326) FROM sql_shapes").collect()


# --- triangulation and draws ------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["any", "grid", "line"])
def test_triangulation(kind):
    rng = np.random.default_rng(3)
    points = {"any": rng.random((250, 2)), "grid": rng.integers(0, 9, (150, 2)).astype(float), "line": np.column_stack([np.arange(30.0), 2 * np.arange(30.0)])}[kind]
    mesh = delaunay.Triangulation(points)
    triangles = {min((a, b, c), (b, c, a), (c, a, b)) for (a, b), c in mesh.apex.items()}
    if kind == "line":
        assert not triangles and delaunay.hollowed(points, 0.5) is None
        return
    assert sum(mesh._turn(*t) / 2 for t in triangles) == pytest.approx(signed_area(convex_hull(points)))
    assert not any(mesh._in_circle(*t, d) for t in triangles for d in range(len(mesh.at)) if d not in t)


def test_concave_hull():
    rng = np.random.default_rng(4)
    points = rng.random((200, 2))
    points = points[(points[:, 0] < 0.3) | (points[:, 1] < 0.3)]  # an angle
    sizes = [signed_area(delaunay.hollowed(points, ratio)) for ratio in (1.0, 0.999, 0.6, 0.3, 0.0)]
    assert sizes[0] == pytest.approx(signed_area(convex_hull(points))) and sizes == sorted(sizes, reverse=True)
    assert sizes[1] > 0.9 * sizes[0] and 0.35 < sizes[3] < 0.6
    for ratio in (0.999, 0.3, 0.0):
        ring = delaunay.hollowed(points, ratio)
        assert rings_are_simple([[ring]])
        inner = np.array([p for p in points if not (ring == p).all(axis=1).any()])
        assert strictly_inside(inner, ring_edges([[ring]])).all() if len(inner) else True


def test_draws_need_no_box():
    comb = [(0, 0), (41, 0)] + [p for k in range(40, 0, -2) for p in ((k + 1, 100), (k, 100), (k, 1e-3), (k - 1, 1e-3))][:-1] + [(0, 1e-3), (0, 0)]
    for geom in (shape([[(0, 0), (1, 1), (1, 1 + 1e-9), (0, 0)]]), shape([comb]), shape([SQUARE, HOLE], [DIAMOND]), shape([[(0, 0), (1e-9, 0), (1e-9, 1e6), (0, 1e6), (0, 0)]])):
        drawn = draw_points(geom, 3000, 5)
        assert len(drawn) == 3000 and strictly_inside(drawn, ring_edges(geom)).all()
        assert (draw_points(geom, 3000, 5) == drawn).all()
        slabs = trapezoids(geom)
        assert ((slabs[:, 1] - slabs[:, 0]) * (slabs[:, 4] - slabs[:, 2] + slabs[:, 5] - slabs[:, 3]) / 2).sum() == pytest.approx(area(geom))
    drawn = draw_points(shape([SQUARE, HOLE], [DIAMOND]), 60_000, 6)
    share = [(drawn[:, 0] > 5).mean(), ((drawn[:, 0] < 5) & (drawn[:, 1] < 1)).mean(), ((drawn[:, 0] > 6) & (drawn[:, 0] < 8)).mean()]
    assert share == pytest.approx([24 / 36, 4 / 36, 3 / 36], abs=0.01)
    for nothing in (shape([[(0, 0), (4, 0), (0, 0)]]), []):
        with pytest.raises(ValueError):
            draw_points(nothing, 1, 1)
    assert len(draw_points([], 0, 1)) == 0

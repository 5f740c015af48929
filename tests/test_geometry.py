import math
import random

import numpy as np
import pytest
from conftest import DIAMOND, ELBOW, HOLE, SQUARE, polygon
from pyspark.sql import functions as F

from arealis.functions import arrow_geometry as R
from arealis.functions import geometry as G
from arealis.functions.arrangement import rings_are_nested
from arealis.functions.register import register
from arealis.operators import spatial_join as J
from arealis.operators import stats as A
from arealis.plans import dots, thinning, tiles
from arealis.sources import spatial as S


def frame(spark, **shapes):
    return spark.createDataFrame(list(shapes.items()), f"code string, geom {G.GEOM_TYPE}")


def as_rings(geom):
    return [[np.array([(v["x"], v["y"]) for v in r]) for r in part] for part in geom]


def test_measures(shapes):
    got = {r["code"]: tuple(r)[1:] for r in shapes.select("code", G.npoints("geom"), G.num_parts("geom"), G.area("geom"), G.is_empty("geom"), G.compactness("geom")).collect()}
    assert got["square"] == (5, 1, 16.0, False, 1.0)
    assert got["holed"] == (10, 1, 12.0, False, 0.75)
    assert got["diamond"] == (5, 1, 24.0, False, 0.5)
    assert got["elbow"] == (7, 1, 12.0, False, 0.75)
    assert got["multi"][:3] == (10, 2, 17.0)
    assert got["empty"] == (0, 0, 0.0, True, None)
    assert got["missing"] == (None,) * 5
    assert sorted(r["code"] for r in A.valid_geom(shapes).collect()) == ["diamond", "elbow", "holed", "multi", "square"]


def test_summary(shapes):
    row = A.geometry_summary(shapes, "code").first()
    assert tuple(row) == (6, 6, 37, 6, 0, 10)


@pytest.mark.parametrize(
    "x, y, square, holed, diamond",
    [(2, 2, (1, 1), (0, 0), (0, 0)), (0.5, 0.5, (1, 1), (1, 1), (0, 0)), (0, 2, (1, 0), (1, 0), (0, 0)), (0, 0, (1, 0), (1, 0), (0, 0)),
     (1, 2, (1, 1), (1, 0), (0, 0)), (10, 0, (0, 0), (0, 0), (1, 1)), (8, 1.5, (0, 0), (0, 0), (1, 0)), (6, 0, (0, 0), (0, 0), (1, 0)),
     (5, 0, (0, 0), (0, 0), (0, 0)), (-1, 2, (0, 0), (0, 0), (0, 0))],
)
def test_predicates(spark, shapes, x, y, square, holed, diamond):
    p = G.make_point(F.lit(float(x)), F.lit(float(y)))
    got = {r[0]: (int(r[1]), int(r[2])) for r in shapes.filter("geom is not null").select("code", G.intersects(p, "geom"), G.contains("geom", p)).collect()}
    assert (got["square"], got["holed"], got["diamond"]) == (square, holed, diamond)
    assert got["empty"] == (0, 0)


def test_wkt(spark, shapes):
    text = {r[0]: r[1] for r in shapes.select("code", G.to_wkt("geom")).collect()}
    assert text["elbow"].startswith("POLYGON((0.0 0.0,4.0 0.0,") and text["empty"] == "MULTIPOLYGON EMPTY" and text["missing"] is None
    back = shapes.select("code", "geom", G.from_wkt(G.to_wkt("geom")).alias("again"))
    assert all(r["geom"] == r["again"] for r in back.collect())
    loose = spark.range(1).select(G.from_wkt(F.lit(" polygon ( ( 0 0 , 1 0, 1  1,0 0 ) , (2 2,3 2,3 3,2 2) )")).alias("g")).first()["g"]
    assert len(loose) == 1 and len(loose[0]) == 2 and tuple(loose[0][1][2]) == (3.0, 3.0)


def test_dumps(shapes):
    assert shapes.transform(G.dump_parts).count() == 6
    assert [(r["part_no"], r["ring_no"]) for r in G.dump_rings(shapes.filter("code = 'holed'")).collect()] == [(1, 1), (1, 2)]
    parts = G.dump_parts(shapes.filter("code = 'multi'"))
    assert A.collect_parts(parts, "code", "part_no").first()["geom"] == shapes.filter("code = 'multi'").first()["geom"]


def test_clean_and_orient(spark):
    messy = polygon([[(0, 0), (0, 0), (0, 4), (4, 4), (4, 4), (4, 0)], [(1, 1), (2, 2), (1, 1)]], [[(9, 9), (9, 9)]])
    df = frame(spark, a=messy, b=[], c=None).select("code", G.clean_rings("geom").alias("geom"))
    got = {r["code"]: r["geom"] for r in df.collect()}
    assert got["b"] == [] and got["c"] is None
    assert [tuple(v) for v in got["a"][0][0]] == [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    assert len(got["a"]) == 1 and len(got["a"][0]) == 1


def test_simple_flag(spark):
    bow = [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]
    touching = [(0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0)]
    df = frame(spark, good=polygon([SQUARE, HOLE]), bow=polygon([bow]), touch=polygon([touching]), none=None)
    assert {r[0]: r[1] for r in df.select("code", R.is_simple("geom")).collect()} == {"good": True, "bow": False, "touch": False, "none": None}


def test_mercator(spark):
    df = frame(spark, a=polygon([[(180, 0), (0, 85.0511287798066), (-180, 0), (180, 0)]]))
    row = df.select(G.xmax(G.to_mercator("geom")), G.ymax(G.to_mercator("geom"))).first()
    assert row[0] == pytest.approx(20037508.342789244) and row[1] == pytest.approx(20037508.342789244)
    assert G.get_srid(G.to_wgs84(G.set_srid(df, 7844))) == 4326
    with pytest.raises(ValueError):
        G.to_wgs84(G.set_srid(df, 28355))


def test_geohash_known(spark):
    df = spark.createDataFrame([(-5.6, 42.6), (151.2093, -33.8688), (112.5584, 37.8324)], "x double, y double")
    got = [r[0] for r in df.select(G.geohash_xy(F.col("x"), F.col("y"), 5)).collect()]
    assert got == ["ezs42", "r3gx2", "ww8p1"]


def wavy(n, radius=3.0, cx=0.0, cy=0.0):
    ring = [(cx + (radius + 0.4 * math.sin(9 * t)) * math.cos(t), cy + (radius + 0.4 * math.sin(9 * t)) * math.sin(t)) for t in np.linspace(0, 2 * math.pi, n, endpoint=False)]
    return ring + ring[:1]


def test_subdivide(spark):
    df = frame(spark, w=polygon([wavy(1500), [(-1, -1), (-1, 1), (1, 1), (1, -1), (-1, -1)]]), s=polygon([SQUARE]), e=[])
    pieces = thinning.subdivide(df, 64).select("code", G.npoints("geom").alias("n"), G.area("geom").alias("a")).collect()
    assert max(r["n"] for r in pieces) <= 64
    whole = {r["code"]: r["a"] for r in df.select("code", G.area("geom").alias("a")).collect()}
    for code in ("w", "s"):
        assert sum(r["a"] for r in pieces if r["code"] == code) == pytest.approx(whole[code], rel=1e-12)
    assert len([r for r in pieces if r["code"] == "s"]) == 1


def plain_vw(ring, tolerance):
    pts, floor = [tuple(p) for p in ring], 0.0
    while len(pts) > 4:
        sizes = []
        for i in range(1, len(pts) - 1):
            (ax, ay), (bx, by), (cx, cy) = pts[i - 1], pts[i], pts[i + 1]
            sizes.append((abs((ax - bx) * (cy - by) - (cx - bx) * (ay - by)) / 2, pts[i], i))
        small = min(sizes)
        if max(small[0], floor) >= tolerance:
            break
        pts.pop(small[2])
    return pts


def test_simplify_vw(spark):
    ring = wavy(120)
    df = frame(spark, w=polygon([ring]), tiny=polygon([[(0, 0), (1e-9, 0), (1e-9, 1e-9), (0, 1e-9), (0, 0)]]))
    got = {r[0]: r[1] for r in df.select("code", R.simplify_vw("geom", 0.01)).collect()}
    assert [tuple(v) for v in got["w"][0][0]] == plain_vw(ring, 0.01)
    assert len(got["tiny"][0][0]) == 4
    untouched = df.select(R.simplify_vw("geom", 0.0).alias("g")).collect()
    assert [len(r["g"][0][0]) for r in untouched] == [121, 5]


def test_simplify_dp(spark):
    ring = wavy(400)
    df = frame(spark, w=polygon([ring, HOLE]), tiny=polygon([[(0, 0), (1e-3, 0), (1e-3, 1e-3), (0, 0)]]))
    got = {r[0]: as_rings(r[1]) for r in df.select("code", R.simplify_dp("geom", 0.05)).collect()}
    thin = got["w"][0][0]
    assert got["tiny"] == [] and len(thin) < 100
    a, b = thin[:-1], thin[1:]
    for p in np.array(ring):  # every dropped vertex lies within the tolerance
        t = np.clip(np.sum((p - a) * (b - a), axis=1) / np.sum((b - a) ** 2, axis=1), 0, 1)
        assert np.min(np.hypot(*(p - a - t[:, None] * (b - a)).T)) <= 0.05 + 1e-12


def test_thinning_keeps_sides(spark):
    """A bulge with a hole in it stays, and spikes through a narrow neck don't cross."""
    bulge = [(0, 0), (10, 0), (10, 4), (6, 4), (5, 4.3), (4, 4), (0, 4), (0, 0)]
    hole = [(4.9, 4.05), (5, 4.15), (5.1, 4.05), (4.9, 4.05)]
    left = [(20, 0), (25, 0), (24.8, 2), (25, 4), (20, 4), (20, 0)]
    spiked = [(25, 0), (30, 0), (30, 4), (25, 4), (24.8, 2), (25, 0)]
    thorn = [(24.85, 1.98), (24.85, 2.02), (27, 2), (24.85, 1.98)]  # a hole of the right one that begins in its bay
    df = spark.createDataFrame([("a", polygon([bulge, hole])), ("b", polygon([left])), ("c", polygon([spiked, thorn]))], f"code string, geom {G.GEOM_TYPE}")
    loose = {r["code"]: r["geom"] for r in thinning.simplify_coverage(df, "code", 0.5, keep_topology=False).collect()}
    kept = {r["code"]: r["geom"] for r in thinning.simplify_coverage(df, "code", 0.5).collect()}
    has = lambda geom, *v: v in [tuple(p) for p in geom[0][0]]
    assert not has(loose["a"], 5.0, 4.3) and has(kept["a"], 5.0, 4.3)
    assert has(kept["b"], 24.8, 2.0) and has(kept["c"], 24.8, 2.0)
    for code, geom in kept.items():
        rings = [[np.array([(v["x"], v["y"]) for v in ring]) for ring in part] for part in geom]
        assert R.rings_are_simple(rings) and rings_are_nested(rings), code
    corners = lambda rows: {r["code"]: [sorted(set(map(tuple, ring))) for part in r["geom"] for ring in part] for r in rows.collect()}
    assert corners(thinning.simplify_coverage(df, "code", 0.0)) == corners(df)


def test_coverage_has_no_gaps(spark):
    from workload.derived import lattice

    cells = lattice(spark, "/root/testdata/sf0.01")
    thin = thinning.simplify_coverage(cells, "code", 0.02)
    before = cells.agg(F.sum(G.npoints("geom"))).first()[0]
    assert thin.agg(F.sum(G.npoints("geom"))).first()[0] < before / 4
    seen = {}
    total = 0.0
    for row in thin.select("code", "geom").collect():
        ring = [tuple(v) for v in row["geom"][0][0]]
        total += R.signed_area(np.array(ring))
        for p, q in zip(ring, ring[1:]):
            seen[(p, q)] = seen.get((p, q), 0) + 1
    assert set(seen.values()) == {1}
    # outer edges have no twin; what they enclose is the sum of the cells: no gap, no overlap
    outer = [e for e in seen if (e[1], e[0]) not in seen]
    assert sum(p[0] * q[1] - q[0] * p[1] for p, q in outer) / 2 == pytest.approx(total, rel=1e-12)


def test_intersection_area(spark):
    pairs = [
        (polygon([SQUARE]), polygon([[(2, 2), (6, 2), (6, 6), (2, 6), (2, 2)]]), 4.0),
        (polygon([SQUARE, HOLE]), polygon([[(2, 2), (6, 2), (6, 6), (2, 6), (2, 2)]]), 3.0),
        (polygon([ELBOW[::-1]]), polygon([SQUARE]), 12.0),
        (polygon([SQUARE]), polygon([DIAMOND]), 0.0),
        (polygon([SQUARE], [[(20, 0), (22, 0), (22, 2), (20, 2), (20, 0)]]), polygon([[(3, 0), (21, 0), (21, 1), (3, 1), (3, 0)]]), 2.0),
        (polygon([[(0, 0), (4, 0), (0, 4), (0, 0)]]), polygon([[(4, 4), (0, 4), (4, 0), (4, 4)]]), 0.0),
        (polygon([[(0, 0), (4, 0), (2, 4), (0, 0)]]), polygon([[(0, 3), (2, -1), (4, 3), (0, 3)]]), 16 / 3 + 0.5 - 1 / 12 - 0.25),
        (None, polygon([SQUARE]), None),
        ([], polygon([SQUARE]), 0.0),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)], f"i int, a {G.GEOM_TYPE}, b {G.GEOM_TYPE}")
    got = {r[0]: r[1] for r in df.coalesce(1).select("i", R.intersection_area("a", "b")).collect()}
    for i, (a, b, want) in enumerate(pairs):
        if i == 6:
            grid = np.linspace(0, 4, 1201)[:-1] + 1 / 600
            pts = np.array([(x, y) for x in grid for y in grid])
            inside = R.strictly_inside(pts, R.ring_edges([[np.array(r) for r in p] for p in a])) & R.strictly_inside(pts, R.ring_edges([[np.array(r) for r in p] for p in b]))
            assert got[i] == pytest.approx(inside.sum() / 300**2, abs=0.03)
        else:
            assert got[i] == (None if want is None else pytest.approx(want, abs=1e-12)), i


def test_intersection_area_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "PAIR_BLOCK", 50)
    import pyarrow as pa

    a = R.pack([[[np.array(wavy(60))]], [[np.array(SQUARE, float)]], None])
    b = R.pack([[[np.array(wavy(60))]], [[np.array(ELBOW, float)]], [[np.array(SQUARE, float)]]])
    got = R.common_areas(a, b)
    assert got[0] == pytest.approx(R.signed_area(np.array(wavy(60)))) and got[1] == pytest.approx(12.0) and isinstance(a, pa.Array)


def test_hulls(spark):
    df = frame(spark, e=polygon([ELBOW]))
    row = df.select(R.near_hull("geom", 1e-5).alias("h"), R.buffer_hull("geom", 1000.0).alias("b")).first()
    hull, grown = as_rings(row["h"])[0][0], as_rings(row["b"])[0][0]
    assert R.signed_area(hull) == pytest.approx(14.0, abs=1e-3) and R.signed_area(hull) > 14.0
    up = math.degrees(1000.0 / G.MERCATOR_RADIUS)
    assert grown[:, 1].min() == pytest.approx(-up) and grown[:, 1].max() == pytest.approx(4 + up)


def test_random_points(spark, shapes):
    base = A.valid_geom(shapes).select("code", F.col("geom").alias("shape"), "geom", F.lit(57).alias("n"))
    first = dots.random_points(base, "n", "code", seed=9, draw_size=10)
    rows = first.select("code", "point_no", "geom", G.contains("shape", "geom").alias("inside")).collect()
    assert len(rows) == 57 * 5 and all(r["inside"] for r in rows)
    assert len({(r["code"], r["point_no"]) for r in rows}) == len(rows)
    again = dots.random_points(base.repartition(5), "n", "code", seed=9, draw_size=10).select("code", "point_no", "geom").collect()
    assert {tuple(r) for r in again} == {(r["code"], r["point_no"], r["geom"]) for r in rows}
    with pytest.raises(Exception, match="too thin"):
        flat = frame(spark, a=polygon([[(0, 0), (1, 1), (0, 0), (0, 0)]])).withColumn("n", F.lit(3))
        dots.random_points(flat, "n", "code").collect()


def test_dot_density_counts(spark, shapes):
    stats = spark.createDataFrame([("square", 0.0), ("holed", 9.0), ("diamond", 10.0), ("elbow", 25.0), ("empty", 100.0), ("gone", 50.0)], "region_id string, g1 double")
    made = dots.dot_density(shapes, stats, "g1", "code").collect()
    counts = {}
    for r in made:
        counts[r["id"]] = counts.get(r["id"], 0) + 1
    assert counts == {"diamond": 1, "elbow": 2}


@pytest.fixture
def scattered(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([0.0, 1.0, 2.0, 4.0, rng.uniform(-1, 22)]), rng.choice([0.0, 1.0, 4.0, rng.uniform(-4, 5)])) for i in range(1500)]
    # a third of all points in one place
    rows += [(i, 0.5, 0.5) for i in range(1500, 2250)]
    return spark.createDataFrame(rows + [(9999, None, 1.0)], "id int, x double, y double")


@pytest.mark.parametrize("path", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_rows": 50}])
def test_tagging_matches_every_pair(spark, shapes, scattered, path):
    big = frame(spark, world=polygon([[(-500, -400), (600, -400), (600, 500), (-500, 500), (-500, -400)]]), round=polygon([wavy(700, 3.0, 12.0, 1.0), HOLE]))
    bdy = shapes.union(big)
    got = {tuple(r) for r in J.tag_points(scattered, bdy, **path).select("id", "code").collect()}
    p = G.make_point("x", "y")
    pairs = scattered.hint("broadcast").crossJoin(bdy).filter(G.intersects(p, "geom"))
    assert got == {tuple(r) for r in pairs.select("id", "code").collect()} and len(got) > 3000


def test_tagging_keeps_outside(spark, shapes, scattered):
    kept = J.tag_points(scattered, shapes, "left")
    assert kept.select("id").distinct().count() == 2251
    assert kept.filter("id = 9999").first()["code"] is None


def test_left_tagging_keeps_points_that_share_an_id_or_a_place(spark):
    bdy = frame(spark, a=polygon([SQUARE]))
    points = spark.createDataFrame([(1, 1.0, 1.0), (1, 99.0, 99.0), (2, 1.0, 1.0), (2, 1.0, 1.0), (3, None, 1.0)], "id int, x double, y double")
    kept = J.tag_points(points, bdy, "left").select("id", "x", "code").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, 1.0, "a"), (1, 99.0, None), (2, 1.0, "a"), (2, 1.0, "a"), (3, None, None)], key=str)


def test_a_cover_with_nested_attributes_is_measured(spark):
    bdy = frame(spark, a=polygon([SQUARE]))
    small = J._measure(J.cell_cover(bdy))[1]
    tags = F.transform(F.sequence(F.lit(1), F.lit(10_000)), lambda i: i.cast("string"))
    assert J._measure(J.cell_cover(bdy.withColumn("tags", tags)))[1] > small + 40_000
    assert J._measure(J.cell_cover(bdy.withColumn("wkb", F.encode(F.repeat(F.lit("x"), 50_000), "utf-8"))))[1] > small + 40_000


@pytest.mark.parametrize("kind", ["point", "line", "polygon"])
def test_export_of_every_kind(spark, tmp_path, kind):
    value = {"point": "named_struct('x', 150D, 'y', -30D)", "line": "array(named_struct('x', 150D, 'y', -30D), named_struct('x', 151D, 'y', -31D))"}
    value["polygon"] = "array(array(named_struct('x', 150D, 'y', -30D), named_struct('x', 151D, 'y', -30D), named_struct('x', 150D, 'y', -29D), named_struct('x', 150D, 'y', -30D)))"
    layer = spark.sql(f"SELECT 1 AS id, {value[kind]} AS shape UNION ALL SELECT 2, NULL")
    target = S.export_table(layer, "t", str(tmp_path), key="id") if kind != "line" else None
    back = S.spatial_layout(layer, geom="shape", with_wkt=True) if target is None else spark.read.parquet(target)
    rows = {r["id"]: r for r in back.collect()}
    assert (rows[1]["xmin"], rows[1]["xmax"]) == (150.0, 150.0 if kind == "point" else 151.0)
    if kind == "polygon":
        assert set(rows) == {1}
    else:
        assert back.schema["shape"].dataType.simpleString() == layer.schema["shape"].dataType.simpleString()
        assert rows[2]["shape"] is None and rows[2]["xmin"] is None
    if kind == "line":
        assert rows[1]["wkt_geom"] == "LINESTRING(150.0 -30.0,151.0 -31.0)"


def test_tiles_reach_the_pole(spark):
    south = frame(spark, a=polygon([[(10, -90), (40, -90), (40, -70), (10, -70), (10, -90)]]))
    cut = tiles.tile_features(south, 2).select("tile_x", "tile_y").collect()
    assert {tuple(r) for r in cut} == {(2, 3)}


def test_sql_names(spark, shapes):
    register(spark)
    shapes.createOrReplaceTempView("sql_shapes")
    got = spark.sql("SELECT st_astext(geom) AS t, st_envelope(geom) AS e, size(st_dump(geom)) AS n, st_simplifyvw(geom, 0.1) AS v, st_simplify(geom, 0.1) AS d, st_subdivide(geom, 16) AS p FROM sql_shapes")
    want = shapes.select(
        G.to_wkt("geom").alias("t"), G.envelope("geom").alias("e"), F.size("geom").alias("n"), R.simplify_vw("geom", 0.1).alias("v"), R.simplify_dp("geom", 0.1).alias("d"), R.subdivided("geom", 16).alias("p")
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def haversine(ax, ay, b):
    la, lb = math.radians(ay), np.radians(b[:, 1])
    h = np.sin((lb - la) / 2) ** 2 + math.cos(la) * np.cos(lb) * np.sin(np.radians(b[:, 0] - ax) / 2) ** 2
    return 2 * J.EARTH_RADIUS * np.arcsin(np.sqrt(h))


@pytest.mark.parametrize("path", [{}, {"broadcast_bytes": 0, "hot_rows": 100}])
def test_within_distance(spark, shapes, path):
    rng = random.Random(8)
    pts = [(i, rng.uniform(-0.3, 4.3), rng.uniform(-0.3, 4.3)) for i in range(400)]
    df = spark.createDataFrame(pts, "id int, x double, y double")
    got = {r["id"]: r["distance"] for r in J.tag_points_within(df, shapes.filter("code = 'elbow'"), 15000.0, **path).collect()}
    ring = np.array(ELBOW, float)
    edges = R.ring_edges([[ring]])
    dense = np.concatenate([a + (b - a) * np.linspace(0, 1, 8000)[:, None] for a, b in zip(ring, ring[1:])])
    for i, x, y in pts:
        if R.strictly_inside(np.array([[x, y]]), edges)[0]:
            assert got[i] == 0.0
            continue
        d = haversine(x, y, dense).min()
        if d < 14900:
            assert got[i] == pytest.approx(d, abs=5)
        elif d > 15100:
            assert i not in got


def test_overlap_pairs_match_every_pair(spark):
    rng = random.Random(4)

    def boxes(n, name):
        rows = []
        for i in range(n):
            x, y, w = rng.uniform(0, 40), rng.uniform(0, 40), rng.choice([0.01, 0.3, 2, 30])
            rows.append((f"{name}{i}", polygon([[(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]]), x, y, w))
        return rows

    a, b = boxes(60, "a"), boxes(80, "b")
    schema = f"code string, geom {G.GEOM_TYPE}"
    left, right = (spark.createDataFrame([r[:2] for r in rows], schema) for rows in (a, b))
    meet = {(p[0], q[0]) for p in a for q in b if p[2] <= q[2] + q[4] and q[2] <= p[2] + p[4] and p[3] <= q[3] + q[4] and q[3] <= p[3] + p[4]}
    pairs = [tuple(r) for r in J.candidate_pairs(left, right).select("a_code", "b_code").collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == meet
    common = {
        (p[0], q[0]): max(0, min(p[2] + p[4], q[2] + q[4]) - max(p[2], q[2])) * max(0, min(p[3] + p[4], q[3] + q[4]) - max(p[3], q[3])) / q[4] ** 2
        for p in a for q in b
    }
    got = {(r["a_code"], r["b_code"]) for r in J.match_by_overlap(left, right, 0.5).collect()}
    assert got == {k for k, v in common.items() if v > 0.5}


def test_overlap_areas_by_cells(spark):
    """Shapes of very different sizes, with holes, parts and bays, against whole shapes."""
    rng = random.Random(9)
    outlines = [[SQUARE, HOLE], [DIAMOND], [ELBOW]]

    def layer(n, name):
        rows = []
        for i in range(n):
            x, y, w = rng.uniform(-20, 20), rng.uniform(-20, 20), rng.choice([0.02, 0.5, 3, 12])
            parts = rng.sample(outlines, rng.choice([1, 1, 2]))
            shift = [[[(x + w * px + 20 * w * k, y + w * py) for px, py in ring] for ring in part] for k, part in enumerate(parts)]
            rows.append((f"{name}{i}", polygon(*shift)))
        return spark.createDataFrame([*rows, (f"{name}x", []), (f"{name}y", None)], f"code string, geom {G.GEOM_TYPE}")

    a, b = layer(25, "a").withColumnRenamed("code", "one"), layer(40, "b").withColumnRenamed("code", "other")
    got = {(r["one"], r["other"]): r["common_area"] for r in J.overlap_areas(a, b, "one", "other").collect()}
    every = a.crossJoin(b.withColumnRenamed("geom", "g2")).select("one", "other", R.intersection_area("geom", "g2").alias("s"))
    want = {(r["one"], r["other"]): r["s"] for r in every.collect() if r["s"] and r["s"] > 1e-9}
    assert {k for k, v in got.items() if v > 1e-9} == set(want) and all(got[k] == pytest.approx(v, rel=1e-9, abs=1e-9) for k, v in want.items())
    plan = J.overlap_areas(a, b, "one", "other")._jdf.queryExecution().optimizedPlan().toString()
    assert "_geom" not in plan.split("Join", 1)[0]


def test_tiles_cover_the_shape(spark):
    shape = polygon([[(100, -40), (150, -40), (150, -10), (100, -10), (100, -40)], [(110, -30), (110, -20), (120, -20), (120, -30), (110, -30)]])
    made = tiles.tile_features(frame(spark, a=shape), 5)
    rows = made.select("tile_x", "tile_y", "geom", G.area("geom").alias("a")).collect()
    assert len({(r["tile_x"], r["tile_y"]) for r in rows}) == len(rows)
    # without the margins the pieces add up to the projected area
    clipped = 0.0
    for r in rows:
        part = [np.array([(v["x"], v["y"]) for v in ring]) for ring in r["geom"][0]]
        for axis, bound, low in ((0, 0, False), (0, tiles.EXTENT, True), (1, 0, False), (1, tiles.EXTENT, True)):
            part = R._clip_part(part, axis, bound, low) if part else part
        clipped += sum(abs(R.signed_area(x)) * (1 if i == 0 else -1) for i, x in enumerate(part))
    size = 2 * math.pi * G.MERCATOR_RADIUS / 32 / tiles.EXTENT
    whole = frame(spark, a=shape).select(G.area(G.to_mercator("geom")).alias("a")).first()["a"]
    assert clipped * size * size == pytest.approx(whole, rel=1e-3)


def test_sql_functions(spark, shapes):
    register(spark)
    shapes.createOrReplaceTempView("t_shapes")
    rows = {r["code"]: r for r in spark.sql("SELECT code, st_area(geom) a, st_npoints(geom) n, st_contains(geom, st_makepoint(0.5, 0.5)) c, st_issimple(geom) s FROM t_shapes").collect()}
    assert (rows["holed"]["a"], rows["holed"]["n"], rows["holed"]["c"], rows["holed"]["s"]) == (12.0, 10, True, True)
    assert rows["missing"]["a"] is None and rows["missing"]["c"] is None
    pts = spark.sql("SELECT p.x, p.y FROM t_shapes, LATERAL st_randompointsinpolygon(geom, 20, 7) p WHERE code = 'elbow'").collect()
    assert len(pts) == 20
    same = spark.sql("SELECT st_intersection_area(a.geom, b.geom) v FROM t_shapes a, t_shapes b WHERE a.code = 'square' AND b.code = 'elbow'").first()["v"]
    assert same == 12.0


def test_layers_from_files(spark, shapes, tmp_path):
    kept = A.valid_geom(shapes)
    folder = tmp_path / "layers"
    folder.mkdir()
    lines = [r[0] for r in S.to_geojson_feature(kept).collect()]
    (folder / "LGA_2021_GDA94.geojsonl").write_text("\n".join(lines))
    csv = "code,wkt_geom\n" + "\n".join(f'{r[0]},"{r[1]}"' for r in kept.select("code", G.to_wkt("geom")).collect())
    (folder / "sa1_gda94_x.csv").write_text(csv)
    (folder / "sa1_gda2020.csv").write_text(csv)
    loaded = S.load_layers(spark, str(folder), "_gda94", "code string")
    assert sorted(loaded) == ["LGA_2021_GDA94", "sa1_gda94_x"]
    want = {r["code"]: r["geom"] for r in kept.collect()}
    for layer in loaded.values():
        assert {r["code"]: r["geom"] for r in layer.select("code", "geom").collect()} == want


def test_geojson_kinds(spark, tmp_path):
    feature = '{"type":"Feature","properties":{"code":"%s"},"geometry":{"type":"%s","coordinates":%s}}'
    lines = [feature % k for k in (("p", "Point", "[1,2]"), ("m", "MultiPoint", "[[1,2],[3,4]]"), ("l", "LineString", "[[0,0],[1,1]]"), ("k", "MultiLineString", "[[[0,0],[1,1]],[[5,5],[6,6]]]"))]
    lines.append('{"type":"Feature","properties":{"code":"n"},"geometry":null}')
    (tmp_path / "good").write_text("\n".join([*lines, ""]))
    found = {r["code"]: r["geom"] for r in S.read_geojsonl(spark, str(tmp_path / "good"), "code string").collect()}
    plain = {k: v and [[[tuple(p) for p in ring] for ring in part] for part in v] for k, v in found.items()}
    assert plain == {"p": [[[(1, 2)]]], "m": [[[(1, 2)]], [[(3, 4)]]], "l": [[[(0, 0), (1, 1)]]], "k": [[[(0, 0), (1, 1)]], [[(5, 5), (6, 6)]]], "n": None}
    (tmp_path / "bad").write_text("\n".join([lines[0], '{"type":"Feature","prop']))
    with pytest.raises(Exception, match="malformed"):
        S.read_geojsonl(spark, str(tmp_path / "bad"), "code string").collect()
    kept = S.read_geojsonl(spark, str(tmp_path / "bad"), "code string", broken="_broken").collect()
    assert [r["_broken"] is None for r in kept] == [True, False]


def test_spatial_export(spark, shapes, tmp_path):
    layer = G.set_srid(shapes, 4283)
    assert S.geometry_columns(layer) == [{"column": "geom", "kind": "MULTIPOLYGON", "srid": 4283}]
    target = S.export_table(layer, "lga_2021_gda94", str(tmp_path), with_wkt=True)
    assert target.endswith("/lga_2021")
    back = S.read_spatial(spark, target)
    assert G.get_srid(back) == 4326
    got = {r[0]: r[1] for r in back.groupBy("code").agg(F.sum(G.area("geom"))).collect()}
    assert got == {"square": 16.0, "holed": 12.0, "diamond": 24.0, "elbow": 12.0, "multi": 17.0}
    assert back.filter(F.col("wkt_geom").startswith("POLYGON")).count() == 6


def test_viewport_is_pushed_down(spark, shapes, tmp_path):
    path = str(tmp_path / "boxed")
    G.with_bbox(shapes).write.parquet(path)
    seen = A.in_viewport(spark.read.parquet(path), 5.0, -1.0, 9.0, 1.0)
    assert sorted(r["code"] for r in seen.collect()) == ["diamond", "multi"]
    plan = spark._jvm.PythonSQLUtils.explainString(seen._jdf.queryExecution(), "formatted")
    assert "PushedFilters" in plan and "GreaterThanOrEqual(xmax,5.0)" in plan


def test_tagging_plan_has_no_nested_loop(spark, shapes, scattered):
    for path in ({}, {"broadcast_bytes": 0}):
        tagged = J.tag_points(scattered, shapes, **path)
        plan = spark._jvm.PythonSQLUtils.explainString(tagged._jdf.queryExecution(), "simple")
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_tagging_with_a_stored_cover(spark, shapes, scattered, monkeypatch):
    plain = {tuple(r) for r in J.tag_points(scattered, shapes).select("id", "code").collect()}
    monkeypatch.setattr(J, "STORE_BYTES", 0)
    assert {tuple(r) for r in J.tag_points(scattered, shapes).select("id", "code").collect()} == plain


def test_shapes_are_made_on_all_cores(spark, tmp_path):
    """One small file of suppliers, read as one partition, gives shapes in several tasks."""
    from workload import derived

    rows = spark.range(400).select(F.col("id").alias("s_suppkey"), F.lit("n").alias("s_name"), (F.col("id") % 25).cast("int").alias("s_nationkey"))
    rows.coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    for made in (derived.regions, derived.ragged, derived.lattice):
        found = made(spark, str(tmp_path)).groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in found) == 400 and max(r["count"] for r in found) <= 200


def test_crowded_cells_are_dealt_to_tasks(spark):
    """Pairs of one crowded cell come from several tasks, each once; a share leaves out
    only shapes too small for it."""
    rng = random.Random(3)

    def boxes(n, sizes):
        corners = [(rng.uniform(0, 3), rng.uniform(0, 3), rng.choice(sizes)) for _ in range(n)]
        rows = [(i, polygon([[(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]]), i % 2) for i, (x, y, w) in enumerate(corners)]
        return corners, spark.createDataFrame(rows, f"id int, geom {G.GEOM_TYPE}, kind int")

    (a, left), (b, right) = boxes(90, [0.02, 0.3, 2]), boxes(120, [0.05, 1, 1.5])
    common = {(i, j): max(0, min(x + w, u + v) - max(x, u)) * max(0, min(y + w, t + v) - max(y, t)) for i, (x, y, w) in enumerate(a) for j, (u, t, v) in enumerate(b)}
    meet = {k for k, v in common.items() if v > 0}
    pairs = J.candidate_pairs(left, right, cell_pairs=200, task_pairs=500).select("a_id", "b_id", F.spark_partition_id().alias("p")).collect()
    assert len(pairs) == len(meet) and {(r[0], r[1]) for r in pairs} == meet
    assert max(sum(r["p"] == p for r in pairs) for p in {r["p"] for r in pairs}) < len(pairs) / 3
    alike = J.candidate_pairs(left, right, on=["kind"], cell_pairs=200).select("a_id", "b_id").collect()
    assert {tuple(r) for r in alike} == {(i, j) for i, j in meet if i % 2 == j % 2} and len(alike) == len(set(alike))
    for share, dealt in ((0.0, 200), (0.5, 200), (0.9, 10**6)):
        want = {k: v for k, v in common.items() if v > share * b[k[1]][2] ** 2}
        found = J.overlap_areas(left.withColumnRenamed("id", "one"), right.withColumnRenamed("id", "other"), "one", "other", share=share, cell_pairs=dealt, task_pairs=500).collect()
        got = {(r["one"], r["other"]): r["common_area"] for r in found if r["common_area"] > 1e-12}
        assert len({(r["one"], r["other"]) for r in found}) == len(found) and all(got[k] == pytest.approx(v) for k, v in want.items())
        assert all(got[k] == pytest.approx(common[k]) for k in got) and (share or set(got) == meet)
        assert not share or not any(a[i][2] ** 2 * 2 < share * b[j][2] ** 2 for i, j in got)

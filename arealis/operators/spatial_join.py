"""Spatial joins planned as equi-joins on grid cells.

A theta join on a geometry predicate would be a nested loop. Instead every
polygon is covered by the cells of a power-of-four grid whose level follows its
size, so it takes a bounded number of cells however large it is, and a point is
looked up once per level in use. Each cell carries only the polygon edges near it,
and for the edges beyond it whether a ray meets an odd number of them: the exact
test touches a handful of edges, and a cell inside the polygon needs none.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions import geometry as G
from arealis.functions.arrow_geometry import intersection_area, pieces_by_cell
from arealis.session import estimated_bytes, spread, stored

# Sides up to this many measured bytes are broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 64 * 1024 * 1024
# A cell with more points than this is split over several tasks.
HOT_ROWS = 1_000_000
LEVELS = (-12, 12)
# The cover of a layer estimated larger than this is written once, not worked out
# again for the join after it was measured.
STORE_BYTES = 4 * 1024 * 1024
# Candidates that a task of a join of shapes should have, and the most that one cell
# gives to a task.
TASK_PAIRS = 4_000_000
CELL_PAIRS = 1_000_000
# Mean earth radius in metres and metres per degree of latitude on it.
EARTH_RADIUS = 6371008.8
METRES_PER_DEGREE = EARTH_RADIUS * math.pi / 180.0


def cell_size(level: Column) -> Column:
    return F.pow(F.lit(4.0), level)


def _grid_level(extent: Column, vertices: Column | None = None) -> Column:
    """Level whose cells cut a box of this extent into few pieces; shapes with
    many vertices get finer cells (at most 65 per side)."""
    wanted = extent
    if vertices is not None:
        side = F.greatest(F.lit(2.0), F.least(F.lit(64.0), F.sqrt(vertices.cast("double")) / 2))
        wanted = extent / side
    level = F.ceil(F.log2(F.greatest(wanted, F.lit(1e-12))) / 2)
    return F.greatest(F.least(level, F.lit(LEVELS[1])), F.lit(LEVELS[0])).cast("int")


def _index(value: Column, level: Column) -> Column:
    return F.floor(value / cell_size(level)).cast("long")


def _degrees_grown(df: DataFrame, metres: float) -> DataFrame:
    """Grow the box columns by a distance on the sphere."""
    up = metres / METRES_PER_DEGREE
    widest = F.cos(F.radians(F.least(F.greatest(F.abs(F.col("_y0")), F.abs(F.col("_y1"))) + up, F.lit(89.9))))
    across = F.lit(up) / widest
    return df.withColumns(
        {"_x0": F.col("_x0") - across, "_x1": F.col("_x1") + across, "_y0": F.col("_y0") - up, "_y1": F.col("_y1") + up, "_gx": across, "_gy": F.lit(up)}
    )


def cell_cover(bdy: DataFrame, geom: str = "geom", metres: float = 0.0) -> DataFrame:
    """Boundary attributes per grid cell: ``_level, _ci, _cj, _parity, _flips,
    _edges`` and the box ``_x0, _y0, _x1, _y1``.

    Rows of cells are exploded first and keep only the edges of their band, so a
    polygon with many vertices is not copied whole into every cell.
    """
    attrs = [c for c in bdy.columns if c != geom]
    known = spread(bdy.filter(F.col(geom).isNotNull() & (G.npoints(geom) > 0)))
    boxed = G.with_bbox(known, geom, ("_x0", "_y0", "_x1", "_y1")).select(
        *attrs, G.edges(geom).alias("_edges"), G.npoints(geom).alias("_n"), "_x0", "_y0", "_x1", "_y1"
    )
    if metres > 0:
        boxed = _degrees_grown(boxed, metres)
    else:
        boxed = boxed.withColumns({"_gx": F.lit(0.0), "_gy": F.lit(0.0)})
    extent = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"))
    levelled = boxed.withColumn("_level", _grid_level(extent, F.col("_n"))).withColumn("_size", cell_size(F.col("_level")))
    size = F.col("_size")

    def steps(low: str, high: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(low) / size).cast("long"), F.floor(F.col(high) / size).cast("long")))

    bands = levelled.withColumn("_cj", steps("_y0", "_y1"))
    low, high, gy = F.col("_cj") * size, (F.col("_cj") + 1) * size, F.col("_gy")
    in_band = F.filter(
        "_edges",
        lambda e: (F.greatest(e["y1"], e["y2"]) >= low - gy) & (F.least(e["y1"], e["y2"]) <= high + gy),
    )
    cells = bands.withColumn("_edges", in_band).withColumn("_ci", steps("_x0", "_x1"))
    left, right, gx = F.col("_ci") * size, (F.col("_ci") + 1) * size, F.col("_gx")

    def past(e: Column) -> Column:
        return F.least(e["x1"], e["x2"]) > right + gx

    def odd_only(values: Column) -> Column:
        """Values met an odd number of times, ascending."""
        none = F.array().cast("array<double>")

        def step(acc: Column, y: Column) -> Column:
            seen = F.try_element_at(acc, F.lit(-1)).eqNullSafe(y)
            return F.when(seen, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(F.array_append(acc, y))

        return F.aggregate(F.array_sort(values), none, step)

    # A ray meets an edge past the cell exactly while the point's y is in the edge's
    # y range. How many it meets, odd or even, is known at the foot of the band and
    # flips at the end of an edge, where the next edge mostly flips it back: a
    # boundary passing by leaves no flip at all.
    def content(reachable: Column) -> Column:
        far = F.filter(reachable, past)
        ends = F.concat(F.transform(far, lambda e: e["y1"]), F.transform(far, lambda e: e["y2"]))
        at_foot = F.filter(far, lambda e: (F.least(e["y1"], e["y2"]) <= low) & (F.greatest(e["y1"], e["y2"]) > low))
        return F.struct(
            (F.size(at_foot) % 2).alias("_parity"),
            odd_only(F.filter(ends, lambda y: (y > low) & (y < high))).alias("_flips"),
            F.filter(reachable, lambda e: ~past(e)).alias("_edges"),
        )

    # edges left of the cell are never met
    reachable = F.filter("_edges", lambda e: F.greatest(e["x1"], e["x2"]) >= left - gx)
    # cells wholly outside are dropped inside the generator, which works each cell out once
    kept = F.filter(
        F.transform(F.array(reachable), content),
        lambda c: (F.size(c["_edges"]) > 0) | (F.size(c["_flips"]) > 0) | (c["_parity"] == 1),
    )
    return cells.select(*attrs, "_level", "_ci", "_cj", "_x0", "_y0", "_x1", "_y1", F.inline(kept))


def _row_bytes(df: DataFrame) -> Column:
    """Estimated bytes of a cover row in a hash table; a nested attribute counts
    four bytes for each of its JSON text's."""
    total = F.lit(144) + F.size("_edges") * 40 + F.size("_flips") * 8
    for name, kind in df.dtypes:
        if name.startswith("_"):
            continue
        total = total + 16
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)) * 4
    return total


def _ready_cover(bdy: DataFrame, geom: str, metres: float = 0.0) -> DataFrame:
    cover = cell_cover(bdy, geom, metres)
    return stored(cover, "cover") if estimated_bytes(bdy) > STORE_BYTES else cover


def _measure(cover: DataFrame) -> tuple[list[int], int]:
    """Grid levels in use (at most 25) and bytes of the whole cover."""
    found = cover.agg(
        F.collect_set("_level").alias("levels"), F.sum(_row_bytes(cover).cast("long")).alias("bytes")
    ).first()
    return sorted(found["levels"]), found["bytes"] or 0


def _with_cells(points: DataFrame, levels: Sequence[int], px: str, py: str) -> DataFrame:
    known = points.filter(F.col(px).isNotNull() & F.col(py).isNotNull())
    if len(levels) == 1:
        probed = known.withColumn("_level", F.lit(levels[0]))
    else:
        probed = known.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels])))
    level = F.col("_level")
    return probed.withColumns({"_ci": _index(F.col(px), level), "_cj": _index(F.col(py), level)})


def _split_hot_cells(probed: DataFrame, cover: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Spread cells holding more than ``hot_rows`` points over several tasks.

    Such cells get as many salts as their points need; a point's salt comes from its
    position, so equal points spread too, and their polygons are repeated once per
    salt. Results do not change.
    """
    keys = ["_level", "_ci", "_cj"]
    hot = (
        probed.groupBy(*keys)
        .count()
        .filter(F.col("count") > hot_rows)
        .select(*keys, F.ceil(F.col("count") / hot_rows).cast("int").alias("_salts"))
    )
    salts = F.coalesce("_salts", F.lit(1))
    placed = probed.withColumn("_row", F.monotonically_increasing_id())
    left = placed.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64("_row"), salts).cast("int")).drop("_row")
    right = cover.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return left.drop("_salts"), right.drop("_salts")


def _cell_join(points: DataFrame, cover: DataFrame, px: str, py: str, broadcast_bytes: int, hot_rows: int) -> DataFrame:
    levels, size = _measure(cover)
    if not levels:
        levels = [0]
    probed = _with_cells(points, levels, px, py)
    keys = ["_level", "_ci", "_cj"]
    if size <= broadcast_bytes:
        joined = probed.join(F.broadcast(cover), keys)
    else:
        probed, cover = _split_hot_cells(probed, cover, hot_rows)
        joined = probed.join(cover, [*keys, "_salt"]).drop("_salt")
    # compiled box test, so that the interpreted one sees few candidates
    return joined.filter(F.col(px).between(F.col("_x0"), F.col("_x1")) & F.col(py).between(F.col("_y0"), F.col("_y1")))


def _inside(px: str, py: str) -> Column:
    """Exact test on a candidate: parity first, borders only for points outside."""
    lines, x, y = F.col("_edges"), F.col(px), F.col(py)
    flips = F.size(F.filter("_flips", lambda at: at <= y))
    inside = ((G.crossings(lines, x, y) + flips + F.col("_parity")) % 2 == 1) | G.on_edge(lines, x, y)
    plain = (F.size("_edges") == 0) & (F.size("_flips") == 0)
    return F.when(plain, F.col("_parity") == 1).otherwise(inside)


def tag_points(
    points: DataFrame,
    bdy: DataFrame,
    how: str = "inner",
    px: str = "x",
    py: str = "y",
    geom: str = "geom",
    point_id: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Points with the attributes of every region they meet, borders included.

    A point on a shared border gets one row per region. ``how='left'`` also keeps
    points outside all regions or without coordinates: the distinct positions are
    tagged and looked up by every point, so points that share an id or a position
    keep their rows. ``point_id`` is not needed for it and has no effect.
    """
    clash = set(points.columns) & set(bdy.columns) - {geom}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    attrs = [c for c in bdy.columns if c != geom]
    asked = spread(points) if how == "inner" else points.select(px, py).distinct()
    joined = _cell_join(asked, _ready_cover(bdy, geom), px, py, broadcast_bytes, hot_rows)
    tagged = joined.filter(_inside(px, py)).select(*asked.columns, *attrs)
    if how == "inner":
        return tagged
    return points.join(tagged, [px, py], "left").select(*points.columns, *attrs)


# --- within a distance ------------------------------------------------------------------


def segment_metres(px: Column, py: Column, e: Column) -> Column:
    """Great-circle distance in metres from a point to an edge.

    The edge is short, so both are laid out on the plane touching the sphere at
    the point (equirectangular), and the nearest position is then measured with
    the haversine formula.
    """
    squeeze = F.cos(F.radians(py))
    ax, ay = (e["x1"] - px) * squeeze, e["y1"] - py
    bx, by = (e["x2"] - px) * squeeze, e["y2"] - py
    dx, dy = bx - ax, by - ay
    along = F.coalesce(F.try_divide(-(ax * dx + ay * dy), dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
    lon = F.radians((e["x2"] - e["x1"]) * t + e["x1"] - px)
    lat1, lat2 = F.radians(py), F.radians((e["y2"] - e["y1"]) * t + e["y1"])
    h = F.pow(F.sin((lat2 - lat1) / 2), F.lit(2.0)) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin(lon / 2), F.lit(2.0))
    return F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * (2 * EARTH_RADIUS)


def tag_points_within(
    points: DataFrame,
    bdy: DataFrame,
    metres: float,
    px: str = "x",
    py: str = "y",
    geom: str = "geom",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Points inside a region or within ``metres`` of it (longitude/latitude),
    with the region's attributes and ``distance`` (0 inside)."""
    attrs = [c for c in bdy.columns if c != geom]
    joined = _cell_join(spread(points), _ready_cover(bdy, geom, metres), px, py, broadcast_bytes, hot_rows)
    nearest = F.array_min(F.transform("_edges", lambda e: segment_metres(F.col(px), F.col(py), e)))
    measured = joined.withColumn("distance", F.when(_inside(px, py), F.lit(0.0)).otherwise(nearest))
    return measured.filter(F.col("distance") <= metres).select(*points.columns, *attrs, "distance")


# --- polygon pairs --------------------------------------------------------------------------


def _pair_cells(df: DataFrame, levels: Sequence[int], tag: str) -> DataFrame:
    """Cells of a polygon's box at its own level (``own``) and every coarser one."""
    coarser = F.filter(F.array(*[F.lit(v) for v in levels]), lambda v: v >= F.col("_level"))
    at = df.withColumn("_own", F.col("_level")).withColumn("_level", F.explode(coarser))
    level = F.col("_level")
    bands = at.withColumn("_cj", F.explode(F.sequence(_index(F.col(f"{tag}_y0"), level), _index(F.col(f"{tag}_y1"), level))))
    return bands.withColumn("_ci", F.explode(F.sequence(_index(F.col(f"{tag}_x0"), level), _index(F.col(f"{tag}_x1"), level))))


def _dealt(left: DataFrame, right: DataFrame, keys: Sequence[str], cell_pairs: int, task_pairs: int) -> DataFrame:
    """``left`` and ``right`` joined on cells, in tasks of about as many pairs each: a
    join's work follows its pairs, not the bytes that tasks are otherwise made by. Of a
    cell with very many pairs the side with more rows is dealt to several tasks and the
    other repeated in each. Both sides are read more than once."""
    sides = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "_l"), (right, "_r"))]
    per = stored(sides[0].join(sides[1], keys).withColumn("_pairs", F.col("_l") * F.col("_r")), "cells")
    total = per.agg(F.sum("_pairs")).first()[0] or 0
    if total <= cell_pairs:
        return left.join(right, keys)
    hot = per.filter(F.col("_pairs") > cell_pairs).select(*keys, F.ceil(F.col("_pairs") / cell_pairs).cast("int").alias("_salts"), (F.col("_l") >= F.col("_r")).alias("_many"))
    tasks = max(left.sparkSession.sparkContext.defaultParallelism, math.ceil(total / task_pairs))

    def placed(df: DataFrame, more: Column) -> DataFrame:
        salts = F.coalesce("_salts", F.lit(1))
        one = F.array(F.pmod(F.xxhash64("_row"), salts).cast("int"))
        salt = F.explode(F.when(more, one).otherwise(F.sequence(F.lit(0), salts - 1))).alias("_salt")
        found = df.withColumn("_row", F.monotonically_increasing_id()).join(hot, keys, "left")
        return found.select(*df.columns, salt).repartition(tasks, *keys, "_salt")

    many = F.coalesce("_many", F.lit(True))
    return placed(left, many).join(placed(right, ~many), [*keys, "_salt"]).drop("_salt")


def candidate_pairs(
    a: DataFrame, b: DataFrame, geom: str = "geom", on: Sequence[str] = (), cell_pairs: int = CELL_PAIRS, task_pairs: int = TASK_PAIRS
) -> DataFrame:
    """Pairs of rows whose boxes meet, each once; geometries as ``a_geom, b_geom``. With
    ``on`` the rows must agree in these columns, too.

    A pair meets at the coarser of its two levels, where both take few cells, and
    only the cell holding the corner of the shared box reports it, so no
    ``distinct`` is needed. Two coarse copies are never paired with each other.
    """

    def boxed(df: DataFrame, tag: str) -> DataFrame:
        known = spread(df.filter(F.col(geom).isNotNull() & (G.npoints(geom) > 0)))
        box = [f"{tag}_{side}" for side in ("x0", "y0", "x1", "y1")]
        out = G.with_bbox(known, geom, box).select(*[F.col(c).alias(f"{tag}_{c}") for c in df.columns], *box)
        extent = F.greatest(F.col(f"{tag}_x1") - F.col(f"{tag}_x0"), F.col(f"{tag}_y1") - F.col(f"{tag}_y0"))
        same = {f"_on_{c}": F.col(f"{tag}_{c}") for c in on}
        return stored(out.withColumns({"_level": _grid_level(extent), **same}), "boxes")

    left, right = boxed(a, "a"), boxed(b, "b")
    found = left.select("_level").union(right.select("_level")).agg(F.collect_set("_level").alias("l")).first()
    levels = sorted(found["l"]) or [0]
    left, right = _pair_cells(left, levels, "a"), _pair_cells(right, levels, "b")
    keys = ["_level", "_ci", "_cj", *[f"_on_{c}" for c in on]]
    own_left = left.filter(F.col("_own") == F.col("_level")).drop("_own")
    own_right = right.filter(F.col("_own") == F.col("_level")).drop("_own")
    finer_left = left.filter(F.col("_own") < F.col("_level")).drop("_own")
    dealt = [_dealt(one, other, keys, cell_pairs, task_pairs) for one, other in ((own_left, right.drop("_own")), (finer_left, own_right))]
    pairs = dealt[0].unionByName(dealt[1])
    x0, y0 = F.greatest("a_x0", "b_x0"), F.greatest("a_y0", "b_y0")
    meet = (x0 <= F.least("a_x1", "b_x1")) & (y0 <= F.least("a_y1", "b_y1"))
    reporting = (_index(x0, F.col("_level")) == F.col("_ci")) & (_index(y0, F.col("_level")) == F.col("_cj"))
    names = [f"a_{c}" for c in a.columns] + [f"b_{c}" for c in b.columns]
    return pairs.filter(meet & reporting).select(*names)


def overlap_areas(
    a: DataFrame, b: DataFrame, a_id: str, b_id: str, geom: str = "geom", share: float = 0.0, cell_pairs: int = CELL_PAIRS, task_pairs: int = TASK_PAIRS
) -> DataFrame:
    """The common area of every two shapes that share any: a_id, b_id, common_area. With
    ``share`` pairs may be missing that have at most this part of b's area in common.

    Shapes are cut into the cells of grids, and only pieces travel. Each takes part in
    the grid of its own size and in the coarser ones that the other layer uses; a pair
    meets in the coarser of its two grids, and two finer shapes never do there. Cells
    that a shape fills carry no geometry: there the other's area counts. The areas of a
    pair's pieces are added up. A shape of a meets only shapes of b that its boxes are
    large enough for: b is told apart by the power of two below what it needs.
    """

    def sized(df: DataFrame, key: str, size: Column) -> DataFrame:
        known = spread(df.filter(F.col(geom).isNotNull() & (G.npoints(geom) > 0)))
        extent = F.greatest(G.xmax(geom) - G.xmin(geom), G.ymax(geom) - G.ymin(geom))
        power = F.floor(F.log2(size)).cast("int") if share > 0 else F.lit(0)
        made = known.select(F.col(key).alias("_key"), F.col(geom).alias("_geom"), _grid_level(extent).alias("_own"), power.alias("_power"))
        return made.filter(F.col("_power").isNotNull())

    # no part of b has more in common with a part of a than the box of a holds
    boxes = (G.xmax(geom) - G.xmin(geom)) * (G.ymax(geom) - G.ymin(geom)) * G.num_parts(geom)
    left, right = sized(a, a_id, boxes), sized(b, b_id, G.area(geom) / G.num_parts(geom) * (share * (1 - 1e-9)))
    # a handful of levels and powers
    used = [[tuple(r) for r in df.select("_own", "_power").distinct().collect()] for df in (left, right)]

    def met(level: Column, own: Column, mine: int) -> Column:
        """The powers of b that the row can meet on this level."""
        known = [F.struct(F.lit(v).alias("own"), F.lit(p).alias("power")) for v, p in used[1 - mine]]
        if not known:
            return F.array().cast("array<int>")
        enough = (lambda p: p <= F.col("_power")) if mine == 0 else (lambda p: p >= F.col("_power"))
        found = F.filter(F.array(*known), lambda o: F.when(own, o["own"] <= level).otherwise(o["own"] == level) & enough(o["power"]))
        return F.array_distinct(F.transform(found, lambda o: o["power"]))

    def pieces(df: DataFrame, mine: int, tag: str) -> DataFrame:
        coarser = F.filter(F.array(*[F.lit(v) for v in sorted({v for v, _ in used[1 - mine]})]).cast("array<int>"), lambda v: v > F.col("_own"))
        levels = F.filter(F.concat(F.array("_own"), coarser), lambda v: F.size(met(v, v == F.col("_own"), mine)) > 0)
        # an inner explode would cut twice, to filter the rows without pieces beforehand
        asked = df.withColumn("_levels", levels)
        cut = asked.select(F.col("_key").alias(tag), "_own", "_power", F.explode_outer(pieces_by_cell("_geom", F.col("_levels"))).alias("p")).filter("p.level IS NOT NULL")
        own = F.col("_own") == F.col("p.level")
        cut = cut.select(tag, F.col("p.level").alias("level"), "p.ci", "p.cj", "_power", own.alias(f"{tag}_own"), *[F.col(f"p.{c}").alias(f"{tag}_{c}") for c in ("full", "area", "piece")])
        power = F.explode(met(F.col("level"), F.col(f"{tag}_own"), 0)) if mine == 0 else F.col("_power")
        return stored(cut, "pieces").withColumn("power", power).drop("_power")

    left, right = pieces(left, 0, "a"), pieces(right, 1, "b")
    keys = ["level", "ci", "cj", "power"]
    both = ((left.filter("a_own"), right), (left.filter("not a_own"), right.filter("b_own")))
    dealt = [_dealt(one, other, keys, cell_pairs, task_pairs) for one, other in both]
    met_pieces = dealt[0].unionByName(dealt[1])
    part = F.when(F.col("a_full"), F.col("b_area")).when(F.col("b_full"), F.col("a_area")).otherwise(intersection_area("a_piece", "b_piece"))
    shared = met_pieces.select(F.col("a").alias(a_id), F.col("b").alias(b_id), part.alias("common_area"))
    return shared.groupBy(a_id, b_id).agg(F.sum("common_area").alias("common_area")).filter("common_area > 0")


def match_by_overlap(a: DataFrame, b: DataFrame, share: float = 0.5, geom: str = "geom") -> DataFrame:
    """Pairs where the common area is more than ``share`` of b's area: the other columns
    of both, as ``a_`` and ``b_``, with ``common_area`` and ``overlap``."""
    a, b = (stored(df.select(F.monotonically_increasing_id().alias(key), "*"), "layer") for df, key in ((a, "_a"), (b, "_b")))
    sized = b.select("_b", G.area(geom).alias("_area"))
    found = overlap_areas(a, b, "_a", "_b", geom, share).join(sized, "_b")
    found = found.withColumn("overlap", F.try_divide("common_area", "_area")).filter(F.col("overlap") > share)
    others = lambda df, tag: df.select(f"_{tag}", *[F.col(c).alias(f"{tag}_{c}") for c in df.columns if c not in (geom, f"_{tag}")])
    return found.join(others(a, "a"), "_a").join(others(b, "b"), "_b").drop("_a", "_b", "_area").select(
        *[f"a_{c}" for c in a.columns if c not in (geom, "_a")], *[f"b_{c}" for c in b.columns if c not in (geom, "_b")], "common_area", "overlap"
    )

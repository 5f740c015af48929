"""Boundaries, points, profiles and dictionaries derived from the supplied tables.

Each derivation exists twice, as a DataFrame and as SQL text, from the same
formulas. Coordinates lie on a 1/1024 grid, so the arithmetic is exact in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions import geometry as G
from arealis.session import spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """The suppliers over all cores: their file is one scan partition however many
    shapes come of it, and each shape costs far more than its row."""
    return spread(table(spark, sf, "supplier"))


# --- regions (one per supplier) -------------------------------------------------------------

SQUARE = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]
DIAMOND = [(0, -1), (1, 0), (0, 1), (-1, 0), (0, -1)]
ELBOW = [(-1, -1), (1, -1), (1, 0), (0, 0), (0, 1), (-1, 1), (-1, -1)]
HOLE = [(-0.5, -0.5), (-0.5, 0.5), (0.5, 0.5), (0.5, -0.5), (-0.5, -0.5)]
ISLAND = [(1.5, -0.5), (2.5, -0.5), (2.5, 0.5), (1.5, 0.5), (1.5, -0.5)]

# shape -> parts -> rings
SHAPES = {
    "square": [[SQUARE]],
    "diamond": [[DIAMOND]],
    "elbow": [[ELBOW]],
    "ring": [[SQUARE, HOLE]],
    "islands": [[SQUARE, HOLE], [ISLAND]],
}


def shape_of(k: Column) -> Column:
    return (
        F.when(k % 16 == 9, F.lit(None))
        .when(k % 16 == 13, "empty")
        .when(k % 8 == 7, "islands")
        .when(k % 4 == 3, "ring")
        .when(k % 4 == 2, "elbow")
        .when(k % 4 == 1, "diamond")
        .otherwise("square")
    )


def half_width(k: Column) -> Column:
    """Regions shrink as their number grows, so they keep overlapping the same."""
    tier = F.floor((F.length(F.bin(k + 1)) - 1) / 2).cast("int")
    return F.lit(2.0) / F.call_function("shiftleft", F.lit(1).cast("long"), tier)


def centre(k: Column) -> tuple[Column, Column]:
    return (k * 7919 % 40960) / 1024.0 + 113, (k * 104729 % 30720) / 1024.0 - 42


def code(k: Column) -> Column:
    return F.concat(F.lit("R"), F.lpad(k.cast("string"), 9, "0"))


def template(parts) -> Column:
    """A shape's offsets as one literal."""

    def array(items) -> str:
        return f"array({', '.join(items)})"

    def point(p) -> str:
        return f"named_struct('x', {float(p[0])}D, 'y', {float(p[1])}D)"

    return F.expr(array(array(array(point(p) for p in ring) for ring in part) for part in parts))


def regions(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    cx, cy = centre(k)
    base = suppliers(spark, sf).select(
        k.alias("k"),
        code(k).alias("code"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("S"), (F.col("s_nationkey") % 8).cast("string")).alias("state"),
        shape_of(k).alias("shape"),
        cx.alias("cx"),
        cy.alias("cy"),
        half_width(k).alias("w"),
    )
    offsets = F.when(F.col("shape") == "empty", F.array().cast(G.GEOM_TYPE))
    for shape, parts in SHAPES.items():
        offsets = offsets.when(F.col("shape") == shape, template(parts))
    cx, cy, w = F.col("cx"), F.col("cy"), F.col("w")
    geom = G.map_vertices(offsets, lambda v: G.make_point(cx + w * v["x"], cy + w * v["y"]))
    return base.select("k", "code", "name", "state", (F.col("w") * F.col("w") * 40000 + 1).alias("area_sqkm"), geom.alias("geom"))


REGIONS_SQL = """
regions AS (
  SELECT s_suppkey AS k, 'R' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS code, s_name AS name,
    'S' || CAST(s_nationkey % 8 AS VARCHAR) AS state,
    CASE WHEN s_suppkey % 16 = 9 THEN NULL WHEN s_suppkey % 16 = 13 THEN 'empty' WHEN s_suppkey % 8 = 7 THEN 'islands'
      WHEN s_suppkey % 4 = 3 THEN 'ring' WHEN s_suppkey % 4 = 2 THEN 'elbow' WHEN s_suppkey % 4 = 1 THEN 'diamond'
      ELSE 'square' END AS shape,
    (s_suppkey * 7919 % 40960) / 1024.0::DOUBLE + 113 AS cx, (s_suppkey * 104729 % 30720) / 1024.0::DOUBLE - 42 AS cy,
    2.0::DOUBLE / (1::BIGINT << CAST((length(bin(s_suppkey + 1)) - 1) // 2 AS INT)) AS w
  FROM supplier),
outline(shape, part, ring, seq, dx, dy) AS (VALUES {values}),
verts AS (
  SELECT r.k, r.code, o.part, o.ring, o.seq, r.cx + r.w * o.dx AS x, r.cy + r.w * o.dy AS y
  FROM regions r JOIN outline o ON r.shape = o.shape),
edges AS (
  SELECT * FROM (
    SELECT k, code, part, ring, seq, x AS x1, y AS y1, lead(x) OVER e AS x2, lead(y) OVER e AS y2
    FROM verts WINDOW e AS (PARTITION BY k, part, ring ORDER BY seq))
  WHERE x2 IS NOT NULL),
boxes AS (
  SELECT k, code, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax, count(*) AS n FROM verts GROUP BY k, code),
ring_areas AS (
  SELECT k, part, ring, abs(sum(x1 * y2 - x2 * y1)) / 2 AS a FROM edges GROUP BY k, part, ring),
areas AS (
  SELECT k, sum(CASE WHEN ring = 1 THEN a ELSE -a END) AS area FROM ring_areas GROUP BY k)
""".replace(
    "{values}",
    ", ".join(
        f"('{shape}', {p}, {r}, {i}, {float(dx)}::DOUBLE, {float(dy)}::DOUBLE)"
        for shape, parts in SHAPES.items()
        for p, part in enumerate(parts, 1)
        for r, ring in enumerate(part, 1)
        for i, (dx, dy) in enumerate(ring, 1)
    ),
)


# --- ragged outlines with many vertices (one per supplier) --------------------------------------


def ragged(spark: SparkSession, sf: str) -> DataFrame:
    """Squares whose sides zigzag inwards: ``steps`` per side (16 to 128), depth
    a small part of a step, so the corners outlast the teeth when thinned."""
    k = F.col("s_suppkey")
    cx, cy = centre(k)
    w, n = half_width(k), F.call_function("shiftleft", F.lit(16), (k % 4).cast("int"))
    base = suppliers(spark, sf).select(
        k.alias("k"), code(k).alias("code"), w.alias("w"), n.alias("steps"),
        (cx - w).alias("x0"), (cy - w).alias("y0"), (w * 2 / n).alias("step"),
    )
    step, side = F.col("step"), F.col("w") * 2
    x0, y0 = F.col("x0"), F.col("y0")
    along = F.sequence(F.lit(0), F.col("steps") - 1)

    def edge(fn) -> Column:
        return F.transform(along, lambda t: fn(t * step, (t % 2) * step / 256))

    ring = F.concat(
        edge(lambda d, h: G.make_point(x0 + d, y0 + h)),
        edge(lambda d, h: G.make_point(x0 + side - h, y0 + d)),
        edge(lambda d, h: G.make_point(x0 + side - d, y0 + side - h)),
        edge(lambda d, h: G.make_point(x0 + h, y0 + side - d)),
        F.array(G.make_point(x0, y0)),
    )
    return base.select("k", "code", "w", "steps", "step", F.array(F.array(ring)).alias("geom"))


RAGGED_SQL = """
ragged AS (
  SELECT s_suppkey AS k, 'R' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS code,
    2.0::DOUBLE / (1::BIGINT << CAST((length(bin(s_suppkey + 1)) - 1) // 2 AS INT)) AS w,
    16 << CAST(s_suppkey % 4 AS INT) AS steps
  FROM supplier),
raggeds AS (SELECT *, w * 2 / steps AS step, 4 * w * w - w * (w * 2 / steps) / 64 AS area FROM ragged)
"""


# --- a lattice of regions with shared wavy borders (one per supplier) -----------------------------


def lattice(spark: SparkSession, sf: str, steps: int = 16) -> DataFrame:
    """Unit cells whose borders zigzag and are shared exactly with the neighbours."""
    k = F.col("s_suppkey")
    base = suppliers(spark, sf).select(
        k.alias("k"), code(k).alias("code"),
        F.pmod(k, F.lit(8)).cast("double").alias("i"), F.floor(k / 8).cast("double").alias("j"),
    )
    along = F.sequence(F.lit(0), F.lit(steps - 1))
    i, j = F.col("i"), F.col("j")

    def edge(fn) -> Column:
        return F.transform(along, lambda t: fn(t / float(steps), (t % 2) / 64.0))

    def back(fn) -> Column:
        return F.transform(along, lambda t: fn((F.lit(steps) - t) / float(steps), ((F.lit(steps) - t) % 2) / 64.0))

    ring = F.concat(
        edge(lambda d, h: G.make_point(i + d, j + h)),
        edge(lambda d, h: G.make_point(i + 1 + h, j + d)),
        back(lambda d, h: G.make_point(i + d, j + 1 + h)),
        back(lambda d, h: G.make_point(i + h, j + d)),
        F.array(G.make_point(i, j)),
    )
    return base.select("k", "code", F.array(F.array(ring)).alias("geom"))


# --- points (one per order, one per customer) -----------------------------------------------------


def _point(k: Column) -> tuple[Column, Column]:
    return (k * 7919 % 45056) / 1024.0 + 111, (k * 104729 % 34816) / 1024.0 - 44


def order_points(spark: SparkSession, sf: str) -> DataFrame:
    px, py = _point(F.col("o_orderkey"))
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("point_id"), F.col("o_orderstatus").alias("kind"), px.alias("x"), py.alias("y"))


def customer_points(spark: SparkSession, sf: str) -> DataFrame:
    px, py = _point(F.col("c_custkey"))
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("point_id"), px.alias("x"), py.alias("y"))


POINTS_SQL = """
points AS (
  SELECT o_orderkey AS point_id, o_orderstatus AS kind, (o_orderkey * 7919 % 45056) / 1024.0::DOUBLE + 111 AS x,
    (o_orderkey * 104729 % 34816) / 1024.0::DOUBLE - 44 AS y FROM orders)
"""

CUSTOMER_POINTS_SQL = """
cpoints AS (
  SELECT c_custkey AS point_id, (c_custkey * 7919 % 45056) / 1024.0::DOUBLE + 111 AS x,
    (c_custkey * 104729 % 34816) / 1024.0::DOUBLE - 44 AS y FROM customer)
"""


# --- profiles --------------------------------------------------------------------------------------


def region_profile(spark: SparkSession, sf: str) -> DataFrame:
    """``region_id, g1..g6`` per supplier: quantities in all and by kind. Regions
    whose number ends in 8 have nobody."""
    q, k = F.col("l_quantity"), F.col("l_suppkey")
    counted = F.when(k % 10 == 8, 0.0).otherwise(q)

    def only(condition: Column) -> Column:
        return F.sum(F.when(condition, counted).otherwise(0.0))

    return (
        table(spark, sf, "lineitem")
        .groupBy(code(k).alias("region_id"))
        .agg(
            F.sum(counted).alias("g1"),
            only(F.col("l_returnflag") == "A").alias("g2"),
            only(F.col("l_returnflag") == "N").alias("g3"),
            only(F.col("l_returnflag") == "R").alias("g4"),
            only(F.col("l_linestatus") == "O").alias("g5"),
            only(F.col("l_linestatus") == "F").alias("g6"),
        )
    )


PROFILE_SQL = """
profile AS (
  SELECT 'R' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS region_id, sum(q) AS g1,
    sum(CASE WHEN l_returnflag = 'A' THEN q ELSE 0 END) AS g2, sum(CASE WHEN l_returnflag = 'N' THEN q ELSE 0 END) AS g3,
    sum(CASE WHEN l_returnflag = 'R' THEN q ELSE 0 END) AS g4, sum(CASE WHEN l_linestatus = 'O' THEN q ELSE 0 END) AS g5,
    sum(CASE WHEN l_linestatus = 'F' THEN q ELSE 0 END) AS g6
  FROM (SELECT *, CASE WHEN l_suppkey % 10 = 8 THEN 0.0::DOUBLE ELSE l_quantity END AS q FROM lineitem)
  GROUP BY l_suppkey)
"""


def populations(spark: SparkSession, sf: str) -> DataFrame:
    """``region_id, t1, t3`` per part: line count and quantity."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("region_id"))
        .agg(F.count(F.lit(1)).cast("double").alias("t1"), F.sum("l_quantity").alias("t3"))
    )


def medians(spark: SparkSession, sf: str) -> DataFrame:
    """``region_id, t205, t206`` per part; every seventh median is NULL."""
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(
        F.concat(F.lit("P"), k.cast("string")).alias("region_id"),
        F.when(k % 7 != 0, F.floor("p_retailprice").cast("double")).alias("t205"),
        F.col("p_size").cast("double").alias("t206"),
    )


INCOME_SQL = """
populations AS (
  SELECT 'P' || CAST(l_partkey AS VARCHAR) AS region_id, CAST(count(*) AS DOUBLE) AS t1, sum(l_quantity) AS t3
  FROM lineitem GROUP BY l_partkey),
medians AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS region_id,
    CASE WHEN p_partkey % 7 <> 0 THEN CAST(floor(p_retailprice) AS DOUBLE) END AS t205, CAST(p_size AS DOUBLE) AS t206
  FROM part),
income AS (SELECT * FROM medians JOIN populations USING (region_id))
"""


# --- dictionary (one statistic per part) --------------------------------------------------------------


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    letter = F.substring(F.lit("GTIB"), (k % 4 + 1).cast("int"), F.lit(1))
    return table(spark, sf, "part").select(
        F.concat(letter, k.cast("string")).alias("sequential_id"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("short_id"),
        F.replace(F.concat_ws(" ", "p_name", "p_type"), F.lit(" "), F.lit("_")).alias("long_id"),
        F.concat(letter, F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("table_number"),
        F.col("p_brand").alias("profile_table"),
        F.when(F.col("p_size") % 3 == 0, "Persons").when(F.col("p_size") % 3 == 1, "Males").otherwise("$/week").alias("column_heading_description"),
    )


DICTIONARY_SQL = """
dictionary AS (
  SELECT substr('GTIB', CAST(p_partkey % 4 + 1 AS INT), 1) || CAST(p_partkey AS VARCHAR) AS sequential_id,
    replace(p_name, ' ', '_') AS short_id, replace(p_name || ' ' || p_type, ' ', '_') AS long_id,
    substr('GTIB', CAST(p_partkey % 4 + 1 AS INT), 1) || lpad(CAST(p_size AS VARCHAR), 2, '0') AS table_number,
    p_brand AS profile_table,
    CASE WHEN p_size % 3 = 0 THEN 'Persons' WHEN p_size % 3 = 1 THEN 'Males' ELSE '$/week' END AS column_heading_description
  FROM part)
"""


def with_sql(*parts: str, body: str) -> str:
    """A WITH query from derivations and a body."""
    return "WITH " + ", ".join(p.strip() for p in parts) + " " + body.strip()

"""Layers thinned for display."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.functions import geometry as G
from arealis.functions.arrow_geometry import simplify_arcs, simplify_vw, subdivided, swept_areas
from arealis.functions.scalars import METRES_PER_DEGREE, zoom_tolerance
from arealis.operators.spatial_join import tag_points
from arealis.session import spread, stored

# Fixed value: area tolerance of the display layer, in squared degrees.
WEB_TOLERANCE = 1e-7


def subdivide(df: DataFrame, max_vertices: int = 256, geom: str = "geom") -> DataFrame:
    """Rows repeated per piece of at most ``max_vertices`` vertices."""
    others = [c for c in df.columns if c != geom]
    return spread(df).select(*others, F.explode(subdivided(geom, max_vertices)).alias(geom))


def thin_layer(df: DataFrame, zoom: int | None = None, geom: str = "geom") -> DataFrame:
    """Thin every region by itself, with the web tolerance or a zoom level's."""
    if zoom is None:
        tolerance = F.lit(WEB_TOLERANCE)
    else:
        tolerance = zoom_tolerance(F.lit(zoom)) / (METRES_PER_DEGREE * METRES_PER_DEGREE)
    return spread(df).withColumn(geom, simplify_vw(geom, tolerance))


def border_nodes(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Vertices ``x, y`` where borders part: those without exactly two different
    neighbours over all regions. Repeats are merged map-side first, so a vertex
    in very many regions stays small."""
    edge = df.select(F.explode(G.edges(geom)).alias("e"))
    links = edge.select(
        F.explode(
            F.array(
                F.struct(F.col("e.x1").alias("x"), F.col("e.y1").alias("y"), F.col("e.x2").alias("nx"), F.col("e.y2").alias("ny")),
                F.struct(F.col("e.x2").alias("x"), F.col("e.y2").alias("y"), F.col("e.x1").alias("nx"), F.col("e.y1").alias("ny")),
            )
        ).alias("l")
    ).select("l.*")
    real = links.filter((F.col("x") != F.col("nx")) | (F.col("y") != F.col("ny")))
    return real.distinct().groupBy("x", "y").count().filter(F.col("count") != 2).select("x", "y")


# in later rounds all vertices of a place in conflict are kept, not only the farthest
GENTLE_ROUNDS = 4


def simplify_coverage(df: DataFrame, id_col: str, tolerance: float, geom: str = "geom", keep_topology: bool = True) -> DataFrame:
    """Thin a layer without opening gaps: a border shared by two regions loses
    the same vertices in both, because the stretch between two nodes is thinned
    on its own and the result does not depend on its direction.

    With ``keep_topology`` no border crosses another afterwards and nothing changes
    sides: thinning may not pass over any vertex of the layer. Places where it would
    (a spatial join of vertices with what each dropped run sweeps over) get nodes, and
    the layer is thinned again, until there are none; only nodes travel between rounds.

    Nodes are gathered per region (never more than the region's own vertices) and joined
    back to the untouched rows.
    """
    corner = df.select(F.col(id_col).alias("_id"), F.explode(G.vertices(geom)).alias("v")).select("_id", F.col("v.x").alias("x"), F.col("v.y").alias("y"))
    none = F.array().cast(G.RING_TYPE)

    def with_nodes(nodes: DataFrame) -> DataFrame:
        gathered = corner.join(nodes, ["x", "y"]).groupBy("_id").agg(F.collect_set(F.struct("x", "y")).alias("_nodes"))
        joined = df.join(gathered, df[id_col] == gathered["_id"], "left").drop("_id")
        return joined.withColumn("_nodes", F.coalesce("_nodes", none))

    nodes, turn = border_nodes(df, geom), 0
    while keep_topology:
        nodes = stored(nodes, "nodes")
        swept = with_nodes(nodes).select(F.explode(swept_areas(geom, "_nodes", tolerance)).alias("_swept"))
        over = swept.select(F.slice("_swept", 1, 1).alias("geom"), F.col("_swept")[0][0].alias("_own"), F.col("_swept")[1][0].alias("_far"))
        met = tag_points(corner.select("x", "y").distinct(), over.filter(G.area("geom") > 0))
        met = met.filter(~F.array_contains("_own", F.struct("x", "y")))
        pins = met.select(F.explode("_far" if turn < GENTLE_ROUNDS else "_own").alias("v")).select("v.x", "v.y").distinct()
        pins = stored(pins.join(nodes, ["x", "y"], "left_anti"), "pins")
        if pins.isEmpty():
            break
        nodes, turn = nodes.unionByName(pins), turn + 1
    return with_nodes(nodes).withColumn(geom, simplify_arcs(geom, "_nodes", tolerance)).drop("_nodes")

"""Regions united and lines turned to regions.

Only edges travel. A union first adds up what edges of one group run along each other,
inside tasks; borders inside a group cancel there, and what is left, the group's own
outline and edges that cross, is traced per group. Turning lines to regions never gathers
the lines: the edge that follows along a face is found around each point by a window, the
faces are named by doubling steps along them, and a task gathers one face. Edges are
merged to lines in the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.functions import geometry as G
from arealis.functions.arrangement import enclosed, generated, make_valid, merge_lines
from arealis.functions.arrow_geometry import _pack_points
from arealis.operators.spatial_join import tag_points
from arealis.session import stored

ENDS = ("x1", "y1", "x2", "y2")


# --- union --------------------------------------------------------------------------------


def _canonical(edges: DataFrame, *others: Column | str) -> DataFrame:
    """Edges turned from their smaller to their larger end, ``n`` counting them forwards;
    edges without length go."""
    x1, y1, x2, y2 = (F.col(c) for c in ENDS)
    turned = (x1 > x2) | ((x1 == x2) & (y1 > y2))
    ends = [F.when(turned, b).otherwise(a).alias(name) for a, b, name in ((x1, x2, "x1"), (y1, y2, "y1"), (x2, x1, "x2"), (y2, y1, "y2"))]
    return edges.filter((x1 != x2) | (y1 != y2)).select(*others, *ends, F.when(turned, -F.col("n")).otherwise(F.col("n")).alias("n"))


def _outlines(edges: DataFrame, keys: Sequence[str], geom: str) -> DataFrame:
    """One geometry per key from directed edges x1, y1, x2, y2, n."""
    net = _canonical(edges, *keys).groupBy(*keys, *ENDS).agg(F.sum("n").alias("n")).filter("n <> 0")
    return net.groupBy(*keys).agg(enclosed(F.collect_list(F.struct(*ENDS, "n"))).alias(geom))


def dissolve(df: DataFrame, group: str | Sequence[str], geom: str = "geom", tile: float | None = None) -> DataFrame:
    """The union of each group's polygons, one row per group.

    With ``tile`` the polygons of a group whose boxes begin in the same square of that
    size are united first, so that a large group with overlaps is traced in pieces.
    Groups without any area have an empty geometry.
    """
    keys = [group] if isinstance(group, str) else list(group)
    if tile is not None:
        corner = F.struct(F.floor(G.xmin(geom) / tile), F.floor(G.ymin(geom) / tile))
        df = dissolve(df.withColumn("_tile", corner), [*keys, "_tile"], geom)
    oriented = df.select(*keys, G.orient_ccw(geom).alias("_geom"))
    valid = generated(generated(oriented, "_geom", F.col("_geom")), "_geom", make_valid("_geom"))
    edges = valid.select(*keys, F.explode(G.edges("_geom")).alias("e")).select(*keys, "e.*", F.lit(1).alias("n"))
    found = _outlines(edges, keys, geom)
    groups = df.select(*keys).distinct()
    same = [groups[k].eqNullSafe(found[k]) for k in keys]
    return groups.join(found, same, "left").select(*[groups[k] for k in keys], F.coalesce(found[geom], F.array().cast(G.GEOM_TYPE)).alias(geom))


def merged_lines(edges: DataFrame, group: str | Sequence[str], line: str = "line") -> DataFrame:
    """Edges x1, y1, x2, y2 joined to lines between ends and forks, a row per line.

    No group is gathered: where just two edges meet, one goes on into the other, lines
    are named by doubling steps along them, and a task gathers one line."""
    keys = [group] if isinstance(group, str) else list(group)
    once = _canonical(edges.withColumn("n", F.lit(1)), *keys).drop("n").distinct()
    once = stored(once.select(F.monotonically_increasing_id().alias("_edge"), *keys, *ENDS), "edges")
    # going along an edge it arrives at its larger end, coming back at its smaller one
    there, back = ((F.col("_edge") * 2 + k, F.col(f"x{end}"), F.col(f"y{end}")) for k, end in ((0, 2), (1, 1)))
    arrivals = F.explode(F.array(*[F.struct(h.alias("id"), x.alias("x"), y.alias("y")) for h, x, y in (there, back)])).alias("_at")
    place = Window.partitionBy(*[F.col(f"`{k}`") for k in keys], "_at.x", "_at.y")
    mine, low, high = F.col("_at.id"), F.min("_at.id").over(place), F.max("_at.id").over(place)
    onward = F.when(mine == low, high).otherwise(low).bitwiseXOR(F.lit(1))
    following = F.when(F.count(F.lit(1)).over(place) == 2, onward).otherwise(mine)
    half = stored(once.select(*keys, arrivals).select(mine.alias("id"), following.alias("following")), "half-edges")
    # the least name ahead, in either direction, is the least of the line
    ends = F.col("following") == F.col("id")
    named = _named_faces(half).groupBy(F.shiftright("id", 1).alias("_edge")).agg(
        F.min(F.shiftright("loop", 1)).alias("_line"), *[F.max(F.when(F.col("id") % 2 == k, ends)).alias(name) for k, name in ((1, "stop1"), (0, "stop2"))]
    )
    steps = F.collect_list(F.struct(*ENDS, "stop1", "stop2"))
    return once.join(named, "_edge").groupBy(*keys, "_line").agg(merge_lines(steps).alias("_lines")).select(*keys, F.explode("_lines").alias(line))


def layer_edges(df: DataFrame, geom: str = "geom") -> DataFrame:
    """The borders of a layer, each once, as x1, y1, x2, y2."""
    edges = df.select(F.explode(G.edges(geom)).alias("e")).select("e.*", F.lit(1).alias("n"))
    return _canonical(edges).drop("n").distinct()


# --- polygonize -----------------------------------------------------------------------------


@F.arrow_udf(G.RING)
def _ring(steps: pa.Array) -> pa.Array:
    """Lists of (id, following, x, y) in the order that they follow one another."""
    flat, rings, at = steps.flatten(), [], 0
    ids, following = (flat.field(i).to_numpy() for i in range(2))
    xy = np.column_stack([flat.field(i).to_numpy() for i in (2, 3)])
    for n in steps.value_lengths().to_pylist():
        mine = slice(at, at + n)
        place = {h: k for k, h in enumerate(ids[mine].tolist())}
        onward, order, here = following[mine].tolist(), [], 0
        for _ in range(n):
            order.append(here)
            here = place[onward[here]]
        ring = xy[mine][order]
        rings.append(np.vstack([ring, ring[:1]]))
        at += n
    return _pack_points(rings)


def _half_edges(edges: DataFrame) -> DataFrame:
    """Both directions of each edge: id (the other direction's differs in the last bit),
    following (the next along the face to the left), x, y (where it begins), dx, dy."""
    numbered = stored(edges.select(F.monotonically_increasing_id().alias("id"), *ENDS), "edges")
    x1, y1, x2, y2 = (F.col(c) for c in ENDS)
    there = numbered.select((F.col("id") * 2).alias("id"), x1.alias("x"), y1.alias("y"), (x2 - x1).alias("dx"), (y2 - y1).alias("dy"))
    back = numbered.select((F.col("id") * 2 + 1).alias("id"), x2.alias("x"), y2.alias("y"), (x1 - x2).alias("dx"), (y1 - y2).alias("dy"))
    both = there.unionByName(back).withColumn("angle", F.atan2("dy", "dx"))
    # arriving against ``id``, the face to the left goes on with the one clockwise of it
    last = both.groupBy("x", "y").agg(F.max_by("id", "angle").alias("last"))
    before = F.lag("id").over(Window.partitionBy("x", "y").orderBy("angle"))
    turned = both.select("id", "x", "y", before.alias("before")).join(last, ["x", "y"])
    onward = turned.select(F.col("id").bitwiseXOR(F.lit(1)).alias("id"), F.coalesce("before", "last").alias("following"))
    return both.join(onward, "id").select("id", "following", "x", "y", "dx", "dy")


def _named_faces(half: DataFrame) -> DataFrame:
    """``half`` with ``loop``, the least id along its face. Each step looks twice as far."""
    now = stored(half.select("id", F.col("following").alias("onward"), F.col("id").alias("loop")), "faces")
    while True:
        ahead = now.select(F.col("id").alias("onward"), F.col("onward").alias("further"), F.col("loop").alias("theirs"))
        after = now.join(ahead, "onward").select("id", F.col("further").alias("onward"), F.least("loop", "theirs").alias("loop"), (F.col("theirs") < F.col("loop")).alias("changed"))
        after = stored(after, "faces")
        if after.filter("changed").isEmpty():
            return half.join(after.select("id", "loop"), "id")
        now = after.drop("changed")


def polygonize(edges: DataFrame) -> DataFrame:
    """The bounded faces of edges x1, y1, x2, y2 that meet at their ends only: a row with
    ``face`` and ``geom`` each. Edges that don't part two faces are left out; what lies
    inside a face without touching its outline is its hole."""
    once = _canonical(edges.select(*ENDS).withColumn("n", F.lit(1))).drop("n").distinct()
    while True:
        faces = stored(_named_faces(_half_edges(once)), "loops")
        other = faces.select(F.col("id").bitwiseXOR(F.lit(1)).alias("id"), F.col("loop").alias("beyond"))
        parted = faces.join(other, "id").filter("loop <> beyond and id % 2 = 0")
        if faces.count() == 2 * parted.count():
            break
        ends = faces.select(F.col("id"), "x", "y")
        keep = parted.select("id")
        head = ends.join(keep, "id").select("id", F.col("x").alias("x1"), F.col("y").alias("y1"))
        tail = ends.join(keep.select((F.col("id") + 1).alias("id")), "id").select((F.col("id") - 1).alias("id"), F.col("x").alias("x2"), F.col("y").alias("y2"))
        once = head.join(tail, "id").select(*ENDS)

    area = F.sum(F.col("x") * F.col("dy") - F.col("y") * F.col("dx"))
    loops = faces.groupBy("loop").agg(area.alias("area"), F.min(F.struct("x", "y")).alias("corner"))
    steps = F.collect_list(F.struct("id", "following", "x", "y"))

    def rings(of: DataFrame, name: str) -> DataFrame:
        return faces.join(of.select("loop"), "loop", "left_semi").groupBy("loop").agg(_ring(steps).alias(name))

    shells = stored(rings(loops.filter("area > 0"), "ring"), "shells")
    outer = loops.filter("area < 0").select(F.col("loop").alias("hole"), "corner.x", "corner.y")
    within = tag_points(outer, shells.select(F.col("loop").alias("face"), F.array(F.array("ring")).alias("geom"), F.array(F.array("ring")).alias("shape")))
    # its own faces touch the corner; of the others that hold it the smallest is the one
    inside = within.filter(G.contains("shape", G.make_point("x", "y"))).select("hole", "face", G.area("shape").alias("size"))
    holder = stored(inside.groupBy("hole").agg(F.min_by("face", F.struct("size", "face")).alias("face")), "holders")
    holes = rings(holder.withColumnRenamed("hole", "loop"), "ring").join(holder, F.col("loop") == F.col("hole"))
    gathered = holes.groupBy("face").agg(F.array_sort(F.collect_list("ring")).alias("holes"))
    out = shells.join(gathered, F.col("loop") == F.col("face"), "left")
    none = F.array().cast(f"array<{G.RING_TYPE}>")
    return out.select(F.col("loop").alias("face"), F.array(F.concat(F.array("ring"), F.coalesce("holes", none))).alias("geom"))

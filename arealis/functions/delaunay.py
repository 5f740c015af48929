"""Delaunay triangulation and the concave hull made from it."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from arealis.functions.arrow_geometry import Geometry, _map_geometries
from arealis.functions.geometry import GEOM


class Triangulation:
    """Triangles over distinct points. ``apex[a, b]`` is the third corner of the triangle
    to the left of the way from a to b; border edges have none the other way.

    Points come in order of x; each is joined to the part of the border that it sees, and
    edges whose circle holds the point beyond are flipped."""

    def __init__(self, points: np.ndarray):
        self.points = np.unique(points, axis=0)
        self.at = self.points.tolist()
        self.apex: dict[tuple[int, int], int] = {}
        n, first = len(self.at), 2
        while first < n and self._turn(0, 1, first) == 0:
            first += 1
        if first >= n:
            return
        # points of one line, then the first beside it
        line = list(range(first))
        if self._turn(0, 1, first) < 0:
            line.reverse()
        for a, b in zip(line, line[1:]):
            self._add(a, b, first)
        ring = [*line, first]
        self.after = dict(zip(ring, ring[1:] + ring[:1]))
        self.before = {b: a for a, b in self.after.items()}
        self._flip([e for e in self.apex])
        newest = first
        for p in range(first + 1, n):
            newest = self._join(p, newest)

    def _turn(self, a: int, b: int, c: int) -> float:
        (ax, ay), (bx, by), (cx, cy) = self.at[a], self.at[b], self.at[c]
        return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)

    def _in_circle(self, a: int, b: int, c: int, d: int) -> bool:
        dx, dy = self.at[d]
        (ax, ay), (bx, by), (cx, cy) = ((self.at[k][0] - dx, self.at[k][1] - dy) for k in (a, b, c))
        aa, bb, cc = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
        found = aa * (bx * cy - by * cx) - bb * (ax * cy - ay * cx) + cc * (ax * by - ay * bx)
        # places on the circle may come out either way and must not be flipped for ever
        return found > 1e-12 * (aa * (abs(bx * cy) + abs(by * cx)) + bb * (abs(ax * cy) + abs(ay * cx)) + cc * (abs(ax * by) + abs(ay * bx)))

    def _add(self, a: int, b: int, c: int) -> None:
        self.apex[a, b], self.apex[b, c], self.apex[c, a] = c, a, b

    def _join(self, p: int, start: int) -> int:
        """Triangles from p to all border edges with p on their outer side."""
        low = high = start
        fresh = []
        while self._turn(high, self.after[high], p) < 0:
            self._add(self.after[high], high, p)
            fresh.append((self.after[high], high))
            high = self.after[high]
        while self._turn(self.before[low], low, p) < 0:
            self._add(low, self.before[low], p)
            fresh.append((low, self.before[low]))
            low = self.before[low]
        self.after[low], self.after[p] = p, high
        self.before[high], self.before[p] = p, low
        self._flip(fresh)
        return p

    def _flip(self, waiting: list[tuple[int, int]]) -> None:
        apex = self.apex
        while waiting:
            a, b = waiting.pop()
            c, d = apex.get((a, b)), apex.get((b, a))
            if c is None or d is None or not self._in_circle(a, b, c, d) or self._turn(a, d, c) <= 0 or self._turn(d, b, c) <= 0:
                continue
            del apex[a, b], apex[b, a]
            self._add(a, d, c)
            self._add(d, b, c)
            waiting += [(a, d), (d, b), (b, c), (c, a)]

    def border(self) -> list[tuple[int, int]]:
        return [(a, b) for a, b in self.apex if (b, a) not in self.apex]

    def length(self, a: int, b: int) -> float:
        return float(np.hypot(*(self.points[a] - self.points[b])))


def hollowed(points: np.ndarray, ratio: float) -> np.ndarray | None:
    """Outline of the points: from the convex hull, border edges longer than the share
    ``ratio`` between the shortest and the longest edge of the triangulation go, longest
    first, while the outline stays one ring through all points that it has."""
    mesh = Triangulation(points)
    if not mesh.apex:
        return None
    lengths = [mesh.length(a, b) for a, b in mesh.apex]
    limit = min(lengths) + ratio * (max(lengths) - min(lengths))
    following = dict(mesh.border())
    heap = [(-mesh.length(a, b), a, b) for a, b in following.items()]
    heapq.heapify(heap)
    while heap:
        size, a, b = heapq.heappop(heap)
        if -size <= limit:
            break
        c = mesh.apex.get((a, b))
        if c is None or c in following or following.get(a) != b:
            continue
        following[a], following[c] = c, b
        for edge in ((a, c), (c, b)):
            heapq.heappush(heap, (-mesh.length(*edge), *edge))
    first = min(following)
    ring = [first]
    while following[ring[-1]] != first:
        ring.append(following[ring[-1]])
    return mesh.points[[*ring, first]]


def _outline(geom: Geometry, ratio: float) -> Geometry:
    corners = [r for part in geom for r in part if len(r)]
    ring = hollowed(np.concatenate(corners), ratio) if corners else None
    return [] if ring is None else [[ring]]


@F.arrow_udf(GEOM)
def _concave_hull(geom: pa.Array, ratio: pa.Array) -> pa.Array:
    return _map_geometries(_outline, geom, ratio)


def concave_hull(geom: Column | str, ratio: Column | float) -> Column:
    """Outline of all vertices, tighter the smaller the ratio: 1 is the convex hull, 0
    follows the shortest edges. Shapes without breadth have an empty one."""
    return _concave_hull(geom, ratio if isinstance(ratio, Column) else F.lit(float(ratio)))

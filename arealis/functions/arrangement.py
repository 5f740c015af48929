"""Planar arrangements: edges split where they meet, faces traced, rings rebuilt.

A set of directed edges parts the plane into faces. Edges are split until they meet at
end points only; around each point they are put in order of direction, which gives every
half-edge the one that follows it along its face. Winding numbers spread from the
unbounded face over the edges: crossing an edge changes them by how often it is passed
one way less the other. Repair, union and buffers keep faces by their winding number and
trace what parts kept from other faces; opposite edges may be cancelled beforehand, as
only their difference counts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions.arrow_geometry import Geometry, Ring, _lists, _map_geometries, _pack_points, near_pairs, pack, ring_edges, rings_are_simple, side_of, signed_area
from arealis.functions.geometry import GEOM, MERCATOR_RADIUS, RING

# computed points are put on a grid of this part of the largest coordinate
GRID = 2.0**-46
# splitting moves edges a little; it is repeated until nothing crosses
PASSES = 12


# --- splitting --------------------------------------------------------------------------


def _within(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Points of the line through a and b that lie between them, ends left out."""
    box = ((p >= np.minimum(a, b)) & (p <= np.maximum(a, b))).all(axis=1)
    return box & (p != a).any(axis=1) & (p != b).any(axis=1)


def split_edges(e: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that meet at their end points only, each once, with the weights of those
    that ran along it: added if they ran its way, taken off if they ran against it."""
    scale = np.abs(e).max() * GRID if len(e) and np.abs(e).max() > 0 else 1.0
    grid = 2.0 ** np.ceil(np.log2(scale))
    e, weight = merged(e, weight)
    for _ in range(PASSES):
        owner, at = [], []
        for i, j in near_pairs(e):
            a, b, c, d = e[i, :2], e[i, 2:], e[j, :2], e[j, 2:]
            da, db, dc, dd = side_of(c, d, a), side_of(c, d, b), side_of(a, b, c), side_of(a, b, d)
            for point, zero, low, high, own in ((c, dc, a, b, i), (d, dd, a, b, i), (a, da, c, d, j), (b, db, c, d, j)):
                on = (zero == 0) & _within(point, low, high)
                owner.append(own[on])
                at.append(point[on])
            cross = (np.sign(da) * np.sign(db) < 0) & (np.sign(dc) * np.sign(dd) < 0)
            t = da[cross] / (da[cross] - db[cross])
            point = np.round((a[cross] + t[:, None] * (b[cross] - a[cross])) / grid) * grid
            for low, high, own in ((a, b, i), (c, d, j)):
                apart = (point != low[cross]).any(axis=1) & (point != high[cross]).any(axis=1)
                owner.append(own[cross][apart])
                at.append(point[apart])
        owner, at = np.concatenate([np.empty(0, np.int64), *owner]), np.concatenate([np.empty((0, 2)), *at])
        if not len(owner):
            return e, weight
        along = ((at - e[owner, :2]) * (e[owner, 2:] - e[owner, :2])).sum(axis=1)
        order = np.lexsort((along, owner))
        owner, at = owner[order], at[order]
        whole = np.ones(len(e), bool)
        whole[owner] = False
        cut = np.flatnonzero(~whole)
        # starts, cuts and ends of each cut edge in line
        who = np.concatenate([cut, owner, cut])
        point = np.concatenate([e[cut, :2], at, e[cut, 2:]])
        place = np.concatenate([np.zeros(len(cut)), np.ones(len(owner)), np.full(len(cut), 2)])
        order = np.lexsort((np.arange(len(who)), place, who))
        who, point = who[order], point[order]
        same = who[1:] == who[:-1]
        pieces = np.hstack([point[:-1], point[1:]])[same]
        e, weight = merged(np.concatenate([e[whole], pieces]), np.concatenate([weight[whole], weight[who[1:][same]]]))
    raise ValueError("edges still cross after repeated splitting")


def merged(e: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each edge once, turned from its smaller to its larger end; the weights of edges
    that run along each other are added with their signs."""
    turned = (e[:, 0] > e[:, 2]) | ((e[:, 0] == e[:, 2]) & (e[:, 1] > e[:, 3]))
    e = np.where(turned[:, None], e[:, [2, 3, 0, 1]], e) + 0.0
    weight = np.where(turned[:, None], -weight, weight)
    long = (e[:, :2] != e[:, 2:]).any(axis=1)
    once, at = np.unique(e[long], axis=0, return_inverse=True)
    total = np.zeros((len(once), weight.shape[1]), np.int64)
    np.add.at(total, at.reshape(-1), weight[long])
    return once, total


# --- faces ------------------------------------------------------------------------------


class Faces:
    """Half-edges 2i and 2i + 1 run along edge i, the first from its smaller end; each
    has the face to its left."""

    def __init__(self, e: np.ndarray, weight: np.ndarray):
        n = len(e)
        self.points, at = np.unique(np.concatenate([e[:, :2], e[:, 2:]]), axis=0, return_inverse=True)
        at = at.reshape(-1)
        self.origin = np.stack([at[:n], at[n:]], axis=1).reshape(-1)
        self.change = np.stack([weight, -weight], axis=1).reshape(2 * n, -1)
        twin = np.arange(2 * n) ^ 1
        way = self.points[self.origin[twin]] - self.points[self.origin]
        order = np.lexsort((np.arctan2(way[:, 1], way[:, 0]), self.origin))
        # the half-edge before each one, going round its point
        starts = np.flatnonzero(np.diff(self.origin[order], prepend=-1))
        before = np.roll(order, 1)
        before[starts] = order[np.append(starts[1:], 2 * n) - 1] if n else before[starts]
        clockwise = np.empty(2 * n, np.int64)
        clockwise[order] = before
        self.following = clockwise[twin]
        self.loops = self._loops()
        self._levels()

    def _loops(self) -> list[np.ndarray]:
        """Cycles of half-edges along faces; ``self.loop`` is each half-edge's."""
        following, loop, found = self.following.tolist(), [-1] * len(self.following), []
        for first in range(len(following)):
            if loop[first] < 0:
                cycle, at = [], first
                while loop[at] < 0:
                    loop[at] = len(found)
                    cycle.append(at)
                    at = following[at]
                found.append(np.array(cycle))
        self.loop = np.array(loop, np.int64)
        return found

    def _levels(self) -> None:
        """Faces from loops, and their winding numbers. A connected piece has one loop
        around it; it belongs to the face that the piece lies in."""
        twin, n = np.arange(len(self.loop)) ^ 1, len(self.loops)
        beside = [[] for _ in range(n)]
        for h, (mine, other) in enumerate(zip(self.loop.tolist(), self.loop[twin].tolist())):
            beside[mine].append((other, h))
        width = self.change.shape[1]
        piece, pieces = np.full(n, -1), []
        level = np.zeros((n, width), np.int64)
        for first in range(n):
            if piece[first] >= 0:
                continue
            piece[first], reached = len(pieces), [first]
            for at in reached:
                for other, h in beside[at]:
                    if piece[other] < 0:
                        piece[other] = len(pieces)
                        level[other] = level[at] - self.change[h]
                        reached.append(other)
            pieces.append(reached)
        area = np.array([self._area(cycle) for cycle in self.loops])
        around = [min(loops, key=lambda loop: area[loop]) for loops in pieces]
        parent = self._containing(piece, pieces, around)
        # pieces from the outside in
        self.face, base = np.arange(n), np.zeros((len(pieces), width), np.int64)
        ready, waiting = set(), list(range(len(pieces)))
        while waiting:
            later = []
            for p in waiting:
                holder = parent[p]
                if holder >= 0 and int(piece[holder]) not in ready:
                    later.append(p)
                    continue
                outside = np.zeros(width, np.int64) if holder < 0 else level[holder]
                level[pieces[p]] += outside - level[around[p]]
                self.face[around[p]] = -1 if holder < 0 else self.face[holder]
                ready.add(p)
            waiting = later
        self.level, self.around = level, set(around)
        # every half-edge's face, -1 for the unbounded one
        self.left = self.face[self.loop] if n else np.empty(0, np.int64)

    def _area(self, cycle: np.ndarray) -> float:
        ring = self.points[self.origin[cycle]]
        return signed_area(np.vstack([ring, ring[:1]]))

    def _containing(self, piece, pieces, around) -> list[int]:
        """Per piece the loop of the face that it lies in, -1 if that is unbounded: what
        bounds it next to the left of one of its points."""
        if len(pieces) < 2:
            return [-1] * len(pieces)
        tail, head = self.points[self.origin[0::2]], self.points[self.origin[1::2]]
        of_edge = piece[self.loop[0::2]]
        found = []
        for p, loop in enumerate(around):
            corners = self.points[self.origin[self.loops[loop]]]
            x, y = corners[np.lexsort((corners[:, 1], corners[:, 0]))[0]]
            spans = np.flatnonzero((of_edge != p) & ((tail[:, 1] <= y) != (head[:, 1] <= y)))
            down = (head[spans, 1] < tail[spans, 1])[:, None]
            low, high = np.where(down, head[spans], tail[spans]), np.where(down, tail[spans], head[spans])
            slope = (high[:, 0] - low[:, 0]) / (high[:, 1] - low[:, 1])
            cut = low[:, 0] + (y - low[:, 1]) * slope
            left = np.flatnonzero(cut < x)
            if not len(left):
                found.append(-1)
                continue
            # edges up from one vertex are as far at y, and part above it
            at = left[np.lexsort((slope[left], cut[left]))[-1]]
            # the half-edge that goes down has the point to its left
            found.append(int(self.loop[2 * spans[at] + (0 if down[at, 0] else 1)]))
        return found

    def polygons(self, label: np.ndarray) -> dict[int, Geometry]:
        """Polygons of equally labelled faces, one list of parts per label. ``label`` is
        per loop (as ``level``), with -1 for what is left out."""
        own = np.where(self.left < 0, -1, label[np.maximum(self.left, 0)])
        other = own[np.arange(len(own)) ^ 1]
        border, following = (own >= 0) & (own != other), self.following.tolist()
        marked, used, rings = border.tolist(), [False] * len(own), {}
        region = self._regions(own)
        for first in np.flatnonzero(border).tolist():
            if used[first]:
                continue
            cycle, at = [], first
            while not used[at]:
                used[at] = True
                cycle.append(at)
                at = following[at]
                while not marked[at]:
                    at = following[at ^ 1]
            for ring in _untouching(self.origin[cycle].tolist()):
                rings.setdefault((int(own[first]), region[int(self.left[first])]), []).append(self.points[ring])
        found: dict[int, Geometry] = {}
        for (kind, _), members in sorted(rings.items(), key=lambda item: item[0]):
            members.sort(key=signed_area, reverse=True)
            shells = [r for r in members if signed_area(r) > 0]
            found.setdefault(kind, []).append(shells[:1] + [r for r in members if signed_area(r) < 0])
            found[kind] += [[s] for s in shells[1:]]
        return found

    def _regions(self, own: np.ndarray) -> dict[int, int]:
        """Faces joined over edges between equal labels."""
        root = {int(f): int(f) for f in np.unique(self.left) if f >= 0}

        def find(f: int) -> int:
            while root[f] != f:
                root[f] = root[root[f]]
                f = root[f]
            return f

        inner = np.flatnonzero((own[0::2] >= 0) & (own[0::2] == own[1::2]))
        for a, b in zip(self.left[2 * inner].tolist(), self.left[2 * inner + 1].tolist()):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return {f: find(f) for f in root}


def _untouching(cycle: list[int]) -> list[list[int]]:
    """A closed walk cut where it comes back to a point, into loops without repeats."""
    found, line, place = [], [], {}
    for at in cycle:
        if at in place:
            found.append([*line[place[at] :], at])
            for gone in line[place[at] + 1 :]:
                del place[gone]
            line = line[: place[at] + 1]
        else:
            place[at] = len(line)
            line.append(at)
    found.append([*line, line[0]])
    return [loop for loop in found if len(loop) > 3]


def wound(e: np.ndarray, weight: np.ndarray, keep: Callable[[np.ndarray], np.ndarray]) -> Geometry:
    """The faces whose winding numbers ``keep`` accepts, as polygons. ``weight`` has a
    column per kind of edge, and so have the winding numbers."""
    if not len(e):
        return []
    e, weight = split_edges(e, weight)
    if not len(e):
        return []
    faces = Faces(e, weight)
    return faces.polygons(np.where(keep(faces.level), 0, -1)).get(0, [])


def _forward(ring: Ring, index: int) -> Ring:
    """Shells anticlockwise, holes clockwise."""
    return ring[::-1] if (signed_area(ring) < 0) != (index > 0) else ring


# --- functions of geometry columns --------------------------------------------------------


def rings_are_nested(geom: Geometry) -> bool:
    """For rings that don't cross: whether each hole lies in its own shell, and shells
    and holes take turns from the outside in."""
    rings = [(r, i, p) for p, part in enumerate(geom) for i, r in enumerate(part) if len(r) > 3]
    if len(rings) < 2:
        return True
    low, high = np.array([r.min(axis=0) for r, _, _ in rings]), np.array([r.max(axis=0) for r, _, _ in rings])
    for k, (ring, i, p) in enumerate(rings):
        x, y = (ring[0] + ring[1]) / 2
        around = np.flatnonzero(((low <= (x, y)) & (high >= (x, y))).all(axis=1))
        holders = []
        for j in around[around != k].tolist():
            (x1, y1), (x2, y2) = rings[j][0][:-1].T, rings[j][0][1:].T
            spans = (y1 <= y) != (y2 <= y)
            cut = x1[spans] + (y - y1[spans]) / (y2[spans] - y1[spans]) * (x2[spans] - x1[spans])
            if (cut > x).sum() % 2:
                holders.append(j)
        if len(holders) % 2 != (i > 0) or (i > 0 and not any(rings[j][1:] == (0, p) for j in holders)):
            return False
    return True


def repaired(geom: Geometry) -> Geometry:
    """Valid polygons that cover what the rings mean: a part is where its shell winds at
    all and no hole does; parts are united."""
    if not geom or (rings_are_simple(geom) and rings_are_nested(geom)):
        return geom
    parts = []
    for part in geom:
        if rings_are_simple([part]) and rings_are_nested([part]):
            parts.append([_forward(r, i) for i, r in enumerate(part)])
            continue
        pieces = [(np.hstack([r[:-1], r[1:]]), i > 0) for i, r in enumerate(part) if len(r) > 1]
        e = np.concatenate([p for p, _ in pieces])
        weight = np.concatenate([np.tile([[0, 1]] if hole else [[1, 0]], (len(p), 1)) for p, hole in pieces])
        parts += wound(e, weight, lambda level: (level[:, 0] != 0) & (level[:, 1] == 0))
    sound = len(parts) < 2 or (rings_are_simple(parts) and rings_are_nested(parts))
    return parts if sound else united(ring_edges(parts))


def united(e: np.ndarray) -> Geometry:
    """Union of what anticlockwise edges ``x1, y1, x2, y2`` enclose."""
    return wound(e, np.ones((len(e), 1), np.int64), lambda level: level[:, 0] > 0)


@F.arrow_udf(GEOM)
def _repair(geom: pa.Array) -> pa.Array:
    return _map_geometries(repaired, geom)


def make_valid(geom: Column | str) -> Column:
    """Self-crossing and overlapping rings rebuilt; valid geometries stay as they are."""
    return _repair(geom)


def generated(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column replaced by a generated one: no filter on what follows can
    repeat its work, nor can it be merged into another expression."""
    made = F.explode(F.array(value)).alias(name)
    return df.select(*[made if c == name else F.col(f"`{c}`") for c in df.columns])


def _edge_groups(edges: pa.Array) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """Lists of structs x1, y1, x2, y2 (and n) as one array each."""
    flat = edges.flatten()
    names = [f.name for f in flat.type]
    xy = np.column_stack([flat.field(names.index(n)).to_numpy(zero_copy_only=False) for n in ("x1", "y1", "x2", "y2")])
    n = flat.field(names.index("n")).to_numpy(zero_copy_only=False).astype(np.int64) if "n" in names else np.ones(len(xy), np.int64)
    lengths = edges.value_lengths().to_pylist()
    ends = np.cumsum([0] + [k or 0 for k in lengths])
    return [None if k is None else (xy[ends[i] : ends[i + 1]], n[ends[i] : ends[i + 1]]) for i, k in enumerate(lengths)]


@F.arrow_udf(GEOM)
def _enclosed(edges: pa.Array) -> pa.Array:
    return pack([None if g is None else wound(g[0], g[1][:, None], lambda level: level[:, 0] > 0) for g in _edge_groups(edges)])


def enclosed(edges: Column | str) -> Column:
    """Polygons around what edges (x1, y1, x2, y2, n) enclose, n being how often each is
    passed with the inside to its left."""
    return _enclosed(edges)


def chained(e: np.ndarray, stops: set[tuple] = frozenset()) -> list[np.ndarray]:
    """Undirected edges joined to lines: from one end or fork to the next, then loops.
    ``stops`` are ends and forks that not all edges are given of."""
    e, _ = merged(e, np.zeros((len(e), 1), np.int64))
    links: dict[tuple, list[int]] = {}
    for i, (x1, y1, x2, y2) in enumerate(e.tolist()):
        links.setdefault((x1, y1), []).append(i)
        links.setdefault((x2, y2), []).append(i)
    used, lines = [False] * len(e), []

    def stop(at: tuple) -> bool:
        return len(links[at]) != 2 or at in stops

    def walk(at: tuple, i: int) -> None:
        line = [at]
        while True:
            used[i] = True
            x1, y1, x2, y2 = e[i].tolist()
            at = (x2, y2) if at == (x1, y1) else (x1, y1)
            line.append(at)
            onward = [j for j in links[at] if not used[j]]
            if stop(at) or not onward:
                break
            i = onward[0]
        lines.append(np.array(line))

    for ends_only in (True, False):
        for at in sorted(links):
            if ends_only and not stop(at):
                continue
            for i in links[at]:
                if not used[i]:
                    walk(at, i)
    return lines


def _stops(edges: pa.Array) -> list[set[tuple]]:
    """The ends marked by stop1 and stop2, if lists of structs have these."""
    flat = edges.flatten()
    if flat.type.get_field_index("stop1") < 0:
        return [set()] * len(edges)
    marked = [{name: flat.field(flat.type.get_field_index(name)).to_pylist() for name in (f"x{k}", f"y{k}", f"stop{k}")} for k in (1, 2)]
    at, found = 0, []
    for n in edges.value_lengths().to_pylist():
        found.append({(x, y) for columns in marked for x, y, stop in zip(*(c[at : at + (n or 0)] for c in columns.values())) if stop})
        at += n or 0
    return found


@F.arrow_udf(T.ArrayType(RING))
def _merge_lines(edges: pa.Array) -> pa.Array:
    groups = [None if g is None else chained(g[0], s) for g, s in zip(_edge_groups(edges), _stops(edges), strict=True)]
    return _lists(groups, _pack_points([line for g in groups if g is not None for line in g]))


def merge_lines(edges: Column | str) -> Column:
    """Edges (x1, y1, x2, y2) joined to as few lines as there are between forks; also cut
    at the ends with stop1 or stop2, if they have these."""
    return _merge_lines(edges)


# --- buffers ----------------------------------------------------------------------------

# Fixed value: segments of a round join's quarter.
QUARTER = 8


def _round_joins(ring: Ring, distance: float, across: np.ndarray) -> np.ndarray:
    """Closed curve at a distance to the right of a ring's edges, with arcs about its
    corners. It winds about each place beside an edge or a corner once more than the
    ring itself does. ``across`` is, per vertex, how many units of x are as long as one
    of y there."""
    apart = (ring[:-1] != np.roll(ring[:-1], -1, axis=0)).any(axis=1)
    v, across = ring[:-1][apart], across[:-1][apart]

    def around(at: int, angles: np.ndarray) -> np.ndarray:
        return v[at] + distance * np.column_stack([across[at] * np.cos(angles), np.sin(angles)])

    if len(v) < 2:
        v, across = ring[:1], np.ones(1) if not len(across) else across
        disk = around(0, np.linspace(0, 2 * np.pi, 4 * QUARTER, endpoint=False))
        return np.vstack([disk, disk[:1]])
    way = np.roll(v, -1, axis=0) - v
    way[:, 0] /= (across + np.roll(across, -1)) / 2
    out = np.arctan2(-way[:, 0], way[:, 1])  # direction to the right of each edge
    turn = np.remainder(out - np.roll(out, 1) + np.pi, 2 * np.pi) - np.pi
    turn = np.where(turn == -np.pi, np.pi, turn)
    points = []
    for at, (last, angle, by) in enumerate(zip(np.roll(out, 1), out, turn)):
        if by > 0:  # an outward corner: an arc from the edge before to the one after
            steps = max(1, int(np.ceil(by / (np.pi / 2) * QUARTER - 1e-9)))
            points.append(around(at, last + by * np.arange(steps + 1) / steps))
        else:  # an inward one: over the corner itself
            ends = around(at, np.array([last, angle]))
            points.append(np.vstack([ends[:1], v[at : at + 1], ends[1:]]))
    curve = np.vstack(points)
    return np.vstack([curve, curve[:1]])


def grown(geom: Geometry, distance: float, on_sphere: bool) -> Geometry:
    """The shape grown by a distance: curves beside its rings, faces wound at least once.
    On the sphere x and y are degrees and the distance is in metres."""
    away = np.degrees(distance / MERCATOR_RADIUS) if on_sphere else distance
    if away <= 0:
        return geom
    curves = []
    for part in geom:
        for i, ring in enumerate(part):
            if len(ring) > 1:
                ring = _forward(ring, i)
                curves.append(_round_joins(ring, away, 1 / np.cos(np.radians(ring[:, 1])) if on_sphere else np.ones(len(ring))))
    return united(np.concatenate([np.hstack([c[:-1], c[1:]]) for c in curves])) if curves else []


@F.arrow_udf(GEOM)
def _buffer(geom: pa.Array, distance: pa.Array, on_sphere: pa.Array) -> pa.Array:
    return _map_geometries(grown, geom, distance, on_sphere)


def buffered(geom: Column | str, distance: Column | float) -> Column:
    """All places up to ``distance`` from a valid shape, with round joins of eight
    segments per quarter; holes that fill up go. Not above 0 it changes nothing."""
    return _buffer(geom, distance if isinstance(distance, Column) else F.lit(float(distance)), F.lit(False))


def buffered_metres(geom: Column | str, metres: Column | float) -> Column:
    """As ``buffered``, for longitude and latitude: every corner is grown by its own
    latitude's degrees, edges run straight between the grown corners."""
    return _buffer(geom, metres if isinstance(metres, Column) else F.lit(float(metres)), F.lit(True))

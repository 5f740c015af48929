"""Geometry functions that need loops: vectorised Arrow UDFs over numpy rings.

Each UDF unpacks a batch once into views of the Arrow buffers (no per-vertex
Python objects) and works ring by ring.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions.geometry import GEOM, MERCATOR_RADIUS, RING

Ring = np.ndarray
Geometry = list[list[Ring]]

STRIPS = T.ArrayType(T.StructType([T.StructField("i", T.IntegerType()), T.StructField("geom", GEOM)]))


# --- Arrow buffers <-> rings ------------------------------------------------------------


def unpack(column: pa.Array) -> list[Geometry | None]:
    parts, rings = column.values, column.values.values
    points = rings.values
    xy = np.column_stack([points.field("x").to_numpy(), points.field("y").to_numpy()])
    part_at, ring_at = parts.offsets.to_numpy(), rings.offsets.to_numpy()
    row_at, valid = column.offsets.to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
    return [
        [
            [xy[ring_at[r] : ring_at[r + 1]] for r in range(part_at[p], part_at[p + 1])]
            for p in range(row_at[i], row_at[i + 1])
        ]
        if valid[i]
        else None
        for i in range(len(column))
    ]


def _lists(groups: list, values: pa.Array) -> pa.Array:
    """A list array over ``values``; None becomes a NULL list."""
    ends = np.cumsum([0] + [0 if g is None else len(g) for g in groups])
    offsets = [None if g is None else int(e) for g, e in zip(groups, ends)] + [int(ends[-1])]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _pack_points(rings: list[Ring]) -> pa.Array:
    xy = np.concatenate([np.empty((0, 2)), *[r for r in rings if r is not None]])
    points = pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(xy[:, 0])), pa.array(np.ascontiguousarray(xy[:, 1]))], ["x", "y"]
    )
    return _lists(rings, points)


def pack(geoms: list[Geometry | None]) -> pa.Array:
    parts = [p for g in geoms if g is not None for p in g]
    return _lists(geoms, _lists(parts, _pack_points([r for p in parts for r in p])))


def _map_geometries(fn: Callable[..., Geometry | None], column: pa.Array, *args: pa.Array) -> pa.Array:
    values = [a.to_pylist() for a in args]
    return pack([None if g is None else fn(g, *row) for g, *row in zip(unpack(column), *values)])


# --- rings ----------------------------------------------------------------------------


def signed_area(ring: Ring) -> float:
    if len(ring) == 0:
        return 0.0
    p = ring - ring[0]
    return float(np.sum(p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]) / 2.0)


def ring_edges(geom: Geometry) -> np.ndarray:
    """Edges ``x1, y1, x2, y2`` of all rings."""
    pieces = [np.hstack([r[:-1], r[1:]]) for part in geom for r in part if len(r) > 1]
    return np.concatenate(pieces) if pieces else np.empty((0, 4))


def clip_half(ring: Ring, axis: int, bound: float, keep_low: bool) -> Ring | None:
    """The ring on one side of an axis-parallel line; None when nothing is left."""
    v = ring[:-1]
    depth = (bound - v[:, axis]) if keep_low else (v[:, axis] - bound)
    inside = depth >= 0
    if inside.all():
        return ring
    if not inside.any():
        return None
    following, next_depth = np.roll(v, -1, axis=0), np.roll(depth, -1)
    crosses = inside != np.roll(inside, -1)
    with np.errstate(divide="ignore", invalid="ignore"):
        t = depth / (depth - next_depth)
        cut = v + t[:, None] * (following - v)
    cut[:, axis] = bound
    both = np.stack([v, cut], axis=1).reshape(-1, 2)
    kept = both[np.stack([inside, crosses], axis=1).reshape(-1)]
    if len(kept) < 3:
        return None
    return np.vstack([kept, kept[:1]])


def _clip_part(part: list[Ring], axis: int, bound: float, keep_low: bool) -> list[Ring]:
    clipped = [clip_half(r, axis, bound, keep_low) for r in part]
    if not clipped or clipped[0] is None or signed_area(clipped[0]) == 0.0:
        return []
    return [r for r in clipped if r is not None and signed_area(r) != 0.0]


# --- subdivision ----------------------------------------------------------------------------


def _halve(part: list[Ring], limit: int) -> list[Geometry]:
    pending, done = [part], []
    while pending:
        piece = pending.pop()
        shell = piece[0]
        low, high = shell.min(axis=0), shell.max(axis=0)
        axis = int(np.argmax(high - low))
        middle = (low[axis] + high[axis]) / 2
        if sum(map(len, piece)) <= limit or not low[axis] < middle < high[axis]:
            done.append([piece])
            continue
        pending += [h for h in (_clip_part(piece, axis, middle, side) for side in (False, True)) if h]
    return done


@F.arrow_udf(T.ArrayType(GEOM))
def _subdivide(geom: pa.Array, limit: pa.Array) -> pa.Array:
    pieces = [
        None if g is None else [h for part in g if part for h in _halve(part, n)]
        for g, n in zip(unpack(geom), limit.to_pylist())
    ]
    return _lists(pieces, pack([p for row in pieces if row is not None for p in row]))


def subdivided(geom: Column | str, max_vertices: int = 256) -> Column:
    """Array of pieces with at most ``max_vertices`` each and the same total area."""
    if max_vertices < 8:
        raise ValueError("pieces need at least 8 vertices")
    return _subdivide(geom, F.lit(max_vertices))


# --- strips, for tiles ---------------------------------------------------------------------------


def _strips(geom: Geometry, axis: int, buffer: float, top: int) -> list[tuple[int, Geometry]]:
    """Unit-wide strips along an axis, each with a margin, by repeated halving."""
    shells = [part[0][:, axis] for part in geom if part]
    if not shells:
        return []
    first = max(int(np.floor(min(s.min() for s in shells) - buffer)), 0)
    last = min(int(np.floor(max(s.max() for s in shells) + buffer)), top)
    pending, done = [(first, last, geom)] if first <= last else [], []
    while pending:
        a, b, piece = pending.pop()
        if a == b:
            inner = [_clip_part(p, axis, a - buffer, False) for p in piece]
            inner = [_clip_part(p, axis, a + 1 + buffer, True) for p in inner if p]
            inner = [p for p in inner if p]
            if inner:
                done.append((a, inner))
            continue
        m = (a + b) // 2 + 1
        lower = [p for p in (_clip_part(p, axis, m + buffer, True) for p in piece) if p]
        upper = [p for p in (_clip_part(p, axis, m - buffer, False) for p in piece) if p]
        pending += [(a, m - 1, lower)] if lower else []
        pending += [(m, b, upper)] if upper else []
    return done


@F.arrow_udf(STRIPS)
def _strip_udf(geom: pa.Array, axis: pa.Array, buffer: pa.Array, top: pa.Array) -> pa.Array:
    settings = zip(unpack(geom), axis.to_pylist(), buffer.to_pylist(), top.to_pylist())
    rows = [None if g is None else _strips(g, a, b, t) for g, a, b, t in settings]
    flat = [s for r in rows if r is not None for s in r]
    structs = pa.StructArray.from_arrays(
        [pa.array([i for i, _ in flat], pa.int32()), pack([g for _, g in flat])], ["i", "geom"]
    )
    return _lists(rows, structs)


def strips(geom: Column | str, axis: int, buffer: float, top: int) -> Column:
    return _strip_udf(geom, F.lit(axis), F.lit(float(buffer)), F.lit(top))


# --- simplification ----------------------------------------------------------------------------------


def thin_line(line: Ring, tolerance: float, keep: int) -> Ring:
    return line[thinned(line, tolerance, keep)]


def thinned(line: Ring, tolerance: float, keep: int) -> np.ndarray:
    """Visvalingam-Whyatt: which vertices stay when interior ones whose triangle is
    smaller than ``tolerance`` go, smallest first, while more than ``keep`` remain.

    Ties go by coordinates and the triangle is measured from its middle vertex,
    so a line and its reverse lose the same vertices.
    """
    n = len(line)
    left = n - 2
    alive = np.ones(n, dtype=bool)
    if left <= keep:
        return alive
    pts = line.tolist()
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))

    def triangle(i: int) -> float:
        (px, py), (vx, vy), (nx, ny) = pts[before[i]], pts[i], pts[after[i]]
        return abs((px - vx) * (ny - vy) - (nx - vx) * (py - vy)) / 2.0

    size = [float("inf")] * n
    for i in range(1, n - 1):
        size[i] = triangle(i)
    heap = [(size[i], pts[i], i) for i in range(1, n - 1)]
    heapq.heapify(heap)
    while heap and left > keep:
        current, _, i = heapq.heappop(heap)
        if not alive[i] or current != size[i]:
            continue
        if current >= tolerance:
            break
        alive[i] = False
        left -= 1
        before[after[i]], after[before[i]] = before[i], after[i]
        for j in (before[i], after[i]):
            if 0 < j < n - 1:
                size[j] = max(triangle(j), current)
                heapq.heappush(heap, (size[j], pts[j], j))
    return alive


@F.arrow_udf(GEOM)
def _simplify_vw(geom: pa.Array, tolerance: pa.Array) -> pa.Array:
    return _map_geometries(lambda g, tol: [[thin_line(r, tol, 2) for r in part] for part in g], geom, tolerance.cast(pa.float64()))


def simplify_vw(geom: Column | str, tolerance: Column | float) -> Column:
    """Visvalingam-Whyatt by triangle area; rings keep at least a triangle."""
    tol = tolerance if isinstance(tolerance, Column) else F.lit(float(tolerance))
    return _simplify_vw(geom, tol.cast("double"))


def _farthest_kept(line: Ring, tolerance: float) -> Ring:
    keep = np.zeros(len(line), dtype=bool)
    keep[[0, -1]] = True
    spans = [(0, len(line) - 1)]
    while spans:
        a, b = spans.pop()
        if b - a < 2:
            continue
        start, step, inner = line[a], line[b] - line[a], line[a + 1 : b]
        length = float(step @ step)
        t = np.clip((inner - start) @ step / length, 0, 1) if length > 0 else np.zeros(len(inner))
        off = np.sum((inner - start - t[:, None] * step) ** 2, axis=1)
        far = int(np.argmax(off))
        if off[far] > tolerance * tolerance:
            keep[a + 1 + far] = True
            spans += [(a, a + 1 + far), (a + 1 + far, b)]
    return line[keep]


def _dp_part(part: list[Ring], tolerance: float) -> list[Ring]:
    thin = [_farthest_kept(r, tolerance) if len(r) else r for r in part]
    return [r for r in thin if len(r) >= 4] if thin and len(thin[0]) >= 4 else []


@F.arrow_udf(GEOM)
def _simplify_dp(geom: pa.Array, tolerance: pa.Array) -> pa.Array:
    return _map_geometries(lambda g, tol: [p for p in (_dp_part(part, tol) for part in g) if p], geom, tolerance.cast(pa.float64()))


def simplify_dp(geom: Column | str, tolerance: float) -> Column:
    """Douglas-Peucker by distance; rings that collapse disappear."""
    return _simplify_dp(geom, F.lit(float(tolerance)))


def _arcs(ring: Ring, nodes: set[tuple[float, float]]) -> list[tuple[Ring, int]]:
    """The stretches between fixed nodes, with the vertices that must stay inside each.
    A ring without nodes is one stretch from its smallest vertex, which its neighbour
    picks too."""
    body = ring[:-1]
    if len(body) < 3:
        return [(ring, len(ring))]
    at = [i for i, v in enumerate(map(tuple, body.tolist())) if v in nodes]
    if not at:
        at = [int(np.lexsort((body[:, 1], body[:, 0]))[0])]
    turned = np.roll(body, -at[0], axis=0)
    turned = np.vstack([turned, turned[:1]])
    stops = [i - at[0] for i in at] + [len(body)]
    return [(turned[a : b + 1], 2 if len(stops) == 2 else 1) for a, b in zip(stops, stops[1:])]


def _thin_arcs(ring: Ring, nodes: set[tuple[float, float]], tolerance: float) -> Ring:
    """Thin each stretch between fixed nodes by itself."""
    arcs = [thin_line(arc, tolerance, keep) for arc, keep in _arcs(ring, nodes)]
    return np.vstack([arcs[0][:1]] + [a[1:] for a in arcs])


def _swept_by(ring: Ring, nodes: set[tuple[float, float]], tolerance: float) -> list[tuple[Ring, Ring]]:
    """What thinning passes over: each run of dropped vertices closed by the edge that
    takes its place, and its vertex farthest from that edge."""
    found = []
    for arc, keep in _arcs(ring, nodes):
        kept = np.flatnonzero(thinned(arc, tolerance, keep))
        for i, j in zip(kept[:-1].tolist(), kept[1:].tolist()):
            if j > i + 1:
                closed = np.vstack([arc[i : j + 1], arc[i : i + 1]])
                off = np.abs(side_of(arc[i : i + 1], arc[j : j + 1], arc[i + 1 : j]))
                if off.any():
                    found.append((closed, arc[i + 1 + int(off.argmax())]))
    return found


def _fixed(nodes: pa.Array) -> list[set[tuple[float, float]]]:
    points, at = nodes.values, nodes.offsets.to_numpy()
    xs, ys = points.field("x").to_pylist(), points.field("y").to_pylist()
    return [set(zip(xs[a:b], ys[a:b])) for a, b in zip(at, at[1:])]


@F.arrow_udf(GEOM)
def _simplify_arcs(geom: pa.Array, nodes: pa.Array, tolerance: pa.Array) -> pa.Array:
    return pack([
        None if g is None else [[_thin_arcs(r, f, tol) for r in part] for part in g]
        for g, f, tol in zip(unpack(geom), _fixed(nodes), tolerance.to_pylist())
    ])


def simplify_arcs(geom: Column | str, nodes: Column | str, tolerance: float) -> Column:
    return _simplify_arcs(geom, nodes, F.lit(float(tolerance)))


@F.arrow_udf(T.ArrayType(GEOM))
def _swept(geom: pa.Array, nodes: pa.Array, tolerance: pa.Array) -> pa.Array:
    rows = [
        [] if g is None else [found for part in g for r in part for found in _swept_by(r, f, tol)]
        for g, f, tol in zip(unpack(geom), _fixed(nodes), tolerance.to_pylist())
    ]
    # the farthest vertex travels as a ring of its own in a second part
    return _lists(rows, pack([[[closed], [far[None, :]]] for row in rows for closed, far in row]))


def swept_areas(geom: Column | str, nodes: Column | str, tolerance: float) -> Column:
    """Array of shapes whose first part is what thinning passes over at one place, the
    second the one vertex of it that is farthest from the new edge."""
    return _swept(geom, nodes, F.lit(float(tolerance)))


# --- overlay area ----------------------------------------------------------------------------------------


def oriented_edges(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a whole batch, shells counter-clockwise and holes clockwise, and
    the row each belongs to; no loop over rows."""
    parts, rings = column.values, column.values.values
    points = rings.values
    x, y = points.field("x").to_numpy(), points.field("y").to_numpy()
    ring_at, part_at = rings.offsets.to_numpy(), parts.offsets.to_numpy()
    row_at = column.offsets.to_numpy()
    row_of_part = np.repeat(np.arange(len(column)), np.diff(row_at))
    first_part, last_part = row_at[0], row_at[-1]
    ring_counts = np.diff(part_at)[first_part:last_part]
    part_of_ring = np.repeat(np.arange(first_part, last_part), ring_counts)
    first_ring = part_at[first_part] if len(ring_counts) else 0
    ring_ids = np.arange(first_ring, first_ring + len(part_of_ring))
    sizes = np.maximum(ring_at[ring_ids + 1] - ring_at[ring_ids] - 1, 0)
    of_ring = np.repeat(np.arange(len(ring_ids)), sizes)
    at = np.arange(len(of_ring)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + ring_at[ring_ids][of_ring]
    e = np.column_stack([x[at], y[at], x[at + 1], y[at + 1]])
    origin = ring_at[ring_ids][of_ring]
    ox, oy = x[origin], y[origin]
    twice = (e[:, 0] - ox) * (e[:, 3] - oy) - (e[:, 2] - ox) * (e[:, 1] - oy)
    signed = np.bincount(of_ring, twice, len(ring_ids))
    is_shell = ring_ids == part_at[part_of_ring]
    turn = ((signed >= 0) != is_shell)[of_ring]
    e[turn] = e[turn][:, [2, 3, 0, 1]]
    return e, row_of_part[part_of_ring - first_part][of_ring]


# Edge pairs worked on at a time.
PAIR_BLOCK = 1_000_000


def common_areas(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Area shared by each row's two polygons.

    A polygon is the signed sum of the areas below its edges, so the overlap is
    the signed sum, over edge pairs, of the integral of the lower edge.
    """
    (ea, row_a), (eb, row_b) = oriented_edges(a), oriented_edges(b)
    slanted_a, slanted_b = ea[:, 0] != ea[:, 2], eb[:, 0] != eb[:, 2]
    ea, row_a, eb, row_b = ea[slanted_a], row_a[slanted_a], eb[slanted_b], row_b[slanted_b]
    partners = np.bincount(row_b, minlength=len(a))
    start = np.cumsum(partners) - partners
    work = partners[row_a]
    block = np.cumsum(work) // PAIR_BLOCK
    areas = np.zeros(len(a))
    for chosen in np.split(np.arange(len(ea)), np.flatnonzero(np.diff(block)) + 1):
        n = work[chosen]
        i = np.repeat(chosen, n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + start[row_a[i]]
        p, q = ea[i], eb[j]
        lo = np.maximum(np.minimum(p[:, 0], p[:, 2]), np.minimum(q[:, 0], q[:, 2]))
        hi = np.minimum(np.maximum(p[:, 0], p[:, 2]), np.maximum(q[:, 0], q[:, 2]))
        meet = lo < hi
        i, p, q, lo, hi = i[meet], p[meet], q[meet], lo[meet], hi[meet]
        slope_p, slope_q = (p[:, 3] - p[:, 1]) / (p[:, 2] - p[:, 0]), (q[:, 3] - q[:, 1]) / (q[:, 2] - q[:, 0])
        # heights above a vertex of the pair; any level cancels over closed rings
        level = ea[np.searchsorted(row_a, row_a[i]), 1]
        p0, p1 = p[:, 1] - level + slope_p * (lo - p[:, 0]), p[:, 1] - level + slope_p * (hi - p[:, 0])
        q0, q1 = q[:, 1] - level + slope_q * (lo - q[:, 0]), q[:, 1] - level + slope_q * (hi - q[:, 0])
        d0, d1 = p0 - q0, p1 - q1
        low0, low1 = np.minimum(p0, q0), np.minimum(p1, q1)
        crosses = d0 * d1 < 0
        t = np.where(crosses, d0 / np.where(crosses, d0 - d1, 1.0), 0.0)
        middle = np.where(crosses, p0 + t * (p1 - p0), low0)
        below = (hi - lo) * (t * (low0 + middle) + (1 - t) * (middle + low1)) / 2
        sign = np.sign(p[:, 2] - p[:, 0]) * np.sign(q[:, 2] - q[:, 0])
        areas += np.bincount(row_a[i], sign * below, len(a))
    return np.maximum(areas, 0.0)


@F.arrow_udf(T.DoubleType())
def _intersection_area(a: pa.Array, b: pa.Array) -> pa.Array:
    missing = ~(a.is_valid().to_numpy(zero_copy_only=False) & b.is_valid().to_numpy(zero_copy_only=False))
    return pa.array(common_areas(a, b), pa.float64(), mask=missing)


def intersection_area(a: Column | str, b: Column | str) -> Column:
    return _intersection_area(a, b)


# --- pieces by cell --------------------------------------------------------------------------------------


def _banded(part: list[Ring], axis: int, size: float) -> list[tuple[int, list[Ring]]]:
    """A part cut along lines at multiples of ``size``: band number and piece."""
    low, high = part[0][:, axis].min(), part[0][:, axis].max()
    first, last, found = int(np.floor(low / size)), int(np.floor(high / size)), []
    for band in range(first, last):
        piece = _clip_part(part, axis, (band + 1) * size, True)
        if piece:
            found.append((band, piece))
        part = _clip_part(part, axis, (band + 1) * size, False)
        if not part:
            return found
    return [*found, (last, part)]


def cell_pieces(geom: Geometry, size: float) -> list[tuple[int, int, bool, float, Geometry]]:
    """What the shape has in each cell of a grid: column, row, whether it fills the cell,
    the area, and the piece (none if it fills the cell)."""
    cells: dict[tuple[int, int], Geometry] = {}
    for part in geom:
        if part and len(part[0]) > 3:
            for i, band in _banded(part, 0, size):
                for j, piece in _banded(band, 1, size):
                    cells.setdefault((i, j), []).append(piece)
    found = []
    for (i, j), pieces in sorted(cells.items()):
        area = sum(abs(signed_area(r)) * (1 if k == 0 else -1) for piece in pieces for k, r in enumerate(piece))
        full = area >= size * size * (1 - 1e-12)
        if area > 0:
            found.append((i, j, full, min(area, size * size), [] if full else pieces))
    return found


PIECES = T.ArrayType(
    T.StructType([
        T.StructField("level", T.IntegerType()), T.StructField("ci", T.LongType()), T.StructField("cj", T.LongType()),
        T.StructField("full", T.BooleanType()), T.StructField("area", T.DoubleType()), T.StructField("piece", GEOM),
    ])
)


@F.arrow_udf(PIECES)
def _cell_pieces(geom: pa.Array, levels: pa.Array) -> pa.Array:
    rows = [
        None if g is None else [(level, *piece) for level in asked or [] for piece in cell_pieces(g, 4.0**level)]
        for g, asked in zip(unpack(geom), levels.to_pylist())
    ]
    flat = [p for row in rows if row is not None for p in row]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.float64())
    columns = [pa.array([p[k] for p in flat], kind) for k, kind in enumerate(kinds)]
    return _lists(rows, pa.StructArray.from_arrays([*columns, pack([p[5] for p in flat])], [f.name for f in PIECES.elementType]))


def pieces_by_cell(geom: Column | str, levels: Column) -> Column:
    """Pieces of the shape in the cells of each of the grids ``levels`` (cells of side
    4^level): array of level, ci, cj, full, area, piece."""
    return _cell_pieces(geom, levels)


# --- validity ------------------------------------------------------------------------------------------


# Pairs of edges looked at in one go.
NEAR_BLOCK = 1_000_000


def near_pairs(e: np.ndarray):
    """Blocks of index pairs of edges whose boxes meet."""
    x_low, x_high = np.minimum(e[:, 0], e[:, 2]), np.maximum(e[:, 0], e[:, 2])
    y_low, y_high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    order = np.argsort(x_low, kind="stable")
    reach = np.searchsorted(x_low[order], x_high[order], side="right")
    count = reach - np.arange(len(e)) - 1
    for chosen in np.split(np.arange(len(e)), np.flatnonzero(np.diff(np.cumsum(count) // NEAR_BLOCK)) + 1):
        n = count[chosen]
        i = np.repeat(chosen, n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        i, j = order[i], order[j]
        meet = (y_low[i] <= y_high[j]) & (y_low[j] <= y_high[i])
        yield i[meet], j[meet]


def side_of(p: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Positive where r is to the left of the way from p to q, 0 on its line."""
    return (q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]) - (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0])


def rings_are_simple(geom: Geometry) -> bool:
    """True when no two edges meet except neighbours at their shared vertex, and rings
    that touch at a vertex of both without crossing there."""
    rings = [r for part in geom for r in part if len(r) > 3]
    if not rings:
        return True
    e = np.concatenate([np.hstack([r[:-1], r[1:]]) for r in rings])
    count = np.concatenate([np.full(len(r) - 1, len(r) - 1) for r in rings])
    ring = np.concatenate([np.full(len(r) - 1, k) for k, r in enumerate(rings)])
    place = np.concatenate([np.arange(len(r) - 1) for r in rings])
    touching = set()
    for i, j in near_pairs(e):
        gap = (place[i] - place[j]) % count[i]
        apart = (ring[i] != ring[j]) | ((gap != 1) & (gap != count[i] - 1))
        i, j = i[apart], j[apart]
        a, b, c, d = e[i, :2], e[i, 2:], e[j, :2], e[j, 2:]
        one, other = np.sign(side_of(a, b, c)) * np.sign(side_of(a, b, d)), np.sign(side_of(c, d, a)) * np.sign(side_of(c, d, b))
        meet = np.flatnonzero((one <= 0) & (other <= 0))
        for i, j in zip(i[meet].tolist(), j[meet].tolist()):
            ends = [(x, y) for x in (0, 1) for y in (0, 1) if (e[i, 2 * x : 2 * x + 2] == e[j, 2 * y : 2 * y + 2]).all()]
            if ring[i] == ring[j] or len(ends) != 1:
                return False
            x, y = ends[0]
            p = e[i, 2 * x : 2 * x + 2]
            mine, its = e[i, 2 - 2 * x : 4 - 2 * x] - p, e[j, 2 - 2 * y : 4 - 2 * y] - p
            if mine[0] * its[1] == mine[1] * its[0] and (mine * its).sum() > 0:
                return False
            touching.add((int(ring[i]), int(place[i] + x), int(ring[j]), int(place[j] + y)))
    return not any(_cross_at(rings[a], p, rings[b], q) for a, p, b, q in touching)


def _cross_at(one: Ring, p: int, other: Ring, q: int) -> bool:
    """Whether two rings that share vertex p of one and q of the other cross there."""
    angles = []
    for r, at in ((one, p), (other, q)):
        v = r[:-1]
        at %= len(v)
        for way in (v[at - 1] - v[at], v[(at + 1) % len(v)] - v[at]):
            angles.append(np.arctan2(way[1], way[0]))
    width, first, second = ((angles[k] - angles[0]) % (2 * np.pi) for k in (1, 2, 3))
    return bool((first < width) != (second < width))


@F.arrow_udf(T.BooleanType())
def _is_simple(geom: pa.Array) -> pa.Array:
    return pa.array([None if g is None else rings_are_simple(g) for g in unpack(geom)], pa.bool_())


def is_simple(geom: Column | str) -> Column:
    return _is_simple(geom)


# --- hulls ------------------------------------------------------------------------------------------------


def convex_hull(points: np.ndarray) -> Ring:
    """Monotone chain, counter-clockwise and closed."""
    pts = np.unique(points, axis=0).tolist()
    if len(pts) < 3:
        return np.array(pts + pts[:1])

    def chain(sequence) -> list:
        line: list = []
        for p in sequence:
            while len(line) > 1 and (line[-1][0] - line[-2][0]) * (p[1] - line[-2][1]) <= (line[-1][1] - line[-2][1]) * (p[0] - line[-2][0]):
                line.pop()
            line.append(p)
        return line[:-1]

    ring = chain(pts) + chain(reversed(pts))
    return np.array(ring + ring[:1])


# Fixed value: segments of a buffer's full circle (eight per quarter).
CIRCLE = np.linspace(0.0, 2 * np.pi, 32, endpoint=False)


def grown_hull(geom: Geometry, radius: float, in_metres: bool) -> Geometry:
    """Hull of the shape grown by a disk: the hull of disks on the hull's corners."""
    shells = [part[0] for part in geom if part and len(part[0])]
    if not shells:
        return []
    corners = convex_hull(np.concatenate(shells))
    up = np.degrees(radius / MERCATOR_RADIUS) if in_metres else radius
    across = up / np.cos(np.radians(corners[:, 1])) if in_metres else np.full(len(corners), up)
    disks = corners[:, None, :] + np.stack(
        [across[:, None] * np.cos(CIRCLE), np.full((len(corners), 1), up) * np.sin(CIRCLE)], axis=2
    )
    return [[convex_hull(disks.reshape(-1, 2))]]


@F.arrow_udf(GEOM)
def _grown_hull(geom: pa.Array, radius: pa.Array, in_metres: pa.Array) -> pa.Array:
    return _map_geometries(grown_hull, geom, radius, in_metres)


def near_hull(geom: Column | str, radius: float = 1e-5) -> Column:
    """Convex hull of the slightly grown shape."""
    return _grown_hull(geom, F.lit(float(radius)), F.lit(False))


def buffer_hull(geom: Column | str, metres: float) -> Column:
    """Convex hull of the shape grown by a distance (longitude/latitude)."""
    return _grown_hull(geom, F.lit(float(metres)), F.lit(True))


# --- random points -------------------------------------------------------------------------------------------


def strictly_inside(points: np.ndarray, edges: np.ndarray) -> np.ndarray:
    px, py = points[:, :1], points[:, 1:]
    x1, y1, x2, y2 = edges.T
    side = (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)
    crossing = ((y1 <= py) & (y2 > py) & (side > 0)) | ((y2 <= py) & (y1 > py) & (side < 0))
    on_edge = (
        (side == 0)
        & (px >= np.minimum(x1, x2)) & (px <= np.maximum(x1, x2))
        & (py >= np.minimum(y1, y2)) & (py <= np.maximum(y1, y2))
    )
    return (crossing.sum(axis=1) % 2 == 1) & ~on_edge.any(axis=1)


# Vertices of a piece that is cut into trapezoids.
SLABS = 64
# Draws for a place that rounding put on a border before a polygon counts as too thin.
TRIES = 64


def trapezoids(geom: Geometry) -> np.ndarray:
    """The shape as trapezoids between two vertical lines: x0, x1, and the heights of the
    lower and of the upper side at both, as rows x0, x1, low0, low1, high0, high1."""
    found = [np.empty((0, 6))]
    for piece in (piece for part in geom if part for piece in _halve(part, SLABS)):
        e = ring_edges(piece)
        e = np.where((e[:, 0] > e[:, 2])[:, None], e[:, [2, 3, 0, 1]], e)
        e = e[e[:, 0] < e[:, 2]]
        if not len(e):
            continue
        xs = np.unique(e[:, [0, 2]])
        x0, x1 = xs[:-1, None], xs[1:, None]
        slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
        spans = (e[:, 0] <= x0) & (e[:, 2] >= x1)
        at0, at1 = e[:, 1] + slope * (x0 - e[:, 0]), e[:, 1] + slope * (x1 - e[:, 0])
        order = np.argsort(np.where(spans, at0 + at1, np.inf), axis=1, kind="stable")
        at0, at1 = np.take_along_axis(at0, order, 1), np.take_along_axis(at1, order, 1)
        most = int(spans.sum(axis=1).max()) // 2
        paired = np.arange(most) < spans.sum(axis=1)[:, None] // 2
        low, high = (slice(0, 2 * most, 2), slice(1, 2 * most, 2))
        across = [np.broadcast_to(x, (len(xs) - 1, most)) for x in (x0, x1)]
        found.append(np.stack([*across, at0[:, low], at1[:, low], at0[:, high], at1[:, high]], axis=2)[paired])
    return np.concatenate(found)


def draw_points(geom: Geometry, n: int, seed: int) -> np.ndarray:
    """``n`` uniform points strictly inside: a trapezoid by its share of the area, then a
    place in it. Nothing depends on how much of its box the polygon fills."""
    edges = ring_edges(geom)
    if n <= 0:
        return np.empty((0, 2))
    if not len(edges):
        raise ValueError("an empty polygon has no points in it")
    x0, x1, low0, low1, high0, high1 = trapezoids(geom).T
    left, right = np.maximum(high0 - low0, 0), np.maximum(high1 - low1, 0)
    upto = np.cumsum((x1 - x0) * (left + right) / 2)
    rng = np.random.default_rng(seed & 0x7FFFFFFFFFFFFFFF)
    found, have = [], 0
    block = max(1, 2_000_000 // len(edges))
    for _ in range(TRIES + n // block):
        if not len(upto) or not upto[-1] > 0 or have >= n:
            break
        size = min(n - have, block)
        k = np.minimum(np.searchsorted(upto, rng.random(size) * upto[-1], "right"), len(upto) - 1)
        u, v = rng.random((2, size))
        # breadth grows evenly from one side to the other: the inverse of its share
        s = u * (left[k] + right[k]) / np.maximum(left[k] + np.sqrt(left[k] ** 2 + u * (right[k] ** 2 - left[k] ** 2)), 1e-300)
        bottom, top = low0[k] + s * (low1[k] - low0[k]), high0[k] + s * (high1[k] - high0[k])
        drawn = np.column_stack([x0[k] + s * (x1[k] - x0[k]), bottom + v * (top - bottom)])
        hits = drawn[strictly_inside(drawn, edges)]
        found.append(hits)
        have += len(hits)
    if have < n:
        raise ValueError("the polygon is too thin for points strictly inside")
    return np.concatenate(found)[:n]


@F.arrow_udf(RING)
def _draw(geom: pa.Array, n: pa.Array, seed: pa.Array) -> pa.Array:
    rows = zip(unpack(geom), n.to_pylist(), seed.to_pylist())
    return _pack_points([None if g is None else draw_points(g, k, s) for g, k, s in rows])


def drawn_points(geom: Column | str, n: Column | str, seed: Column | str) -> Column:
    """Array of ``n`` random points; the seed decides them completely."""
    return _draw(geom, n, seed)

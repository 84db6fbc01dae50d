"""Geometry functions as columns, and their SQL names.

Boxes, Web Mercator and Hilbert codes are JVM expressions; the rest decode text or binary
geometries in Arrow batches. Null and unreadable geometries give null, empty ones give area 0,
no position and no intersection.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliolake.functions import geometry as G
from heliolake.functions.geo_columns import decode

#: Fixed values of the reference ellipsoid and of Web Mercator.
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
MERCATOR_R = 6378137.0
#: Relative tolerance within which areas count as equal.
EPS = 1e-9


# --- JVM expressions -----------------------------------------------------------------------


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to Web Mercator metres; the poles have no image and give null."""
    y = F.when(F.abs(lat) < 90, F.lit(MERCATOR_R) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)))
    return F.lit(MERCATOR_R) * F.radians(lon), y


def mercator_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """Web Mercator metres to degrees."""
    return F.degrees(x / MERCATOR_R), F.degrees(F.lit(2.0) * F.atan(F.exp(y / MERCATOR_R)) - F.lit(math.pi / 2))


def envelope_wkt(xmin: str, ymin: str, xmax: str, ymax: str) -> Column:
    """Rectangle as text, counter-clockwise from its lower left corner."""
    corner = lambda x, y: F.concat(F.col(x).cast("string"), F.lit(" "), F.col(y).cast("string"))
    ring = F.concat_ws(", ", corner(xmin, ymin), corner(xmax, ymin), corner(xmax, ymax), corner(xmin, ymax), corner(xmin, ymin))
    return F.concat(F.lit("POLYGON (("), ring, F.lit("))"))


def hilbert(x: Column, y: Column, bits: int) -> Column:
    """Place of a cell along the Hilbert curve of ``2^bits`` cells a side."""
    top = (1 << bits) - 1
    state = F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y"), F.lit(0).cast("bigint").alias("d"))

    def step(acc: Column, s: Column) -> Column:
        rx = F.when(acc["x"].bitwiseAND(s) > 0, 1).otherwise(0)
        ry = F.when(acc["y"].bitwiseAND(s) > 0, 1).otherwise(0)
        d = acc["d"] + s * s * (rx * 3).bitwiseXOR(ry)
        nx = F.when(ry == 0, F.when(rx == 1, F.lit(top) - acc["y"]).otherwise(acc["y"])).otherwise(acc["x"])
        ny = F.when(ry == 0, F.when(rx == 1, F.lit(top) - acc["x"]).otherwise(acc["x"])).otherwise(acc["y"])
        return F.struct(nx.cast("bigint").alias("x"), ny.cast("bigint").alias("y"), d.cast("bigint").alias("d"))

    sides = F.array(*[F.lit(1 << b).cast("bigint") for b in range(bits - 1, -1, -1)])
    return F.aggregate(sides, state, step, lambda acc: acc["d"])


def st_hilbert(lon: Column, lat: Column, bounds: tuple[float, float, float, float] = (-180.0, -90.0, 180.0, 90.0), bits: int = 16) -> Column:
    """Hilbert code of a position within bounds, positions outside clamped to the border."""
    n = (1 << bits) - 1
    scale = lambda v, lo, hi: F.greatest(F.lit(0), F.least(F.lit(n), F.floor((v - lo) / (hi - lo) * (n + 1))))
    return hilbert(scale(lon, bounds[0], bounds[2]), scale(lat, bounds[1], bounds[3]), bits)


# --- Arrow functions -----------------------------------------------------------------------


def _measure(name: str):
    @F.arrow_udf(T.DoubleType())
    def f(g: pa.Array) -> pa.Array:
        r = decode(g)
        m = G.measure(r)
        known = r.kinds != "NULL"
        value = getattr(m, name)
        return pa.array(np.where(np.isnan(value), 0.0, value), mask=~(known if name.startswith("area") else m.has))

    return f


st_area = _measure("area_deg2")
st_area_m2 = _measure("area_m2")
st_x = _measure("cx")
st_y = _measure("cy")
st_xmin, st_ymin, st_xmax, st_ymax = (_measure(n) for n in ("xmin", "ymin", "xmax", "ymax"))


def authalic_area(r: G.RingSet) -> np.ndarray:
    """Ellipsoidal m² of each row: rings in longitude and the sine of the authalic latitude, where areas are true.

    Edges count as straight there; the difference from geodesics is 3e-5 of a degree-wide box and falls with the square of its width.
    """
    e2 = WGS84_F * (2 - WGS84_F)
    e = math.sqrt(e2)
    s = np.sin(np.radians(r.y))
    q = (1 - e2) * (s / (1 - e2 * s * s) - np.log((1 - e * s) / (1 + e * s)) / (2 * e))
    flat = G.RingSet(np.radians(r.x), q, r.ring, r.row, r.hole, r.kinds)
    return G.measure(flat).area_deg2 * WGS84_A**2 / 2


@F.arrow_udf(T.DoubleType())
def st_area_spheroid(g: pa.Array) -> pa.Array:
    r = decode(g)
    return pa.array(authalic_area(r), mask=r.kinds == "NULL")


@F.arrow_udf(T.DoubleType())
def st_area_mercator(g: pa.Array) -> pa.Array:
    """Planar area in Web Mercator: inflated away from the equator, as the staging contract wants it."""
    r = decode(g)
    y = MERCATOR_R * np.log(np.tan(np.pi / 4 + np.radians(np.clip(r.y, -89.9999, 89.9999)) / 2))
    m = G.measure(G.RingSet(MERCATOR_R * np.radians(r.x), y, r.ring, r.row, r.hole, r.kinds))
    return pa.array(m.area_deg2, mask=r.kinds == "NULL")


@F.arrow_udf(T.StringType())
def st_astext(g: pa.Array) -> pa.Array:
    return pa.array(G.encode_wkt(decode(g)), pa.string())


@F.arrow_udf(T.BinaryType())
def st_aswkb(g: pa.Array) -> pa.Array:
    return pa.array(G.encode_wkb(decode(g)), pa.binary())


@F.arrow_udf(T.StringType())
def st_centroid(g: pa.Array) -> pa.Array:
    m = G.measure(decode(g))
    return pa.array([f"POINT ({x:.15g} {y:.15g})" if ok else None for x, y, ok in zip(m.cx, m.cy, m.has)], pa.string())


@F.arrow_udf(T.StringType())
def st_geometrytype(g: pa.Array) -> pa.Array:
    values = g.to_pylist()
    kinds = decode(g).kinds
    return pa.array([None if k == "NULL" else k if k != "EMPTY" else _kind_of(v) for k, v in zip(kinds, values)], pa.string())


def _kind_of(v: str | bytes) -> str:
    if isinstance(v, str):
        return v.rsplit(";", 1)[-1].split()[0].upper().split("(")[0]
    return G.WKB_KINDS.get(int.from_bytes(v[1:5], "little" if v[0] == 1 else "big") & 0xFF, "POLYGON")


def crossing_rows(r: G.RingSet, chunk: int = 1_000_000) -> np.ndarray:
    """Rows in which two edges, of one ring or of two, cross properly. Neighbouring edges share a vertex and don't count.

    Edges are sorted by their left ends, and each meets only those that begin before its right end; pairs are
    formed in chunks, so memory doesn't grow with a ring's length.
    """
    if not len(r.x):
        return np.zeros(0, np.int64)
    e = np.flatnonzero(r.ring[1:] == r.ring[:-1])
    first = np.concatenate(([0], np.flatnonzero(np.diff(r.ring)) + 1))[r.ring[e]]
    last = np.bincount(r.ring)[r.ring[e]] - 2
    place, ring, row = e - first, r.ring[e], r.row[r.ring[e]]
    x1, y1, x2, y2 = r.x[e], r.y[e], r.x[e + 1], r.y[e + 1]
    low, high = np.minimum(x1, x2), np.maximum(x1, x2)
    wide = float(r.x.max() - r.x.min()) + 1.0
    order = np.lexsort((low, row))
    key = row[order] * wide + (low[order] - r.x.min())
    reach = np.searchsorted(key, row[order] * wide + (high[order] - r.x.min()), "right")
    work = np.maximum(reach - np.arange(len(order)) - 1, 0)
    bounds = np.concatenate(([0], np.cumsum(work)))
    side = lambda i, px, py: (x2[i] - x1[i]) * (py - y1[i]) - (y2[i] - y1[i]) * (px - x1[i])
    bad: set[int] = set()
    at = 0
    while at < len(order):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + chunk, "right")) - 1)
        w = work[at:to]
        k = np.repeat(np.arange(at, to), w)
        i, j = order[k], order[k + 1 + np.arange(len(k)) - np.repeat(np.cumsum(w) - w, w)]
        gap = np.abs(place[i] - place[j])
        meet = (np.minimum(y1[i], y2[i]) <= np.maximum(y1[j], y2[j])) & (np.minimum(y1[j], y2[j]) <= np.maximum(y1[i], y2[i]))
        meet &= (ring[i] != ring[j]) | ((gap > 1) & (gap < last[i]))
        i, j = i[meet], j[meet]
        cross = (side(i, x1[j], y1[j]) * side(i, x2[j], y2[j]) < 0) & (side(j, x1[i], y1[i]) * side(j, x2[i], y2[i]) < 0)
        bad.update(row[i[cross]].tolist())
        at = to
    return np.array(sorted(bad), np.int64)


def _part(r: G.RingSet, rings: np.ndarray) -> G.RingSet:
    """The chosen rings of a batch, with the rows as they are."""
    number = np.cumsum(rings) - 1
    on = rings[r.ring]
    return G.RingSet(r.x[on], r.y[on], number[r.ring[on]], r.row[rings], r.hole[rings], r.kinds)


@F.arrow_udf(T.BooleanType())
def st_isvalid(g: pa.Array) -> pa.Array:
    """Rings closed, of four points or more, with an area; no two edges of a row cross; holes begin inside a shell of their row. Empty is valid, null is null."""
    r = decode(g)
    ok = r.kinds != "NULL"
    if len(r.x):
        areal = np.isin(r.kinds[r.row], ("POLYGON", "MULTIPOLYGON"))
        start = np.concatenate(([0], np.flatnonzero(np.diff(r.ring)) + 1))
        end = np.concatenate((start[1:], [len(r.x)])) - 1
        good = (end - start >= 3) & (r.x[start] == r.x[end]) & (r.y[start] == r.y[end]) & (G._ring_sums(r)[0] != 0)
        ok[r.row[areal & ~good]] = False
        if (areal & r.hole).any():
            shells = G.filled_edges(_part(r, ~r.hole))
            h = np.flatnonzero(areal & r.hole)
            x, y = r.x[start[h]], r.y[start[h]]
            ok[r.row[h[~(G.points_in(shells, r.row[h], x, y) | on_border(shells, r.row[h], x, y))]]] = False
        if areal.any():
            ok[crossing_rows(_part(r, areal))] = False
    return pa.array(ok, mask=r.kinds == "NULL")


@F.arrow_udf(T.BooleanType())
def st_isempty(g: pa.Array) -> pa.Array:
    r = decode(g)
    return pa.array(r.kinds == "EMPTY", mask=r.kinds == "NULL")


class _Pair:
    """Two columns of geometries with what every predicate needs."""

    def __init__(self, a: pa.Array, b: pa.Array) -> None:
        self.a, self.b = decode(a), decode(b)
        self.ma, self.mb = G.measure(self.a), G.measure(self.b)
        self.ea, self.eb = G.filled_edges(self.a), G.filled_edges(self.b)
        self.k = np.arange(len(a))
        self.null = (self.a.kinds == "NULL") | (self.b.kinds == "NULL")
        self.common = G.common_area(self.ea, self.eb, self.k, self.k)

    def inside(self, other: bool) -> np.ndarray:
        """Are all vertices of one side in or on the other?"""
        r, e, m = (self.b, self.ea, self.ma) if other else (self.a, self.eb, self.mb)
        row = r.row[r.ring] if len(r.x) else np.zeros(0, int)
        hit = G.points_in(e, row, r.x, r.y) | on_border(e, row, r.x, r.y)
        out = np.ones(len(self.k), bool)
        np.logical_and.at(out, row, hit)
        return out & m.has

    def distance(self) -> np.ndarray:
        return min_distance(self.a, self.b, self.touching())

    def touching(self) -> np.ndarray:
        """A common point, borders included."""
        some = self.common > 0
        for r, e in ((self.a, self.eb), (self.b, self.ea)):
            if len(r.x):
                row = r.row[r.ring]
                np.logical_or.at(some, row, G.points_in(e, row, r.x, r.y))
        return (some | (min_distance(self.a, self.b, some) == 0)) & self.ma.has & self.mb.has


def on_border(e: G.Edges, row: np.ndarray, px: np.ndarray, py: np.ndarray) -> np.ndarray:
    """Is each point on a border edge of its row (vertical edges through their end points)?"""
    out = np.zeros(len(row), bool)
    w = e.count[row]
    k = np.repeat(np.arange(len(row)), w)
    i = e.start[row[k]] + np.arange(len(k)) - np.repeat(np.cumsum(w) - w, w)
    x, y = px[k], py[k]
    line = e.yl[i] + (e.yr[i] - e.yl[i]) / (e.xr[i] - e.xl[i]) * (x - e.xl[i])
    tol = 1e-12 * (1 + np.abs(y))
    hit = (x >= e.xl[i]) & (x <= e.xr[i]) & (np.abs(y - line) <= tol)
    np.logical_or.at(out, k[hit], True)
    # a vertical edge joins two end points of other edges with the same x
    lo, hi = np.full(len(row), np.inf), np.full(len(row), -np.inf)
    for ex, ey in ((e.xl, e.yl), (e.xr, e.yr)):
        at = np.abs(x - ex[i]) <= 1e-12 * (1 + np.abs(x))
        np.minimum.at(lo, k[at], ey[i[at]])
        np.maximum.at(hi, k[at], ey[i[at]])
    return out | ((py >= lo) & (py <= hi) & G.points_in(e, row, px - 1e-9, py) ^ ((py >= lo) & (py <= hi) & G.points_in(e, row, px + 1e-9, py)))


def _segments(r: G.RingSet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, x, y of all segments, row by row; first of each row; number of each row); a lone vertex is a segment of no length."""
    if not len(r.x):
        return np.zeros((0, 4)), np.zeros(r.n, np.int64), np.zeros(r.n, np.int64)
    e = np.flatnonzero(r.ring[1:] == r.ring[:-1])
    lone = np.flatnonzero(np.bincount(r.ring)[r.ring] == 1)
    i, j = np.concatenate((e, lone)), np.concatenate((e + 1, lone))
    row = r.row[r.ring[i]]
    order = np.argsort(row, kind="stable")
    i, j = i[order], j[order]
    count = np.bincount(row, minlength=r.n)
    return np.column_stack((r.x[i], r.y[i], r.x[j], r.y[j])), np.cumsum(count) - count, count


def min_distance(a: G.RingSet, b: G.RingSet, zero: np.ndarray, chunk: int = 500_000) -> np.ndarray:
    """Least planar distance of the two rows of each place; 0 where ``zero`` says so, NaN without vertices. All pairs of segments of a batch, in chunks."""
    (sa, fa, ca), (sb, fb, cb) = _segments(a), _segments(b)
    out = np.where(zero, 0.0, np.nan)
    rows = np.flatnonzero(~zero & (ca > 0) & (cb > 0))
    out[rows] = np.inf
    work = ca[rows] * cb[rows]
    bounds = np.concatenate(([0], np.cumsum(work)))
    total, at = int(bounds[-1]), 0

    def to_segment(px: np.ndarray, py: np.ndarray, q: np.ndarray) -> np.ndarray:
        dx, dy = q[:, 2] - q[:, 0], q[:, 3] - q[:, 1]
        u = np.clip(((px - q[:, 0]) * dx + (py - q[:, 1]) * dy) / np.maximum(dx * dx + dy * dy, 1e-300), 0, 1)
        return np.hypot(px - q[:, 0] - u * dx, py - q[:, 1] - u * dy)

    side = lambda q, px, py: (q[:, 2] - q[:, 0]) * (py - q[:, 1]) - (q[:, 3] - q[:, 1]) * (px - q[:, 0])
    while at < total:
        n = np.arange(at, min(at + chunk, total))
        k = np.searchsorted(bounds, n, "right") - 1
        row, nth = rows[k], n - bounds[k]
        s, t = sa[fa[row] + nth // cb[row]], sb[fb[row] + nth % cb[row]]
        d = np.minimum.reduce([to_segment(s[:, 0], s[:, 1], t), to_segment(s[:, 2], s[:, 3], t), to_segment(t[:, 0], t[:, 1], s), to_segment(t[:, 2], t[:, 3], s)])
        cross = (side(s, t[:, 0], t[:, 1]) * side(s, t[:, 2], t[:, 3]) < 0) & (side(t, s[:, 0], s[:, 1]) * side(t, s[:, 2], s[:, 3]) < 0)
        np.minimum.at(out, row, np.where(cross, 0.0, d))
        at += chunk
    return out


def _intervals(edges: list[np.ndarray], left: float, right: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """(lower edge, upper edge) of the filled stretches between two successive places, from below, by the edges' signs."""
    mid = (left + right) / 2
    on = [q for q in edges if q[0] <= left and q[2] >= right]
    on.sort(key=lambda q: q[1] + (q[3] - q[1]) / (q[2] - q[0]) * (mid - q[0]))
    out, depth, low = [], 0, None
    for q in on:
        before = depth
        depth += -int(q[4])
        if before == 0 and depth > 0:
            low = q
        elif before > 0 and depth == 0:
            out.append((low, q))
    return out


def overlay(shapes: list[np.ndarray], union: bool) -> str | None:
    """Union of any number of shapes, or what is common to all, as a multipolygon of trapezoids that share no area.

    ``shapes`` hold edges (left x, y, right x, y, sign). The plane is cut at all vertices and crossings; between two
    successive cuts edges don't cross, so the filled stretches are found by counting. Nothing in common gives the empty multipolygon.
    """
    if not shapes or (not union and any(not len(q) for q in shapes)):
        return "MULTIPOLYGON EMPTY"
    every = np.vstack(shapes)
    if not len(every):
        return "MULTIPOLYGON EMPTY"
    cuts = [every[:, 0], every[:, 2]]
    slope = (every[:, 3] - every[:, 1]) / (every[:, 2] - every[:, 0])
    for k in range(len(every)):  # crossings with the edges that come after, one edge against all
        q, rest = every[k], every[k + 1 :]
        with np.errstate(divide="ignore", invalid="ignore"):
            x = ((rest[:, 1] - slope[k + 1 :] * rest[:, 0]) - (q[1] - slope[k] * q[0])) / (slope[k] - slope[k + 1 :])
        cuts.append(x[np.isfinite(x) & (x > np.maximum(q[0], rest[:, 0])) & (x < np.minimum(q[2], rest[:, 2]))])
    xs = np.unique(np.concatenate(cuts))
    at = lambda q, x: q[1] + (q[3] - q[1]) / (q[2] - q[0]) * (x - q[0])
    parts: list[str] = []
    for left, right in zip(xs, xs[1:]):
        if right - left <= 1e-13 * max(1.0, abs(left)):
            continue
        mid = (left + right) / 2
        spans = [_intervals(list(q), left, right) for q in shapes]
        if union:
            kept: list[tuple[np.ndarray, np.ndarray]] = []
            for low, high in sorted((s for sp in spans for s in sp), key=lambda s: at(s[0], mid)):
                if kept and at(low, mid) <= at(kept[-1][1], mid):
                    if at(high, mid) > at(kept[-1][1], mid):
                        kept[-1] = kept[-1][0], high
                else:
                    kept.append((low, high))
        else:
            kept = spans[0]
            for other in spans[1:]:
                kept = [(low, high) for a in kept for b in other if at(low := max(a[0], b[0], key=lambda q: at(q, mid)), mid) < at(high := min(a[1], b[1], key=lambda q: at(q, mid)), mid)]
        for low, high in kept:
            ring: list[tuple[float, float]] = []
            for p in ((left, at(low, left)), (right, at(low, right)), (right, at(high, right)), (left, at(high, left))):
                if not ring or p != ring[-1]:
                    ring.append(p)
            if len(set(ring)) >= 3:
                parts.append("((" + ", ".join(f"{x:.15g} {y:.15g}" for x, y in [*ring, ring[0]]) + "))")
    return "MULTIPOLYGON (" + ", ".join(parts) + ")" if parts else "MULTIPOLYGON EMPTY"


def edges_of(e: G.Edges, row: int) -> np.ndarray:
    """Edges of one row for :func:`overlay`."""
    i = slice(e.start[row], e.start[row] + e.count[row])
    return np.column_stack((e.xl[i], e.yl[i], e.xr[i], e.yr[i], e.sign[i]))


@F.arrow_udf(T.StringType())
def st_intersection(a: pa.Array, b: pa.Array) -> pa.Array:
    """What two areas have in common, as a multipolygon (its area is :func:`st_intersection_area`)."""
    p = _Pair(a, b)
    return pa.array([None if n else overlay([edges_of(p.ea, k), edges_of(p.eb, k)], False) for k, n in enumerate(p.null)], pa.string())


@F.arrow_udf(T.DoubleType())
def st_intersection_area(a: pa.Array, b: pa.Array) -> pa.Array:
    p = _Pair(a, b)
    return pa.array(p.common, mask=p.null)


@F.arrow_udf(T.BooleanType())
def st_intersects(a: pa.Array, b: pa.Array) -> pa.Array:
    p = _Pair(a, b)
    return pa.array(p.touching(), mask=p.null)


@F.arrow_udf(T.BooleanType())
def st_overlaps(a: pa.Array, b: pa.Array) -> pa.Array:
    """Areas meet, and neither holds the other: false for equal and for nested shapes."""
    p = _Pair(a, b)
    fa, fb = p.ma.area_deg2, p.mb.area_deg2
    return pa.array((p.common > EPS * np.minimum(fa, fb)) & (p.common < fa * (1 - EPS)) & (p.common < fb * (1 - EPS)), mask=p.null)


@F.arrow_udf(T.BooleanType())
def st_equals(a: pa.Array, b: pa.Array) -> pa.Array:
    p = _Pair(a, b)
    fa, fb = p.ma.area_deg2, p.mb.area_deg2
    areal = (fa > 0) & (fb > 0)
    same = areal & (np.abs(fa - fb) <= EPS * np.maximum(fa, fb)) & (p.common >= fa * (1 - 1e-7))
    point = ~areal & (fa == 0) & (fb == 0) & p.ma.has & p.mb.has & (p.ma.cx == p.mb.cx) & (p.ma.cy == p.mb.cy)
    return pa.array(same | point, mask=p.null)


@F.arrow_udf(T.BooleanType())
def st_within(a: pa.Array, b: pa.Array) -> pa.Array:
    """a lies in b. A point on a border isn't within beyond the half-open rule of ``points_in``; a line is if all its vertices and the middles of its segments lie in b or on its border."""
    p = _Pair(a, b)
    fa = p.ma.area_deg2
    areal = (fa > 0) & (p.common >= fa * (1 - EPS))
    one = np.isin(p.a.kinds, ("POINT", "MULTIPOINT"))
    point = one & p.ma.has
    if point.any():
        row = p.a.row[p.a.ring]
        np.logical_and.at(point, row, G.points_in(p.eb, row, p.a.x, p.a.y))
    line = np.isin(p.a.kinds, ("LINESTRING", "MULTILINESTRING")) & p.inside(False)
    if line.any():
        seg, _, count = _segments(p.a)
        row = np.repeat(p.k, count)
        x, y = (seg[:, 0] + seg[:, 2]) / 2, (seg[:, 1] + seg[:, 3]) / 2
        np.logical_and.at(line, row, G.points_in(p.eb, row, x, y) | on_border(p.eb, row, x, y))
    return pa.array(areal | point | line, mask=p.null)


def in_metres(a: G.RingSet, b: G.RingSet) -> tuple[G.RingSet, G.RingSet]:
    """Both sides of each pair in metres about the pair's middle latitude; good to a part in a thousand for pairs within some ten kilometres."""
    ma, mb = G.measure(a), G.measure(b)
    mid = np.radians(np.nan_to_num((ma.cy + mb.cy) / 2))
    scale = np.radians(1.0) * G.EARTH_RADIUS_M
    turn = 360.0 * np.round(np.nan_to_num(ma.cx - mb.cx) / 360.0)
    flat = lambda r, t: G.RingSet((r.x + t[r.row[r.ring]]) * scale * np.cos(mid)[r.row[r.ring]], r.y * scale, r.ring, r.row, r.hole, r.kinds) if len(r.x) else r
    return flat(a, np.zeros(a.n)), flat(b, turn)


def st_dwithin(distance: float, metres: bool = False):
    """Predicate: least distance at most ``distance``, planar in the units of the coordinates or in metres on the ground."""

    @F.arrow_udf(T.BooleanType())
    def f(a: pa.Array, b: pa.Array) -> pa.Array:
        p = _Pair(a, b)
        d = min_distance(*in_metres(p.a, p.b), p.touching()) if metres else p.distance()
        return pa.array(np.nan_to_num(d, nan=np.inf) <= distance, mask=p.null)

    return f


#: SQL names of the functions.
FUNCTIONS = {
    "st_area": st_area,
    "st_area_spheroid": st_area_spheroid,
    "st_area_mercator": st_area_mercator,
    "st_x": st_x,
    "st_y": st_y,
    "st_xmin": st_xmin,
    "st_ymin": st_ymin,
    "st_xmax": st_xmax,
    "st_ymax": st_ymax,
    "st_geomfromtext": st_aswkb,
    "st_geomfromwkb": st_aswkb,
    "st_astext": st_astext,
    "st_aswkb": st_aswkb,
    "st_centroid": st_centroid,
    "st_geometrytype": st_geometrytype,
    "st_isvalid": st_isvalid,
    "st_isempty": st_isempty,
    "st_intersection_area": st_intersection_area,
    "st_intersects": st_intersects,
    "st_overlaps": st_overlaps,
    "st_equals": st_equals,
    "st_within": st_within,
    "st_intersection": st_intersection,
}


def register(spark: SparkSession) -> None:
    """Install the functions under their SQL names, and the cell functions."""
    from heliolake.functions import hexcells

    for name, f in FUNCTIONS.items():
        spark.udf.register(name, f)
    hexcells.register(spark)

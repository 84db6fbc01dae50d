"""Problem 6: points near other points, and the region that contains each point.

Near pairs. Points become three-dimensional positions on the sphere, in metres; a cell is a
cube whose side is twice the distance, and its identifier the Morton code of the cube (a
space-filling curve, so that sorted codes keep neighbours together). The ball around a point
touches at most eight cubes, two runs of codes along each axis; cubes that the sphere does not
pass through are left out. Neither poles nor the 180th meridian are special. Points meet the
covers of others in a sort-merge join on the codes and are refined by the exact chord, which
bounds the great-circle distance exactly. A pair whose points lie in different cubes is met
only from the lower code, so no pair is met twice and none has to be removed.

Regions. Each region is covered by the cells of a quadtree on longitude and latitude: ranges
of Morton codes, marked as lying inside the region or on its border. Regions are a dimension
table; their number is checked, and that of ranges a region may have is a parameter, so what travels with
the tasks is bounded by regions times ranges; more regions go through a join of boxes. Each point's code is looked up in the sorted ranges by binary search,
and only points in border cells are tested against the polygon.

Defined results: rows with null or empty geometries have no position, hence no pair and no
region; equal positions are 0 m apart; points on a border belong to the region to their east
or north; without regions the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from heliolake.functions import geometry as G
from heliolake.functions import st
from heliolake.functions.geometry import EARTH_RADIUS_M
from heliolake.operators.geojoin import spatial_join
from heliolake.session import cut

_SPREAD_3 = ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249))


def _spread(c: Column) -> Column:
    """The low 21 bits of a non-negative long, two zero bits between each."""
    for by, mask in _SPREAD_3:
        c = (c.bitwiseOR(F.shiftleft(c, by))).bitwiseAND(F.lit(mask).cast("long"))
    return c


def morton3(x: Column, y: Column, z: Column) -> Column:
    """Morton code of a cube with coordinates of up to 21 bits."""
    return _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1)).bitwiseOR(F.shiftleft(_spread(z), 2))


def on_sphere(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """Add ``__x, __y, __z`` in metres."""
    lo, la = F.radians(F.col(lon)), F.radians(F.col(lat))
    return df.withColumns(
        {
            "__x": F.lit(EARTH_RADIUS_M) * F.cos(la) * F.cos(lo),
            "__y": F.lit(EARTH_RADIUS_M) * F.cos(la) * F.sin(lo),
            "__z": F.lit(EARTH_RADIUS_M) * F.sin(la),
        }
    )


def chord_of(distance_m: float) -> float:
    """Straight-line distance of two points that are ``distance_m`` apart on the sphere."""
    return 2 * EARTH_RADIUS_M * math.sin(min(distance_m / (2 * EARTH_RADIUS_M), math.pi / 2))


def near_pairs(df: DataFrame, key: str, lon: str, lat: str, distance_m: float) -> DataFrame:
    """Pairs of rows at most ``distance_m`` apart: ``a, b, distance_m`` with a < b (by ``key``)."""
    side = max(2 * distance_m, 2 * EARTH_RADIUS_M / 2**20)
    reach = chord_of(distance_m)
    pts = df.select(F.col(key).alias("__id"), F.col(lon).alias("__lon"), F.col(lat).alias("__lat"))
    pts = pts.filter(F.col("__lon").isNotNull() & F.col("__lat").isNotNull() & ~F.isnan("__lon") & ~F.isnan("__lat") & F.col("__id").isNotNull())
    # both sides of the join read the positions: they are worked out from the geometries once
    pts = cut(on_sphere(pts, "__lon", "__lat").select("__id", "__x", "__y", "__z"))
    cell = lambda c: F.floor((F.col(c) + F.lit(EARTH_RADIUS_M + side)) / side)
    stored = pts.withColumn("__cell", morton3(cell("__x"), cell("__y"), cell("__z")))

    low = lambda c: F.floor((F.col(c) - reach + EARTH_RADIUS_M + side) / side)
    high = lambda c: F.floor((F.col(c) + reach + EARTH_RADIUS_M + side) / side)
    probe = stored
    for c in ("x", "y", "z"):
        probe = probe.withColumn(f"__c{c}", F.explode(F.sequence(low(f"__{c}"), high(f"__{c}"))))
    # leave out cubes that the sphere doesn't cut: nearest corner beyond it, or farthest within
    edge = lambda c: F.col(f"__c{c}") * side - (EARTH_RADIUS_M + side)
    near2 = sum(F.pow(F.greatest(edge(c), -(edge(c) + side), F.lit(0.0)), 2) for c in "xyz")
    far2 = sum(F.pow(F.greatest(F.abs(edge(c)), F.abs(edge(c) + side)), 2) for c in "xyz")
    slack = 1.0
    probe = probe.filter((near2 <= (EARTH_RADIUS_M + slack) ** 2) & (far2 >= (EARTH_RADIUS_M - slack) ** 2))
    probe = probe.withColumn("__probe", morton3(F.col("__cx"), F.col("__cy"), F.col("__cz"))).filter(F.col("__probe") >= F.col("__cell"))

    a = probe.select(F.col("__id").alias("ia"), F.col("__x").alias("xa"), F.col("__y").alias("ya"), F.col("__z").alias("za"), F.col("__cell").alias("own"), F.col("__probe").alias("code"))
    b = stored.select(F.col("__id").alias("ib"), F.col("__x").alias("xb"), F.col("__y").alias("yb"), F.col("__z").alias("zb"), F.col("__cell").alias("code"))
    d2 = F.pow(F.col("xa") - F.col("xb"), 2) + F.pow(F.col("ya") - F.col("yb"), 2) + F.pow(F.col("za") - F.col("zb"), 2)
    met = a.hint("merge").join(b, "code").filter(((F.col("own") < F.col("code")) | (F.col("ia") < F.col("ib"))) & (F.col("ia") != F.col("ib")) & (d2 <= reach * reach))
    arc = F.asin(F.least(F.sqrt(d2) / (2 * EARTH_RADIUS_M), F.lit(1.0))) * (2 * EARTH_RADIUS_M)
    return met.select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"), arc.alias("distance_m"))


# --- regions -------------------------------------------------------------------------------

#: Depth of the quadtree; its finest cells are about 0.0003 degrees wide.
DEPTH = 20
#: Most regions that are collected and covered on the driver.
DRIVER_REGIONS = 5000
#: Most cell ranges that one region's cover may have.
RANGES = 48


def morton2(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    """Morton codes of depth :data:`DEPTH` of positions in degrees."""
    side = 1 << DEPTH
    x = np.clip((np.mod(lon + 180, 360) / 360 * side).astype(np.int64), 0, side - 1)
    y = np.clip(((lat + 90) / 180 * side).astype(np.int64), 0, side - 1)

    def part(v: np.ndarray) -> np.ndarray:
        for by, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = (v | (v << by)) & mask
        return v

    return part(x) | (part(y) << 1)


def cover(e: G.Edges, vertical: tuple[np.ndarray, ...], row: int, box: tuple[float, float, float, float], most: int = RANGES) -> list[tuple[int, int, bool]]:
    """Code ranges [from, to) that cover a filled area, and whether each lies inside it.

    ``vertical`` are the edges that ``e`` doesn't hold (:func:`geometry.vertical_edges`). The
    largest border cell is divided first, until the number of cells reaches ``most``.
    """
    i = slice(e.start[row], e.start[row] + e.count[row])
    xl, yl, xr, yr = e.xl[i], e.yl[i], e.xr[i], e.yr[i]
    vx, vlow, vhigh = (v[vertical[0] == row] for v in vertical[1:])

    def state(x0: float, y0: float, x1: float, y1: float) -> int:
        """0 outside, 1 border, 2 inside; the longitudes of the area may pass 180."""
        worst = 0
        for shift in (0.0, 360.0):
            a, b = x0 + shift, x1 + shift
            if b < box[0] or a > box[2] or y1 < box[1] or y0 > box[3]:
                continue
            on = (xl <= b) & (xr >= a)
            if on.any():
                slope = (yr[on] - yl[on]) / (xr[on] - xl[on])
                left = yl[on] + slope * (np.maximum(xl[on], a) - xl[on])
                right = yl[on] + slope * (np.minimum(xr[on], b) - xl[on])
                if ((np.maximum(left, right) >= y0) & (np.minimum(left, right) <= y1)).any():
                    return 1
            if ((vx >= a) & (vx <= b) & (vhigh >= y0) & (vlow <= y1)).any():
                return 1
            # no edge meets the cell, so it is inside or outside as a whole
            if G.points_in(e, np.array([row]), np.array([(a + b) / 2]), np.array([(y0 + y1) / 2]))[0]:
                worst = 2
        return worst

    cells = [(0, 0, 0)]  # depth, x, y
    done: list[tuple[int, int, bool]] = []
    border: list[tuple[int, int, int]] = []
    while cells:
        nxt = []
        for depth, x, y in cells:
            w, h = 360 / (1 << depth), 180 / (1 << depth)
            s = state(x * w - 180, y * h - 90, (x + 1) * w - 180, (y + 1) * h - 90)
            if s == 0:
                continue
            if s == 1 and depth < DEPTH:
                nxt.append((depth, x, y))
            else:
                border.append((depth, x, y)) if s == 1 else done.append((depth, x, y))
        if len(done) + len(border) + 4 * len(nxt) > most:
            border += nxt
            break
        cells = [(d + 1, 2 * x + i, 2 * y + j) for d, x, y in nxt for i in (0, 1) for j in (0, 1)]
    out = []
    for kind, group in ((True, done), (False, border)):
        for depth, x, y in group:
            w, h = 360 / (1 << depth), 180 / (1 << depth)
            first = int(morton2(np.array([(x + 0.5) * w - 180]), np.array([(y + 0.5) * h - 90]))[0])
            step = 1 << (2 * (DEPTH - depth))
            first -= first % step
            out.append((first, first + step, kind))
    return sorted(out)


def containing_regions(points: DataFrame, key: str, lon: str, lat: str, regions: DataFrame, region_key: str, geometry: str) -> DataFrame:
    """``key, region_key`` for each region that contains each point.

    Regions are counted first. Up to ``DRIVER_REGIONS`` they are covered once on the driver and travel with the
    tasks; more of them meet the points by the join of boxes in cells, tested exactly as well.
    """
    if regions.count() > DRIVER_REGIONS:
        dot = F.concat(F.lit("POINT ("), F.col(lon).cast("string"), F.lit(" "), F.col(lat).cast("string"), F.lit(")"))
        there = F.col(lon).isNotNull() & F.col(lat).isNotNull() & ~F.isnan(lon) & ~F.isnan(lat)
        dots = points.filter(there).select(F.col(key).alias("__key"), dot.alias("__dot"))
        met = spatial_join(dots, regions.select(F.col(region_key).alias("__region"), F.col(geometry).alias("__shape")), ("__dot", "__shape"), st.st_within)
        # shapes beyond 180 degrees also hold the positions one turn west of them
        again = spatial_join(points.filter(there & (F.col(lon) < 0)).select(F.col(key).alias("__key"), F.concat(F.lit("POINT ("), (F.col(lon) + 360).cast("string"), F.lit(" "), F.col(lat).cast("string"), F.lit(")")).alias("__dot")), regions.select(F.col(region_key).alias("__region"), F.col(geometry).alias("__shape")), ("__dot", "__shape"), st.st_within)
        return met.unionByName(again).select(F.col("__key").alias(key), F.col("__region").alias(region_key))
    rows = regions.select(region_key, geometry).collect()
    blobs = [r[1] for r in rows]
    rings = G.decode_wkb(blobs) if dict(regions.dtypes)[geometry] == "binary" else G.decode_wkt(blobs)
    m, e, vertical = G.measure(rings), G.filled_edges(rings), G.vertical_edges(rings)
    # overlapping covers (a country and its parts) are flattened by listing each region's ranges apart
    covers = []
    for i in range(len(rows)):
        if m.has[i] and e.count[i]:
            c = cover(e, vertical, i, (m.xmin[i], m.ymin[i], m.xmax[i], m.ymax[i]))
            covers.append((i, np.array([a for a, _, _ in c], np.int64), np.array([b for _, b, _ in c], np.int64), np.array([k for _, _, k in c], bool)))
    names, name_type = [r[0] for r in rows], to_arrow_type(regions.schema[region_key].dataType)
    schema = f"{key} {dict(points.dtypes)[key]}, {region_key} {dict(regions.dtypes)[region_key]}"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (b.column(k).to_numpy(zero_copy_only=False).astype(float) for k in (1, 2))
            ok = np.flatnonzero(np.isfinite(x) & np.isfinite(y))
            code = morton2(x[ok], y[ok])
            order = np.argsort(code, kind="stable")
            ok, code = ok[order], code[order]
            who, where = [], []
            for i, start, end, inside in covers:
                lo, hi = np.searchsorted(code, start), np.searchsorted(code, end)  # sorted codes against sorted ranges
                for full in (True, False):
                    pick = [np.arange(a, z) for a, z, f in zip(lo, hi, inside) if f == full and z > a]
                    if not pick:
                        continue
                    p = ok[np.concatenate(pick)]
                    if not full:
                        # positions west of an unrolled region's box are meant one turn further east
                        px = np.where(x[p] < m.xmin[i], x[p] + 360, x[p])
                        p = p[G.points_in(e, np.full(len(p), i), px, y[p])]
                    who.append(p)
                    where.append(np.full(len(p), i))
            if who:
                p, w = np.concatenate(who), np.concatenate(where)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(p)), pa.array(names, name_type).take(pa.array(w))], names=[key, region_key])

    return points.select(key, lon, lat).mapInArrow(assign, schema)

"""Hexagonal cells of equal area, in sixteen resolutions of aperture seven.

This is this library's own grid, not any published index: hexagons in the cylindrical
equal-area projection, so all cells of a resolution have the same true area, and a position's
cell is a JVM expression. An identifier holds the resolution and two axial coordinates in one
long. Neighbours across the 180th meridian are not joined; near the poles cells are stretched.

Defined results: null in, null out; identifiers sort by resolution, then column.
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

R = 6371.0072  # km, of the sphere with the ellipsoid's area
#: Area of a cell of resolution 0 in km²; each resolution has a seventh of the one before.
AREA_0 = 4_357_449.0
_OFFSET = 1 << 27


def cell_area_km2(res: int) -> float:
    return AREA_0 / 7**res


def _edge(res: int) -> float:
    return math.sqrt(2 * cell_area_km2(res) / (3 * math.sqrt(3)))


def latlng_to_cell(lat: Column, lng: Column, res: int) -> Column:
    """Cell of a position, as a long."""
    s = _edge(res)
    x = F.lit(R) * F.radians(lng)
    y = F.lit(R) * F.sin(F.radians(lat))
    q = x * (math.sqrt(3) / 3 / s) - y * (1 / 3 / s)
    r = y * (2 / 3 / s)
    rq, rr, rs = F.rint(q), F.rint(r), F.rint(-q - r)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs + q + r)
    fq = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    fr = F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)
    return F.lit(res).cast("bigint") * F.lit(1 << 56) + (fq.cast("bigint") + _OFFSET) * F.lit(1 << 28) + (fr.cast("bigint") + _OFFSET)


def cell_resolution(cell: Column) -> Column:
    return F.shiftright(cell, 56).cast("int")


def cell_to_latlng(cell: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of a cell's centre."""
    q = (F.shiftright(cell, 28).bitwiseAND(F.lit((1 << 28) - 1)) - _OFFSET).cast("double")
    r = (cell.bitwiseAND(F.lit((1 << 28) - 1)) - _OFFSET).cast("double")
    edge = F.element_at(F.array(*[F.lit(_edge(k)) for k in range(16)]), cell_resolution(cell) + 1)
    x, y = edge * math.sqrt(3) * (q + r / 2), edge * 1.5 * r
    return F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), y / R)))), F.degrees(x / R)


def cell_to_string(cell: Column) -> Column:
    return F.lower(F.hex(cell))


def string_to_cell(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("bigint")


def _corners(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    q = ((cells >> 28) & ((1 << 28) - 1)) - _OFFSET
    r = (cells & ((1 << 28) - 1)) - _OFFSET
    s = np.array([_edge(k) for k in range(16)])[cells >> 56]
    a = np.radians(np.arange(6) * 60 - 30)
    x = (s * math.sqrt(3) * (q + r / 2))[:, None] + s[:, None] * np.cos(a)
    y = (s * 1.5 * r)[:, None] + s[:, None] * np.sin(a)
    return np.degrees(x / R), np.degrees(np.arcsin(np.clip(y / R, -1, 1)))


@F.arrow_udf(T.StringType())
def cell_to_boundary_wkt(cell: pa.Array) -> pa.Array:
    ok = cell.is_valid().to_numpy(zero_copy_only=False)
    x, y = _corners(cell.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    out = []
    for k in range(len(ok)):
        ring = [f"{a:.12g} {b:.12g}" for a, b in zip(x[k], y[k])] if ok[k] else []
        out.append("POLYGON ((" + ", ".join([*ring, ring[0]]) + "))" if ring else None)
    return pa.array(out, pa.string())


def _cells_of(lat: np.ndarray, lng: np.ndarray, res: int) -> np.ndarray:
    s = _edge(res)
    x, y = R * np.radians(lng), R * np.sin(np.radians(lat))
    q, r = x * math.sqrt(3) / 3 / s - y / 3 / s, y * 2 / 3 / s
    rq, rr, rs = np.rint(q), np.rint(r), np.rint(-q - r)
    dq, dr, ds = np.abs(rq - q), np.abs(rr - r), np.abs(rs + q + r)
    first = (dq > dr) & (dq > ds)
    fq = np.where(first, -rr - rs, rq)
    fr = np.where(first, rr, np.where(dr > ds, -rq - rs, rr))
    return (np.int64(res) << 56) + ((fq.astype(np.int64) + _OFFSET) << 28) + fr.astype(np.int64) + _OFFSET


def polygon_to_cells(res: int):
    """Function of a geometry: the sorted cells whose centres lie in it."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def f(g: pa.Array) -> pa.Array:
        r = decode(g)
        m, e = G.measure(r), G.filled_edges(r)
        s = _edge(res)
        out = []
        for k in range(r.n):
            if not m.has[k] or not e.count[k]:
                out.append(None if r.kinds[k] == "NULL" else [])
                continue
            y0, y1 = (R * math.sin(math.radians(v)) for v in (m.ymin[k], m.ymax[k]))
            x0, x1 = R * math.radians(m.xmin[k]), R * math.radians(m.xmax[k])
            rows = np.arange(math.floor(y0 / (1.5 * s)) - 1, math.ceil(y1 / (1.5 * s)) + 2)
            found = []
            for rr in rows:  # one row of cells at a time, so memory follows the row
                qs = np.arange(math.floor(x0 / (math.sqrt(3) * s) - rr / 2) - 1, math.ceil(x1 / (math.sqrt(3) * s) - rr / 2) + 2)
                px = np.degrees(s * math.sqrt(3) * (qs + rr / 2) / R)
                sy = s * 1.5 * rr / R
                if abs(sy) > 1:
                    continue
                py = np.full(len(qs), math.degrees(math.asin(sy)))
                hit = G.points_in(e, np.full(len(qs), k), px, py)
                found.append((np.int64(res) << 56) + ((qs[hit].astype(np.int64) + _OFFSET) << 28) + np.int64(int(rr) + _OFFSET))
            out.append(np.sort(np.concatenate(found)).tolist() if found else [])
        return pa.array(out, pa.list_(pa.int64()))

    return f


def register(spark: SparkSession) -> None:
    """``hex_cell_to_boundary_wkt`` for SQL; the other functions are plain expressions."""
    spark.udf.register("hex_cell_to_boundary_wkt", cell_to_boundary_wkt)

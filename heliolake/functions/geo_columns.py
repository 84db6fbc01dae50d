"""Columns of measures from a geometry column, in one Arrow pass: only that column leaves the JVM."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliolake.functions import geometry as G

#: Fields of :class:`heliolake.functions.geometry.Measures` that a column can hold.
MEASURES = ("area_deg2", "area_m2", "cx", "cy", "xmin", "ymin", "xmax", "ymax")


def decode(column: pa.Array) -> G.RingSet:
    """Text or binary geometries, by the column's own type."""
    values = column.to_pylist()
    return G.decode_wkb(values) if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else G.decode_wkt(values)


def measures(geometry: Column, *names: str) -> Column:
    """Struct of the named measures; a field is null where the geometry has no vertices.

    Marked as not deterministic, so that the optimizer never works it out twice, once below a
    pushed filter and once for the result. Filter by other columns before.
    """
    chosen = names or MEASURES

    @F.arrow_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in chosen]))
    def of(column: pa.Array) -> pa.Array:
        m = G.measure(decode(column))
        return pa.StructArray.from_arrays([pa.array(getattr(m, n), mask=~m.has) for n in chosen], names=list(chosen))

    return of.asNondeterministic()(geometry)


@F.arrow_udf(T.StructType([*[T.StructField(n, T.DoubleType()) for n in ("xmin", "ymin", "xmax", "ymax")], T.StructField("full", T.BooleanType())]))
def _outline(column: pa.Array) -> pa.Array:
    r = decode(column)
    m = G.measure(r)
    names = ["xmin", "ymin", "xmax", "ymax"]
    return pa.StructArray.from_arrays([*[pa.array(getattr(m, n), mask=~m.has) for n in names], pa.array(G.rectangles(r))], names=[*names, "full"])


def outline(geometry: Column) -> Column:
    """Struct of the box, null where the geometry has no vertices, and ``full``: is it a polygon that fills its box? Not deterministic, as :func:`measures`."""
    return _outline.asNondeterministic()(geometry)


def with_position(df: DataFrame, geometry: str, lon: str = "pos_lon", lat: str = "pos_lat") -> DataFrame:
    """Add the area centroid (the point itself for points, null if empty)."""
    m = df.withColumn("__m", measures(F.col(f"`{geometry}`"), "cx", "cy"))
    return m.withColumns({lon: F.col("__m.cx"), lat: F.col("__m.cy")}).drop("__m")

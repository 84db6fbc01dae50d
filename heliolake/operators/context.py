"""Context of sites from other layers, cell indexing of shapes, and the older consolidation's operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliolake.functions import geometry as G
from heliolake.functions import hexcells as H
from heliolake.functions import st
from heliolake.functions.geo_columns import decode, measures
from heliolake.operators import products as P
from heliolake.operators import relational as R
from heliolake.operators.geojoin import box_pairs, distinct_join
from heliolake.session import cut

#: Number of the cell resolutions that products use, and of sensors.
RESOLUTIONS = {"dedup": 12, "country": 4, "boundaries": 6, "default": 8, "hexgrid": 5}
PREDICATES: dict[str, Callable[[Column, Column], Column]] = {"intersects": st.st_intersects, "within": st.st_within, "overlaps": st.st_overlaps}


def resolution_for(use: str | None) -> int:
    """Resolution of a use case; 10 for an unknown one."""
    return RESOLUTIONS.get(use or "", 10)


def predicate_of(name: str) -> Callable[[Column, Column], Column]:
    """Predicate by name; an unknown name means intersects."""
    return PREDICATES.get((name or "").lower(), st.st_intersects)


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def with_defaults(df: DataFrame, defaults: dict[str, tuple[str, object]]) -> DataFrame:
    """Columns ``{name: (type, default)}`` exist with their type; missing ones and nulls take the default (null for None)."""
    out = {}
    for name, (kind, default) in defaults.items():
        have = F.col(f"`{name}`").try_cast(kind) if name in df.columns else F.lit(None).cast(kind)
        out[name] = have if default is None else F.coalesce(have, F.lit(default).cast(kind))
    return df.withColumns(out)


def layer_context(sites: DataFrame, layer: DataFrame, key: str, site_geometry: str, layer_geometry: str, layer_key: str, keep: list[str], prefer: list[Column], flag: str, predicate: str = "intersects", countries: tuple[str, str] | None = None) -> DataFrame:
    """Each site with the best matching feature of a layer (buildings, land use, land cover) and a flag.

    ``prefer`` ranks matches, greatest first; ties go to the smallest ``layer_key``. ``countries`` are
    the country columns of both sides: features of countries without sites are left out before the
    join, unless that would leave none. Sites without a match keep nulls and a false flag.
    """
    if countries:
        there = sites.select(F.col(countries[0]).alias(countries[1])).distinct()
        own = layer.join(there, countries[1], "left_semi")
        layer = own if not own.isEmpty() else layer
    names = [layer_key, *[c for c in keep if c != layer_key]]
    order = [F.col("__rank").desc(), F.col(layer_key).asc_nulls_last()]
    # of equal shapes only the best one can be chosen, and sites of equal geometry have the same match, so distinct shapes are joined
    right = layer.select(F.col(layer_geometry).alias("__rg"), F.struct(*prefer).alias("__rank"), *names)
    # keyed by a number first: it sorts faster than texts that begin alike
    right = R.best_match(right.filter(F.col("__rg").isNotNull()).withColumn("__h", F.xxhash64("__rg")), ["__h", "__rg"], order).drop("__h")
    left = cut(sites.select(key, F.col(site_geometry).alias("__lg")).filter(F.col("__lg").isNotNull()))
    met = distinct_join(left.select("__lg").distinct(), right, predicate_of(predicate))
    first = R.best_match(met.select("__lid", "__lg", "__rank", *names), ["__lid"], order).drop("__lid")
    best = R.best_match(left.join(first, "__lg"), [key], order).select(key, *names)
    return sites.join(best.withColumn(flag, F.lit(True)), key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def building_preference() -> list[Column]:
    """Tallest with a known height, else the largest."""
    return [F.col("height").isNotNull(), F.col("height"), F.col("feature_area")]


def unified_context(sites: DataFrame, layers: list[DataFrame], key: list[str]) -> DataFrame:
    """Sites with all layers' columns, by key, and the scores of :func:`products.site_scores`."""
    out = sites
    for layer in layers:
        out = out.join(layer, key, "left")
    text = {c: ("string", "unknown") for c in ("building_relationship", "land_use_type", "land_use_suitability", "land_cover_type", "ecosystem_type", "environmental_impact", "admin_level")}
    flags = {c: ("boolean", False) for c in ("has_admin", "has_building", "has_land_use", "has_land_cover")}
    return P.site_scores(with_defaults(out, text | flags))


def final_types(df: DataFrame, numbers: list[str], booleans: list[str]) -> DataFrame:
    """Numbers are doubles, 0 where unreadable; booleans false where null."""
    return with_defaults(df, {c: ("double", 0.0) for c in numbers} | {c: ("boolean", False) for c in booleans})


# --- cells of shapes -----------------------------------------------------------------------


def cells_of_shapes(df: DataFrame, geometry: str, res: int) -> DataFrame:
    """Coverage: ``cells`` whose centres lie in the shape, or the centroid's cell where there is none, and the first as ``primary_cell``."""
    m = df.withColumns({"__cells": H.polygon_to_cells(res)(F.col(geometry)), "__m": measures(F.col(geometry), "cx", "cy")})
    own = F.when(F.col("__m.cx").isNotNull(), F.array(H.latlng_to_cell(F.col("__m.cy"), F.col("__m.cx"), res)))
    cells = F.when(F.size("__cells") > 0, F.col("__cells")).otherwise(own)
    return m.withColumn("cells", cells).withColumn("primary_cell", F.try_element_at("cells", F.lit(1))).drop("__cells", "__m")


def representative_cells(df: DataFrame, key: str, geometry: str, res: int) -> DataFrame:
    """``key, cell``: of the cells that a shape covers the one with the largest common area, ties to the smallest."""
    c = cells_of_shapes(df.select(key, geometry), geometry, res).select(key, geometry, F.explode("cells").alias("cell"))
    c = c.withColumn("__w", st.st_intersection_area(F.col(geometry), H.cell_to_boundary_wkt("cell")))
    return R.best_by(c, [key], F.struct("__w", -F.col("cell")), "cell")


@F.pandas_udf(T.StringType())
def st_union_agg(g: pd.Series) -> str:
    """Union of a group's areas, overlaps counted once, as a multipolygon."""
    r = G.decode_wkt(list(dict.fromkeys(t for t in g if t)))
    e = G.filled_edges(r)
    return st.overlay([st.edges_of(e, k) for k in range(r.n) if e.count[k]], True)


def group_by_cells(df: DataFrame, cell: str, area: str, geometry: str, parts: int = 64) -> DataFrame:
    """Count, sum and mean of area, the dissolved shapes and the cell's border, by cell.

    Shapes are dissolved in ``parts`` parts of a cell, told by a hash of the shape, and then the parts'
    unions, so a crowded cell isn't one task's.
    """
    numbers = df.groupBy(cell).agg(F.count("*").alias("n"), F.sum(area).alias("total_area"), F.avg(area).alias("mean_area"))
    some = df.withColumn("__s", F.pmod(F.xxhash64(geometry), F.lit(parts))).groupBy(cell, "__s").agg(st_union_agg(F.col(geometry)).alias("__u"))
    shapes = some.groupBy(cell).agg(st_union_agg(F.col("__u")).alias("shapes"))
    return numbers.join(shapes, cell).withColumn("cell_geometry", H.cell_to_boundary_wkt(cell))


def partition_level(area_deg2: Column) -> Column:
    """Quadtree level of a partition key by area in square degrees: 8, 10 or 12."""
    return F.when(area_deg2 > 0.01, 8).when(area_deg2 > 0.001, 10).otherwise(12)


# --- the older consolidation ---------------------------------------------------------------


def greedy_dedup(df: DataFrame, key: str, geometry: str, threshold: float = 0.5) -> DataFrame:
    """Equal geometries once (smallest key), then of every pair that shares more than ``threshold`` of the smaller one the larger goes, of equal areas the one with the larger key."""
    once = R.best_match(df.filter(F.col(geometry).isNotNull()), [geometry], [F.col(key).asc()])
    m = cut(once.withColumn("__m", measures(F.col(geometry), "area_deg2", "xmin", "ymin", "xmax", "ymax")).filter("__m.area_deg2 > 0"))
    edges = ("xmin", "ymin", "xmax", "ymax")
    boxes = lambda p: m.select(F.col(key).alias(f"{p}id"), *[F.col(f"__m.{c}").alias(f"{p}{c}") for c in edges])
    pairs = box_pairs(boxes("a"), boxes("b")).filter("aid < bid")
    shape = lambda p: m.select(F.col(key).alias(f"{p}id"), F.col(geometry).alias(f"{p}g"), F.col("__m.area_deg2").alias(f"{p}a"))
    hit = pairs.join(shape("a"), "aid").join(shape("b"), "bid").withColumn("c", st.st_intersection_area("ag", "bg")).filter(F.col("c") / F.least("aa", "ba") > threshold)
    gone = hit.select(F.when(F.col("aa") > F.col("ba"), F.col("aid")).otherwise(F.col("bid")).alias(key)).distinct()
    return once.join(gone, key, "left_anti")


def legacy_record(df: DataFrame, dataset: str, ids: list[str], keep: list[str], geometry: str = "geometry") -> DataFrame:
    """Projection of one source: polygons only, measures, and sha256 of id and dataset; rows without an id get ``NO_ID_`` and a number of their own."""
    m = df.withColumns({"__own": R.candidate(df, ids, "string"), "__m": measures(F.col(geometry), "cx", "cy"), "__k": st.st_geometrytype(F.col(geometry))})
    m = R.numbered_ids(m.filter(F.col("__k").isin("POLYGON", "MULTIPOLYGON")), "__own")
    return m.select(
        F.sha2(F.concat_ws("_", F.col("__own"), F.lit(dataset)), 256).alias("unified_id"),
        F.lit(dataset).alias("dataset"),
        st.st_area_mercator(F.col(geometry)).alias("area_m2"),
        st.st_area_spheroid(F.col(geometry)).alias("spheroid_area"),
        F.col("__m.cx").alias("centroid_lon"),
        F.col("__m.cy").alias("centroid_lat"),
        *[F.col(f"`{c}`") for c in keep if c in df.columns],
        F.col(geometry).alias("geometry"),
    )


def excluded_kinds(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Number of rows of each geometry type that :func:`legacy_record` leaves out."""
    return df.groupBy(st.st_geometrytype(F.col(geometry)).alias("kind")).agg(F.count("*").alias("n")).filter("kind IS NULL OR kind NOT IN ('POLYGON', 'MULTIPOLYGON')")


def readable_files(spark: SparkSession, paths: list[str], required: list[str]) -> list[str]:
    """Parquet files whose schema holds every required column; only footers are read."""
    return [p for p in paths if set(required) <= set(spark.read.parquet(p).columns)]


def minus_one_for_missing(c: Column) -> Column:
    """-1 for null and NaN, as the older table stores them."""
    return F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(-1.0)).otherwise(c)


def coerced(df: DataFrame) -> DataFrame:
    """Text columns that are numeric throughout become doubles; columns that are so in part stay text. One aggregate decides."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not text:
        return df
    facts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{k}") for k, c in enumerate(text)], *[F.count(F.col(f"`{c}`").try_cast("double")).alias(f"d{k}") for k, c in enumerate(text)]).first()
    return df.withColumns({c: F.col(f"`{c}`").try_cast("double") for k, c in enumerate(text) if facts[f"n{k}"] and facts[f"n{k}"] == facts[f"d{k}"]})


def annotations_to_shapes(df: DataFrame, column: str) -> DataFrame:
    """JSON annotations ``polygons[].points[].x,y`` and ``clicks[].x,y`` as WKT, one a row; rings are closed."""
    schema = "struct<polygons:array<struct<points:array<struct<x:double,y:double>>>>,clicks:array<struct<x:double,y:double>>>"
    a = df.withColumn("__a", F.from_json(column, schema))
    at = lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
    ring = lambda pts: F.concat(F.lit("POLYGON (("), F.concat_ws(", ", F.transform(pts, at), F.array(at(F.get(pts, 0)))), F.lit("))"))
    polygons = F.transform(F.filter("__a.polygons", lambda p: F.size(p["points"]) >= 3), lambda p: ring(p["points"]))
    points = F.transform("__a.clicks", lambda p: F.concat(F.lit("POINT ("), at(p), F.lit(")")))
    none = F.array().cast("array<string>")
    return a.withColumn("geometry", F.explode(F.concat(F.coalesce(polygons, none), F.coalesce(points, none)))).drop("__a")


def unmatched_stems(images: DataFrame, masks: DataFrame, path: str) -> DataFrame:
    """Image paths without a mask of the same file stem."""
    stem = F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)
    return images.withColumn("__stem", stem).join(masks.select(stem.alias("__stem")).distinct(), "__stem", "left_anti").drop("__stem")


def nearest_rank(df: DataFrame, by: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """Position within a group, for report tables of bounded groups."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def vertices(df: DataFrame, key: str, geometry: str) -> DataFrame:
    """``key, ring, place, lon, lat`` of every vertex."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = decode(b.column(1))
            row = r.row[r.ring] if len(r.x) else np.zeros(0, np.int64)
            start = np.flatnonzero(np.concatenate(([True], r.ring[1:] != r.ring[:-1]))) if len(r.x) else np.zeros(0, int)
            first = start[r.ring] if len(r.x) else start
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(r.ring.astype(np.int32)), pa.array((np.arange(len(r.x)) - first).astype(np.int32)), pa.array(r.x), pa.array(r.y)], names=[key, "ring", "place", "lon", "lat"])

    return df.select(key, geometry).mapInArrow(run, f"{key} {kind}, ring int, place int, lon double, lat double")

"""Queries of the geometry functions, spatial joins, products, catalogs and sinks with their SQL.

Shapes are rectangles made from integer keys, written as text, so every result has a closed form in SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.functions import hexcells as H
from heliolake.functions import indexbits as I
from heliolake.functions import st
from heliolake.operators import context as C
from heliolake.operators import relational as R
from heliolake.operators import spatial
from heliolake.operators.geojoin import common_box_area, spatial_join, spatial_join_within_distance
from heliolake.plans import lakehouse, twins
from heliolake.plans.twins import LONLAT, RECT_CUSTOMER, RECT_PART, lonlat, rects
from heliolake.session import own_folder
from heliolake.sources import catalog, sinks
from heliolake.sources.tables import read_table as table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def twin(sql: str) -> Callable:
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return keep


def shapes(spark: SparkSession, sf: str, which: str) -> DataFrame:
    """Rectangles with their text in ``g``."""
    return rects(spark, sf, which).withColumn("g", st.envelope_wkt("x0", "y0", "x1", "y1"))


_RING = "{0}x0 || ' ' || {0}y0 || ', ' || {0}x1 || ' ' || {0}y0 || ', ' || {0}x1 || ' ' || {0}y1 || ', ' || {0}x0 || ' ' || {0}y1 || ', ' || {0}x0 || ' ' || {0}y0"


# --- functions -----------------------------------------------------------------------------


@twin(f"SELECT id, CAST((x1-x0)*(y1-y0) AS DOUBLE) AS area, (CAST(x0+x1 AS DOUBLE)/2 + 180) % 360 - 180 AS cx, CAST(y0+y1 AS DOUBLE)/2 AS cy, CAST(x0 AS DOUBLE) AS xmin, CAST(y0 AS DOUBLE) AS ymin, CAST(x1 AS DOUBLE) AS xmax, CAST(y1 AS DOUBLE) AS ymax FROM ({RECT_PART})")
def geo_measures(spark: SparkSession, sf: str) -> DataFrame:
    near = lambda f: F.round(f("g"), 6)
    return shapes(spark, sf, "part").select("id", near(st.st_area).alias("area"), near(st.st_x).alias("cx"), near(st.st_y).alias("cy"), st.st_xmin("g").alias("xmin"), st.st_ymin("g").alias("ymin"), st.st_xmax("g").alias("xmax"), st.st_ymax("g").alias("ymax"))


@twin(f"SELECT id, 'POLYGON ((' || {_RING.format('')} || '))' AS text, 93 AS n_bytes, (CAST(x0+x1 AS DOUBLE)/2 + 180) % 360 - 180 AS lon FROM ({RECT_PART})")
def geo_codec(spark: SparkSession, sf: str) -> DataFrame:
    """Text to binary and back, and the longitude of the centroid's own geometry."""
    d = shapes(spark, sf, "part").withColumn("b", st.st_aswkb("g"))
    return d.select("id", st.st_astext("b").alias("text"), F.length("b").alias("n_bytes"), F.round(st.st_x(st.st_centroid("b")), 6).alias("lon"))


_ODD = """CASE k % 6 WHEN 0 THEN 'POLYGON' WHEN 1 THEN 'POLYGON' WHEN 2 THEN 'POINT' WHEN 3 THEN 'POLYGON' WHEN 4 THEN NULL ELSE 'LINESTRING' END"""


@twin(f"""SELECT k, {_ODD} AS kind, CASE k % 6 WHEN 1 THEN 'false' WHEN 4 THEN NULL ELSE 'true' END AS valid, CASE k % 6 WHEN 3 THEN 'true' WHEN 4 THEN NULL ELSE 'false' END AS is_empty FROM (SELECT p_partkey AS k FROM part)""")
def geo_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Type, validity and emptiness of squares, bow ties, points, empty polygons, unreadable texts and lines."""
    d = table(spark, sf, "part", "p_partkey").select(F.col("p_partkey").alias("k"))
    n = (F.col("k") % 50).cast("string")
    at = lambda x, y: F.concat(x, F.lit(" "), y)
    zero, ten = F.lit("0"), F.lit("99")
    ring = lambda *p: F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[at(x, y) for x, y in (*p, p[0])]), F.lit("))"))
    g = (
        F.when(F.col("k") % 6 == 0, ring((zero, zero), (ten, zero), (ten, ten), (n, ten)))
        .when(F.col("k") % 6 == 1, ring((zero, zero), (ten, ten), (ten, zero), (n, ten)))
        .when(F.col("k") % 6 == 2, F.concat(F.lit("POINT ("), at(n, n), F.lit(")")))
        .when(F.col("k") % 6 == 3, F.lit("POLYGON EMPTY"))
        .when(F.col("k") % 6 == 4, F.lit("no shape"))
        .otherwise(F.concat(F.lit("LINESTRING (0 0, "), at(n, ten), F.lit(")")))
    )
    return d.select("k", st.st_geometrytype(g).alias("kind"), st.st_isvalid(g).cast("string").alias("valid"), st.st_isempty(g).cast("string").alias("is_empty"))


_PAIR = f"(SELECT c.id, c.x0 AS ax0, c.y0 AS ay0, c.x1 AS ax1, c.y1 AS ay1, c.x0 + c.id % 9 - 4 AS bx0, c.y0 + c.id % 7 - 3 AS by0, c.x0 + c.id % 9 - 4 + 1 + c.id % 13 AS bx1, c.y0 + c.id % 7 - 3 + 1 + c.id % 11 AS by1 FROM ({RECT_CUSTOMER}) c)"


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """A rectangle and another near it, which may lie inside, across, beside or be equal."""
    k = F.col("id")
    d = rects(spark, sf, "customer").select("id", *[F.col(c).alias(f"a{c}") for c in ("x0", "y0", "x1", "y1")])
    d = d.withColumns({"bx0": F.col("ax0") + k % 9 - 4, "by0": F.col("ay0") + k % 7 - 3}).withColumns({"bx1": F.col("bx0") + 1 + k % 13, "by1": F.col("by0") + 1 + k % 11})
    return d.withColumns({"a": st.envelope_wkt("ax0", "ay0", "ax1", "ay1"), "b": st.envelope_wkt("bx0", "by0", "bx1", "by1")})


_W, _H = "greatest(0, least(ax1, bx1) - greatest(ax0, bx0))", "greatest(0, least(ay1, by1) - greatest(ay0, by0))"
_A, _B = "(ax1-ax0)*(ay1-ay0)", "(bx1-bx0)*(by1-by0)"


@twin(f"""SELECT id, ax0 <= bx1 AND bx0 <= ax1 AND ay0 <= by1 AND by0 <= ay1 AS meet, {_W}*{_H} > 0 AND {_W}*{_H} < {_A} AND {_W}*{_H} < {_B} AS overlap,
bx0 >= ax0 AND bx1 <= ax1 AND by0 >= ay0 AND by1 <= ay1 AS b_within_a, ax0 = bx0 AND ay0 = by0 AND ax1 = bx1 AND ay1 = by1 AS equal,
CAST({_W}*{_H} AS DOUBLE) AS common FROM {_PAIR}""")
def geo_predicates(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf).select("id", st.st_intersects("a", "b").alias("meet"), st.st_overlaps("a", "b").alias("overlap"), st.st_within("b", "a").alias("b_within_a"), st.st_equals("a", "b").alias("equal"), F.round(st.st_intersection_area("a", "b"), 6).alias("common"))


@twin(f"""SELECT id, CAST({_W}*{_H} AS DOUBLE) AS area, CASE WHEN {_W}*{_H} > 0 THEN CAST(greatest(ax0, bx0) AS DOUBLE) END AS xmin, CASE WHEN {_W}*{_H} > 0 THEN CAST(least(ay1, by1) AS DOUBLE) END AS ymax FROM {_PAIR}""")
def geo_intersection(spark: SparkSession, sf: str) -> DataFrame:
    """What two rectangles have in common, as a geometry."""
    d = pairs(spark, sf).withColumn("c", st.st_intersection("a", "b"))
    return d.select("id", F.round(st.st_area("c"), 6).alias("area"), F.round(st.st_xmin("c"), 6).alias("xmin"), F.round(st.st_ymax("c"), 6).alias("ymax"))


@twin(f"SELECT id, sqrt(CAST(power(greatest(0, bx0 + 20 - ax1, ax0 - bx1 - 20), 2) + power(greatest(0, by0 - ay1, ay0 - by1), 2) AS DOUBLE)) <= 14 AS near FROM {_PAIR}")
def geo_dwithin(spark: SparkSession, sf: str) -> DataFrame:
    """Least distance of a rectangle and another moved away."""
    d = pairs(spark, sf).withColumns({"bx0": F.col("bx0") + 20, "bx1": F.col("bx1") + 20}).withColumn("b", st.envelope_wkt("bx0", "by0", "bx1", "by1"))
    return d.select("id", st.st_dwithin(14.0)("a", "b").alias("near"))


@twin(f"""WITH r AS (SELECT *, (x0//40)*100 + y0//40 AS cell FROM ({RECT_CUSTOMER})), u AS (SELECT DISTINCT cell, i, j FROM r, unnest(generate_series(x0, x1 - 1)) AS t(i), unnest(generate_series(y0, y1 - 1)) AS s(j))
SELECT r.cell, count(*) AS n, CAST(sum((x1-x0)*(y1-y0)) AS DOUBLE) AS total_area, CAST(any_value(u.area) AS DOUBLE) AS dissolved_area FROM r JOIN (SELECT cell, count(*) AS area FROM u GROUP BY 1) u ON u.cell = r.cell GROUP BY 1""")
def group_by_cells_dissolved(spark: SparkSession, sf: str) -> DataFrame:
    """Shapes of each cell dissolved into one: overlaps count once."""
    d = shapes(spark, sf, "customer").withColumns({"cell": F.expr("(x0 div 40)*100 + y0 div 40"), "area": F.expr("cast((x1-x0)*(y1-y0) as double)")})
    return C.group_by_cells(d, "cell", "area", "g").select("cell", "n", "total_area", F.round(st.st_area("shapes"), 6).alias("dissolved_area"))


# --- joins ---------------------------------------------------------------------------------

_MEET = "c.x0 <= p.x1 AND p.x0 <= c.x1 AND c.y0 <= p.y1 AND p.y0 <= c.y1"


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return shapes(spark, sf, "customer").select("id", "g"), shapes(spark, sf, "part").select(F.col("id").alias("part_id"), "g")


@twin(f"SELECT c.id, p.id AS part_id FROM ({RECT_CUSTOMER}) c JOIN ({RECT_PART}) p ON {_MEET}")
def join_geometry_inner(spark: SparkSession, sf: str) -> DataFrame:
    return spatial_join(*_sides(spark, sf), ("g", "g")).select("id", "part_id")


@twin(f"SELECT c.id, CAST(p.id AS DOUBLE) AS part_id FROM ({RECT_CUSTOMER}) c LEFT JOIN ({RECT_PART}) p ON p.x0 >= c.x0 AND p.x1 <= c.x1 AND p.y0 >= c.y0 AND p.y1 <= c.y1")
def join_geometry_left_within(spark: SparkSession, sf: str) -> DataFrame:
    """Left join by containment: rows without a match stay."""
    return spatial_join(*_sides(spark, sf), ("g", "g"), lambda a, b: st.st_within(b, a), "left").select("id", F.col("part_id").cast("double").alias("part_id"))


@twin(f"SELECT c.id FROM ({RECT_CUSTOMER}) c WHERE EXISTS (SELECT 1 FROM ({RECT_PART}) p WHERE p.x0 > c.x0 AND p.x1 < c.x1 AND p.y0 > c.y0 AND p.y1 < c.y1) OR EXISTS (SELECT 1 FROM ({RECT_PART}) p WHERE {_MEET} AND greatest(0, least(c.x1, p.x1) - greatest(c.x0, p.x0)) * greatest(0, least(c.y1, p.y1) - greatest(c.y0, p.y0)) > 0)")
def join_geometry_semi(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that share an area with some other."""
    return spatial_join(*_sides(spark, sf), ("g", "g"), lambda a, b: st.st_intersection_area(a, b) > 1e-9, "left_semi", by_box=lambda a, b: common_box_area(a, b) > 1e-9).select("id")


@twin(f"SELECT p.id AS part_id FROM ({RECT_PART}) p WHERE NOT EXISTS (SELECT 1 FROM ({RECT_CUSTOMER}) c WHERE {_MEET} AND c.id % 3 = p.id % 3 AND c.x0 >= 0 AND c.id IN (SELECT min(c_custkey) + k * 7 FROM customer, range(40) t(k) GROUP BY k))")
def join_geometry_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Parts that none of forty far-between rectangles of the same remainder meets."""
    left, right = _sides(spark, sf)
    first = table(spark, sf, "customer", "c_custkey").agg(F.min("c_custkey").alias("m"))
    few = left.crossJoin(F.broadcast(first)).filter(((F.col("id") - F.col("m")) % 7 == 0) & (F.col("id") < F.col("m") + 280)).drop("m")
    met = spatial_join(right, few.withColumnRenamed("g", "h"), ("g", "h")).filter(F.col("id") % 3 == F.col("part_id") % 3).select("part_id").distinct()
    return right.select("part_id").join(met, "part_id", "left_anti")


@twin(f"SELECT c.id, p.id AS part_id FROM ({RECT_CUSTOMER}) c JOIN ({RECT_PART}) p ON c.x0 - p.x1 <= 3 AND p.x0 - c.x1 <= 3 AND power(greatest(0, c.x0 - p.x1, p.x0 - c.x1), 2) + power(greatest(0, c.y0 - p.y1, p.y0 - c.y1), 2) <= 9")
def join_geometry_distance(spark: SparkSession, sf: str) -> DataFrame:
    return spatial_join_within_distance(*_sides(spark, sf), ("g", "g"), 3.0, degrees=True, by_box=True).select("id", "part_id")


@twin(f"""SELECT a.c_custkey AS a, b.c_custkey AS b FROM ({LONLAT}) a JOIN ({LONLAT}) b ON a.c_custkey < b.c_custkey
AND 2 * 6371008.8 * asin(least(1, sqrt(power(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * power(sin(radians(b.lon - a.lon) / 2), 2)))) <= 123456.7""")
def near_points(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of positions within some hundred kilometres, by the operator of problem 6."""
    lon, lat = lonlat()
    pts = table(spark, sf, "customer", "c_custkey").select("c_custkey", lon.alias("lon"), lat.alias("lat"))
    return spatial.near_pairs(pts, "c_custkey", "lon", "lat", 123_456.7).select("a", "b")


@twin(f"SELECT c.c_custkey, r.r_regionkey FROM ({LONLAT}) c JOIN region r ON c.lon >= r.r_regionkey*60-150 AND c.lon < r.r_regionkey*60-110.25 AND c.lat >= r.r_regionkey*20-60.25 AND c.lat < r.r_regionkey*20-10.25")
def regions_of_points(spark: SparkSession, sf: str) -> DataFrame:
    """The rectangles that contain each position; left and lower borders belong to them."""
    lon, lat = lonlat()
    pts = table(spark, sf, "customer", "c_custkey").select("c_custkey", lon.alias("lon"), lat.alias("lat"))
    k = F.col("r_regionkey").cast("double")
    boxes = table(spark, sf, "region", "r_regionkey").withColumns({"x0": k * 60 - 150, "x1": k * 60 - 110.25, "y0": k * 20 - 60.25, "y1": k * 20 - 10.25})
    return spatial.containing_regions(pts, "c_custkey", "lon", "lat", boxes.withColumn("g", st.envelope_wkt("x0", "y0", "x1", "y1")), "r_regionkey", "g")


# --- products ------------------------------------------------------------------------------


@twin(twins.ORACLE["overlap_dedup"])
def dedup_by_cell_geometry(spark: SparkSession, sf: str) -> DataFrame:
    """The deduplication by cells on geometries."""
    u = twins.celled_rects(spark, sf).withColumn("geometry", st.envelope_wkt("x0", "y0", "x1", "y1"))
    rows = u.select("cell", F.col("ds").alias("dataset_name"), F.col("id").cast("string").alias("unified_id"), F.col("area").cast("double").alias("area_m2"), "geometry")
    return lakehouse.dedup_by_cell(rows).select(F.col("dataset_name").alias("ds"), F.col("unified_id").cast("bigint").alias("id"))


@twin(f"""WITH r AS (SELECT min(id) AS id, x0, y0, x1, y1, (x1-x0)*(y1-y0) AS area FROM ({RECT_PART}) GROUP BY x0, y0, x1, y1),
gone AS (SELECT DISTINCT CASE WHEN a.area > b.area THEN a.id ELSE b.id END AS id FROM r a JOIN r b ON a.id < b.id AND CAST(greatest(0, least(a.x1,b.x1)-greatest(a.x0,b.x0))*greatest(0, least(a.y1,b.y1)-greatest(a.y0,b.y0)) AS DOUBLE) / least(a.area, b.area) > 0.5)
SELECT id FROM r WHERE id NOT IN (SELECT id FROM gone)""")
def greedy_dedup_geometry(spark: SparkSession, sf: str) -> DataFrame:
    return C.greedy_dedup(shapes(spark, sf, "part").select("id", "g"), "id", "g").select("id")


def _context_sql(order: str, cond: str, keep: str, where: str = "true") -> str:
    return f"""WITH p AS (SELECT *, CAST((x1-x0)*(y1-y0) AS DOUBLE) AS feature_area, CASE WHEN id % 3 = 0 THEN NULL ELSE CAST(id % 17 AS DOUBLE) END AS height, 'class' || (id % 4) AS class FROM ({RECT_PART}) WHERE {where}),
b AS (SELECT c.id, p.id AS feature_id, {keep}, row_number() OVER (PARTITION BY c.id ORDER BY {order}, p.id) AS k FROM ({RECT_CUSTOMER}) c JOIN p ON {cond})
SELECT c.id, CAST(b.feature_id AS DOUBLE) AS feature_id, {keep.replace("p.", "b.")}, b.id IS NOT NULL AS has_context FROM ({RECT_CUSTOMER}) c LEFT JOIN b ON b.id = c.id AND b.k = 1"""


def _context(spark: SparkSession, sf: str, keep: list[str], prefer: list[Column], predicate: str) -> DataFrame:
    sites = shapes(spark, sf, "customer").select("id", F.col("g").alias("geometry"))
    layer = shapes(spark, sf, "part").select(F.col("id").alias("feature_id"), F.col("g").alias("shape"), F.expr("cast((x1-x0)*(y1-y0) as double)").alias("feature_area"), F.when(F.col("id") % 3 != 0, (F.col("id") % 17).cast("double")).alias("height"), F.concat(F.lit("class"), (F.col("id") % 4).cast("string")).alias("class"))
    return C.layer_context(sites, layer, "id", "geometry", "shape", "feature_id", keep, prefer, "has_context", predicate).select("id", F.col("feature_id").cast("double").alias("feature_id"), *keep, "has_context")


@twin(_context_sql("p.height DESC NULLS LAST, p.feature_area DESC", _MEET, "p.height, p.feature_area"))
def context_buildings(spark: SparkSession, sf: str) -> DataFrame:
    """Sites with their building: the tallest of known height, else the largest; a flag for sites without one."""
    return _context(spark, sf, ["height", "feature_area"], C.building_preference(), "intersects")


@twin(_context_sql("p.feature_area DESC", _MEET, "p.class, p.feature_area"))
def context_land_use(spark: SparkSession, sf: str) -> DataFrame:
    """Sites with the largest land-use feature that meets them."""
    return _context(spark, sf, ["class", "feature_area"], [F.col("feature_area")], "intersects")


@twin(_context_sql("p.feature_area DESC", "c.x0 >= p.x0 AND c.x1 <= p.x1 AND c.y0 >= p.y0 AND c.y1 <= p.y1", "p.class"))
def context_land_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Sites with the largest land-cover feature that they lie within."""
    return _context(spark, sf, ["class"], [F.col("feature_area")], "within")


@twin(f"SELECT c_custkey, true AS same, 7 AS res FROM ({LONLAT})")
def hex_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Position to cell, to the cell's centre, to the same cell, and by text."""
    lon, lat = lonlat()
    d = table(spark, sf, "customer", "c_custkey").withColumn("cell", H.latlng_to_cell(lat, lon, 7))
    la, lo = H.cell_to_latlng(F.col("cell"))
    again = H.latlng_to_cell(la, lo, 7)
    return d.select("c_custkey", ((again == F.col("cell")) & (H.string_to_cell(H.cell_to_string(F.col("cell"))) == F.col("cell"))).alias("same"), H.cell_resolution(F.col("cell")).alias("res"))


_CELL = "(SELECT p_partkey AS k, (1::BIGINT << 59) + ((p_partkey % 16)::BIGINT << 52) + ((p_partkey * 7 % 130)::BIGINT << 45) + {0} AS cell FROM part)"
_DIGITS = " + ".join(f"(CASE WHEN p_partkey % 16 >= {k} THEN (p_partkey * {k} % 7)::BIGINT ELSE 7 END << {3 * (15 - k)})" for k in range(1, 16))


@twin(f"""SELECT k, CAST((cell >> 52) & 15 AS INTEGER) AS res, CAST((cell >> 45) & 127 AS INTEGER) AS base, lower(to_hex(cell)) AS text, CASE WHEN ((cell >> 52) & 15) >= 4 THEN lower(to_hex((cell & ~(15::BIGINT << 52)) | (4::BIGINT << 52) | ((1::BIGINT << 33) - 1))) END AS parent_4,
((cell >> 45) & 127) < 122 AS base_known FROM {_CELL.format(_DIGITS)}""")
def index_bits(spark: SparkSession, sf: str) -> DataFrame:
    """Resolution, base cell, text and parent of identifiers of the public index's layout."""
    k = F.col("k")
    cell = F.lit(1 << 59) + F.shiftleft((k % 16).cast("bigint"), 52) + F.shiftleft((k * 7 % 130).cast("bigint"), 45)
    for n in range(1, 16):
        cell = cell + F.shiftleft(F.when(k % 16 >= n, k * n % 7).otherwise(7).cast("bigint"), 3 * (15 - n))
    d = table(spark, sf, "part", "p_partkey").select(F.col("p_partkey").cast("bigint").alias("k")).withColumn("cell", cell)
    c = F.col("cell")
    return d.select("k", I.resolution(c).alias("res"), I.base_cell(c).alias("base"), I.to_text(c).alias("text"), I.to_text(I.parent(I.from_text(I.to_text(c)), 4)).alias("parent_4"), (I.base_cell(c) < I.BASE_CELLS).alias("base_known"))


# --- statements, catalog, sinks ------------------------------------------------------------


@twin("SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT n_nationkey, n_name FROM nation")
def union_positional(spark: SparkSession, sf: str) -> DataFrame:
    parts = [table(spark, sf, t, k, n).select(F.col(k).alias("id") if t == "customer" else k, F.col(n).alias("name") if t == "customer" else n) for t, k, n in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("nation", "n_nationkey", "n_name"))]
    return R.union_all(parts)


@twin("SELECT count(*) AS n, count(DISTINCT id) AS distinct_ids, count(*) FILTER (WHERE id LIKE 'NO_ID_%') AS made, max(TRY_CAST(substr(id, 7) AS BIGINT)) FILTER (WHERE id LIKE 'NO_ID_%') AS last FROM (SELECT CASE WHEN c_custkey % 4 = 0 THEN 'NO_ID_' || row_number() OVER (PARTITION BY c_custkey % 4 = 0) ELSE CAST(c_custkey AS VARCHAR) END AS id FROM customer)")
def surrogate_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without an id get one of their own."""
    c = table(spark, sf, "customer", "c_custkey").select(F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey").cast("string")).alias("id"))
    made = F.col("id").startswith("NO_ID_")
    return R.numbered_ids(c, "id").agg(F.count("*").alias("n"), F.count_distinct("id").alias("distinct_ids"), F.count_if(made).alias("made"), F.max(F.when(made, F.substring("id", 7, 20).cast("bigint"))).alias("last"))


@twin("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)")
def delete_not_in(spark: SparkSession, sf: str) -> DataFrame:
    """What a DELETE of the rows whose key isn't in another table leaves."""
    kept = table(spark, sf, "orders", "o_custkey", "o_totalprice").filter("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey"))
    return R.deleted_where_not_in(table(spark, sf, "customer", "c_custkey", "c_name"), kept, "c_custkey")


@twin("SELECT md5(count(*) || ':[''n_nationkey'', ''n_regionkey'']') AS digest, count(*) AS n FROM nation")
def structure_digest(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation", "n_regionkey", "n_nationkey")
    return n.agg(F.lit(R.structure_hash(n)).alias("digest"), F.count("*").alias("n"))


@twin("SELECT division_id, subtype FROM overture_division_area WHERE theme = 'divisions' AND bbox.xmin <= 15 AND bbox.xmax >= -12 AND bbox.ymin <= 60 AND bbox.ymax >= 35")
def theme_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Features of a theme in a box."""
    return catalog.theme_scan(table(spark, sf, "overture_division_area", "division_id", "subtype", "theme", "bbox"), (-12, 35, 15, 60), "divisions").select("division_id", "subtype")


@twin("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def partitioned_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Folders by key, read again through a glob with two of them."""
    path = own_folder(spark, "copy")
    catalog.copy_to(table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderpriority"), path, compression="zstd", partition_by=["o_orderpriority"])
    return catalog.scan(spark, f"{path}/*", ["o_orderkey"]).filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey", "o_custkey", F.col("o_orderpriority").cast("string").alias("o_orderpriority"))


@twin("SELECT c_custkey, c_name, c_acctbal FROM customer")
def copy_csv(spark: SparkSession, sf: str) -> DataFrame:
    """CSV with a header, compressed, and back."""
    path = own_folder(spark, "copy")
    catalog.copy_to(table(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal"), path, "csv", "gzip")
    return catalog.csv_metadata(spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@twin(f"SELECT id, CAST((x1-x0)*(y1-y0) AS DOUBLE) AS area, CAST(x0 AS DOUBLE) AS xmin, 'Polygon' AS kind FROM ({RECT_PART})")
def geoparquet_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """GeoParquet and back, with the geometry types that its footers state."""
    path = own_folder(spark, "copy")
    sinks.write_geoparquet(shapes(spark, sf, "part").select("id", "g"), path, "g")
    kinds = ",".join(sinks.geo_footer(spark, path)["columns"]["geometry"]["geometry_types"])
    return spark.read.parquet(path).select("id", F.round(st.st_area("geometry"), 6).alias("area"), F.col("bbox.xmin").alias("xmin"), F.lit(kinds).alias("kind"))


@twin("SELECT 0 AS position, 'n_nationkey' AS column_name, n AS n FROM (SELECT count(*) AS n FROM nation WHERE n_regionkey = 1) UNION ALL SELECT 1, 'n_name', n FROM (SELECT count(*) AS n FROM nation WHERE n_regionkey = 1)")
def catalog_view(spark: SparkSession, sf: str) -> DataFrame:
    """A view over a view, described by the catalog."""
    one, two = f"v_{uuid.uuid4().hex[:12]}", f"v_{uuid.uuid4().hex[:12]}"
    catalog.create_view(table(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey"), one)
    catalog.create_view(spark.sql(f"SELECT n_nationkey, n_name FROM {catalog.quoted(one)} WHERE n_regionkey = 1"), two)
    n = catalog.table(spark, two).agg(F.count("*").alias("n"))
    return catalog.describe(spark, two).select("position", "column_name").crossJoin(F.broadcast(n))  # one row


@twin("SELECT json_extract_string(props, '$.k') AS k, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1")
def json_paths(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", "event_id", "props")
    return e.groupBy(F.get_json_object("props", "$.k").alias("k")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


# --- cookbook on the inventory -------------------------------------------------------------

_STG = "stg_pv_consolidated"


@twin("SELECT floor(centroid_lon) AS grid_lon, floor(centroid_lat) AS grid_lat, count(*) AS n, round(avg(area_m2), 3) AS mean_area FROM stg_pv_consolidated WHERE centroid_lon IS NOT NULL AND centroid_lat IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 3")
def cb_density_grid(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, _STG, "centroid_lon", "centroid_lat", "area_m2").dropna(subset=["centroid_lon", "centroid_lat"])
    g = lambda c: F.floor(c).cast("double")
    return d.groupBy(g("centroid_lon").alias("grid_lon"), g("centroid_lat").alias("grid_lat")).agg(F.count("*").alias("n"), F.round(F.avg("area_m2"), 3).alias("mean_area")).filter("n >= 3")


@twin("SELECT dataset_name, min(processed_at) AS first_at, max(processed_at) AS last_at, count(DISTINCT CAST(processed_at AS DATE)) AS days, min(centroid_lon) AS xmin, max(centroid_lon) AS xmax, min(centroid_lat) AS ymin, max(centroid_lat) AS ymax FROM stg_pv_consolidated GROUP BY 1")
def cb_freshness_and_bounds(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, _STG, "dataset_name", "processed_at", "centroid_lon", "centroid_lat")
    return d.groupBy("dataset_name").agg(F.min("processed_at").alias("first_at"), F.max("processed_at").alias("last_at"), F.count_distinct(F.to_date("processed_at")).alias("days"), F.min("centroid_lon").alias("xmin"), F.max("centroid_lon").alias("xmax"), F.min("centroid_lat").alias("ymin"), F.max("centroid_lat").alias("ymax"))


@twin("SELECT row_id, dataset_name, area_m2 FROM stg_pv_consolidated WHERE area_m2 IS NOT NULL AND NOT isnan(area_m2) ORDER BY area_m2 DESC, row_id LIMIT 20")
def cb_largest(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, _STG, "row_id", "dataset_name", "area_m2").filter("area_m2 IS NOT NULL AND NOT isnan(area_m2)")
    return d.orderBy(F.desc("area_m2"), "row_id").limit(20)


@twin("SELECT dataset_name, count(*) AS n, min(area_m2) AS least, max(area_m2) AS most, round(median(area_m2), 4) AS middle, round(quantile_cont(area_m2, 0.9), 4) AS p90 FROM stg_pv_consolidated WHERE area_m2 IS NOT NULL AND NOT isnan(area_m2) GROUP BY 1")
def cb_area_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, _STG, "dataset_name", "area_m2").filter("area_m2 IS NOT NULL AND NOT isnan(area_m2)")
    return d.groupBy("dataset_name").agg(F.count("*").alias("n"), F.min("area_m2").alias("least"), F.max("area_m2").alias("most"), F.round(F.percentile("area_m2", 0.5), 4).alias("middle"), F.round(F.percentile("area_m2", 0.9), 4).alias("p90"))


@twin("SELECT 'area_m2' AS field_name, count(*) - count(area_m2) AS missing, count(*) AS n FROM stg_pv_consolidated UNION ALL SELECT 'capacity_mw', count(*) - count(capacity_mw), count(*) FROM stg_pv_consolidated UNION ALL SELECT 'install_date', count(*) - count(install_date), count(*) FROM stg_pv_consolidated UNION ALL SELECT 'unified_id', count(*) - count(unified_id), count(*) FROM stg_pv_consolidated")
def cb_completeness(spark: SparkSession, sf: str) -> DataFrame:
    names = ("area_m2", "capacity_mw", "install_date", "unified_id")
    one = table(spark, sf, _STG, *names).agg(F.count("*").alias("n"), *[(F.count("*") - F.count(c)).alias(c) for c in names])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("missing"), F.col("n").alias("n")) for c in names])).alias("f")).select("f.*")


@twin("SELECT s.dataset_name, m.trust_rank, m.local_tz, count(*) AS n FROM stg_pv_consolidated s LEFT JOIN dataset_manifest m USING (dataset_name) GROUP BY 1, 2, 3")
def cb_manifest_join(spark: SparkSession, sf: str) -> DataFrame:
    per = table(spark, sf, _STG, "dataset_name").groupBy("dataset_name").agg(F.count("*").alias("n"))
    return per.join(F.broadcast(table(spark, sf, "dataset_manifest", "dataset_name", "trust_rank", "local_tz")), "dataset_name", "left").select("dataset_name", "trust_rank", "local_tz", "n")


@twin("SELECT m.dataset_name, u.f AS keep_col FROM dataset_manifest m, unnest(m.keep_cols) AS u(f)")
def cb_keep_columns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "dataset_manifest", "dataset_name", "keep_cols").select("dataset_name", F.explode("keep_cols").alias("keep_col"))


@twin("SELECT country, count(*) AS divisions, count(*) FILTER (WHERE subtype = 'region') AS regions, min(bbox.xmin) AS xmin, max(bbox.xmax) AS xmax FROM overture_division_area GROUP BY 1")
def cb_divisions_by_country(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "overture_division_area", "country", "subtype", "bbox")
    return d.groupBy("country").agg(F.count("*").alias("divisions"), F.count_if(F.col("subtype") == "region").alias("regions"), F.min("bbox.xmin").alias("xmin"), F.max("bbox.xmax").alias("xmax"))


@twin("SELECT source_file, dataset_name, file_seq, count(*) AS n_lines, min(delivered_at) AS delivered_at FROM raw_deliveries GROUP BY 1, 2, 3")
def cb_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "raw_deliveries", "source_file", "dataset_name", "file_seq", "delivered_at")
    return d.groupBy("source_file", "dataset_name", "file_seq").agg(F.count("*").alias("n_lines"), F.min("delivered_at").alias("delivered_at"))



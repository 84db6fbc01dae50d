"""Queries of the general problems, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliolake.functions.geo_columns import measures, with_position
from heliolake.operators import drift, skew, spatial
from heliolake.operators import relational as R
from heliolake.operators import timestamps
from heliolake.operators import units as U
from heliolake.sources.tables import read_table


def unit_values_uk(spark: SparkSession, sf: str) -> DataFrame:
    """Capacities in MWp and areas in m² of the UK table."""
    df = read_table(spark, sf, "raw_uk_crowdsourced_pv_2020", "row_id", "capacity_osm_MWp", "area_sqm", "capacity_repd_MWp", "num_modules", "geometry_wkt")
    df = df.withColumn("__fp", measures(F.col("geometry_wkt"), "area_m2")["area_m2"])
    log_fp, log_repd, log_mod = U.log10_positive(F.col("__fp")), U.log10_positive(F.col("capacity_repd_MWp")), U.log10_positive(F.col("num_modules"))
    power = U.Quantity(
        "power",
        "capacity_osm_MWp",
        "MW",
        {u: F.lit(v[0]) for u, v in U.POWER_MW.items()},
        {u: v[1] for u, v in U.POWER_MW.items()},
        (
            U.Identity("the register's capacity", log_repd, 0.04),
            U.Identity("module power times modules", log_mod, 0.10, log_repd - log_mod),
            U.Identity("power density times footprint", log_fp, 0.10, log_repd - log_fp),
        ),
        (("area", 0.15, log_repd - log_fp),),
    )
    area = U.Quantity("area", "area_sqm", "m2", {u: F.lit(v[0]) for u, v in U.AREA_M2.items()}, {u: v[1] for u, v in U.AREA_M2.items()}, (U.Identity("area of the footprint", log_fp, 0.02), U.Identity("modules times module area", log_mod, 0.15, log_fp - log_mod)))
    return U.reconcile(df, [area, power], "row_id").withColumn("table_name", F.lit("raw_uk_crowdsourced_pv_2020"))


def unit_values_usa(spark: SparkSession, sf: str) -> DataFrame:
    """Areas of the Californian table; the field's own unit is the pixel of ``resolution`` metres, the common one m².

    Where ``resolution`` is missing it follows from the image: the distance of the centroid from
    the image's corner in metres over that in pixels.
    """
    df = read_table(spark, sf, "raw_usa_cali_usgs_pv_2016", "row_id", "area_pixels", "area_meters", "resolution", "geometry_wkt", "centroid_latitude", "centroid_latitude_pixels", "nw_corner_of_image_latitude")
    metres = (F.col("nw_corner_of_image_latitude") - F.col("centroid_latitude")) * F.lit(111_195.08)
    implied = F.when(F.col("centroid_latitude_pixels") > 0, metres / F.col("centroid_latitude_pixels"))
    res = F.coalesce(F.when(F.col("resolution") > 0, F.col("resolution")), F.when(implied > 0, implied))
    df = df.withColumns({"__fp": measures(F.col("geometry_wkt"), "area_m2")["area_m2"], "__px": res * res})
    sizes = {u: F.lit(v[0]) for u, v in U.AREA_M2.items()} | {"pixel": F.col("__px"), "kilopixel": F.col("__px") * 1e3, "megapixel": F.col("__px") * 1e6}
    area = U.Quantity("area", "area_pixels", "pixel", sizes, {}, (U.Identity("area of the polygon", U.log10_positive(F.col("area_meters")), 0.02), U.Identity("area of the footprint", U.log10_positive(F.col("__fp")), 0.02)))
    return U.reconcile(df, [area], "row_id").withColumn("table_name", F.lit("raw_usa_cali_usgs_pv_2016"))


def p1_values(spark: SparkSession, sf: str) -> DataFrame:
    """Every recorded capacity and area in MWp and m²."""
    return unit_values_uk(spark, sf).unionByName(unit_values_usa(spark, sf)).select("table_name", "row_id", "field_name", "unit", "value", "residual", "is_own", "is_unique")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Values that are not in the field's own unit."""
    return p1_values(spark, sf).filter(~F.col("is_own")).select("table_name", "row_id", "field_name")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p1_found": p1_found, "p1_values": p1_values}


def p4_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Load-order position of every row within its dataset and within its unified id."""
    df = read_table(spark, sf, "stg_pv_consolidated", "row_id", "dataset_name", "unified_id", "processed_at")
    long = df.select("row_id", "processed_at", F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("key_value")) for c in ("dataset_name", "unified_id")])).alias("__k"))
    long = long.select("__k.field_name", "__k.key_value", "row_id", "processed_at")
    return skew.positions(long, "key_value", ["processed_at", "row_id"], by=["field_name"]).select("field_name", "key_value", "row_id", "position")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """The rows numbered 100, 200, 300 and so on."""
    return p4_positions(spark, sf).filter(F.col("position") % 100 == 0).select("field_name", "key_value", "row_id")


QUERIES |= {"p4_found": p4_found, "p4_positions": p4_positions}


def p5_values(spark: SparkSession, sf: str) -> DataFrame:
    """Every recorded date or time in one form."""
    manifest = F.broadcast(read_table(spark, sf, "dataset_manifest", "dataset_name", "local_tz", "date_order"))  # one row a dataset
    parts = []
    for table, columns in (("raw_uk_crowdsourced_pv_2020", ("osm_tag_start_date", "repd_operational_date")), ("stg_pv_consolidated", ("install_date",))):
        df = read_table(spark, sf, table, "row_id", "dataset_name", *columns)
        one = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in columns])).alias("__f")
        parts.append(df.select(F.lit(table).alias("table_name"), "row_id", "dataset_name", one).select("table_name", "row_id", "dataset_name", "__f.field_name", "__f.text"))
    values = parts[0].unionByName(parts[1]).filter("text IS NOT NULL").join(manifest, "dataset_name", "left")
    out = timestamps.normalise(values, "text", F.col("local_tz"), F.col("date_order"))
    return out.select("table_name", "row_id", "field_name", "text", "written_date", "instant", "day", "precision", "zone_source", "tz_version")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Values whose written calendar day isn't that of their moment in UTC."""
    return p5_values(spark, sf).filter(timestamps.utc_day(F.col("instant")) != F.col("written_date")).select("table_name", "row_id", "field_name")


QUERIES |= {"p5_found": p5_found, "p5_values": p5_values}


def positions_of(spark: SparkSession, sf: str) -> DataFrame:
    """``row_id, pos_lon, pos_lat`` of the consolidated records, from the geometry."""
    df = read_table(spark, sf, "stg_pv_consolidated", "row_id", "geometry")
    return with_position(df, "geometry").select("row_id", "pos_lon", "pos_lat")


def p6_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of records at most 100 m apart, with their distance."""
    return spatial.near_pairs(positions_of(spark, sf), "row_id", "pos_lon", "pos_lat", 100.0).select(F.col("a").alias("row_id_a"), F.col("b").alias("row_id_b"), "distance_m")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of records at most 100 m apart."""
    return p6_pairs(spark, sf).select("row_id_a", "row_id_b")


def p6_divisions(spark: SparkSession, sf: str) -> DataFrame:
    """The divisions (country, region) that contain each record's position."""
    regions = read_table(spark, sf, "overture_division_area", "division_id", "geometry")
    return spatial.containing_regions(positions_of(spark, sf), "row_id", "pos_lon", "pos_lat", regions, "division_id", "geometry")


QUERIES |= {"p6_found": p6_found, "p6_pairs": p6_pairs, "p6_divisions": p6_divisions}


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "raw_deliveries", "record_id", "dataset_name", "source_file", "file_seq", "payload")


def p3_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Every change of a file against the file before it, with the types on both sides."""
    return drift.changes(deliveries(spark, sf))[0]


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every change of a file against the file before it."""
    return p3_changes(spark, sf).select("source_file", "change_kind", "old_name", "new_name")


def p3_unified(spark: SparkSession, sf: str) -> DataFrame:
    """All delivered records under canonical names: the typed tables of the datasets, below each other.

    A field that two datasets have with different types is text here; each table by itself keeps its types.
    """
    tables = list(drift.unified_tables(deliveries(spark, sf)).values())
    kinds: dict[str, set[str]] = {}
    for t in tables:
        for name, kind in t.dtypes:
            kinds.setdefault(name.lower(), set()).add(kind)
    first = {name.lower(): name for t in reversed(tables) for name in t.columns}
    same = [t.select(*[(F.col(f"`{c}`").cast("string") if len(kinds[c.lower()]) > 1 else F.col(f"`{c}`")).alias(first[c.lower()]) for c in t.columns]) for t in tables]
    return R.union_by_name(same, T.StructType([T.StructField("dataset_name", T.StringType())]))


QUERIES |= {"p3_found": p3_found, "p3_changes": p3_changes, "p3_unified": p3_unified}


#: SQL of the problems that SQL can express.
ORACLE: dict[str, str] = {
    "p4_found": """SELECT field_name, key_value, row_id FROM (SELECT *, row_number() OVER (PARTITION BY field_name, key_value ORDER BY processed_at NULLS FIRST, row_id) AS n FROM (SELECT 'dataset_name' AS field_name, dataset_name AS key_value, row_id, processed_at FROM stg_pv_consolidated UNION ALL SELECT 'unified_id', unified_id, row_id, processed_at FROM stg_pv_consolidated) WHERE key_value IS NOT NULL) WHERE n % 100 = 0""",
    "p4_positions": """SELECT field_name, key_value, row_id, row_number() OVER (PARTITION BY field_name, key_value ORDER BY processed_at NULLS FIRST, row_id) AS position FROM (SELECT 'dataset_name' AS field_name, dataset_name AS key_value, row_id, processed_at FROM stg_pv_consolidated UNION ALL SELECT 'unified_id', unified_id, row_id, processed_at FROM stg_pv_consolidated) WHERE key_value IS NOT NULL""",
}

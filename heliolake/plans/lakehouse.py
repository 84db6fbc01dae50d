"""Layered products on the photovoltaic tables: raw, staged, consolidated, deduplicated, enriched."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliolake.functions import hexcells as H
from heliolake.functions import st
from heliolake.functions.geo_columns import measures, with_position
from heliolake.operators import products as P
from heliolake.operators import relational as R
from heliolake.operators import spatial
from heliolake.operators.geojoin import spatial_join, spatial_join_within_distance  # noqa: F401
from heliolake.session import cut
from heliolake.sources.tables import read_table

#: Candidate columns of the staging record, in order; names that only these tables have come after.
CANDIDATES = {
    "unified_id": ["fid", "sol_id", "GID_0", "polygon_id", "unique_id", "osm_id", "FID_PV_202"] + ["FID_Train", "OID_", "id"],
    "source_area_m2": ["Shape_Area", "Area", "area_sqm", "panels.area", "area"] + ["area_meters", "area_m2"],
    "capacity_mw": ["capacity_mw", "power", "capacity"] + ["capacity_osm_MWp", "capacity_repd_MWp"],
    "install_date": ["install_date", "installation_date", "Date"] + ["osm_tag_start_date", "repd_operational_date"],
}
KINDS = {"unified_id": "string", "source_area_m2": "double", "capacity_mw": "double", "install_date": "string"}
RAW = ("raw_uk_crowdsourced_pv_2020", "raw_usa_cali_usgs_pv_2016", "raw_chn_med_res_pv_2024")
STAGED = T.StructType(
    [
        T.StructField("dataset_name", T.StringType()),
        T.StructField("geometry", T.StringType()),
        T.StructField("centroid_lon", T.DoubleType()),
        T.StructField("centroid_lat", T.DoubleType()),
        T.StructField("area_m2", T.DoubleType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("cell", T.LongType()),
        T.StructField("unified_id", T.StringType()),
        T.StructField("source_area_m2", T.DoubleType()),
        T.StructField("capacity_mw", T.DoubleType()),
        T.StructField("install_date", T.StringType()),
    ]
)


def raw_model(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Source columns with the manifest's metadata, valid and non-empty geometries only."""
    meta = read_table(spark, sf, "dataset_manifest", "dataset_name", "doi", "repo", "paper_doi", "paper_title")  # one row a dataset
    own = read_table(spark, sf, name)
    df = own.drop("doi", "repo", "paper_doi", "paper_title").join(F.broadcast(meta), "dataset_name", "left")
    return df.filter(F.col("geometry_wkt").isNotNull() & st.st_isvalid("geometry_wkt") & ~st.st_isempty("geometry_wkt"))


def staged(df: DataFrame, resolution: int = P.DEDUP_RESOLUTION) -> DataFrame:
    """The fixed staging record: measures of the geometry, and each field from its first usable candidate column."""
    m = df.withColumns({"__m": measures(F.col("geometry_wkt"), "cx", "cy"), "__a": st.st_area_mercator("geometry_wkt")})
    lon, lat = F.col("__m.cx"), F.col("__m.cy")
    return m.select(
        "dataset_name",
        F.col("geometry_wkt").alias("geometry"),
        lon.alias("centroid_lon"),
        lat.alias("centroid_lat"),
        F.col("__a").alias("area_m2"),
        F.col("dbt_loaded_at").cast("timestamp").alias("processed_at"),
        F.when(lon.isNotNull(), H.latlng_to_cell(lat, lon, resolution)).alias("cell"),
        *[R.candidate(df, names, KINDS[f]).alias(f) for f, names in CANDIDATES.items()],
    )


def consolidated(spark: SparkSession, sf: str) -> DataFrame:
    """All raw tables in the staging record, by name."""
    return R.union_by_name([staged(raw_model(spark, sf, n)) for n in RAW])


def stg_with_cells(spark: SparkSession, sf: str, resolution: int) -> DataFrame:
    """The consolidated table with positions from the geometry and their cells."""
    df = with_position(read_table(spark, sf, "stg_pv_consolidated", "row_id", "dataset_name", "unified_id", "geometry", "area_m2", "capacity_mw"), "geometry")
    return df.withColumn("cell", F.when(F.col("pos_lon").isNotNull(), H.latlng_to_cell(F.col("pos_lat"), F.col("pos_lon"), resolution)))


def dedup_by_cell(df: DataFrame) -> DataFrame:
    """Rows left after the removal of larger cross-dataset overlaps within each cell.

    Cheap conditions come first, so only overlapping candidates of a cell reach the exact test.
    Rows without a cell or geometry are dropped; rows without an id are never removed; rows that
    share an id within a dataset go together. Pairs of different cells are never compared.
    """
    rows = cut(df.withColumn("__id", F.monotonically_increasing_id()).filter("cell IS NOT NULL AND geometry IS NOT NULL AND geometry <> ''").withColumn("__b", measures(F.col("geometry"), "area_deg2", "xmin", "ymin", "xmax", "ymax")))
    ren = lambda p: rows.select("cell", F.col("__id").alias(p), F.col("dataset_name").alias(f"{p}_dataset"), F.col("unified_id").alias(f"{p}_id"), F.col("area_m2").alias(f"{p}_area"), F.col("__b").alias(f"{p}_b"))
    a, b = ren("a"), ren("b").filter("b_id IS NOT NULL")
    aa, ba = F.coalesce("a_area", F.lit(float("-inf"))), F.coalesce("b_area", F.lit(float("-inf")))
    width = F.least("a_b.xmax", "b_b.xmax") - F.greatest("a_b.xmin", "b_b.xmin")
    height = F.least("a_b.ymax", "b_b.ymax") - F.greatest("a_b.ymin", "b_b.ymin")
    pairs = a.join(b, "cell").filter((F.col("a_dataset") != F.col("b_dataset")) & ((aa < ba) | ((aa == ba) & (F.col("a_dataset") > F.col("b_dataset")))) & (width > 0) & (height > 0) & (width * height > P.OVERLAP_THRESHOLD * F.least("a_b.area_deg2", "b_b.area_deg2")))
    # only ids, boxes and areas meet by cell; the shapes are fetched for the pairs that are left
    shape = lambda p: rows.select(F.col("__id").alias(p), F.col("geometry").alias(f"{p}_g"))
    tested = pairs.join(shape("a"), "a").join(shape("b"), "b").withColumn("common", st.st_intersection_area("a_g", "b_g")).withColumns({"a_size": F.col("a_b.area_deg2"), "b_size": F.col("b_b.area_deg2")})
    gone = P.removed_by_overlap(tested)
    return rows.drop("__id", "__b").join(gone.select(F.col("dataset").alias("dataset_name"), F.col("id").alias("unified_id")), ["dataset_name", "unified_id"], "left_anti")


# --- queries -------------------------------------------------------------------------------


def cp_raw_model(spark: SparkSession, sf: str) -> DataFrame:
    """Raw model of each dataset with metadata and validity filter."""
    return R.union_by_name([raw_model(spark, sf, n).select("dataset_name", "row_id", "source_file", "geometry_wkt", "doi", "paper_title") for n in RAW])


def cp_consolidated(spark: SparkSession, sf: str) -> DataFrame:
    return consolidated(spark, sf)


def cp_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Cell-local overlap deduplication of the consolidated table."""
    return dedup_by_cell(stg_with_cells(spark, sf, P.DEDUP_RESOLUTION)).select("row_id", "dataset_name", "unified_id", "cell")


def admin_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Every record with each division that contains its position."""
    d = read_table(spark, sf, "overture_division_area", "division_id", "country", "region", "subtype", "names").withColumn("name", F.coalesce("names.primary", F.lit("Unknown"))).drop("names")
    pos = with_position(read_table(spark, sf, "stg_pv_consolidated", "row_id", "geometry"), "geometry")
    regions = read_table(spark, sf, "overture_division_area", "division_id", "geometry")
    hits = spatial.containing_regions(pos, "row_id", "pos_lon", "pos_lat", regions, "division_id", "geometry")
    return hits.join(F.broadcast(d), "division_id")  # dimension of fixed size


def cp_admin_context(spark: SparkSession, sf: str) -> DataFrame:
    """Best division of each record by administrative priority; records without one are 'Unknown'."""
    m = admin_matches(spark, sf)
    best = R.best_by(m.withColumn("priority", P.admin_priority(F.col("subtype"))), ["row_id"], F.struct("priority", "division_id"), "division_id", "country", "name", "subtype")
    base = read_table(spark, sf, "stg_pv_consolidated", "row_id", "dataset_name")
    out = base.join(best, "row_id", "left")
    unknown = lambda c: F.coalesce(c, F.lit("Unknown")).alias(c)
    return out.select("row_id", "dataset_name", F.col("division_id").isNotNull().alias("has_admin_context"), unknown("division_id"), unknown("country"), unknown("name"), unknown("subtype"))


def cp_boundaries_with_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Divisions that hold records, with their distinct cells and spheroid area."""
    cells = stg_with_cells(spark, sf, 6).filter("cell IS NOT NULL").select("row_id", "cell")
    hit = admin_matches(spark, sf).select("row_id", "division_id").join(cells, "row_id").groupBy("division_id", "cell").agg(F.count("*").alias("n"))
    per = hit.groupBy("division_id").agg(F.count("*").alias("pv_cell_count"), F.sum("n").alias("pv_count"))
    d = read_table(spark, sf, "overture_division_area", "division_id", "country", "subtype", "geometry", "bbox")
    return d.withColumn("area_m2", st.st_area_spheroid("geometry")).join(per, "division_id").select(
        "division_id", "country", "subtype", F.round("area_m2", 3).alias("area_m2"), ((F.col("bbox.xmin") + F.col("bbox.xmax")) / 2).alias("mid_lon"), ((F.col("bbox.ymin") + F.col("bbox.ymax")) / 2).alias("mid_lat"), "pv_cell_count", "pv_count"
    )


def cp_country_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Country decomposition into cells with density and adoption category."""
    res = 4
    c = read_table(spark, sf, "overture_division_area", "division_id", "country", "subtype", "geometry").filter("subtype = 'country'")
    grid = c.select("country", F.explode(H.polygon_to_cells(res)(F.col("geometry"))).alias("cell")).distinct()
    counts = stg_with_cells(spark, sf, res).filter("cell IS NOT NULL").groupBy("cell").agg(F.count("*").alias("n"), F.round(F.sum("area_m2"), 3).alias("pv_area_m2"))
    out = grid.join(counts, "cell", "left").na.fill(0, ["n"]).na.fill(0.0, ["pv_area_m2"])
    lat, lon = H.cell_to_latlng(F.col("cell"))
    return out.select("country", "cell", F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon"), "n", "pv_area_m2", F.round(P.density(F.col("n"), F.lit(H.cell_area_km2(res))), 9).alias("density"), P.adoption_category(F.col("n")).alias("category"))


def cp_cell_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Records per cell, then the spread of these counts."""
    per = stg_with_cells(spark, sf, 8).filter("cell IS NOT NULL").groupBy("cell").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("cells"), F.sum("n").alias("records"), F.round(F.avg("n"), 6).alias("mean_per_cell"), F.max("n").alias("max_per_cell"), F.min("n").alias("min_per_cell"), F.median("n").alias("median_per_cell"))


def cp_hilbert_order(spark: SparkSession, sf: str) -> DataFrame:
    """Records range-partitioned and sorted along the Hilbert curve of their position."""
    df = with_position(read_table(spark, sf, "stg_pv_consolidated", "row_id", "geometry"), "geometry").filter("pos_lon IS NOT NULL")
    coded = df.select("row_id", st.st_hilbert(F.col("pos_lon"), F.col("pos_lat")).alias("code"))
    return coded.repartitionByRange("code", "row_id").sortWithinPartitions("code", "row_id")


def cp_fetch_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Cells to fetch: large records one resolution coarser, small ones one finer, grouped by cell."""
    df = with_position(read_table(spark, sf, "stg_pv_consolidated", "row_id", "geometry", "area_m2"), "geometry").filter("pos_lon IS NOT NULL")
    large = F.col("area_m2") >= 10_000
    cell = F.when(large, H.latlng_to_cell(F.col("pos_lat"), F.col("pos_lon"), 9)).otherwise(H.latlng_to_cell(F.col("pos_lat"), F.col("pos_lon"), 11))
    return df.groupBy(cell.alias("cell"), F.coalesce(large, F.lit(False)).alias("is_large")).agg(F.count("*").alias("n"), F.round(F.sum("area_m2"), 3).alias("area_m2"), F.min("row_id").alias("first_row"))


def cp_country_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    """Count, area and bounds of the records of each country."""
    m = admin_matches(spark, sf).filter("subtype = 'country'").select("row_id", "country")
    rows = with_position(read_table(spark, sf, "stg_pv_consolidated", "row_id", "geometry", "area_m2"), "geometry")
    g = m.join(rows, "row_id").groupBy("country").agg(F.count("*").alias("n"), F.round(F.sum("area_m2"), 3).alias("area_m2"), *[f(F.round(c, 9)).alias(n) for f, c, n in ((F.min, "pos_lon", "xmin"), (F.min, "pos_lat", "ymin"), (F.max, "pos_lon", "xmax"), (F.max, "pos_lat", "ymax"))])
    return g


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (cp_raw_model, cp_consolidated, cp_dedup, cp_admin_context, cp_boundaries_with_cells, cp_country_cells, cp_cell_summary, cp_hilbert_order, cp_fetch_plan, cp_country_aggregates)}
ORACLE: dict[str, str] = {}


def _sql(name: str, sql: str) -> Callable:
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name], ORACLE[name] = f, sql
        return f

    return keep


_STG = "stg_pv_consolidated"


@_sql("cb_overview", "SELECT dataset_name, count(*) AS n, count(*) - count(capacity_mw) AS no_capacity, count(*) - count(install_date) AS no_date, count(*) - count(centroid_lon) AS no_centroid, count(DISTINCT unified_id) AS ids, count(DISTINCT CAST(processed_at AS DATE)) AS days FROM stg_pv_consolidated GROUP BY 1")
def cb_overview(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, _STG)
    missing = lambda c: F.count("*") - F.count(c)
    return d.groupBy("dataset_name").agg(F.count("*").alias("n"), missing("capacity_mw").alias("no_capacity"), missing("install_date").alias("no_date"), missing("centroid_lon").alias("no_centroid"), F.count_distinct("unified_id").alias("ids"), F.count_distinct(F.to_date("processed_at")).alias("days"))


@_sql("cb_duplicate_ids", "SELECT dataset_name, unified_id, count(*) AS n, min(row_id) AS first_row FROM stg_pv_consolidated WHERE unified_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1")
def cb_duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, _STG, "dataset_name", "unified_id", "row_id").filter("unified_id IS NOT NULL").groupBy("dataset_name", "unified_id").agg(F.count("*").alias("n"), F.min("row_id").alias("first_row")).filter("n > 1")


@_sql("cb_bbox_filter", "SELECT row_id, dataset_name FROM stg_pv_consolidated WHERE centroid_lon BETWEEN -10 AND 5 AND centroid_lat BETWEEN 45 AND 60 AND area_m2 BETWEEN 3 AND 1000000")
def cb_bbox_filter(spark: SparkSession, sf: str) -> DataFrame:
    return R.filter_by(read_table(spark, sf, _STG, "row_id", "dataset_name", "centroid_lon", "centroid_lat", "area_m2"), {"centroid_lon": ("between", (-10, 5)), "centroid_lat": ("between", (45, 60)), "area_m2": ("between", (3, 1_000_000))}).select("row_id", "dataset_name")


@_sql("cb_size_ladder", "SELECT CASE WHEN area_m2 < 25 THEN 'micro' WHEN area_m2 < 100 THEN 'small' WHEN area_m2 < 1000 THEN 'medium' WHEN area_m2 < 50000 THEN 'large' ELSE 'utility' END AS bucket, count(*) AS n, round(sum(area_m2), 2) AS total FROM stg_pv_consolidated WHERE area_m2 IS NOT NULL GROUP BY 1")
def cb_size_ladder(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, _STG, "area_m2").filter("area_m2 IS NOT NULL")
    return d.groupBy(R.ladder(F.col("area_m2"), [(25, "micro"), (100, "small"), (1000, "medium"), (50000, "large")], "utility").alias("bucket")).agg(F.count("*").alias("n"), F.round(F.sum("area_m2"), 2).alias("total"))


@_sql("cb_division_names", "SELECT division_id, country, names['primary'] AS name, subtype, round((bbox['xmin'] + bbox['xmax']) / 2, 9) AS mid_lon, round((bbox['ymin'] + bbox['ymax']) / 2, 9) AS mid_lat FROM overture_division_area WHERE is_land AND subtype IN ('country', 'region')")
def cb_division_names(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, "overture_division_area", "division_id", "country", "names", "subtype", "bbox", "is_land").filter(F.col("is_land") & F.col("subtype").isin("country", "region"))
    return d.select("division_id", "country", F.col("names.primary").alias("name"), "subtype", F.round((F.col("bbox.xmin") + F.col("bbox.xmax")) / 2, 9).alias("mid_lon"), F.round((F.col("bbox.ymin") + F.col("bbox.ymax")) / 2, 9).alias("mid_lat"))


@_sql("cb_available_datasets", "SELECT dataset_name, trust_rank, array_to_string(keep_cols, '|') AS keep_cols FROM dataset_manifest WHERE NOT coalesce(skip, false)")
def cb_available_datasets(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, "dataset_manifest", "dataset_name", "trust_rank", "keep_cols", "skip").filter(~F.coalesce("skip", F.lit(False)))
    return d.select("dataset_name", "trust_rank", F.array_join("keep_cols", "|").alias("keep_cols"))

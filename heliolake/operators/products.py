"""Composite data products on plain columns: duplicate removal by cell, enrichment, scores, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliolake.operators.relational import ladder, ratio

#: Fixed values of the reference's rules.
ADMIN_PRIORITY = {"localadmin": 5, "county": 4, "region": 3, "country": 2, "dependency": 1}
ADOPTION = [(1, "No PV"), (100, "Low PV"), (1000, "Medium PV"), (10000, "High PV")]
DEDUP_RESOLUTION, OVERLAP_THRESHOLD = 12, 0.5
#: Average cell areas in km² by resolution, from which an adaptive resolution is picked.
CELL_AREA_KM2 = [4357449.416078383, 609788.441794133, 86801.780398997, 12393.434655088, 1770.347654491, 252.903858182, 36.129062164, 5.161293360, 0.737327598, 0.105332513, 0.015047502, 0.002149643, 0.000307092, 0.000043870, 0.000006267, 0.000000895]


def adaptive_resolution(area_m2: Column) -> Column:
    """Finest resolution whose average cell holds the area with 5 % to spare; 15 for no area, never below 0."""
    need = area_m2 / 1e6 * 1.05
    out = F.lit(0)
    for res, km2 in enumerate(CELL_AREA_KM2):
        out = F.when(need <= km2, F.lit(res)).otherwise(out)
    return F.when(area_m2.isNull() | (area_m2 <= 0), F.lit(15)).otherwise(out)


def removed_by_overlap(pairs: DataFrame) -> DataFrame:
    """``dataset, id`` of rows that a smaller one overlaps by more than the threshold.

    ``pairs`` has the columns ``a_area, b_area, a_dataset, b_dataset, b_id, common`` of two rows of
    one cell. Of a pair from two datasets the larger row goes, of equal areas the one whose dataset
    sorts first; equal and nested rows are no overlap, rows without an id stay.
    """
    a, b = F.coalesce(F.col("a_area"), F.lit(float("-inf"))), F.coalesce(F.col("b_area"), F.lit(float("-inf")))
    overlaps = (F.col("common") > 0) & (F.col("common") < F.col("a_size")) & (F.col("common") < F.col("b_size"))
    loses = (a < b) | ((a == b) & (F.col("a_dataset") > F.col("b_dataset")))
    hit = overlaps & loses & (F.col("a_dataset") != F.col("b_dataset")) & (F.col("common") / F.least("a_size", "b_size") > OVERLAP_THRESHOLD)
    return pairs.filter(hit & F.col("b_id").isNotNull()).select(F.col("b_dataset").alias("dataset"), F.col("b_id").alias("id")).distinct()


def admin_priority(subtype: Column) -> Column:
    out = F.lit(0)
    for name, p in ADMIN_PRIORITY.items():
        out = F.when(F.lower(subtype) == name, F.lit(p)).otherwise(out)
    return out


def adoption_category(count: Column) -> Column:
    return ladder(count, ADOPTION, "Very High PV")


def country_statistics(countries: DataFrame, rows: DataFrame, key: str, measure: str) -> DataFrame:
    """Count, sum, mean and extremes per country, zero where a country has none, with its adoption category."""
    agg = rows.groupBy(key).agg(
        F.count("*").alias("n"), F.round(F.sum(measure), 4).alias("total"), F.round(F.avg(measure), 4).alias("mean"), F.min(measure).alias("least"), F.max(measure).alias("most")
    )
    out = countries.join(agg, key, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    n = F.coalesce("n", F.lit(0))
    return out.select(*countries.columns, n.cast("bigint").alias("n"), zero("total"), zero("mean"), zero("least"), zero("most"), adoption_category(n).alias("category"))


def site_scores(df: DataFrame) -> DataFrame:
    """Site class, solar score, sensitivity, feasibility and completeness from the context columns.

    Reads ``building_relationship, land_use_type, land_use_suitability, land_cover_type, ecosystem_type,
    environmental_impact, admin_level`` and the flags ``has_admin, has_building, has_land_use,
    has_land_cover``; nulls count as 'unknown' or false.
    """
    v = lambda c: F.coalesce(F.lower(F.col(c)), F.lit("unknown"))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("int")
    rooftop = v("building_relationship").isin("rooftop_confirmed", "rooftop_likely")
    site = (
        F.when(rooftop, "rooftop")
        .when(v("land_use_type") == "industrial", "industrial_ground_mount")
        .when(v("land_use_type") == "commercial", "commercial_ground_mount")
        .when(v("land_use_type") == "agricultural", "agrivoltaic")
        .when(v("land_cover_type") == "built_up", "urban_ground_mount")
        .when(v("land_cover_type").isin("grass", "bare"), "utility_scale")
        .otherwise("ground_mount_other")
    )
    pick = lambda c, table: sum((F.when(v(c) == k, x).otherwise(0.0) for k, x in table.items()), F.lit(0.0))
    score = (
        F.lit(0.5)
        + pick("building_relationship", {"rooftop_confirmed": 0.2, "rooftop_likely": 0.1})
        + pick("land_use_suitability", {"highly_suitable": 0.2, "suitable": 0.1, "moderately_suitable": 0.05})
        + pick("environmental_impact", {"minimal_impact": 0.1, "moderate_impact": 0.05, "high_impact": -0.1})
        + F.when(v("admin_level").isin("locality", "county"), 0.05).otherwise(0.0)
    )
    eco, impact = v("ecosystem_type"), v("environmental_impact")
    sensitivity = (
        F.when((eco == "forest") | (impact == "high_impact"), "high_sensitivity")
        .when(eco.isin("aquatic", "polar") | (impact == "special_consideration"), "special_consideration")
        .when(eco.isin("grassland", "agricultural") | (impact == "moderate_impact"), "moderate_sensitivity")
        .when(eco.isin("urban", "barren") | (impact == "minimal_impact"), "low_sensitivity")
        .otherwise("unknown_sensitivity")
    )
    out = df.withColumns({"site_classification": site, "solar_potential_score": F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4), "environmental_sensitivity": sensitivity})
    suit, sens = v("land_use_suitability"), F.col("environmental_sensitivity")
    feasible = (
        F.when((suit == "highly_suitable") & (sens == "low_sensitivity"), "highly_feasible")
        .when(suit.isin("suitable", "highly_suitable") & sens.isin("low_sensitivity", "moderate_sensitivity"), "feasible")
        .when((suit == "moderately_suitable") | (sens == "moderate_sensitivity"), "moderately_feasible")
        .when(sens.isin("high_sensitivity", "special_consideration"), "challenging")
        .otherwise("unknown_feasibility")
    )
    complete = sum(flag(c) for c in ("has_admin", "has_building", "has_land_use", "has_land_cover")) / 4.0
    return out.withColumns({"development_feasibility": feasible, "context_completeness": complete, "has_complete_context": complete >= 0.75, "is_rooftop_installation": rooftop, "is_ground_mount": ~rooftop})


def density(count: Column, area_km2: Column) -> Column:
    """Count per km², 0 where there is no area."""
    return ratio(count, area_km2)


def sample_split(df: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """Adds ``split`` ('train' or 'validation') by a seeded hash of the key: the same on every run and cluster."""
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000)) / 1_000_000.0
    return df.withColumn("split", F.when(u < share, "train").otherwise("validation"))


def first_by(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("__rn = 1").drop("__rn")

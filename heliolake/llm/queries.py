"""Queries of the problems on training data, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.llm import packing, spam, survivors, tokens
from heliolake.session import cut_table
from heliolake.sources.tables import read_table

CAPACITY = 2048


FIELDS = {
    "capacity_mw": survivors.usable_number,
    "install_date": survivors.usable_text,
    "source_area_m2": survivors.usable_number,
}


def grouped_records(spark: SparkSession, sf: str, *columns: Column | str) -> DataFrame:
    """Consolidated records in groups of two or more, with group, trust, time and what else is asked for."""
    df = read_table(spark, sf, "stg_pv_consolidated", "row_id", "dataset_name", "geometry", "processed_at", *FIELDS)
    trust = F.broadcast(read_table(spark, sf, "dataset_manifest", "dataset_name", "trust_rank"))  # one row a dataset
    groups = survivors.installation_groups(df, "row_id", "geometry")
    return df.join(trust, "dataset_name", "left").select("row_id", "trust_rank", "processed_at", *columns).join(groups, "row_id")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Of each group and field, the row whose value survives."""
    # what is usable is worked out before the join, so that no values are shuffled
    rows = grouped_records(spark, sf, *[u(F.col(f)).alias(f"__u{k}") for k, (f, u) in enumerate(FIELDS.items())])
    out = survivors.surviving_values(rows, "group", "row_id", "trust_rank", "processed_at", {f: F.col(f"__u{k}") for k, f in enumerate(FIELDS)})
    return out.select(F.col("group").alias("group_row_id"), "field_name", "row_id")


def p2_records(spark: SparkSession, sf: str) -> DataFrame:
    """One record for each installation that is recorded more than once."""
    rows = cut_table(grouped_records(spark, sf, "dataset_name", *FIELDS))
    out = survivors.built_records(rows, "group", "row_id", "trust_rank", "processed_at", {f: u(F.col(f)) for f, u in FIELDS.items()}, ["dataset_name", "processed_at"])
    return out.withColumnRenamed("group", "group_row_id")


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every text by byte_bpe_50k."""
    return tokens.encode_column(read_table(spark, sf, "documents", "doc_id", "text"), "doc_id", "text")


def p8_packed(spark: SparkSession, sf: str) -> DataFrame:
    """Container and offset of every text, measured in tokens of byte_bpe_50k."""
    sizes = tokens.encode_column(read_table(spark, sf, "documents", "doc_id", "text"), "doc_id", "text", counts=True)
    return packing.pack(cut_table(sizes), "doc_id", "n_tokens", CAPACITY)


def p8_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of the containers: every token of every text once, none over the capacity, no overlap, whole unless longer than one."""
    packed = cut_table(p8_packed(spark, sf))
    documents = read_table(spark, sf, "documents", "doc_id").agg(F.count("*").alias("documents"))
    sizes = tokens.encode_column(read_table(spark, sf, "documents", "doc_id", "text"), "doc_id", "text", counts=True)
    texts = packed.groupBy("doc_id").agg(F.sum("size").alias("n"), F.count("*").alias("pieces"), F.count_distinct("piece").alias("places"))
    kept = sizes.join(texts, "doc_id", "full_outer")
    bad = kept.agg(
        F.count_if(~F.col("n").eqNullSafe(F.col("n_tokens")) | (F.col("pieces") != F.col("places"))).alias("not_kept"),
        F.count_if((F.col("pieces") > 1) & (F.col("n_tokens") <= CAPACITY)).alias("cut_needlessly"),
    )
    fill = packed.groupBy("container").agg(F.sum("size").alias("held"), F.max(F.col("offset") + F.col("size")).alias("end"))
    over = fill.agg(F.count_if((F.col("held") > CAPACITY) | (F.col("held") != F.col("end"))).alias("overfull_or_with_gaps"))
    return documents.crossJoin(bad).crossJoin(over)  # one row each


def p7_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Digest of every text decoded again from its ids."""
    return tokens.decode_column(p7_ids(spark, sf), "doc_id", "ids").select("doc_id", F.md5("text").alias("digest"))


def p2_by_identifier(spark: SparkSession, sf: str) -> DataFrame:
    """The surviving rows of the groups that ``unified_id`` makes, one of which holds a tenth of all rows."""
    df = read_table(spark, sf, "stg_pv_consolidated", "row_id", "unified_id", "dataset_name", "processed_at", *FIELDS).filter("unified_id IS NOT NULL")
    trust = F.broadcast(read_table(spark, sf, "dataset_manifest", "dataset_name", "trust_rank"))  # one row a dataset
    return survivors.surviving_values(df.join(trust, "dataset_name", "left"), "unified_id", "row_id", "trust_rank", "processed_at", {f: u(F.col(f)) for f, u in FIELDS.items()})


def p9_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Part of every text that is lists instead of statements."""
    return spam.page_shares(read_table(spark, sf, "documents", "doc_id", "text"), "doc_id", "text")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of repeated key phrases, links, breadcrumbs, tags or product names."""
    return p9_pages(spark, sf).filter("is_spam").select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found,
    "p2_records": p2_records,
    "p2_by_identifier": p2_by_identifier,
    "p7_ids": p7_ids,
    "p7_round_trip": p7_round_trip,
    "p8_packed": p8_packed,
    "p8_invariants": p8_invariants,
    "p9_found": p9_found,
    "p9_pages": p9_pages,
}

_MISSING = ", ".join(f"'{t}'" for t in survivors.MISSING_TEXTS)
_DAYS = ", ".join(f"'{t}'" for t in survivors.MISSING_DAYS)
_NUMBER = "coalesce({0} > 0 AND NOT isnan({0}) AND {0} < 1e300 AND {0} NOT IN (99999, 999999, 9999999, 99999999, 999999999), false)"
_TEXT = f"coalesce(trim(lower(install_date)) NOT IN ({_MISSING}) AND trim(lower(install_date)) NOT IN ({_DAYS}) AND trim(lower(install_date)) <> '1970-01-01t00:00:00z', false)"

#: SQL of the queries that SQL can express: survivors of given groups, what must hold of containers, texts that come back.
ORACLE: dict[str, str] = {
    "p2_by_identifier": f"""WITH v AS (
SELECT s.unified_id, s.row_id, s.processed_at, m.trust_rank, f.field_name,
CASE f.field_name WHEN 'capacity_mw' THEN {_NUMBER.format("s.capacity_mw")} WHEN 'source_area_m2' THEN {_NUMBER.format("s.source_area_m2")} ELSE {_TEXT} END AS usable
FROM stg_pv_consolidated s LEFT JOIN dataset_manifest m USING (dataset_name)
CROSS JOIN (SELECT unnest(['capacity_mw', 'install_date', 'source_area_m2']) AS field_name) f WHERE s.unified_id IS NOT NULL)
SELECT unified_id, field_name, row_id FROM (SELECT *, row_number() OVER (PARTITION BY unified_id, field_name ORDER BY trust_rank NULLS LAST, processed_at DESC NULLS LAST, row_id DESC) AS k FROM v WHERE usable) WHERE k = 1""",
    "p7_round_trip": "SELECT doc_id, md5(coalesce(text, '')) AS digest FROM documents",
    "p8_invariants": "SELECT count(*) AS documents, 0::BIGINT AS not_kept, 0::BIGINT AS cut_needlessly, 0::BIGINT AS overfull_or_with_gaps FROM documents",
}

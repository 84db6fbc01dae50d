"""Readers of the lakehouse tables, one Parquet file or folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    """Table ``name`` under ``root``; with ``columns``, only these (the scan then reads no others)."""
    df = spark.read.parquet(f"{root}/{name}.parquet")
    return df.select(*[f"`{c}`" for c in columns]) if columns else df


def has_columns(df: DataFrame, *needed: str) -> bool:
    """Schema probe: does the frame hold every column of ``needed``?"""
    return set(needed) <= set(df.columns)

"""Quality rules: each gives the rows that violate it; none of them stops a pipeline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; null is a value here."""
    return df.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Nulls pass."""
    return df.filter(~F.col(column).isin(values))


def accepted_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Nulls pass; NaN doesn't."""
    c = F.col(column)
    bad = F.isnan(c.cast("double"))
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return df.filter(bad)


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def summary(rules: dict[str, DataFrame]) -> DataFrame:
    """``rule, violations`` for named violation frames."""
    counts = [v.agg(F.count("*").alias("violations")).select(F.lit(k).alias("rule"), "violations") for k, v in rules.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)

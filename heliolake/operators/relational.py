"""Relational operators that the data products share, as rewrites of DataFrames."""

from __future__ import annotations

from functools import reduce
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliolake.session import cut


def union_by_name(frames: list[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Union by column name; columns that a frame lacks are typed nulls. Without frames, an empty one of ``schema``."""
    if not frames:
        spark = SparkSession.getActiveSession()
        if schema is None or spark is None:
            raise ValueError("no frames, and no schema or session for an empty one")
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by position, as SQL's UNION ALL: the names are the first frame's; other numbers of columns are an error."""
    return reduce(lambda a, b: a.union(b), frames)


def numbered_ids(df: DataFrame, column: str, prefix: str = "NO_ID_") -> DataFrame:
    """Null ids become the prefix and a number of their own, from 1 in no given order, without a single task for all rows.

    Rows without an id are counted by partition first; each partition numbers its own from there.
    """
    part = cut(df.withColumn("__p", F.spark_partition_id()))
    none = part.filter(F.col(column).isNull())
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = none.groupBy("__p").agg(F.count("*").alias("__c")).select("__p", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__s"))  # one row a partition
    own = F.row_number().over(Window.partitionBy("__p").orderBy(F.monotonically_increasing_id()))
    numbered = none.join(F.broadcast(starts), "__p").withColumn(column, F.concat(F.lit(prefix), (F.col("__s") + own).cast("string"))).select(*df.columns)
    return part.filter(F.col(column).isNotNull()).select(*df.columns).unionByName(numbered)


def bernoulli(df: DataFrame, share: float, key: str | None = None, seed: int = 42) -> DataFrame:
    """Each row with the given chance; by a hash of ``key`` the same rows on every run."""
    return df.sample(False, share, seed) if key is None else df.filter(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000)) < share * 1_000_000)


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in a random order that a seed decides, by range partitions."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key)


def deleted_where_not_in(df: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """What DELETE ... WHERE key NOT IN (SELECT key FROM kept) leaves: nothing goes where the comparison is unknown."""
    gone = not_in(df.select(key), kept, key).distinct()
    return df.join(gone, df[key].eqNullSafe(gone[key]), "left_anti")


def structure_hash(df: DataFrame) -> str:
    """md5 of the number of rows and the sorted column names."""
    return md5(f"{df.count()}:{sorted(df.columns)}".encode()).hexdigest()


def best_match(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("__rn = 1").drop("__rn")


def best_by(df: DataFrame, key: list[str], rank: Column, *columns: str) -> DataFrame:
    """Columns of the row with the greatest rank per key, combined before the shuffle (no sort, no window)."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*columns), rank).alias("__b")).select(*key, *[f"__b.{c}" for c in columns])


def not_in(df: DataFrame, other: DataFrame, column: str) -> DataFrame:
    """SQL's NOT IN: rows with a null never pass, and none passes if the other side has a null.

    Over an empty other side every row passes, nulls too.
    """
    facts = other.agg(F.count("*").alias("__n"), F.count_if(F.col(column).isNull()).alias("__nulls"))
    kept = df.join(other.select(column).distinct(), column, "left_anti").crossJoin(F.broadcast(facts))  # one row
    return kept.filter((F.col("__n") == 0) | ((F.col("__nulls") == 0) & F.col(column).isNotNull())).drop("__n", "__nulls")


#: Comparisons that a filter dictionary may name.
OPERATORS = {
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(*v),
    "not in": lambda c, v: ~c.isin(*v),
    "between": lambda c, v: c.between(*v),
    "like": lambda c, v: c.like(v),
    "is null": lambda c, v: c.isNull() if v else c.isNotNull(),
}


def filter_by(df: DataFrame, conditions: dict[str, tuple[str, object]]) -> DataFrame:
    """All conditions ``{column: (operator, value)}`` together; without any, every row."""
    unknown = [op for op, _ in conditions.values() if op.lower() not in OPERATORS]
    if unknown:
        raise ValueError(f"unknown operators: {unknown}")
    return reduce(lambda d, kv: d.filter(OPERATORS[kv[1][0].lower()](F.col(kv[0]), kv[1][1])), conditions.items(), df)


def ladder(value: Column, steps: list[tuple[float, str]], last: str, null: str | None = None) -> Column:
    """Label of the first step whose bound exceeds the value."""
    out = F.lit(last)
    for bound, label in reversed(steps):
        out = F.when(value < bound, F.lit(label)).otherwise(out)
    return F.when(value.isNull(), F.lit(null)).otherwise(out)


def ratio(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """Division that gives ``default`` where the denominator isn't positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double")).otherwise(F.lit(default))


def candidate(df: DataFrame, names: list[str], kind: str) -> Column:
    """First usable value of an ordered list of columns, of those that the frame has."""
    have = [F.col(f"`{n}`") for n in names if n in df.columns]
    if not have:
        return F.lit(None).cast(kind)
    return F.coalesce(*[c.try_cast(kind) if kind != "string" else c.cast("string") for c in have])


def boxes_join(points: DataFrame, boxes: DataFrame, x: str, y: str, box: tuple[str, str, str, str], cell: float, how: str = "inner") -> DataFrame:
    """Points in closed boxes: both sides go to a grid, so a range join becomes an equi-join.

    A point is in one cell, so no pair is met twice; a box goes into every cell that it touches.
    """
    xmin, ymin, xmax, ymax = (F.col(c) for c in box)
    p = points.withColumns({"__gx": F.floor(F.col(x) / cell), "__gy": F.floor(F.col(y) / cell)})
    b = boxes.withColumn("__gx", F.explode(F.sequence(F.floor(xmin / cell), F.floor(xmax / cell))))
    b = b.withColumn("__gy", F.explode(F.sequence(F.floor(ymin / cell), F.floor(ymax / cell))))
    inside = F.col(x).between(xmin, xmax) & F.col(y).between(ymin, ymax)
    b = b.withColumnsRenamed({"__gx": "__bx", "__gy": "__by"})
    return p.join(b, (F.col("__gx") == F.col("__bx")) & (F.col("__gy") == F.col("__by")) & inside, how).drop("__gx", "__gy", "__bx", "__by")


def summary_of(df: DataFrame, column: str) -> DataFrame:
    """Count, nulls, distinct values, extremes, mean, deviation and quartiles of a numeric column, as one row."""
    c = F.col(column)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(c.isNull()).alias("n_null"),
        F.count_distinct(c).alias("n_distinct"),
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
        F.round(F.avg(c), 6).alias("mean_value"),
        F.round(F.stddev_samp(c), 6).alias("std_value"),
        *[F.round(F.percentile(c, p), 6).alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))],
    )

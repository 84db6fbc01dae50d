"""Problem 4: per-key results when a few keys hold most rows.

Positions within each key, in a total order, without a task that holds a whole hot key:

1. Rows are cut into slices of equal size along the order (range partitioning), and the cut
   is written once, so that a slice is the same in every later step.
2. Heavy hitters come from a frequent-items sketch over all rows (bounded memory, no row is
   left out; its error only decides which path a key takes, never a result).
3. Heavy keys: the number of rows in every slice, summed along the slices, gives each slice its
   first position. The heavy keys are counted: while they and the offsets (keys times slices) are
   at most ``BROADCAST_ROWS`` they are broadcast, beyond that shuffled. Rows are numbered within
   (key, slice), which no hot key can overfill.
4. All other keys are numbered by an ordinary shuffle on the key, and both parts are united.

Defined results: rows whose key is null have no position; null order values come first; rows
equal in all order columns are numbered in an arbitrary order among themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliolake.session import cut, partitions

#: A key with more than this share of all rows is heavy.
SHARE = 1 / 256
#: Items that the sketch tracks; its error is about 3.5 / TRACKED of all rows.
TRACKED = 8192
#: Most rows of heavy keys, and of offsets, that are broadcast.
BROADCAST_ROWS = 500_000


def heavy_keys(df: DataFrame, key: str, share: float = SHARE, by: list[str] | None = None) -> DataFrame:
    """Keys that hold more than ``share`` of the rows (of each group of ``by``), by a frequent-items sketch.

    At most ``1 / share`` rows a group. A key whose share is within the sketch's error of the
    limit may fall on either side.
    """
    by = by or []
    k = int(1 / share) + 1
    size = df.filter(F.col(key).isNotNull()).groupBy(*by).agg(F.count("*").alias("__n"), F.expr(f"approx_top_k(`{key}`, {k}, {max(TRACKED, 4 * k)})").alias("__top"))
    return size.select(*by, "__n", F.explode("__top").alias("__t")).filter(F.col("__t.count") > F.col("__n") * share).select(*by, F.col("__t.item").alias(key))


def positions(df: DataFrame, key: str, order: list[str], by: list[str] | None = None, out: str = "position", share: float = SHARE) -> DataFrame:
    """``df`` with the position (from 1) of each row within its key; ``by`` are further, few-valued key columns.

    A column named ``out`` in the input is replaced; ``__slice`` and ``__before`` are reserved.
    """
    by = by or []
    keys = [*by, key]
    df = df.drop(out, "__slice", "__before")
    slices = max(2, partitions(df.sparkSession))
    rows = df.filter(F.col(key).isNotNull())
    rows = cut(rows.repartitionByRange(slices, *[F.col(c).asc_nulls_first() for c in order]).withColumn("__slice", F.spark_partition_id()))
    ordered = [F.col(c).asc_nulls_first() for c in order]

    heavy = cut(heavy_keys(rows, key, share, by))
    n_heavy = heavy.count()  # with many values of ``by`` there may be many
    marked = F.broadcast(heavy) if n_heavy <= BROADCAST_ROWS else heavy
    is_heavy = [rows[c].eqNullSafe(marked[c]) for c in keys]
    hot = rows.join(marked, keys, "left_semi") if not by else rows.join(marked, is_heavy, "left_semi")
    cold = rows.join(marked, keys, "left_anti") if not by else rows.join(marked, is_heavy, "left_anti")

    per_slice = hot.groupBy(*keys, "__slice").agg(F.count("*").alias("__c"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(*keys, "__slice", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before"))
    # beyond the bound the join shuffles by (key, slice), which is even
    small = n_heavy * slices <= BROADCAST_ROWS
    hot = hot.join(F.broadcast(offsets) if small else offsets, [*keys, "__slice"])
    hot = hot.withColumn(out, F.col("__before") + F.row_number().over(Window.partitionBy(*keys, "__slice").orderBy(*ordered))).drop("__before")

    cold = cold.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*ordered)).cast("long"))
    return hot.unionByName(cold).drop("__slice")

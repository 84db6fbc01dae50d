"""Incremental ingest: a stream of delivered files into a versioned table.

Structured Streaming's file source, one upsert a micro-batch. Each upsert writes a whole new version of the
table, so batches should be large against the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from heliolake.operators.relational import best_by
from heliolake.sources.sinks import Versions, upsert


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def latest_rows(df: DataFrame, key: list[str], time: str) -> DataFrame:
    """Of each key the row with the latest time, nulls last; ties by content."""
    others = [c for c in df.columns if c not in key]
    rank = F.struct(F.col(time), F.xxhash64(*[F.col(c) for c in others]))
    return best_by(df, key, rank, *others).select(*df.columns)


def start_upserts(stream: DataFrame, target: Versions, key: list[str], time: str, checkpoint: str):
    """A query that merges each micro-batch into the table; a repeated batch changes nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        rows = latest_rows(batch, key, time)
        if target.snapshots():
            current = target.read()
            rows = latest_rows(rows.unionByName(current.join(rows.select(*key), key, "left_semi")), key, time)
            rows = upsert(current, rows, key)
        target.write(rows)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

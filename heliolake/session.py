"""Session settings and the few helpers that touch the SparkContext."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "heliolake", master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with the settings that the plans rely on: UTC, AQE with skew handling, Arrow.

    ``master`` and ``shuffle_partitions`` are left to spark-submit where they are None.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in extra.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or a folder of our own where that is unset and the master is local.

    On a cluster a folder of one machine would lose rows silently, so there an unset folder is an error.
    """
    sc = spark.sparkContext
    now = sc._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    path = spark.conf.get("spark.checkpoint.dir", None) or _own_dir(sc.master)
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


def _own_dir(master: str) -> str:
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    return tempfile.mkdtemp(prefix="heliolake-")


_made: list[tuple[SparkSession, str]] = []


def drop_tables() -> None:
    """Remove the tables that :func:`cut` has written. For callers that are done with all results; also runs when the process ends in order."""
    for spark, path in _made:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session is gone
            break
    _made.clear()


def own_folder(spark: SparkSession, kind: str = "table") -> str:
    """A new name in the shared folder, removed with the tables of this process."""
    path = f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and go on from the files.

    Used where a result is read more than once or a loop would grow the lineage. The files
    survive the loss of executors. Unlike an RDD checkpoint, which works out its input a second
    time, this runs the plan once, adaptively, and later steps read only the columns they need.
    """
    return cut_all(df)[0]


def cut_all(*dfs: DataFrame) -> tuple[DataFrame, ...]:
    """:func:`cut` of tables that don't need each other: they are written side by side, as one alone often leaves cores idle."""
    spark = dfs[0].sparkSession
    paths = [own_folder(spark) for _ in dfs]
    if len(dfs) == 1:
        dfs[0].write.parquet(paths[0])
    else:
        write = inheritable_thread_target(spark)(lambda df, path: df.write.parquet(path))
        with ThreadPoolExecutor(len(dfs)) as pool:
            list(pool.map(write, dfs, paths))
    return tuple(spark.read.schema(df.schema).parquet(path) for df, path in zip(dfs, paths))


def file_bytes(df: DataFrame) -> int:
    """Size of the files that a table of :func:`cut` stands in, all columns."""
    return int(df._jdf.queryExecution().analyzed().stats().sizeInBytes())


cut_table = cut
atexit.register(drop_tables)


def partitions(spark: SparkSession) -> int:
    """The cluster's shuffle width, the only size knob that the operators use."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

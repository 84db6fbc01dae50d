"""Catalogs: databases, tables, views, partitioned and theme scans, and statements on tables.

Everything goes through the session's catalog, so a metastore that is configured for the session is
the catalog that is attached. Names are quoted part by part; a name that isn't there is an error that says what is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A dotted name with each part quoted."""
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def attach(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create a database if it isn't there, at a location of the shared storage, and use it."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}" + (f" LOCATION '{location}'" if location else ""))
    spark.sql(f"USE {quoted(database)}")


def tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``namespace, name, kind, is_temporary`` of tables and views."""
    rows = [(".".join(t.namespace or []), t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "namespace string, name string, kind string, is_temporary boolean")


def describe(spark: SparkSession, name: str) -> DataFrame:
    """``position, column_name, data_type, is_nullable`` of a table or view."""
    rows = [(k, f.name, f.dataType.simpleString(), f.nullable) for k, f in enumerate(table(spark, name).schema)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, is_nullable boolean")


def table(spark: SparkSession, name: str, wkb: str | None = None) -> DataFrame:
    """A table by name; an unknown one is an error that lists what there is.

    With ``wkb`` the column ``geometry`` is taken from that binary column where it is missing or null.
    """
    if not spark.catalog.tableExists(name):
        there = sorted(t.name for t in spark.catalog.listTables())
        raise ValueError(f"no table {name}; there are {there}")
    df = spark.table(name)
    if wkb is None or wkb not in df.columns:
        return df
    from heliolake.functions import st

    text = st.st_astext(F.col(wkb))
    return df.withColumn("geometry", F.coalesce("geometry", text) if "geometry" in df.columns else text)


def create_view(df: DataFrame, name: str, temporary: bool = True) -> None:
    """A view of a frame in the session, or of a table's query in the catalog."""
    if temporary:
        df.createOrReplaceTempView(name)
        return
    raise ValueError("a permanent view needs its SQL: use create_view_as")


def create_view_as(spark: SparkSession, name: str, sql: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {sql}")


def create_table_as(spark: SparkSession, name: str, sql: str, partition_by: list[str] | None = None) -> None:
    """Replace a table by a query's result; the query may read the table itself, as the result is written beside it first."""
    from heliolake.session import cut

    w = cut(spark.sql(sql)).write.mode("overwrite").format("parquet")
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)


def insert_by_key(df: DataFrame, name: str, key: list[str]) -> int:
    """Append the rows whose key a table hasn't, each key once, as a primary key demands; null keys are an error. Returns the table's rows."""
    spark = df.sparkSession
    nulls = df.filter(" OR ".join(f"`{k}` IS NULL" for k in key))
    if not nulls.isEmpty():
        raise ValueError(f"null in the key {key}")
    new = df.dropDuplicates(key)
    if spark.catalog.tableExists(name):
        new = new.join(spark.table(name).select(*key), key, "left_anti").select(*spark.table(name).columns)
        new.write.mode("append").insertInto(name)
    else:
        new.write.format("parquet").saveAsTable(name)
    return spark.table(name).count()


def drop(spark: SparkSession, name: str) -> None:
    """DROP TABLE or VIEW IF EXISTS, whichever the name means."""
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if spark.catalog.getTable(name).isTemporary:
            spark.catalog.dropTempView(name)
        else:
            spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} IF EXISTS {quoted(name)}")


def scan(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    """Parquet under a path or glob, with the partition columns of ``key=value`` folders, pruned by filters on them."""
    root = path.split("*", 1)[0].rstrip("/") if "*" in path else None
    df = spark.read.option("mergeSchema", "true")
    df = (df.option("basePath", root) if root else df).parquet(path)
    if missing := [c for c in required or [] if c not in df.columns]:
        raise ValueError(f"{path} has no columns {missing}")
    return df


def theme_scan(df: DataFrame, bbox: tuple[float, float, float, float], theme: str | None = None, kind: str | None = None, release: str | None = None) -> DataFrame:
    """Features whose box meets ``bbox`` (xmin, ymin, xmax, ymax), of a theme, type and release. All conditions are plain comparisons, so they prune folders and row groups."""
    for column, value in (("theme", theme), ("type", kind), ("release", release)):
        if value is not None:
            df = df.filter(F.col(column) == value)
    xmin, ymin, xmax, ymax = bbox
    return df.filter((F.col("bbox.xmin") <= xmax) & (F.col("bbox.xmax") >= xmin) & (F.col("bbox.ymin") <= ymax) & (F.col("bbox.ymax") >= ymin))


def csv_metadata(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV file with a header; blanks are null, types are inferred unless given."""
    r = spark.read.option("header", "true").option("ignoreLeadingWhiteSpace", "true").option("ignoreTrailingWhiteSpace", "true").option("mode", "PERMISSIVE")
    return (r.schema(schema) if schema else r.option("inferSchema", "true")).csv(path)


def copy_to(df: DataFrame, path: str, form: str = "parquet", compression: str | None = None, row_group_bytes: int | None = None, partition_by: list[str] | None = None) -> None:
    """COPY (query) TO: Parquet (any codec, row group size, partition folders), CSV with a header, or JSON lines. Written beside and swapped, so a failed write leaves the old files."""
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    if row_group_bytes:
        w = w.option("parquet.block.size", str(row_group_bytes))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if form == "csv":
        w.option("header", "true").csv(path)
    elif form == "json":
        w.json(path)
    elif form == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {form}: csv, json or parquet")

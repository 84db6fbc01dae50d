"""Writers: tables, GeoParquet with a covering box, GeoJSON lines, guarded and versioned writes; CSV and others are in :mod:`heliolake.sources.catalog`."""

from __future__ import annotations

import json
import shutil
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.functions import st
from heliolake.functions.geo_columns import measures
from heliolake.session import cut


def save_table(df: DataFrame, name: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> int:
    """Managed table, replaced as a whole; its number of rows, read back from it."""
    w = df.write.mode(mode)
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)
    return df.sparkSession.table(name).count()


def geoparquet_frame(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Geometry as WKB in ``geometry`` and its box in ``bbox``, so that row groups can be pruned by place."""
    m = df.withColumn("__m", measures(F.col(geometry), "xmin", "ymin", "xmax", "ymax"))
    box = F.struct(*[F.col(f"__m.{k}").alias(k) for k in ("xmin", "ymin", "xmax", "ymax")])
    return m.withColumn("__wkb", st.st_aswkb(geometry)).withColumn("bbox", box).drop("__m", geometry).withColumnRenamed("__wkb", "geometry")


def geo_metadata(kinds: list[str], bbox: list[float] | None = None) -> str:
    """The ``geo`` entry of a GeoParquet 1.1 footer."""
    column = {"encoding": "WKB", "geometry_types": kinds, "covering": {"bbox": {k: ["bbox", k] for k in ("xmin", "ymin", "xmax", "ymax")}}}
    if bbox:
        column["bbox"] = bbox
    return json.dumps({"version": "1.1.0", "primary_column": "geometry", "columns": {"geometry": column}})


#: Names of the geometry types in a footer.
FOOTER_KINDS = {"POINT": "Point", "LINESTRING": "LineString", "POLYGON": "Polygon", "MULTIPOINT": "MultiPoint", "MULTILINESTRING": "MultiLineString", "MULTIPOLYGON": "MultiPolygon", "GEOMETRYCOLLECTION": "GeometryCollection"}


def write_geoparquet(df: DataFrame, path: str, geometry: str = "geometry", compression: str = "zstd", sort: bool = True) -> None:
    """Parquet with WKB, box and the ``geo`` entry in every file's footer, in Hilbert order of the boxes so that their statistics prune.

    Types and bounds are found in one aggregate over the frame, which is written once before, so that its geometries
    are decoded once. Spark can't name footer entries of its own, so each file is stamped by a task afterwards.
    """
    out = cut(geoparquet_frame(df, geometry))
    facts = out.agg(F.collect_set(st.st_geometrytype("geometry")), *[f(f"bbox.{k}") for f, k in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))]).first()  # at most seven types
    kinds = sorted(FOOTER_KINDS[k] for k in facts[0] if k in FOOTER_KINDS)
    meta = geo_metadata(kinds, list(facts[1:]) if facts[1] is not None else None)
    if sort:
        code = st.st_hilbert((F.col("bbox.xmin") + F.col("bbox.xmax")) / 2, (F.col("bbox.ymin") + F.col("bbox.ymax")) / 2)
        out = out.withColumn("__h", code).repartitionByRange("__h").sortWithinPartitions("__h").drop("__h")
    out.write.mode("overwrite").option("compression", compression).parquet(path)
    _stamp(df.sparkSession, path, meta)


def _stamp(spark: SparkSession, path: str, meta: str) -> None:
    """Rewrite each file with the ``geo`` entry in its footer, one task a file, beside it and then renamed; rows and row groups stay."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    files = [str(s.getPath().toString()) for s in fs.listStatus(root) if s.getPath().getName().endswith(".parquet")]

    def stamp(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as F_
        from pyarrow import parquet as pq

        for b in batches:
            for name in b.column(0).to_pylist():
                store, place = F_.FileSystem.from_uri(name if "://" in name else name.replace("file:", "file://", 1))
                with store.open_input_file(place) as f:
                    source = pq.ParquetFile(f)
                    schema = source.schema_arrow.with_metadata({**(source.schema_arrow.metadata or {}), b"geo": meta.encode()})
                    codec = source.metadata.row_group(0).column(0).compression if source.metadata.num_row_groups else "zstd"
                    with store.open_output_stream(place + ".stamped") as o, pq.ParquetWriter(o, schema, compression=codec) as w:
                        for k in range(source.metadata.num_row_groups):
                            w.write_table(source.read_row_group(k).cast(schema))
                store.move(place + ".stamped", place)
                check = "/".join([*place.split("/")[:-1], "." + place.split("/")[-1] + ".crc"])
                if store.get_file_info(check).type == F_.FileType.File:  # the checksum of the file as it was
                    store.delete_file(check)
                yield pa.RecordBatch.from_arrays([pa.array([name])], names=["file"])

    if files:
        spark.createDataFrame([(f,) for f in files], "file string").repartition(len(files)).mapInArrow(stamp, "file string").count()


def geo_footer(spark: SparkSession, path: str) -> dict:
    """The ``geo`` entry of the first file under a path, as readers find it; an error if there is none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    for s in root.getFileSystem(conf).listStatus(root):
        if s.getPath().getName().endswith(".parquet"):
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(s.getPath(), conf))
            try:
                entry = reader.getFooter().getFileMetaData().getKeyValueMetaData().get("geo")
            finally:
                reader.close()
            if entry is None:
                raise ValueError(f"no geo entry in {s.getPath().toString()}")
            return json.loads(entry)
    raise ValueError(f"no Parquet file in {path}")


def geojson_lines(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One GeoJSON feature a line (column ``value``); rings and parts come from the WKT by text."""
    wkt = F.regexp_replace(st.st_astext(F.col(geometry)), r"(-?[0-9.eE+-]+) (-?[0-9.eE+-]+)", "[$1,$2]")
    kind = F.regexp_extract(wkt, r"^([A-Z]+)", 1)
    name = F.element_at(F.create_map(*[F.lit(x) for k, v in (("POINT", "Point"), ("LINESTRING", "LineString"), ("POLYGON", "Polygon"), ("MULTIPOINT", "MultiPoint"), ("MULTILINESTRING", "MultiLineString"), ("MULTIPOLYGON", "MultiPolygon")) for x in (k, v)]), F.nullif(kind, F.lit("")))
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace(wkt, r"^[A-Z]+ ", ""), r"\(", "["), r"\)", "]")
    body = F.when(kind == "POINT", F.regexp_replace(F.regexp_replace(body, r"^\[\[", "["), r"\]\]$", "]")).otherwise(body)
    geometry_json = F.when(name.isNotNull(), F.concat(F.lit('{"type":"'), name, F.lit('","coordinates":'), body, F.lit("}"))).otherwise(F.lit("null"))
    props = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != geometry]), {"ignoreNullFields": "false"})
    return df.select(F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), geometry_json, F.lit("}")).alias("value"))


def checksum(df: DataFrame) -> tuple[int, str]:
    """(rows, order-independent checksum of all values), in one aggregate."""
    r = df.agg(F.count("*"), F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)"))).first()
    return r[0], str(r[1])


class Versions:
    """A table as versioned folders with a manifest of snapshots: replace, list, travel back, expire, clean up, compact.

    A version is written beside the others and becomes current by one rename of the manifest, so
    readers never see half a table, and a table may be rewritten from itself.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, Path(root)

    def _load(self) -> list[dict]:
        p = self.root / "_snapshots.json"
        return json.loads(p.read_text()) if p.exists() else []

    def _store(self, snapshots: list[dict]) -> None:
        self.root.mkdir(parents=True, exist_ok=True)
        tmp = self.root / f"_snapshots.{uuid.uuid4().hex}"
        tmp.write_text(json.dumps(snapshots))
        tmp.rename(self.root / "_snapshots.json")

    def write(self, df: DataFrame, now: datetime | None = None, skip_unchanged: bool = True) -> dict | None:
        """A new snapshot; None if the content is that of the current one.

        The plan runs once: rows are counted and summed over the written files.
        """
        old = self._load()
        folder = f"v{len(old) + 1:06d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(str(self.root / folder))
        rows, sum_ = checksum(self.spark.read.schema(df.schema).parquet(str(self.root / folder)))
        if skip_unchanged and old and (old[-1]["rows"], old[-1]["checksum"]) == (rows, sum_):
            shutil.rmtree(self.root / folder)
            return None
        snap = {"snapshot_id": (old[-1]["snapshot_id"] if old else 0) + 1, "folder": folder, "rows": rows, "checksum": sum_, "created_at": (now or datetime.now(timezone.utc)).isoformat()}
        self._store([*old, snap])
        return snap

    def read(self, snapshot_id: int | None = None) -> DataFrame:
        """The current table, or that of a snapshot."""
        snaps = self._load()
        hit = [s for s in snaps if snapshot_id is None or s["snapshot_id"] == snapshot_id]
        if not hit:
            raise ValueError(f"no snapshot {snapshot_id or ''} in {self.root}")
        return self.spark.read.parquet(str(self.root / hit[-1]["folder"]))

    def snapshots(self) -> list[dict]:
        """Newest first."""
        return self._load()[::-1]

    def expire(self, older_than: datetime, dry_run: bool = True) -> list[dict]:
        """Snapshots made before a time, but never the current one; dropped from the list unless dry."""
        snaps = self._load()
        gone = [s for s in snaps[:-1] if datetime.fromisoformat(s["created_at"]) < older_than]
        if gone and not dry_run:
            self._store([s for s in snaps if s not in gone])
        return gone

    def cleanup(self, dry_run: bool = True) -> list[str]:
        """Version folders that no snapshot refers to; removed unless dry."""
        kept = {s["folder"] for s in self._load()}
        gone = sorted(p.name for p in self.root.iterdir() if p.is_dir() and p.name.startswith("v") and p.name not in kept) if self.root.exists() else []
        if not dry_run:
            for name in gone:
                shutil.rmtree(self.root / name)
        return gone

    def compact(self, target_bytes: int = 128 << 20) -> dict | None:
        """Rewrite the current version in files of about the target size."""
        cur = self._load()[-1]
        size = sum(p.stat().st_size for p in (self.root / cur["folder"]).rglob("*.parquet"))
        n = max(1, round(size / target_bytes))
        return self.write(self.read().repartition(n), skip_unchanged=False)

    def maintain(self, older_than: datetime, dry_run: bool = True) -> dict[str, list]:
        """Expiry, then cleanup."""
        return {"expired": self.expire(older_than, dry_run), "removed": self.cleanup(dry_run)}


def storage_result(spark: SparkSession, tables: dict[str, DataFrame]) -> dict:
    """Rows and schemas of named frames, with totals."""
    rows = {k: v.count() for k, v in tables.items()}
    return {"tables": [{"name": k, "rows": n, "columns": len(tables[k].columns)} for k, n in rows.items()], "total_rows": sum(rows.values()), "total_tables": len(rows)}


def upsert(current: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``changes`` replace those of ``current`` with the same key; nulls are equal."""
    on = [current[k].eqNullSafe(changes[k]) for k in key]
    return current.join(changes, on, "left_anti").unionByName(changes, allowMissingColumns=True)

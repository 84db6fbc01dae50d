"""Files: discovery and filters, manifests, vector formats, archives."""

from __future__ import annotations

import fnmatch
import json
import re
import sqlite3
import struct
import tarfile
import zipfile
from collections.abc import Iterator
from itertools import islice, repeat
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Names of vector files.
VECTOR_SUFFIXES = (".geojson", ".json", ".gpkg", ".shp", ".kml", ".gml")


def glob_to_regex(pattern: str) -> str:
    """Java regular expression of a shell pattern, for the whole text."""
    out = ""
    for c in pattern:
        out += ".*" if c == "*" else "." if c == "?" else re.escape(c)
    return f"^{out}$"


def find_files(root: str, suffixes: tuple[str, ...] = VECTOR_SUFFIXES) -> list[str]:
    """Files below a folder, by suffix, in order of path."""
    return sorted(str(p) for p in Path(root).rglob("*") if p.is_file() and p.suffix.lower() in suffixes)


def filter_files(files: list[str], include: list[str] | None = None, exclude: list[str] | None = None, use_regex: bool = False) -> list[str]:
    """Files that match an include pattern and no exclude pattern; if none does, all of them."""

    def hit(f: str, patterns: list[str]) -> bool:
        name = Path(f).name
        return any(re.search(p, name) if use_regex else fnmatch.fnmatch(name, p) or Path(f).match(p) for p in patterns)

    kept = [f for f in files if (not include or hit(f, include)) and not (exclude and hit(f, exclude))]
    return kept or files


def expand_archives(root: str) -> list[str]:
    """Unpack zip and tar archives in place; paths that would leave the folder are refused."""
    done = []
    for p in sorted(Path(root).rglob("*")):
        to = p.parent / p.name.split(".")[0]
        if p.suffix == ".zip":
            with zipfile.ZipFile(p) as z:
                if any(not (to / n).resolve().is_relative_to(to.resolve()) for n in z.namelist()):
                    raise ValueError(f"{p}: a member leaves the folder")
                z.extractall(to)
            done.append(str(to))
        elif p.name.endswith((".tar.gz", ".tgz", ".tar")):
            with tarfile.open(p) as t:
                t.extractall(to, filter="data")
            done.append(str(to))
    return done


def read_manifest(path: str) -> dict[str, dict]:
    """JSON manifest, keyed by dataset; a missing file is an error."""
    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(f"no manifest at {path}")
    return json.loads(p.read_text())


def available_datasets(manifest: dict[str, dict], fallback: list[str] | None = None) -> list[str]:
    """Datasets that the manifest doesn't skip, in its order; the fallback if there is none."""
    names = [k for k, v in manifest.items() if not v.get("skip")]
    return names or list(fallback or [])


def manifest_frame(spark: SparkSession, path: str) -> DataFrame:
    """``dataset_name`` and the entry's fields as a map, from a whole JSON document."""
    doc = spark.read.text(path, wholetext=True)
    return doc.select(F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("dataset_name", "entry"))


_GEOJSON = "struct<type:string,features:array<struct<type:string,geometry:string,properties:map<string,string>>>>"


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features of GeoJSON files, whole documents or one feature a line: ``properties, geometry`` (WKT), ``source_file``."""
    lines = spark.read.text(path, wholetext=True).withColumn("source_file", F.input_file_name())
    doc = F.from_json("value", _GEOJSON)
    whole = lines.withColumn("d", doc).filter("d.features IS NOT NULL").select("source_file", F.explode("d.features").alias("f"))
    single = lines.withColumn("d", doc).filter("d.features IS NULL").select("source_file", F.explode(F.split("value", "\n")).alias("l")).filter(F.trim("l") != "")
    single = single.select("source_file", F.from_json("l", "struct<type:string,geometry:string,properties:map<string,string>>").alias("f"))
    return whole.unionByName(single).select("f.properties", geojson_to_wkt(F.col("f.geometry")).alias("geometry"), "source_file")


def _coords(v: list, depth: int) -> str:
    if depth == 0:
        return " ".join(repr(float(x)) for x in v[:2])
    return "(" + ", ".join(_coords(x, depth - 1) for x in v) + ")"


def geometry_text(g: dict | None) -> str | None:
    """WKT of a GeoJSON geometry."""
    if not g or g.get("type") not in ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon"):
        return None
    depth = {"Point": 0, "LineString": 1, "MultiPoint": 1, "Polygon": 2, "MultiLineString": 2, "MultiPolygon": 3}[g["type"]]
    c = g.get("coordinates")
    if not c:
        return f"{g['type'].upper()} EMPTY"
    body = _coords(c, depth)
    return f"{g['type'].upper()} {body if depth else f'({body})'}"


@F.pandas_udf(T.StringType())
def geojson_to_wkt(text):  # noqa: ANN001, ANN201
    return text.map(lambda t: geometry_text(json.loads(t)) if t else None)


#: Rows that a task reads of one file, and rows of a batch on the way.
TASK_ROWS, BATCH_ROWS = 500_000, 4096


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, BATCH_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)


def read_gpkg(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """One layer of a GeoPackage: its columns as text and ``geometry`` as WKB.

    The driver reads names and the largest row number only; each task reads ``TASK_ROWS`` rows of the file,
    which all executors must see under the same path.
    """
    con = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
    try:
        layer, column = con.execute("SELECT table_name, column_name FROM gpkg_geometry_columns" + (" WHERE table_name = ?" if table else " ORDER BY table_name LIMIT 1"), (table,) if table else ()).fetchone()
        names = [d[0] for d in con.execute(f'SELECT * FROM "{layer}" LIMIT 0').description]
        low, high = con.execute(f'SELECT min(rowid), max(rowid) FROM "{layer}"').fetchone()
    finally:
        con.close()
    schema = T.StructType([T.StructField("geometry" if n == column else n, T.BinaryType() if n == column else T.StringType()) for n in names])
    if low is None:
        return spark.createDataFrame([], schema)
    form = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in b.column(0).to_pylist():
                own = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
                try:
                    cur = own.execute(f'SELECT * FROM "{layer}" WHERE rowid >= ? AND rowid < ?', (start, start + TASK_ROWS))
                    yield from _batches((tuple(_gpkg_wkb(v) if n == column else None if v is None else str(v) for n, v in zip(names, row)) for row in cur), form)
                finally:
                    own.close()

    return spark.range(low, high + 1, TASK_ROWS, max(1, (high - low) // TASK_ROWS + 1)).mapInArrow(run, schema)


def _gpkg_wkb(blob: bytes | None) -> bytes | None:
    if not blob or blob[:2] != b"GP":
        return None
    envelope = (0, 32, 48, 48, 64)[(blob[3] >> 1) & 7]
    return bytes(blob[8 + envelope :])


def read_shapefile(spark: SparkSession, path: str) -> DataFrame:
    """Points and polygons of a shapefile with its attributes as text: a ``.shp`` beside a ``.dbf``.

    The driver reads the attributes' names only; one task reads the file from front to back, shape by shape.
    """
    dbf = Path(path).with_suffix(".dbf")
    fields = _dbf_fields(dbf)[0] if dbf.exists() else []
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n, _ in fields], T.StructField("geometry", T.StringType())])
    form = to_arrow_schema(schema)

    def shapes() -> Iterator[str | None]:
        with open(path, "rb") as f:
            f.seek(100)
            while len(head := f.read(8)) == 8:
                yield _shape(f.read(2 * struct.unpack(">i", head[4:])[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            rows = _dbf_rows(dbf) if fields else repeat(())
            yield from _batches(((*r, s) for r, s in zip(rows, shapes())), form)

    return spark.range(1).repartition(1).mapInArrow(run, schema)


def _shape(b: bytes) -> str | None:
    (kind,) = struct.unpack_from("<i", b)
    if kind % 10 == 1:
        return "POINT ({!r} {!r})".format(*struct.unpack_from("<2d", b, 4))
    if kind % 10 != 5:
        return None
    parts, points = struct.unpack_from("<2i", b, 36)
    starts = [*struct.unpack_from(f"<{parts}i", b, 44), points]
    xy = struct.unpack_from(f"<{2 * points}d", b, 44 + 4 * parts)
    polygons: list[list[str]] = []
    for a, z in zip(starts, starts[1:]):
        p = [(xy[2 * k], xy[2 * k + 1]) for k in range(a, z)]
        turn = sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(p, p[1:]))
        ring = "(" + ", ".join(f"{x!r} {y!r}" for x, y in p) + ")"
        if turn <= 0 or not polygons:  # shells turn clockwise in this format
            polygons.append([ring])
        else:
            polygons[-1].append(ring)
    return "MULTIPOLYGON (" + ", ".join("(" + ", ".join(q) + ")" for q in polygons) + ")"


def _dbf_fields(path: Path) -> tuple[list[tuple[str, int]], tuple[int, int, int]]:
    """((name, width) of the fields, (rows, bytes before the first, bytes of one))."""
    with open(path, "rb") as f:
        b = f.read(32)
        n, head, size = struct.unpack_from("<IHH", b, 4)
        b += f.read(head - 32)
    fields, at = [], 32
    while b[at] != 0x0D:
        fields.append((b[at : at + 11].split(b"\0")[0].decode("latin-1"), b[at + 16]))
        at += 32
    return fields, (n, head, size)


def _dbf_rows(path: Path) -> Iterator[tuple]:
    fields, (n, head, size) = _dbf_fields(path)
    with open(path, "rb") as f:
        f.seek(head)
        for _ in range(n):
            b, pos, row = f.read(size), 1, []
            for _, width in fields:
                row.append(b[pos : pos + width].decode("utf-8", "replace").strip() or None)
                pos += width
            yield tuple(row)


def read_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Box labels ``class xc yc w h`` in shares of the image, one a line, as clipped corners."""
    p = F.split(F.trim("value"), r"\s+")
    num = lambda k: F.get(p, k).try_cast("double")
    df = spark.read.text(path).select(F.input_file_name().alias("source_file"), F.get(p, 0).try_cast("int").alias("label"), num(1).alias("xc"), num(2).alias("yc"), num(3).alias("w"), num(4).alias("h"))
    clip = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    xc, yc, w, h = F.col("xc"), F.col("yc"), F.col("w"), F.col("h")
    return df.filter("h IS NOT NULL").select("source_file", "label", clip(xc - w / 2).alias("x0"), clip(yc - h / 2).alias("y0"), clip(xc + w / 2).alias("x1"), clip(yc + h / 2).alias("y1"))

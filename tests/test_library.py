"""Sources, sinks, versions, pipeline, products and plan shapes."""

import json
import sqlite3
import struct
import subprocess
import sys
import tarfile
import zipfile
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from heliolake.operators import expectations as X
from heliolake.operators import products as P
from heliolake.operators import relational as R
from heliolake.plans import lakehouse as L
from heliolake.plans import twins
from heliolake.plans.pipeline import Pipeline, load_config, merged
from heliolake.sources import files, sinks
from heliolake.streaming import incremental

SQUARE = "POLYGON ((0 0, 4 0, 4 3, 0 3, 0 0))"


# --- relational ----------------------------------------------------------------------------


def test_not_in_follows_sql(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    some = spark.createDataFrame([(1,)], "k int")
    null = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r.k for r in R.not_in(df, some, "k").collect()] == [2]
    assert R.not_in(df, null, "k").collect() == []
    assert R.not_in(df, some.limit(0), "k").count() == 3


def test_country_stats_count_all_customers(spark, tmp_path):
    spark.createDataFrame([(k, f"N{k}") for k in range(5)], "n_nationkey int, n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    spark.createDataFrame([(0, 1.0), (0, 3.0), (1, -2.5), (3, 7.0)], "c_nationkey int, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    got = {r.n_nationkey: tuple(r)[2:] for r in twins.country_stats_zero_fill(spark, str(tmp_path)).collect()}
    none = (0, 0.0, 0.0, 0.0, 0.0, "No PV")
    assert got == {0: (2, 4.0, 2.0, 1.0, 3.0, "Low PV"), 1: (1, -2.5, -2.5, -2.5, -2.5, "Low PV"), 2: none, 3: (1, 7.0, 7.0, 7.0, 7.0, "Low PV"), 4: none}


def test_positional_contexts_hold_every_row(spark):
    c = spark.range(1, 31).withColumnRenamed("id", "c_custkey")
    contexts = twins.positional_contexts(c)
    assert [t.count() for t in contexts] == [30, 30]
    got = {r.c_custkey: (r.site, r.cover) for r in twins.joined_contexts(c, "c_custkey", contexts).collect()}
    assert got == {k: (f"site{k % 7}" if k % 2 == 0 else None, f"cover{k % 5}" if k % 3 == 0 else None) for k in range(1, 31)}
    # keys that a context table doesn't have keep their row
    part = contexts[0].filter("c_custkey <= 10")
    assert {r.c_custkey: r.site for r in twins.joined_contexts(c, "c_custkey", [part]).collect()} == {k: got[k][0] if k <= 10 else None for k in range(1, 31)}


def test_boxes_join_equals_brute_force(spark):
    pts = [(k, (k * 37) % 101 - 50.0, (k * 53) % 83 - 40.0) for k in range(300)] + [(900, None, 1.0)]
    boxes = [(k, x, y, x + w, y + w) for k, (x, y, w) in enumerate([(-50.0, -40.0, 30.0), (0.0, 0.0, 0.0), (5.0, 5.0, 7.5), (-10.0, -10.0, 90.0)])]
    p = spark.createDataFrame(pts, "id int, x double, y double")
    b = spark.createDataFrame(boxes, "box int, x0 double, y0 double, x1 double, y1 double")
    got = {(r.id, r.box) for r in R.boxes_join(p, b, "x", "y", ("x0", "y0", "x1", "y1"), 10.0).collect()}
    assert got == {(i, k) for i, x, y in pts if x is not None for k, x0, y0, x1, y1 in boxes if x0 <= x <= x1 and y0 <= y <= y1}
    plan = R.boxes_join(p, b, "x", "y", ("x0", "y0", "x1", "y1"), 10.0)._jdf.queryExecution().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_filter_by_rejects_unknown_operators(spark):
    df = spark.range(10)
    assert R.filter_by(df, {}).count() == 10
    assert R.filter_by(df, {"id": ("in", [1, 2])}).count() == 2
    with pytest.raises(ValueError):
        R.filter_by(df, {"id": ("; DROP", 1)})


def test_candidates(spark):
    df = spark.createDataFrame([(None, "3", "x"), ("a", None, "y")], "p string, q string, r string")
    assert [r[0] for r in df.select(R.candidate(df, ["zz", "p", "q"], "double")).collect()] == [3.0, None]
    assert [r[0] for r in df.select(R.candidate(df, ["p", "r"], "string")).collect()] == ["x", "a"]
    assert df.select(R.candidate(df, ["zz"], "double")).first()[0] is None


def test_expectations(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (None, float("nan")), (2, -1.0)], "k int, v double")
    assert X.not_null(df, "k").count() == 1 and X.unique(df, "k").count() == 1
    assert X.accepted_range(df, "v", 0, 10).count() == 2 and X.accepted_values(df, "k", [1]).count() == 1
    assert X.relationships(df, "k", spark.createDataFrame([(1,)], "p int"), "p").count() == 1


# --- cell deduplication --------------------------------------------------------------------


def box(x0, y0, x1, y1):
    return f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"


def dedup(spark, rows):
    df = spark.createDataFrame(rows, "row_id int, dataset_name string, unified_id string, cell long, geometry string, area_m2 double")
    return sorted(r.row_id for r in L.dedup_by_cell(df).collect())


def test_dedup_semantics(spark):
    small, large = box(0, 0, 2, 2), box(0.2, 0, 2.4, 2)
    assert dedup(spark, [(1, "a", "x", 1, small, 4.0), (2, "b", "y", 1, large, 4.4)]) == [1]
    assert dedup(spark, [(1, "a", "x", 1, small, 4.0), (2, "a", "y", 1, large, 4.4)]) == [1, 2]  # one dataset
    assert dedup(spark, [(1, "a", "x", 1, small, 4.0), (2, "b", "y", 2, large, 4.4)]) == [1, 2]  # two cells
    assert dedup(spark, [(1, "a", "x", 1, small, 4.0), (2, "b", "y", 1, small, 4.0)]) == [1, 2]  # equal is no overlap
    assert dedup(spark, [(1, "a", "x", 1, small, 4.0), (2, "b", "y", 1, box(0.5, 0.5, 1, 1), 0.25)]) == [1, 2]  # nested
    assert dedup(spark, [(1, "a", "x", 1, small, 4.0), (2, "b", None, 1, large, 4.4)]) == [1, 2]  # no id
    assert dedup(spark, [(1, "b", "x", 1, small, 4.0), (2, "a", "y", 1, box(0.2, 0, 2.2, 2), 4.0)]) == [1]  # equal areas
    assert dedup(spark, [(1, "a", "x", None, small, 4.0), (2, "a", "y", 1, None, 4.0), (3, "a", "z", 1, "", 1.0)]) == []
    # a removed row still removes others
    chain = [(1, "a", "x", 1, box(0, 0, 2, 2), 4.0), (2, "b", "y", 1, box(0.5, 0, 2.6, 2), 4.2), (3, "a", "z", 1, box(1.1, 0, 3.3, 2), 4.4)]
    assert dedup(spark, chain) == [1]


def test_spatial_join_kinds(spark):
    a = spark.createDataFrame([(1, box(0, 0, 2, 2)), (2, box(10, 10, 11, 11)), (3, None)], "id int, g string")
    b = spark.createDataFrame([(7, box(1, 1, 3, 3)), (8, box(0, 0, 50, 1.5)), (9, "POLYGON EMPTY")], "rid int, h string")
    run = lambda how: sorted((r.id, r.asDict().get("rid")) for r in L.spatial_join(a, b, ("g", "h"), how=how).collect())
    assert run("inner") == [(1, 7), (1, 8)] and run("left") == [(1, 7), (1, 8), (2, None), (3, None)]
    assert [k for k, _ in run("left_semi")] == [1] and [k for k, _ in run("left_anti")] == [2, 3]
    near = L.spatial_join_within_distance(a, b, ("g", "h"), 8.6, degrees=True).select("id", "rid").collect()
    assert sorted(map(tuple, near)) == [(1, 7), (1, 8), (2, 8)]
    metres = lambda m: sorted(map(tuple, L.spatial_join_within_distance(a, b, ("g", "h"), m).select("id", "rid").collect()))
    assert metres(900_000) == [(1, 7), (1, 8)] and metres(960_000) == [(1, 7), (1, 8), (2, 8)]
    # clashing names, and rows that occur twice
    same = L.spatial_join(a.unionByName(a), a, ("g", "g"))
    assert same.columns == ["id", "g", "id_right", "g_right"] and sorted((r.id, r.id_right) for r in same.collect()) == [(1, 1), (1, 1), (2, 2), (2, 2)]
    with pytest.raises(ValueError):
        L.spatial_join(a, b, ("g", "h"), how="cross")
    plan = L.spatial_join(a, b, ("g", "h"))._jdf.queryExecution().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_large_and_small_boxes_take_few_cells(spark, monkeypatch):
    """Countries against buildings: a box stands in four cells a level at most, on whichever side it is."""
    from heliolake.operators import geojoin

    small = [(k, (k * 37 % 1000) / 20.0, (k * 53 % 1000) / 40.0) for k in range(2000)]
    a = spark.createDataFrame([(k, x, y, x + 0.001, y + 0.001) for k, x, y in small] + [(-1, -60.0, -30.0, 60.0, 30.0)], "aid long, axmin double, aymin double, axmax double, aymax double")
    b = spark.createDataFrame([(k, 10.0 * (k % 6) - 5, 5.0 * (k % 5) - 5, 10.0 * (k % 6) + 25, 5.0 * (k % 5) + 10) for k in range(30)] + [(k, x + 0.0005, y, x + 0.0015, y + 0.001) for k, x, y in small[:500] if k >= 30], "bid long, bxmin double, bymin double, bxmax double, bymax double")
    got = sorted(map(tuple, geojoin.box_pairs(a, b).collect()))
    ra, rb = a.collect(), b.collect()
    want = sorted((p[0], q[0]) for p in ra for q in rb if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    assert got == want
    levels = sorted({r[0] for r in b.withColumn("k", geojoin._own_level("b")).select("k").collect()} | {r[0] for r in a.withColumn("k", geojoin._own_level("a")).select("k").collect()})
    assert 4 * len(levels) * (len(ra) + len(rb)) <= 20 * (len(ra) + len(rb))


def test_adaptive_resolution(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0.0, 0.5, 100.0, 1e6, 1e14, 1e18)], "a double")
    assert [r[0] for r in df.select(P.adaptive_resolution(F.col("a"))).collect()] == [15, 15, 15, 12, 7, 0, 0]


# --- files ---------------------------------------------------------------------------------


def test_file_discovery(tmp_path):
    (tmp_path / "a").mkdir()
    for n in ("x.geojson", "a/y.shp", "a/z.txt"):
        (tmp_path / n).write_text("{}")
    found = files.find_files(str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in found] == ["y.shp", "x.geojson"]
    assert files.filter_files(found, include=["*.shp"]) == found[:1]
    assert files.filter_files(found, exclude=[r"\.shp$"], use_regex=True) == found[1:]
    assert files.filter_files(found, include=["nothing*"]) == found
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        z.writestr("in/q.geojson", "{}")
    with tarfile.open(tmp_path / "t.tar.gz", "w:gz") as t:
        t.add(tmp_path / "x.geojson", "x2.geojson")
    files.expand_archives(str(tmp_path))
    assert (tmp_path / "p/in/q.geojson").exists() and (tmp_path / "t/x2.geojson").exists()


def test_manifest(spark, tmp_path):
    p = tmp_path / "m.json"
    p.write_text(json.dumps({"a": {"doi": "1", "skip": True}, "b": {"doi": "2"}}))
    m = files.read_manifest(str(p))
    assert files.available_datasets(m) == ["b"] and files.available_datasets({}, ["z"]) == ["z"]
    assert {r.dataset_name: r.entry["doi"] for r in files.manifest_frame(spark, str(p)).collect()} == {"a": "1", "b": "2"}
    with pytest.raises(FileNotFoundError):
        files.read_manifest(str(tmp_path / "none.json"))


def test_vector_formats(spark, tmp_path):
    poly = {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 3], [0, 3], [0, 0]]]}
    features = [{"type": "Feature", "properties": {"id": 1, "n": None}, "geometry": poly}, {"type": "Feature", "properties": {"id": 2}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"type": "Feature", "properties": {"id": 3}, "geometry": None}]
    (tmp_path / "whole.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    (tmp_path / "lines.geojson").write_text("\n".join(map(json.dumps, features)))
    rows = files.read_geojson(spark, str(tmp_path / "*.geojson")).collect()
    assert len(rows) == 6 and sorted(r.geometry or "" for r in rows)[:2] == ["", ""]
    assert {r.properties["id"]: r.geometry for r in rows}["2"] == "POINT (1.0 2.0)"
    # what we write reads back the same
    df = spark.createDataFrame([(1, SQUARE), (2, "POINT (1 2)"), (3, None), (4, "MULTIPOLYGON (((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))")], "id int, geometry string")
    sinks.geojson_lines(df).write.text(str(tmp_path / "out"))
    back = {r.properties["id"]: r.geometry for r in files.read_geojson(spark, str(tmp_path / "out")).collect()}
    from heliolake.functions import geometry as G

    assert G.measure(G.decode_wkt([back[str(k)] for k in (1, 2, 3, 4)])).area_deg2 == pytest.approx([12, 0, 0, 1])
    # GeoPackage
    con = sqlite3.connect(tmp_path / "l.gpkg")
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    con.execute("INSERT INTO gpkg_geometry_columns VALUES ('sites', 'geom')")
    con.execute("CREATE TABLE sites (fid INTEGER, geom BLOB)")
    con.execute("INSERT INTO sites VALUES (7, ?)", (b"GP\0\x01" + struct.pack("<i", 4326) + struct.pack("<BI2d", 1, 1, 3.0, 4.0),))
    con.commit()
    con.close()
    r = files.read_gpkg(spark, str(tmp_path / "l.gpkg")).first()
    assert r.fid == "7" and G.measure(G.decode_wkb([r.geometry])).cx[0] == 3
    # shapefile
    xy = [0, 0, 0, 3, 4, 3, 4, 0, 0, 0]
    content = struct.pack("<i4d2i", 5, 0, 0, 4, 3, 1, 5) + struct.pack("<i", 0) + struct.pack("<10d", *xy)
    (tmp_path / "s.shp").write_bytes(b"\0" * 100 + struct.pack(">2i", 1, len(content) // 2) + content)
    field = b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([5]) + b"\0" * 15
    (tmp_path / "s.dbf").write_bytes(struct.pack("<4BIHH", 3, 0, 0, 0, 1, 65, 6) + b"\0" * 20 + field + b"\r" + b" abc  ")
    r = files.read_shapefile(spark, str(tmp_path / "s.shp")).first()
    assert r.NAME == "abc" and G.measure(G.decode_wkt([r.geometry])).area_deg2[0] == pytest.approx(12)
    # boxes
    (tmp_path / "l.txt").write_text("0 0.5 0.5 0.2 0.4\n1 0.95 0.5 0.2 0.4\nbad\n")
    assert [tuple(round(v, 6) for v in r[1:]) for r in files.read_boxes(spark, str(tmp_path / "l.txt")).collect()] == [(0, 0.4, 0.3, 0.6, 0.7), (1, 0.85, 0.3, 1.0, 0.7)]


def test_geoparquet(spark, tmp_path):
    df = spark.createDataFrame([(k, box(k, 0, k + 1, 1)) for k in range(20)] + [(99, None)], "id int, geometry string")
    sinks.write_geoparquet(df, str(tmp_path / "g"))
    import pyarrow.parquet as pq

    got = pq.read_table(tmp_path / "g").to_pylist()
    assert len(got) == 21 and {g["id"]: g["bbox"]["xmax"] for g in got}[7] == 8
    back = spark.read.parquet(str(tmp_path / "g")).filter("bbox.xmin > 10 AND bbox.xmin < 12")
    assert back.count() == 1 and "bbox.xmin" in back._jdf.queryExecution().toString()


def test_versions(spark, tmp_path):
    v = sinks.Versions(spark, str(tmp_path / "t"))
    day = datetime(2024, 1, 1, tzinfo=timezone.utc)
    assert v.write(spark.range(5), day)["rows"] == 5
    assert v.write(spark.range(5), day) is None  # unchanged
    v.write(v.read().withColumn("id", F.col("id") + 1), day + timedelta(days=10))  # from itself
    v.write(spark.range(3), day + timedelta(days=20))
    assert [s["snapshot_id"] for s in v.snapshots()] == [3, 2, 1] and v.read(1).count() == 5 and v.read().count() == 3
    assert len(v.expire(day + timedelta(days=15))) == 2 and len(v.snapshots()) == 3
    v.expire(day + timedelta(days=99), dry_run=False)
    assert [s["snapshot_id"] for s in v.snapshots()] == [3]
    assert len(v.cleanup()) == 2 and len(v.cleanup(dry_run=False)) == 2 and v.cleanup() == []
    v.compact()
    assert v.read().inputFiles().__len__() == 1 and v.read().count() == 3
    with pytest.raises(ValueError):
        v.read(77)


def test_upsert_and_stream(spark, tmp_path):
    cur = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(None, "m"), (2, "b")], "k int, v string")
    assert sorted((r.k or 0, r.v) for r in sinks.upsert(cur, new, ["k"]).collect()) == [(0, "m"), (1, "a"), (2, "b")]
    src, t = tmp_path / "in", lambda s: datetime(2024, 1, 1, 0, 0, s)
    target = sinks.Versions(spark, str(tmp_path / "table"))

    def run():
        s = incremental.file_stream(spark, str(src), spark.createDataFrame([], "k int, v string, at timestamp").schema)
        incremental.start_upserts(s, target, ["k"], "at", str(tmp_path / "cp")).awaitTermination()

    spark.createDataFrame([(1, "a", t(1)), (1, "b", t(2)), (2, "c", t(1))], "k int, v string, at timestamp").write.mode("append").parquet(str(src))
    run()
    spark.createDataFrame([(1, "late", t(0)), (2, "d", t(5)), (3, "e", None)], "k int, v string, at timestamp").write.mode("append").parquet(str(src))
    run()
    assert sorted((r.k, r.v) for r in target.read().collect()) == [(1, "b"), (2, "d"), (3, "e")]


# --- pipeline ------------------------------------------------------------------------------


def test_pipeline(tmp_path):
    p, calls = Pipeline(), []

    @p.node(tags={"layer": "raw"}, cache=True)
    def raw(n):
        calls.append("raw")
        return list(range(n))

    @p.node("mode", when={"execution": "serial"})
    def serial(raw):
        return ("serial", len(raw))

    @p.node("mode", when={"execution": "parallel"})
    def parallel(raw):
        return ("parallel", len(raw))

    @p.node()
    def final(mode, raw):
        return (*mode, sum(raw))

    assert p.run(["final"], {"n": 4, "execution": "serial"}) == {"final": ("serial", 4, 6)}
    assert p.run(["final"], {"n": 4, "execution": "parallel"})["final"][0] == "parallel"
    p.run(["final"], {"n": 4, "execution": "serial"})
    assert calls == ["raw", "raw"]
    assert p.upstream("final") == {"mode", "raw", "n"} and p.downstream("raw") == {"mode", "final"} and p.between("n", "mode") == {"n", "raw", "mode"}
    assert p.names(layer="raw") == ["raw"] and p.run(["mode"], {"execution": "serial"}, {"raw": [1]}) == {"mode": ("serial", 1)}
    with pytest.raises(KeyError):
        p.run(["final"], {"execution": "serial"})
    (tmp_path / "c.json").write_text('{"a": {"x": 1}, "y": 2}')
    assert load_config(str(tmp_path / "c.json")) == {"x": 1, "y": 2}
    assert merged({"a": {"b": 1, "c": 2}}, {"a": {"c": 3}}) == {"a": {"b": 1, "c": 3}}


# --- contracts -----------------------------------------------------------------------------


def test_staging_contract(spark):
    sf = "/root/testdata/sf0.001"
    df = L.consolidated(spark, sf)
    assert df.schema.simpleString() == L.STAGED.simpleString()
    assert df.filter("geometry IS NULL OR dataset_name IS NULL OR area_m2 < 0").count() == 0


def test_nothing_else_imports_llm():
    code = "import sys; sys.modules['heliolake.llm'] = None; import __spark_entry__ as e; assert not any(k.startswith(('p2_', 'p7_', 'p8_', 'p9_')) for k in e.queries()); assert 'p1_found' in e.queries(); assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])

"""Context layers, cells of shapes and the older consolidation."""

import pytest
from pyspark.sql import functions as F

from heliolake.functions import geometry as G
from heliolake.functions import st
from heliolake.operators import context as C


def box(x0, y0, x1, y1):
    return f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"


def test_layer_context(spark):
    sites = spark.createDataFrame([(1, "GB", box(0, 0, 1, 1)), (2, "GB", box(5, 5, 6, 6)), (3, None, None)], "row_id int, country string, geometry string")
    layer = spark.createDataFrame(
        [(10, "GB", box(0, 0, 2, 2), None, 4.0), (11, "GB", box(0.5, 0.5, 3, 3), 9.0, 6.0), (12, "GB", box(0, 0, 1, 3), 9.0, 3.0), (13, "FR", box(0, 0, 9, 9), 99.0, 81.0)],
        "building_id int, iso string, shape string, height double, feature_area double",
    )
    run = lambda **k: {r.row_id: (r.building_id, r.has_building) for r in C.layer_context(sites, layer, "row_id", "geometry", "shape", "building_id", ["height", "feature_area"], C.building_preference(), "has_building", **k).collect()}
    assert run(countries=("country", "iso")) == {1: (11, True), 2: (None, False), 3: (None, False)}
    assert run() == {1: (13, True), 2: (13, True), 3: (None, False)}
    assert run(predicate="within")[1] == (13, True) and run(predicate="nonsense") == run()


def test_unified_context(spark):
    sites = spark.createDataFrame([(1,), (2,)], "row_id int")
    building = spark.createDataFrame([(1, "rooftop_confirmed", True)], "row_id int, building_relationship string, has_building boolean")
    got = {r.row_id: (r.site_classification, r.solar_potential_score, r.context_completeness, r.is_ground_mount) for r in C.unified_context(sites, [building], ["row_id"]).collect()}
    assert got == {1: ("rooftop", 0.7, 0.25, False), 2: ("ground_mount_other", 0.5, 0.0, True)}
    f = C.final_types(spark.createDataFrame([("x", None), ("2", True)], "a string, b boolean"), ["a", "new"], ["b"]).collect()
    assert [tuple(r) for r in f] == [(0.0, False, 0.0), (2.0, True, 0.0)]


def test_cells_of_shapes(spark):
    df = spark.createDataFrame([(1, box(10, 10, 11, 11)), (2, "POINT (10.5 10.5)"), (3, None), (4, box(10, 10, 10.0001, 10.0001))], "id int, g string")
    got = {r.id: r for r in C.cells_of_shapes(df, "g", 5).collect()}
    assert len(got[1].cells) > 20 and got[1].cells == sorted(got[1].cells) and got[1].primary_cell == got[1].cells[0]
    assert len(got[2].cells) == 1 and got[3].cells is None and len(got[4].cells) == 1
    rep = {r.id: r.cell for r in C.representative_cells(df, "id", "g", 5).collect()}
    assert rep[1] in got[1].cells and rep[2] == got[2].primary_cell and 3 not in rep
    grouped = C.group_by_cells(df.filter("id IN (1, 4)").withColumns({"c": F.lit(got[2].primary_cell), "a": F.lit(2.0)}), "c", "a", "g").first()
    assert grouped.n == 2 and grouped.total_area == 4 and G.measure(G.decode_wkt([grouped.shapes])).area_deg2[0] == pytest.approx(1, abs=1e-12)  # the small one lies in the large one


def test_greedy_dedup(spark):
    rows = [(1, box(0, 0, 2, 2)), (2, box(0, 0, 2, 2)), (3, box(0.2, 0, 2.4, 2)), (4, box(5, 5, 6, 6)), (5, box(5.9, 5, 7, 6)), (6, None), (7, "POLYGON EMPTY")]
    df = spark.createDataFrame(rows, "id int, g string")
    assert sorted(r.id for r in C.greedy_dedup(df, "id", "g").collect()) == [1, 4, 5, 7]
    again = C.greedy_dedup(C.greedy_dedup(df, "id", "g"), "id", "g")
    assert sorted(r.id for r in again.collect()) == [1, 4, 5, 7]


def test_legacy_record(spark, tmp_path):
    df = spark.createDataFrame([("7", box(0, 0, 1, 1), None), (None, box(0, 0, 1, 1), 2.0), ("8", "POINT (1 1)", 1.0)], "sid string, geometry string, v double")
    got = C.legacy_record(df, "d", ["sid"], ["v", "none"]).collect()
    from hashlib import sha256

    assert {r.unified_id for r in got} == {sha256(t.encode()).hexdigest() for t in ("7_d", "NO_ID_1_d")}
    assert [tuple(r) for r in C.excluded_kinds(df).collect()] == [("POINT", 1)]
    assert len(got) == 2 and got[0].spheroid_area == pytest.approx(12308778361, rel=1e-4)  # geodesic edges of a whole degree bulge by so much
    assert [r[0] for r in df.select(C.minus_one_for_missing(F.col("v"))).collect()] == [-1.0, 2.0, 1.0]
    df.write.parquet(str(tmp_path / "a"))
    spark.range(1).write.parquet(str(tmp_path / "b"))
    assert C.readable_files(spark, [str(tmp_path / "a"), str(tmp_path / "b")], ["sid"]) == [str(tmp_path / "a")]


def test_small_rules(spark):
    df = spark.createDataFrame([("1", "1", None), ("2.5", "x", None)], "a string, b string, c string")
    assert dict(C.coerced(df).dtypes) == {"a": "double", "b": "string", "c": "string"}
    j = '{"polygons":[{"points":[{"x":0,"y":0},{"x":2,"y":0},{"x":2,"y":2}]},{"points":[{"x":1,"y":1}]}],"clicks":[{"x":5,"y":6}]}'
    shapes = [r.geometry for r in C.annotations_to_shapes(spark.createDataFrame([(j,), ("{}",), (None,)], "j string"), "j").collect()]
    assert G.measure(G.decode_wkt(shapes)).area_deg2 == pytest.approx([2, 0])
    im = spark.createDataFrame([("/a/x.png",), ("/a/y.v2.png",)], "p string")
    assert [r.p for r in C.unmatched_stems(im, spark.createDataFrame([("/m/x.tif",)], "p string"), "p").collect()] == ["/a/y.v2.png"]
    assert C.vertices(spark.createDataFrame([(1, box(0, 0, 1, 1)), (2, None)], "id int, g string"), "id", "g").count() == 5
    assert C.resolution_for("dedup") == 12 and C.resolution_for(None) == 10 and C.predicate_of("x") is st.st_intersects
    assert C.renamed(spark.range(1), {"id": "k", "zz": "q"}).columns == ["k"]
    assert [r[0] for r in spark.createDataFrame([(0.02,), (0.005,), (0.0,)], "a double").select(C.partition_level(F.col("a"))).collect()] == [8, 10, 12]

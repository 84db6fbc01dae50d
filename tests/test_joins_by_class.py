"""Spatial joins work on distinct shapes: equal rows are joined and tested once, and all their pairs come out."""

import itertools

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliolake.functions import geometry as G
from heliolake.functions import st
from heliolake.operators import context as C
from heliolake.operators import geojoin
from heliolake.plans import geotwins, twins


def box(x0, y0, x1, y1):
    return f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"


@pytest.fixture
def counted(spark):
    """A predicate by name that counts the pairs it tests."""
    seen = spark.sparkContext.accumulator(0)

    def of(predicate):
        @F.arrow_udf(T.BooleanType())
        def f(a: pa.Array, b: pa.Array, met: pa.Array) -> pa.Array:
            seen.add(len(a))
            return met

        return lambda a, b: f(a, b, predicate(a, b))

    return of, seen


def sides(spark, n):
    """n copies each of two left and three right shapes; of the six pairs three meet."""
    shapes = [box(0, 0, 4, 4), box(40, 40, 44, 44)], [box(1, 1, 2, 2), box(3, 3, 9, 9), box(41, 41, 60, 60)]
    a = [(k, shapes[0][k % 2]) for k in range(2 * n)] + [(-1, None), (-2, None), (-3, "POLYGON EMPTY")]
    b = [(k, shapes[1][k % 3]) for k in range(3 * n)] + [(-1, None)]
    want = [(p, q) for p, q in itertools.product(range(2 * n), range(3 * n)) if (p % 2, q % 3) in ((0, 0), (0, 1), (1, 2))]
    return spark.createDataFrame(a, "id long, g string"), spark.createDataFrame(b, "rid long, h string"), want


@pytest.mark.parametrize("members", [7, 1024])
def test_inner_tests_equal_geometries_once(spark, counted, monkeypatch, members):
    monkeypatch.setattr(geojoin, "MEMBERS", members)
    (of, seen), (a, b, want) = counted, sides(spark, 40)
    got = geojoin.spatial_join(a, b, ("g", "h"), of(st.st_intersects))
    assert got.columns == ["id", "g", "rid", "h"] and sorted((r.id, r.rid) for r in got.collect()) == want
    assert seen.value <= 3 * (-(-40 // members)) ** 2


def test_semi_and_anti_test_equal_geometries_once(spark, counted):
    (of, seen), (a, b, want) = counted, sides(spark, 40)
    b = b.filter("rid % 3 <> 2")
    overlap = of(lambda x, y: st.st_intersection_area(x, y) > 1e-9)
    run = lambda how: sorted(r.id for r in geojoin.spatial_join(a, b, ("g", "h"), overlap, how).collect())
    assert run("left_semi") == list(range(0, 80, 2)) and seen.value <= 2
    assert run("left_anti") == [-3, -2, -1, *range(1, 80, 2)]


def test_left_keeps_every_row(spark, monkeypatch):
    monkeypatch.setattr(geojoin, "MEMBERS", 5)
    a, b, want = sides(spark, 12)
    got = sorted((r.id, r.rid) for r in geojoin.spatial_join(a, b.filter("rid % 3 < 2"), ("g", "h"), how="left").fillna(-9).collect())
    assert got == sorted([p for p in want if p[0] % 2 == 0] + [(k, -9) for k in [-3, -2, -1, *range(1, 24, 2)]])


def test_distance_tests_equal_geometries_once(spark, counted, monkeypatch):
    (of, seen), (a, b, _) = counted, sides(spark, 40)
    within = st.st_dwithin
    monkeypatch.setattr(st, "st_dwithin", lambda *d, **k: of(within(*d, **k)))
    b = spark.createDataFrame([(k, box(7, 8, 9, 9)) for k in range(120)], "rid long, h string")
    near = lambda d: geojoin.spatial_join_within_distance(a, b, ("g", "h"), d, degrees=True).count()
    assert near(5.0) == 40 * 120 and seen.value <= 1
    assert near(4.9) == 0


def layer_of(spark, n):
    """n features each of two shapes: of the first the best is height 9 of smallest id, of the second area 50 without a height."""
    rows = [(k, box(0, 0, 5, 5), [None, 3.0, 9.0][k % 3], 25.0, f"c{k % 4}") for k in range(n)] + [(k, box(2, 2, 50, 50), None, 50.0, f"c{k % 4}") for k in range(n, 2 * n)]
    return spark.createDataFrame(rows, "fid long, shape string, height double, feature_area double, class string")


@pytest.mark.parametrize(("prefer", "keep", "low", "high"), [(C.building_preference, ["height", "feature_area"], (2, 9.0, 25.0), (60, None, 50.0)), (lambda: [F.col("feature_area")], ["class", "feature_area"], (60, "c0", 50.0), (60, "c0", 50.0))], ids=["buildings", "land_use"])
def test_context_tests_equal_geometries_once(spark, counted, monkeypatch, prefer, keep, low, high):
    of, seen = counted
    monkeypatch.setitem(C.PREDICATES, "intersects", of(st.st_intersects))
    sites = spark.createDataFrame([(k, box(1, 1, 3, 3) if k % 2 else box(40, 40, 44, 44)) for k in range(50)] + [(50, None), (51, box(90, 9, 91, 10))], "id long, geometry string")
    got = {r.id: r for r in C.layer_context(sites, layer_of(spark, 60), "id", "geometry", "shape", "fid", keep, prefer(), "there").collect()}
    assert seen.value <= 4
    assert len(got) == 52 and all((got[k].fid, *(got[k][c] for c in keep)) == (low if k % 2 else high) and got[k].there for k in range(50))
    assert not got[50].there and not got[51].there and got[50].fid is None


def test_context_of_a_repeated_key(spark):
    """Sites of one key share the best match of all their geometries."""
    sites = spark.createDataFrame([(1, box(3, 3, 4, 4)), (1, box(40, 40, 44, 44)), (2, None), (None, box(3, 3, 4, 4))], "id long, geometry string")
    got = C.layer_context(sites, layer_of(spark, 9), "id", "geometry", "shape", "fid", ["feature_area"], [F.col("feature_area")], "there").collect()
    assert sorted((r.id or 0, r.fid or 0, r.there) for r in got) == [(0, 0, False), (1, 9, True), (1, 9, True), (2, 0, False)]


def joined_rows(df):
    """Most rows that any join of the plan of ``df`` put out."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    out, todo = 0, [plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan]
    while todo:
        p = todo.pop()
        if "Join" in p.nodeName() and p.metrics().contains("numOutputRows"):
            out = max(out, p.metrics().apply("numOutputRows").value())
        if "QueryStage" in p.nodeName():
            todo.append(p.plan())
        children = p.children()
        todo += [children.apply(k) for k in range(children.size())]
    return out


@pytest.mark.parametrize(("name", "n"), [("spatial_join_intersects", 100 * 100), ("spatial_join_within", 50 * 100)])
def test_boxes_of_equal_rows_are_joined_once(spark, tmp_path, monkeypatch, name, n):
    """Keys that are alike modulo 8400 and 39600 have equal rectangles."""
    spark.createDataFrame([(8400 * k,) for k in range(100)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(39600 * k,) for k in range(50)] + [(39600 * k + 1200,) for k in range(50)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(geojoin, "MEMBERS", 64)
    df = twins.QUERIES[name](spark, str(tmp_path))
    got = sorted(map(tuple, df.collect()))
    rects = {w: [tuple(r) for r in twins.rects(spark, str(tmp_path), w).select("id", "x0", "y0", "x1", "y1").collect()] for w in ("customer", "part")}
    if name == "spatial_join_within":
        meet = lambda c, p: p[1] >= c[1] and p[3] <= c[3] and p[2] >= c[2] and p[4] <= c[4]
    else:
        meet = lambda c, p: c[1] <= p[3] and p[1] <= c[3] and c[2] <= p[4] and p[2] <= c[4]
    want = sorted((c[0], p[0]) for c in rects["customer"] for p in rects["part"] if meet(c, p))
    assert got == want and len(want) == n
    assert 0 < joined_rows(df) <= 2 * 2 * 2


@pytest.fixture
def batches(spark):
    """A predicate by name that counts the batches it is given, where a shuffle is wider than the machine."""
    seen, wide = spark.sparkContext.accumulator(0), 12 * spark.sparkContext.defaultParallelism

    def of(predicate):
        @F.arrow_udf(T.BooleanType())
        def f(met: pa.Array) -> pa.Array:
            seen.add(1)
            return met

        return lambda a, b: f(predicate(a, b))

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", wide)
    yield of, seen
    spark.conf.set("spark.sql.shuffle.partitions", before)


def grid(spark, n, key):
    """n boxes; those of two grids meet where their numbers are the same, and nowhere else."""
    return spark.createDataFrame([(k, box(k % 40 * 10, k // 40 * 10, k % 40 * 10 + 4, k // 40 * 10 + 4)) for k in range(n)], f"{key} long, g string")


def few_tasks(spark, seen, rows, n):
    assert rows == list(range(n)) and 0 < seen.value <= 4 * spark.sparkContext.defaultParallelism


def test_context_tests_few_pairs_in_few_tasks(spark, batches, monkeypatch):
    of, seen = batches
    monkeypatch.setitem(C.PREDICATES, "intersects", of(st.st_intersects))
    layer = grid(spark, 1000, "fid").withColumnRenamed("g", "shape")
    got = C.layer_context(grid(spark, 1000, "id"), layer, "id", "g", "shape", "fid", [], [F.lit(1)], "there").collect()
    few_tasks(spark, seen, sorted(r.fid for r in got if r.fid == r.id and r.there), 1000)


def test_distance_tests_few_pairs_in_few_tasks(spark, batches, monkeypatch):
    of, seen = batches
    within = st.st_dwithin
    monkeypatch.setattr(st, "st_dwithin", lambda *d, **k: of(within(*d, **k)))
    got = geojoin.spatial_join_within_distance(grid(spark, 1000, "id"), grid(spark, 1000, "rid"), ("g", "g"), 3.0, degrees=True).collect()
    few_tasks(spark, seen, sorted(r.id for r in got if r.id == r.rid), 1000)


def test_semi_tests_few_pairs_in_few_tasks(spark, batches):
    of, seen = batches
    got = geojoin.spatial_join(grid(spark, 1000, "id"), grid(spark, 1000, "rid"), ("g", "g"), of(lambda a, b: st.st_intersection_area(a, b) > 1e-9), "left_semi").collect()
    few_tasks(spark, seen, sorted(r.id for r in got), 1000)


def test_only_column_beside_the_geometry_may_be_null(spark):
    a = spark.createDataFrame([(None, box(0, 0, 4, 4)), (1, box(0, 0, 4, 4)), (None, box(9, 9, 10, 10))], "id long, g string")
    b = spark.createDataFrame([(None, box(1, 1, 2, 2)), (None, box(1, 1, 2, 2)), (7, box(1, 1, 2, 2))], "rid long, h string")
    rows = lambda how: sorted((r.id or 0, r.asDict().get("rid") or 0, r.asDict().get("h") is not None) for r in geojoin.spatial_join(a, b, ("g", "h"), how=how).collect())
    assert rows("inner") == [(0, 0, True), (0, 0, True), (0, 7, True), (1, 0, True), (1, 0, True), (1, 7, True)]
    assert rows("left") == [(0, 0, False), *rows("inner")]
    assert rows("left_semi") == [(0, 0, False), (1, 0, False)] and rows("left_anti") == [(0, 0, False)]


TABLES = {"c_custkey": [*range(0, 600, 7), 8400, 16800], "p_partkey": [*range(0, 600, 5), 39600, 79200]}


@pytest.fixture
def rectangles(spark, tmp_path):
    """Folder of two tables, and the rectangles that their keys stand for."""
    for key, values in TABLES.items():
        spark.createDataFrame([(k,) for k in values], f"{key} long").write.parquet(f"{tmp_path}/{'customer' if key[0] == 'c' else 'part'}.parquet")
    return str(tmp_path), *[[tuple(r)[:5] for r in twins.rects(spark, str(tmp_path), w).collect()] for w in ("customer", "part")]


def gaps(c, p):
    """Distances of two rectangles in x and y, below 0 where they have a stretch in common."""
    return max(c[1] - p[3], p[1] - c[3]), max(c[2] - p[4], p[2] - c[4])


@pytest.mark.parametrize("small", [0, geojoin.SMALL], ids=["shuffled", "sent"])
def test_distance_of_rectangles_is_told_by_boxes(spark, counted, rectangles, monkeypatch, small):
    """No pair is tested in Python, and those at the limit itself are near."""
    (of, seen), (folder, customers, parts) = counted, rectangles
    monkeypatch.setattr(geojoin, "SMALL", small)
    within = st.st_dwithin
    monkeypatch.setattr(st, "st_dwithin", lambda *d, **k: of(within(*d, **k)))
    got = sorted(map(tuple, geotwins.QUERIES["join_geometry_distance"](spark, folder).collect()))
    squares = {(c[0], p[0]): sum(max(0, g) ** 2 for g in gaps(c, p)) for c in customers for p in parts}
    assert got == sorted(k for k, d in squares.items() if d <= 9) and 9 in squares.values()
    assert seen.value == 0


def test_semi_of_rectangles_is_told_by_boxes(spark, counted, rectangles, monkeypatch):
    """No pair is tested in Python, and a border in common is no area."""
    (_, seen), (folder, customers, parts) = counted, rectangles
    area = st.st_intersection_area

    @F.arrow_udf(T.DoubleType())
    def noted(a: pa.Array) -> pa.Array:
        seen.add(len(a))
        return a

    monkeypatch.setattr(st, "st_intersection_area", lambda a, b: noted(area(a, b)))
    borders = [(1200 * k + 1,) for k in range(40)]
    spark.createDataFrame(borders, "c_custkey long").write.mode("append").parquet(f"{folder}/customer.parquet")
    customers = [tuple(r)[:5] for r in twins.rects(spark, folder, "customer").collect()]
    got = sorted(r.id for r in geotwins.QUERIES["join_geometry_semi"](spark, folder).collect())
    near = {c[0]: [gaps(c, p) for p in parts] for c in customers}
    want = sorted(c[0] for c in customers if any(max(g) < 0 for g in near[c[0]]))
    assert got == want and 0 < len(want) < len(customers)
    assert any(max(g) == 0 for c in set(near) - set(want) for g in near[c])
    assert seen.value == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_only_shapes_that_fill_their_boxes_are_told_by_them(spark, counted, how):
    """A triangle, a rectangle with a hole, two parts and a point are tested; nulls and empty shapes meet nothing."""
    of, seen = counted
    odd = ["POLYGON ((0 0, 8 0, 0 8, 0 0))", "POLYGON ((20 0, 30 0, 30 10, 20 10, 20 0), (21 1, 29 1, 29 9, 21 9, 21 1))", f"MULTIPOLYGON ((({box(0, 20, 1, 21)[10:-2]})), (({box(8, 28, 9, 29)[10:-2]})))", "POINT (41 1)", None, "POLYGON EMPTY"]
    a = spark.createDataFrame([*enumerate(odd), (10, box(40, 0, 44, 4)), (11, box(90, 90, 91, 91))], "id long, g string")
    b = spark.createDataFrame([(0, box(7, 7, 8, 8)), (1, box(24, 4, 26, 6)), (2, box(3, 23, 6, 26)), (3, box(40, 0, 42, 2)), (4, odd[0]), (5, None), (6, box(28, 5, 40, 6))], "rid long, h string")
    want = {(0, 4), (1, 6), (3, 3), (10, 3)}
    meet = lambda a, b: geojoin.box_distance(a, b) <= 0
    got = geojoin.spatial_join(a, b, ("g", "h"), of(st.st_intersects), how, by_box=meet).collect()
    hit, ids = {p for p, _ in want}, {0, 1, 2, 3, 4, 5, 10, 11}
    wanted = {"inner": want, "left": want | {(k, None) for k in ids - hit}, "left_semi": {(k,) for k in hit}, "left_anti": {(k,) for k in ids - hit}}[how]
    key = lambda t: tuple(v if v is not None else -1 for v in t)
    assert sorted([(r.id, *([r.rid] if how in ("inner", "left") else [])) for r in got], key=key) == sorted(wanted, key=key)
    assert 0 < seen.value <= 7


@pytest.mark.parametrize("empty", ["left", "right"])
def test_by_box_of_an_empty_side(spark, empty):
    a, b, _ = sides(spark, 3)
    a, b = (a.filter("false") if empty == "left" else a), (b.filter("false") if empty == "right" else b)
    near = geojoin.spatial_join_within_distance(a, b, ("g", "h"), 5.0, degrees=True, by_box=True)
    assert near.columns == ["id", "g", "rid", "h"] and near.count() == 0


def test_rectangles():
    told = {
        box(0, 0, 4, 3): True,
        "POLYGON ((0 0, 0 3, 4 3, 4 0, 0 0))": True,
        "MULTIPOLYGON (((0 0, 0 3, 4 3, 4 0, 0 0)))": True,
        "POLYGON ((0 0, 4 0, 4 3, 0 3))": False,
        "POLYGON ((0 0, 4 3, 4 0, 0 3, 0 0))": False,
        "POLYGON ((0 0, 4 0, 4 0, 0 0, 0 0))": False,
        "POLYGON ((0 0, 4 0, 4 3, 1 3, 0 0))": False,
        "POLYGON ((2 0, 4 2, 2 4, 0 2, 2 0))": False,
        "LINESTRING (0 0, 4 0, 4 3, 0 3, 0 0)": False,
        "POLYGON ((0 0, 4 0, 4 3, 0 3, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))": False,
        "MULTIPOLYGON (((0 0, 0 3, 4 3, 4 0, 0 0)), ((9 9, 9 10, 10 10, 10 9, 9 9)))": False,
        "POLYGON EMPTY": False,
        "POINT (1 1)": False,
    }
    assert G.rectangles(G.decode_wkt([*told, None])).tolist() == [*told.values(), False]
    assert G.rectangles(G.decode_wkt([None, "POLYGON EMPTY"])).tolist() == [False, False]

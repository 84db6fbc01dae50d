"""Hand-computed cases and properties of the geometry functions."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs

from heliolake.functions import geometry as G
from heliolake.functions import st

SQUARE = "POLYGON ((0 0, 4 0, 4 3, 0 3, 0 0))"
HOLED = "POLYGON ((0 0,10 0,10 10,0 10,0 0),(2 2,4 2,4 4,2 4,2 2))"
ELL = "POLYGON ((0 0,3 0,3 1,1 1,1 3,0 3,0 0))"


def measured(*texts):
    return G.measure(G.decode_wkt(list(texts)))


def common(a, b):
    ea, eb = (G.filled_edges(G.decode_wkt([t])) for t in (a, b))
    return G.common_area(ea, eb, np.array([0]), np.array([0]))[0]


def box(x0, y0, x1, y1):
    return f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"


def test_areas_and_centroids():
    m = measured(SQUARE, HOLED, ELL, "POINT (1 1)", "POLYGON EMPTY", None, "MULTIPOLYGON (((0 0,1 0,1 1,0 1,0 0)),((5 5,6 5,6 6,5 6,5 5)))")
    assert m.area_deg2[[0, 1, 2, 6]] == pytest.approx([12, 96, 5, 2])
    assert (m.cx[0], m.cy[0]) == pytest.approx((2, 1.5))
    assert list(m.area_deg2[3:6]) == [0, 0, 0] and list(m.has) == [True, True, True, True, False, False, True]


def test_spellings_mean_the_same():
    m = measured(SQUARE, "SRID=4326;polygon((0 0,4 0,4 3,0 3,0 0))", " POLYGON  (( 0.0 0e0 , 4 0 ,4 3, 0 3,0 0 ) )", "POLYGON Z ((0 0 1, 4 0 1, 4 3 1, 0 3 1, 0 0 1))")
    assert m.area_deg2 == pytest.approx([12] * 4)


@pytest.mark.parametrize("text", ["POLYGON ((0 0, 4 0", "POINT (1 - 1)", "junk", "", "POINT (1.2.3 4)", "POLYGON ((0 0 0 0 0, 1 1))"])
def test_unreadable_is_null(text):
    r = G.decode_wkt([SQUARE, text, SQUARE])
    assert r.kinds[1] == "NULL" and G.measure(r).area_deg2 == pytest.approx([12, 0, 12])


def test_unrolled_at_180():
    m = measured("POLYGON ((179.9 0,-179.9 0,-179.9 1,179.9 1,179.9 0))")
    assert m.area_deg2[0] == pytest.approx(0.2) and abs(m.cx[0]) == pytest.approx(180)


def test_wkb_round_trip_both_orders():
    texts = [SQUARE, HOLED, "POINT (1 2)", None, "MULTIPOLYGON (((0 0,1 0,1 1,0 1,0 0)),((5 5,6 5,6 6,5 6,5 5)))"]
    blobs = G.encode_wkb(G.decode_wkt(texts))
    assert G.encode_wkt(G.decode_wkb(blobs)) == G.encode_wkt(G.decode_wkt(texts))
    import struct

    big = struct.pack(">BI2d", 0, 1, 3.0, 4.0)
    m = G.measure(G.decode_wkb([big, b"\x01\x02", b""]))
    assert (m.cx[0], m.cy[0]) == (3, 4) and list(m.has) == [True, False, False]


def test_common_areas():
    assert common(box(0, 0, 2, 2), box(1, 1, 3, 3)) == pytest.approx(1)
    assert common(box(0, 0, 2, 2), box(0.2, 0, 2.4, 2)) == pytest.approx(3.6)
    assert common(ELL, box(0, 0, 2, 2)) == pytest.approx(3)
    assert common(SQUARE, HOLED) == pytest.approx(10)
    assert common(box(0, 0, 1, 1), box(1, 0, 2, 1)) == 0
    assert common("POINT (1 1)", SQUARE) == 0


@settings(max_examples=60, deadline=None)
@given(hs.lists(hs.tuples(hs.floats(0.2, 3), hs.floats(0, 0.9)), min_size=3, max_size=9), hs.floats(-2, 2), hs.floats(-2, 2))
def test_common_area_against_a_grid(spokes, dx, dy):
    def star(ox, oy):
        n = len(spokes)
        p = [(ox + r * math.cos(2 * math.pi * (k + j * 0.9) / n), oy + r * math.sin(2 * math.pi * (k + j * 0.9) / n)) for k, (r, j) in enumerate(spokes)]
        return "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in [*p, p[0]]) + "))"

    a, b = star(0, 0), star(dx, dy)
    ea, eb = (G.filled_edges(G.decode_wkt([t])) for t in (a, b))
    area = [G.measure(G.decode_wkt([t])).area_deg2[0] for t in (a, b)]
    got, back = common(a, b), common(b, a)
    assert got == pytest.approx(back, abs=1e-9) and got <= min(area) + 1e-9 and got >= 0
    g = np.linspace(-3.2, 3.2, 161)
    x, y = (v.ravel() for v in np.meshgrid(g, g))
    zero = np.zeros(len(x), int)
    inside = G.points_in(ea, zero, x, y) & G.points_in(eb, zero, x, y)
    assert got == pytest.approx(inside.sum() * (g[1] - g[0]) ** 2, abs=0.6)
    assert common(a, a) == pytest.approx(area[0], rel=1e-9, abs=1e-12)


def test_predicates(spark):
    rows = [
        (1, box(0, 0, 2, 2), box(1, 1, 3, 3)),
        (2, box(1, 1, 2, 2), box(0, 0, 4, 4)),
        (3, box(0, 0, 1, 1), box(0, 0, 1, 1)),
        (4, box(0, 0, 1, 1), box(1, 0, 2, 1)),
        (5, box(0, 0, 1, 1), box(1, 1, 2, 2)),
        (6, box(0, 0, 1, 1), box(3, 0, 4, 1)),
        (7, "POINT (0.5 0.5)", box(0, 0, 1, 1)),
        (8, None, box(0, 0, 1, 1)),
        (9, "POLYGON EMPTY", box(0, 0, 1, 1)),
    ]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    got = df.select("id", st.st_intersects("a", "b"), st.st_overlaps("a", "b"), st.st_within("a", "b"), st.st_equals("a", "b"), st.st_dwithin(2.0)("a", "b"), st.st_intersection_area("a", "b")).collect()
    got = {r[0]: tuple(r[1:6]) for r in got}
    assert got[1] == (True, True, False, False, True)
    assert got[2] == (True, False, True, False, True)
    assert got[3] == (True, False, True, True, True)
    assert got[4] == (True, False, False, False, True)
    assert got[5] == (True, False, False, False, True)
    assert got[6] == (False, False, False, False, True)
    assert got[7][0] and got[7][2]
    assert got[8] == (None,) * 5
    assert got[9][:3] == (False, False, False)


def test_validity_and_types(spark):
    st.register(spark)
    rows = [(SQUARE,), ("POLYGON ((0 0,2 2,2 0,0 2,0 0))",), ("POLYGON EMPTY",), (None,), ("POINT (1 1)",)]
    spark.createDataFrame(rows, "g string").createOrReplaceTempView("shapes")
    got = spark.sql("SELECT st_isvalid(g), st_isempty(g), st_geometrytype(g), st_area(g), st_astext(st_centroid(g)) FROM shapes").collect()
    assert [r[0] for r in got] == [True, False, True, None, True]
    assert [r[2] for r in got] == ["POLYGON", "POLYGON", "POLYGON", None, "POINT"]
    assert got[0][3] == pytest.approx(12) and got[0][4] == "POINT (2 1.5)" and got[3][3] is None


def test_spheroid_area_of_a_zone():
    # the whole ellipsoid, as one box on longitude and latitude
    whole = st.authalic_area(G.RingSet(np.array([0, 90, 90, 0, 0.0]), np.array([-90, -90, 90, 90, -90.0]), np.zeros(5, int), np.array([0]), np.array([False]), np.array(["POLYGON"], dtype=object)))
    assert whole[0] * 4 == pytest.approx(510065621724088.0, rel=1e-9)


def test_hilbert_visits_neighbours(spark):
    from pyspark.sql import functions as F

    df = spark.range(256).select((F.col("id") % 16).alias("x"), F.expr("id div 16").alias("y"))
    rows = df.select("x", "y", st.hilbert(F.col("x"), F.col("y"), 4).alias("d")).orderBy("d").collect()
    assert [r.d for r in rows] == list(range(256))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(rows, rows[1:]))


def test_cells(spark):
    from pyspark.sql import functions as F

    from heliolake.functions import hexcells as H

    df = spark.createDataFrame([(1, 37.77, -122.41), (2, -33.9, 151.2), (3, 0.0, 0.0), (4, None, 1.0)], "id int, lat double, lon double")
    for res in (0, 5, 12, 15):
        c = df.withColumn("c", H.latlng_to_cell(F.col("lat"), F.col("lon"), res))
        lat, lon = H.cell_to_latlng(F.col("c"))
        again = c.select("c", H.latlng_to_cell(lat, lon, res).alias("again"), H.cell_resolution(F.col("c")).alias("r"), H.string_to_cell(H.cell_to_string(F.col("c"))).alias("s"), H.cell_to_boundary_wkt("c").alias("w"), lat.alias("la"), lon.alias("lo")).collect()
        for r in again[:3]:
            assert r.c == r.again == r.s and r.r == res
            e = G.filled_edges(G.decode_wkt([r.w]))
            assert G.points_in(e, np.array([0]), np.array([r.lo]), np.array([r.la]))[0]
        assert again[3].c is None
    cells = spark.createDataFrame([(box(10, 10, 12, 12),), (None,), ("POLYGON EMPTY",)], "g string").select(H.polygon_to_cells(5)("g").alias("c")).collect()
    area = H.cell_area_km2(5) * len(cells[0].c)
    assert area == pytest.approx(2 * 2 * 111.2**2 * math.cos(math.radians(11)), rel=0.05)
    assert cells[1].c is None and cells[2].c == []


def test_distances_of_a_batch_against_single_pairs():
    import random as rnd

    from heliolake.functions import st

    rnd.seed(3)
    shapes = [box(x, y, x + rnd.uniform(0.1, 2), y + rnd.uniform(0.1, 2)) for x, y in ((rnd.uniform(0, 9), rnd.uniform(0, 9)) for _ in range(60))]
    shapes += ["POINT (3 3)", "LINESTRING (0 0, 5 5)", "POLYGON EMPTY", "MULTIPOINT (1 1, 8 8)"]
    a, b = G.decode_wkt(shapes), G.decode_wkt(shapes[::-1])
    together = st.min_distance(a, b, np.zeros(len(shapes), bool), chunk=7)
    for k, (p, q) in enumerate(zip(shapes, shapes[::-1])):
        alone = st.min_distance(G.decode_wkt([p]), G.decode_wkt([q]), np.zeros(1, bool))[0]
        assert np.isnan(alone) == np.isnan(together[k]) and (np.isnan(alone) or alone == pytest.approx(together[k]))
    one = st.min_distance(G.decode_wkt([box(0, 0, 1, 1)]), G.decode_wkt([box(4, 5, 6, 6)]), np.zeros(1, bool))
    assert one[0] == pytest.approx(5)


def test_validity_of_long_and_nested_rings(spark):
    import resource

    from heliolake.functions import st

    t = np.linspace(0, 2 * np.pi, 50_001)
    ring = ", ".join(f"{10 * np.cos(v):.9f} {10 * np.sin(v):.9f}" for v in t[:-1])
    first = ring.split(", ")[0]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert len(st.crossing_rows(G.decode_wkt([f"POLYGON (({ring}, {first}))"]))) == 0
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000
    texts = [
        "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))",
        "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (9 9, 9.5 9, 9.5 9.5, 9 9))",  # a hole beside its shell
        "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (3 1, 6 1, 6 2, 3 2, 3 1))",  # a hole that crosses it
        "POLYGON ((0 0, 4 4, 4 0, 0 4, 0 0))",
        "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((1 1, 3 1, 3 3, 1 3, 1 1)))",
        "POLYGON EMPTY",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, g string")
    got = {r.k: r.v for r in df.select("k", st.st_isvalid("g").alias("v")).collect()}
    assert got == {0: True, 1: False, 2: False, 3: False, 4: False, 5: True, 6: None}


def test_overlays_against_areas():
    import random as rnd

    from heliolake.functions import st

    rnd.seed(9)

    def star(x, y):
        n = rnd.randrange(3, 9)
        pts = [(x + rnd.uniform(0.5, 2) * np.cos(2 * np.pi * k / n), y + rnd.uniform(0.5, 2) * np.sin(2 * np.pi * k / n)) for k in range(n)]
        return "POLYGON ((" + ", ".join(f"{u:.6f} {v:.6f}" for u, v in [*pts, pts[0]]) + "))"

    for _ in range(40):
        e = G.filled_edges(G.decode_wkt([star(0, 0), star(rnd.uniform(0, 2), rnd.uniform(0, 2))]))
        k = np.array([0])
        m = [G.measure(G.decode_wkt([st.overlay([st.edges_of(e, 0), st.edges_of(e, 1)], u)])).area_deg2[0] for u in (False, True)]
        common = G.common_area(e, e, k, k + 1)[0]
        both = sum(G.common_area(e, e, k + i, k + i)[0] for i in (0, 1))
        assert m[0] == pytest.approx(common, abs=1e-9) and m[1] == pytest.approx(both - common, abs=1e-9)
    assert st.overlay([], True) == "MULTIPOLYGON EMPTY"

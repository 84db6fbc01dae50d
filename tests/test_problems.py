"""The general problems on small fixtures: brute force, nulls, ties, repeated rows, empty tables, clashing columns."""

import json
import math
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from heliolake.operators import drift, skew, spatial, timestamps
from heliolake.operators import units as U

# --- units ---------------------------------------------------------------------------------


def quantities(area=True):
    fp = U.log10_positive(F.col("fp"))
    power = U.Quantity("power", "cap", "MW", {u: F.lit(v[0]) for u, v in U.POWER_MW.items()}, {u: v[1] for u, v in U.POWER_MW.items()}, (U.Identity("density", fp, 0.1, U.log10_positive(F.col("repd")) - fp),))
    a = U.Quantity("area", "area", "m2", {u: F.lit(v[0]) for u, v in U.AREA_M2.items()}, {u: v[1] for u, v in U.AREA_M2.items()}, (U.Identity("footprint", fp, 0.02),))
    return [a, power] if area else [power]


SCHEMA = "row_id long, cap string, area string, repd double, fp double, unit string"


def unit_rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_units_stated_and_not(spark):
    base = [(100 + k, "0.02", "100", 0.02, 100.0, "x") for k in range(20)]
    cases = [
        (1, "20 kW", "0.01 ha", None, 100.0, "clash"),
        (2, "20", "1076.4", None, 100.0, None),
        (3, "20000.0", "1000000", None, 100.0, None),
        (4, "0,02", "1,000.0", None, 1000.0, None),
        (5, "about 0.02 MW peak", "ca. 100.2 m2", None, 100.0, None),
        (6, "50 x 400 W", "100 sq yd", None, 83.6, None),
        (7, None, None, None, None, None),
        (8, "unknown", "", None, 100.0, None),
        (9, "0", "-5", None, 100.0, None),
        (10, "0.00002 GW", "1.0e2", None, 100.0, None),
        (11, "1,500", "100", None, 7500.0, None),
    ]
    got = {(r.row_id, r.field_name): r for r in U.reconcile(unit_rows(spark, base + cases), quantities(), "row_id").collect()}
    unit = {k: r.unit for k, r in got.items()}
    assert [unit[1, "cap"], unit[1, "area"]] == ["kW", "ha"]
    assert [unit[2, "cap"], unit[2, "area"]] == ["kW", "ft2"]
    assert [unit[3, "cap"], unit[3, "area"]] == ["W", "cm2"]
    assert [unit[4, "cap"], unit[4, "area"]] == ["MW", "m2"] and got[4, "area"].value == pytest.approx(1000)
    assert [unit[5, "cap"], unit[5, "area"]] == ["MW", "m2"]
    assert [unit[6, "cap"], unit[6, "area"]] == ["W", "yd2"] and got[6, "cap"].value == pytest.approx(0.02)
    assert (7, "cap") not in got and (7, "area") not in got
    assert unit[8, "cap"] == "" or got[8, "cap"].is_own
    assert got[9, "cap"].is_own and got[9, "area"].is_own
    assert unit[10, "cap"] == "GW" and got[10, "cap"].value == pytest.approx(0.02) and got[10, "area"].is_own
    assert got[11, "cap"].value == pytest.approx(1.5)
    assert all(got[100 + k, f].is_own and got[100 + k, f].is_unique for k in range(20) for f in ("cap", "area"))


def test_units_without_identities_or_rows(spark):
    lone = U.reconcile(unit_rows(spark, [(1, "5", "7", None, None, None)]), quantities(), "row_id").collect()
    assert all(r.is_own and not r.is_unique for r in lone)
    assert U.reconcile(unit_rows(spark, []), quantities(), "row_id").count() == 0


# --- skew ----------------------------------------------------------------------------------


def test_positions_against_brute_force(spark):
    random.seed(1)
    rows = []
    for k in range(3000):
        key = random.choice(["hot"] * 10 + ["warm"] * 3 + [f"k{random.randrange(200)}", None])
        at = None if random.random() < 0.02 else datetime(2024, 1, 1, 0, 0, random.choice([0, 0, 0, random.randrange(60)]))
        rows.append((k, key, at, "extra"))
    rows += rows[:50]  # repeated rows
    df = spark.createDataFrame(rows, "row_id long, k string, at timestamp, position string")
    got = [(r.row_id, r.k, r.position) for r in skew.positions(df, "k", ["at", "row_id"], share=0.05).collect()]
    want = []
    for key in {r[1] for r in rows} - {None}:
        mine = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2] is not None, r[2] or datetime.min, r[0]))
        want += [(r[0], key, n) for n, r in enumerate(mine, 1)]
    assert sorted(got) == sorted(want)


def test_positions_of_nothing(spark):
    df = spark.createDataFrame([], "row_id long, k string, at timestamp")
    assert skew.positions(df, "k", ["at", "row_id"]).count() == 0
    nulls = spark.createDataFrame([(1, None, None)], "row_id long, k string, at timestamp")
    assert skew.positions(nulls, "k", ["at", "row_id"]).count() == 0


# --- timestamps ----------------------------------------------------------------------------


def normalised(spark, values, zone="Europe/London", order="DMY"):
    df = spark.createDataFrame([(k, v, "clash") for k, v in enumerate(values)], "id int, v string, day string")
    rows = timestamps.normalise(df, "v", F.lit(zone), F.lit(order)).orderBy("id").collect()
    return [(r.instant, r.day, r.precision) for r in rows]


def test_one_moment_in_many_forms(spark):
    forms = [
        "2021-07-05T12:30:15+0100", "2021-07-05 12:30:15+01", "2021-07-05T12:30:15+01:00", "20210705T113015Z", "2021-07-05 11:30:15 UTC",
        "2021-07-05 12:30:15 BST", "05-Jul-2021 12:30:15 BST", "Mon, 05 Jul 2021 12:30:15 +0100", "05/07/2021 12:30:15", "2021-07-05T12:30:15[Europe/London]",
        "2021-07-05 12:30:15 Europe/London", "2021-07-05T12:30:15,000", "2021-07-05 12:30:15.000000", "20210705T123015", " 2021-07-05  12:30:15 ", "2021-07-05T19:30:15[Asia/Shanghai]",
        "5 July 2021, 12:30", "2021年7月5日 12:30", "05/07/2021 12:30 PM", "1625484615", "1625484615000",
    ]
    got = normalised(spark, forms)
    for f, (instant, day, precision) in zip(forms, got):
        want = datetime(2021, 7, 5, 11, 30, 0 if f.endswith(("12:30", "PM")) else 15)
        assert (instant, day, precision) == (want, None, "instant"), f


def test_days_and_coarser_values(spark):
    got = normalised(spark, ["2021-07-05", "20210705", "05/07/2021", "5.7.2021", "July 5, 2021", "5 Jul 2021", "2021年7月5日", "2021-07", "Jul 2021", "Q3 2021", "2021-Q3", "2021"])
    assert [g[1] for g in got] == [date(2021, 7, 5)] * 7 + [date(2021, 7, 1)] * 4 + [date(2021, 1, 1)]
    assert [g[2] for g in got] == ["day"] * 7 + ["month"] * 2 + ["quarter"] * 2 + ["year"]


def test_what_is_no_date(spark):
    bad = [None, "", " ", "unknown", "2021-13-45", "0000-00-00", "2021-02-30T10:00", "2021-07-05 25:00", "x" * 5000, "12:30", "2021-07-05 12:30 XYZ", "13:30 PM"]
    assert all(g == (None, None, "none") for g in normalised(spark, bad))


def test_daylight_saving(spark):
    # skipped, twice, before, after; and order of day and month
    got = normalised(spark, ["2021-03-28 01:30", "2021-10-31 01:30", "2021-10-31 00:30", "2021-10-31 02:30"])
    assert [g[0] for g in got] == [datetime(2021, 3, 28, 1, 30), datetime(2021, 10, 31, 0, 30), datetime(2021, 10, 30, 23, 30), datetime(2021, 10, 31, 2, 30)]
    assert normalised(spark, ["07/05/2021", "25/12/2021"], order="MDY") == [(None, date(2021, 7, 5), "day"), (None, date(2021, 12, 25), "day")]
    assert normalised(spark, ["2021-01-05 00:30 PST", "2021-07-05 00:30 PDT"], zone="America/Los_Angeles") == [(datetime(2021, 1, 5, 8, 30), None, "instant"), (datetime(2021, 7, 5, 7, 30), None, "instant")]
    assert normalised(spark, ["2021-07-05 12:30"], zone=None)[0][0] is None
    assert normalised(spark, []) == []


def test_long_values(spark):
    # names of regions have no greatest length, so neither have values
    got = normalised(spark, ["Wednesday, 23 September 2020, 11:45:00.123456 -07:00[America/Los_Angeles]", "Wednesday, 23 September 2020, 11:45:00.123456789 -03:00 [America/Argentina/ComodRivadavia]", "Wednesday, 23 September 2020, 11:45:00 " + "x" * 100])
    assert got == [(datetime(2020, 9, 23, 18, 45, 0, 123456), None, "instant"), (datetime(2020, 9, 23, 14, 45, 0, 123456), None, "instant"), (None, None, "none")]


# --- near pairs and regions ----------------------------------------------------------------


def haversine(a, b):
    la, lo, lb, mo = (math.radians(v) for v in (a[2], a[1], b[2], b[1]))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((mo - lo) / 2) ** 2
    return 2 * 6_371_008.8 * math.asin(math.sqrt(h))


def test_pairs_against_brute_force(spark):
    random.seed(2)
    pts = []
    for k, (lon, lat) in enumerate([(0, 51), (180, -17), (-180, -17), (30, 89.9999), (-150, 89.9999), (10, 0)] * 30):
        pts.append((k, lon + random.gauss(0, 0.001), lat + random.gauss(0, 0.0005), "x"))
    pts = [(k, (lo + 180) % 360 - 180, min(la, 90.0), x) for k, lo, la, x in pts]
    pts += [(900, 5.0, 5.0, "x"), (901, 5.0, 5.0, "x"), (902, None, 5.0, "x"), (903, 5.0, float("nan"), "x"), (None, 5.0, 5.0, "x")]
    df = spark.createDataFrame(pts, "row_id long, lon double, lat double, a string")
    got = {(r.a, r.b) for r in spatial.near_pairs(df, "row_id", "lon", "lat", 100.0).collect()}
    ok = [p for p in pts if None not in p[:3] and p[2] == p[2]]
    want = {(min(p[0], q[0]), max(p[0], q[0])) for i, p in enumerate(ok) for q in ok[i + 1 :] if haversine(p, q) <= 100}
    assert got == want and (900, 901) in got
    assert spatial.near_pairs(df.limit(0), "row_id", "lon", "lat", 100.0).count() == 0


def test_regions(spark):
    regions = spark.createDataFrame(
        [("west", "POLYGON ((0 0,10 0,10 10,0 10,0 0))"), ("east", "POLYGON ((10 0,20 0,20 10,10 10,10 0))"), ("all", "POLYGON ((0 0,20 0,20 10,0 10,0 0))"), ("fiji", "POLYGON ((179 -20,-179 -20,-179 -10,179 -10,179 -20))"), ("none", None), ("void", "POLYGON EMPTY")],
        "division_id string, geometry string",
    )
    random.seed(3)
    pts = [(k, random.uniform(-1, 21), random.uniform(-1, 11)) for k in range(500)] + [(900, 10.0, 5.0), (901, 179.5, -15.0), (902, -179.5, -15.0), (903, -178.5, -15.0), (904, None, 1.0)]
    df = spark.createDataFrame(pts, "row_id long, lon double, lat double")
    got = {(r.row_id, r.division_id) for r in spatial.containing_regions(df, "row_id", "lon", "lat", regions, "division_id", "geometry").collect()}
    for k, x, y in pts[:500]:
        inside = 0 <= y < 10
        assert ((k, "west") in got) == (inside and 0 <= x < 10) and ((k, "east") in got) == (inside and 10 <= x < 20) and ((k, "all") in got) == (inside and 0 <= x < 20)
    assert {g for g in got if g[0] == 900} == {(900, "east"), (900, "all")}
    assert {g for g in got if g[0] in (901, 902, 903, 904)} == {(901, "fiji"), (902, "fiji")}
    assert spatial.containing_regions(df, "row_id", "lon", "lat", regions.limit(0), "division_id", "geometry").count() == 0


def test_narrow_and_tall_regions(spark):
    # between the corners and middles of the cells that they cross; one ends at the 180th meridian
    boxes = {"narrow": (10.1, -60.3, 10.2, 70.7), "edge": (179.5, -20.0, 180.0, -14.2), "thin": (-0.001, -89.0, 0.001, 89.0)}
    wkt = {n: f"POLYGON (({a} {b},{c} {b},{c} {d},{a} {d},{a} {b}))" for n, (a, b, c, d) in boxes.items()}
    wkt["holed"] = "POLYGON ((-120 -40,-60 -40,-60 40,-120 40,-120 -40),(-90.1 -39,-90.05 -39,-90.05 39,-90.1 39,-90.1 -39))"
    regions = spark.createDataFrame(list(wkt.items()), "division_id string, geometry string")
    random.seed(4)
    pts = [(random.uniform(a - 0.05, min(c + 0.05, 179.9999)), random.uniform(b - 1, d + 1)) for a, b, c, d in boxes.values() for _ in range(400)]
    pts += [(random.uniform(-90.2, -89.95), random.uniform(-41, 41)) for _ in range(400)]
    df = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(pts)], "row_id long, lon double, lat double")
    got = {(r.row_id, r.division_id) for r in spatial.containing_regions(df, "row_id", "lon", "lat", regions, "division_id", "geometry").collect()}
    want = {(k, n) for k, (x, y) in enumerate(pts) for n, (a, b, c, d) in boxes.items() if a <= x < c and b <= y < d}
    want |= {(k, "holed") for k, (x, y) in enumerate(pts) if -120 <= x < -60 and -40 <= y < 40 and not (-90.1 <= x < -90.05 and -39 <= y < 39)}
    assert got == want


# --- drift ---------------------------------------------------------------------------------


def lines_of(files):
    out, n = [], 0
    for seq, (name, records) in enumerate(files):
        for r in records:
            n += 1
            out.append((n, "ds", name, seq, r if isinstance(r, str) or r is None else json.dumps(r), -1))
    return out


LINES = "record_id long, dataset_name string, source_file string, file_seq long, payload string, file_no int"


def records(start, n, rename=None, **types):
    out = []
    for k in range(start, start + n):
        r = {"id": k, "cap": k * 1.25, "name": f"site {k}", "ok": k % 2 == 0}
        for f, t in types.items():
            r[f] = t(r[f])
        out.append({(rename or {}).get(f, f): v for f, v in r.items()})
    return out


def changes_of(spark, files):
    df = spark.createDataFrame(lines_of(files), LINES)
    return {(r.source_file, r.change_kind, r.old_name, r.new_name) for r in drift.changes(df)[0].collect()}


def test_drift(spark):
    files = [
        ("f0", records(0, 20)),
        ("f1", records(5, 20, {"cap": "power"})),  # renamed
        ("f2", records(10, 20, {"cap": "power", "id": "Id"}, cap=str)),  # key renamed by case, type changed
        ("f3", [{k: v for k, v in r.items() if k != "ok"} | {"tags": [1]} for r in records(15, 20, {"cap": "power", "id": "Id"}, cap=str)]),  # removed and added, unrelated
        ("f4", [*records(20, 20, {"cap": "id", "id": "Id"}, cap=str), None, "no json", "[1]"]),  # tags gone, ok back, power -> id
    ]
    assert changes_of(spark, files) == {
        ("f1", "renamed", "cap", "power"),
        ("f2", "renamed", "id", "Id"), ("f2", "type_changed", "power", "power"),
        ("f3", "removed", "ok", ""), ("f3", "added", "", "tags"),
        ("f4", "renamed", "power", "id"), ("f4", "removed", "tags", ""), ("f4", "added", "", "ok"),
    }


def test_drift_swap_and_nulls(spark):
    a = [{"u": k * 7, "v": k * 11 + 3, "w": None} for k in range(40)]
    b = [{"u": r["v"], "v": r["u"], "w": "x"} for r in a]
    assert changes_of(spark, [("a", a), ("b", b)]) == {("b", "renamed", "u", "v"), ("b", "renamed", "v", "u")}
    assert changes_of(spark, [("a", a)]) == set()
    assert changes_of(spark, []) == set()


def test_unified(spark):
    files = [("f0", records(0, 20)), ("f1", records(5, 20, {"cap": "power"})), ("f2", [r | {"cap": "new"} for r in records(10, 20, {"cap": "power"})])]
    rows = drift.unified(spark.createDataFrame(lines_of(files), LINES)).collect()
    assert len(rows) == 60
    by = {r.record_id: r.fields for r in rows}
    assert by[21]["cap"] == "6.25" and by[41]["cap"] == "12.5" and by[41]["cap#2"] == "new"


def test_unified_tables_have_typed_columns(spark):
    files = [("f0", records(0, 20)), ("f1", records(5, 20, {"cap": "power"}, id=str)), ("f2", [r | {"cap": "new", "NAME": {"a": 1}, "record_id": None} for r in records(10, 20, {"cap": "power"})])]
    tables = drift.unified_tables(spark.createDataFrame(lines_of(files), LINES))
    t = tables["ds"]
    assert list(tables) == ["ds"] and dict(t.dtypes) == {"dataset_name": "string", "source_file": "string", "record_id": "bigint", "NAME": "string", "cap": "double", "cap#2": "string", "id": "string", "name#2": "string", "ok": "boolean", "record_id#2": "string"}
    rows = {r.record_id: r for r in t.collect()}
    assert len(rows) == 60 and rows[21]["cap"] == 6.25 and rows[41]["cap#2"] == "new" and rows[41]["NAME"] == '{"a":1}' and rows[1]["ok"] is True and rows[1]["name#2"] == "site 0"
    assert drift.unified_tables(spark.createDataFrame([], LINES)) == {}


def test_many_regions_meet_points_by_boxes(spark, monkeypatch):
    random.seed(21)
    boxes = {k: (x := random.uniform(-179, 170), y := random.uniform(-80, 70), x + random.uniform(0.1, 9), y + random.uniform(0.1, 9)) for k in range(60)}
    boxes[99] = (179.0, -5.0, 181.5, 5.0)
    regions = spark.createDataFrame([(k, f"POLYGON (({a} {b}, {c} {b}, {c} {d}, {a} {d}, {a} {b}))") for k, (a, b, c, d) in boxes.items()], "division_id int, geometry string")
    pts = [(k, random.uniform(-180, 180), random.uniform(-85, 85)) for k in range(800)] + [(900, -179.2, 0.0), (901, 179.7, 0.0), (902, None, 1.0)]
    df = spark.createDataFrame(pts, "row_id int, lon double, lat double")
    run = lambda: sorted(map(tuple, spatial.containing_regions(df, "row_id", "lon", "lat", regions, "division_id", "geometry").collect()))
    few = run()
    monkeypatch.setattr(spatial, "DRIVER_REGIONS", 10)
    assert run() == few and (900, 99) in few and (901, 99) in few


@pytest.mark.parametrize("seed", range(5))
def test_matching_is_optimal(seed):
    from itertools import permutations

    random.seed(seed)
    n, m = random.randrange(1, 5), random.randrange(1, 5)
    w = [[random.choice([0, random.random()]) for _ in range(m)] for _ in range(n)]
    got = sum(w[i][j] for i, j in drift.best_matching(w))
    k = max(n, m)
    full = [[w[i][j] if i < n and j < m else 0 for j in range(k)] for i in range(k)]
    assert got == pytest.approx(max(sum(full[i][p[i]] for i in range(k)) for p in permutations(range(k))))
    assert drift.best_matching([]) == []


# --- zones before 1970, session zone, size checks --------------------------------------------


def test_zone_tables_reach_back_to_the_first_transition():
    import numpy as np

    from heliolake.functions import zones

    def offset(zone, *when):
        local = int((datetime(*when) - datetime(1970, 1, 1)).total_seconds())
        return int(zones.utc_offsets(np.array([local]), zone, None)[0])

    assert offset("Europe/London", 1950, 12, 1) == 0 and offset("Europe/London", 1950, 7, 1) == 3600
    assert offset("Europe/London", 1969, 12, 1) == 3600 and offset("Europe/London", 1800, 1, 1) == -75
    assert offset("Europe/Berlin", 2090, 7, 1) == 7200 and zones.transitions("Nowhere/Land") is None and zones.transitions("../etc/passwd") is None


def test_long_and_old_values_and_any_session_zone(spark):
    from heliolake.operators import timestamps

    rows = [(1, "Wednesday, 5th September 2018 at 23:30:15.123456 [America/Argentina/ComodRivadavia]"), (2, "1950-12-01 00:10:00"), (3, "2020-07-01 00:10:00")]
    df = spark.createDataFrame(rows, "k int, v string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "Pacific/Auckland", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", session)
            out = timestamps.normalise(df, "v", F.lit("Europe/London"), F.lit("DMY"))
            got = {r.k: (r.us, str(r.d)) for r in out.select("k", F.unix_micros("instant").alias("us"), timestamps.utc_day(F.col("instant")).alias("d")).collect()}
            assert got == {1: (1_536_201_015_123_456, "2018-09-06"), 2: (-602_293_800_000_000, "1950-12-01"), 3: (1_593_558_600_000_000, "2020-06-30")}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_many_parsers_and_many_heavy_keys_are_not_broadcast(spark, monkeypatch):
    from heliolake.operators import skew, timestamps

    df = spark.createDataFrame([(k % 3, k % 2, k) for k in range(600)], "a int, b int, n int")
    want = {r.n: r.position for r in skew.positions(df, "a", ["n"], by=["b"]).collect()}
    dates = spark.createDataFrame([("2020-01-01",), ("1 May 2020",), ("junk",), (None,)], "v string")
    days = sorted(str(r.day) for r in timestamps.normalise(dates, "v", F.lit("UTC"), F.lit("DMY")).collect())
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(timestamps, "BROADCAST_ROWS", 0)
    assert {r.n: r.position for r in skew.positions(df, "a", ["n"], by=["b"]).collect()} == want
    assert sorted(str(r.day) for r in timestamps.normalise(dates, "v", F.lit("UTC"), F.lit("DMY")).collect()) == days


def test_no_machine_local_folder_on_a_cluster(tmp_path):
    from heliolake import session

    for master in ("yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session._own_dir(master)
    assert session._own_dir("local[4]") and session._own_dir("local")

"""Joins on geometry predicates: boxes meet in grid cells of their own size, ids go through the join, shapes follow.

A box stands in the cells of the level that fits it (cells no smaller than the box, so four at most), and
on the coarser levels that the other side has. Two boxes meet on the level of the larger one, in the cell of the
lower left corner of their common part, so each pair is met once, and neither a country among
buildings nor a building among countries takes more than four cells a level. What moves through this
join is an id and a box; geometries are fetched for the pairs whose boxes meet and tested in Arrow batches.

Rows of equal boxes or equal geometries form a class, which is joined and tested once; its pairs are spelled out
at the end. So the work before the result follows the distinct shapes, and what is tested in Python carries no rows.
Of polygons that fill their boxes the boxes tell everything: with ``by_box`` such pairs aren't tested in Python at all.

Defined results: rows with null, unreadable or empty geometries meet nothing (left and anti joins keep
them); equal rows meet as often as they occur; columns of the right side whose names the left one has get the suffix
``_right``; an empty side gives no pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliolake.functions import st
from heliolake.functions.geo_columns import measures, outline
from heliolake.session import cut, cut_all, file_bytes, partitions

#: Cell sizes are these powers of two: from about 1e-5 to 512 units of the coordinates.
LEVELS = tuple(range(-17, 10, 2))
BOX = ("xmin", "ymin", "xmax", "ymax")
#: Most rows of one class: more equal rows form several, so that no row of a class grows with the table.
MEMBERS = 1024
#: Most bytes of the written classes of a side that are sent to all tasks instead of being shuffled once for each pair.
SMALL = 32 << 20


def _size(level: Column) -> Column:
    return F.element_at(F.array(*[F.lit(2.0**k) for k in LEVELS]), level + 1)


def _own_level(p: str) -> Column:
    extent = F.greatest(F.col(f"{p}xmax") - F.col(f"{p}xmin"), F.col(f"{p}ymax") - F.col(f"{p}ymin"))
    out = F.lit(len(LEVELS) - 1)
    for k in range(len(LEVELS) - 2, -1, -1):
        out = F.when(extent <= 2.0 ** LEVELS[k], F.lit(k)).otherwise(out)
    return out


def _levels(sides: dict[str, DataFrame], full: dict[str, Column] | None = None) -> dict[str, dict[bool, list[int]]]:
    """Levels of each side's boxes, of those that are ``full`` and of the others, by one job: at most len(LEVELS) numbers each."""
    a, b = (df.select(F.lit(p).alias("side"), (full[p] if full else F.lit(False)).alias("full"), _own_level(p).alias("level")).distinct() for p, df in sides.items())
    found = a.union(b).collect()
    return {p: {f: sorted(level for side, is_full, level in found if (side, is_full) == (p, f)) for f in (False, True)} for p in sides}


def _classes(df: DataFrame, by: list[str], row: Column, rows: str) -> DataFrame:
    """One line for every ``MEMBERS`` rows that are equal in ``by``, with the array ``rows`` of their ``row``."""
    df = df.select(F.xxhash64(*by).alias("__h"), *by, row.alias("__row"))  # numbers sort faster than texts that begin alike
    number = F.row_number().over(Window.partitionBy("__h", *by).orderBy(F.lit(0)))
    return df.withColumn("__n", F.floor((number - 1) / MEMBERS)).groupBy("__h", *by, "__n").agg(F.collect_list("__row").alias(rows)).drop("__h", "__n")


def _meeting(a: DataFrame, b: DataFrame, levels: dict[str, list[int]]) -> DataFrame:
    """The rows of ``a`` and ``b`` whose boxes (``axmin`` ..., ``bxmin`` ...) have a common point, each pair once, with all columns."""
    a, b = a.withColumn("alevel", _own_level("a")), b.withColumn("blevel", _own_level("b"))

    def celled(df: DataFrame, p: str, other: list[int]) -> DataFrame:
        own = F.col(f"{p}level")
        on = F.array_union(F.array(own), F.filter(F.array(*[F.lit(k) for k in other]).cast("array<int>"), lambda k: k > own))
        df = df.withColumn("__l", F.explode(on)).withColumn("__s", _size(F.col("__l")))
        for c in ("x", "y"):
            df = df.withColumn(f"__{c}", F.explode(F.sequence(F.floor(F.col(f"{p}{c}min") / F.col("__s")), F.floor(F.col(f"{p}{c}max") / F.col("__s")))))
        return df.drop("__s")

    left, low = F.greatest("axmin", "bxmin"), F.greatest("aymin", "bymin")
    size = _size(F.col("__l"))
    met = celled(a, "a", levels["b"]).join(celled(b, "b", levels["a"]), ["__l", "__x", "__y"]).filter(
        (F.col("__l") == F.greatest("alevel", "blevel"))
        & (left <= F.least("axmax", "bxmax"))
        & (low <= F.least("aymax", "bymax"))
        & (F.floor(left / size) == F.col("__x"))
        & (F.floor(low / size) == F.col("__y"))
    )
    return met.drop("__l", "__x", "__y", "alevel", "blevel")


def _spread(pairs: DataFrame, *ids: str, each: int | None = None) -> DataFrame:
    """The pairs' numbers, evenly over the cluster's width: their size doesn't tell how many rows they stand for, nor a cell's how many pairs it has. With ``each`` over so many tasks a core at most."""
    spark, n = pairs.sparkSession, partitions(pairs.sparkSession)
    return pairs.select(*ids).repartition(min(n, each * spark.sparkContext.defaultParallelism) if each else n, *ids)


def box_pairs(a: DataFrame, b: DataFrame, where: Column | None = None) -> DataFrame:
    """``aid, bid`` of the boxes that have a common point, each pair once; ``where`` is a further condition on the two boxes.

    ``a`` has the columns ``aid, axmin, aymin, axmax, aymax``, ``b`` likewise.
    """
    sides = {}
    for p, df in (("a", a), ("b", b)):
        edges = [f"{p}{c}" for c in BOX]
        sides[p] = cut(_classes(df.dropna(subset=edges), edges, F.struct(f"{p}id"), f"{p}rows").withColumn(f"__{p}id", F.monotonically_increasing_id()))
    met = _meeting(sides["a"].drop("arows"), sides["b"].drop("brows"), {p: of[False] for p, of in _levels(sides).items()})
    met = _spread(met if where is None else met.filter(where), "__aid", "__bid")
    met = met.join(sides["b"].select("__bid", "brows"), "__bid").join(sides["a"].select("__aid", "arows"), "__aid")
    return met.select(F.explode("arows").alias("__a"), "brows").select("__a.aid", F.explode("brows").alias("__b")).select("aid", "__b.bid")


def _others(columns: list[str], geometry: str) -> list[str]:
    return [c for c in columns if c != geometry]


def _keyed(df: DataFrame, geometry: str, p: str, nulls: bool, rows: bool = True) -> DataFrame:
    """Classes of equal geometries with their number, outline and, with ``rows``, members, to be written once. Without ``nulls`` rows without a geometry are left out; else they are spread, so that they aren't one task's.

    Members are structs of the other columns, or the values of the only one: rows are spelled out faster from those.
    """
    g, others = F.col(f"`{geometry}`"), _others(df.columns, geometry)
    if rows:
        own = F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(True).alias("__only")])
        named = df.select(g.alias(f"__{p}g"), own.alias("__own"), F.when(g.isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(4096))).alias("__spread"))
        named = named if nulls else named.filter(F.col(f"__{p}g").isNotNull())
        c = _classes(named, [f"__{p}g", "__spread"], F.col("__own"), f"__{p}rows").drop("__spread")
        c = c.withColumn(f"__{p}rows", F.col(f"__{p}rows")[others[0]]) if len(others) == 1 else c
    else:
        c = df.select(g.alias(f"__{p}g")).filter(F.col(f"__{p}g").isNotNull()).distinct()
    return c.withColumns({f"__{p}id": F.monotonically_increasing_id(), "__m": outline(F.col(f"__{p}g"))})


def _boxes(keyed: DataFrame, key: str, p: str, dx: Column, dy: Column, outlined: bool = False) -> DataFrame:
    """Number and widened box; if ``outlined``, also the box as it is and ``full``, as flat columns, since fields are cut out of structs wrongly below a generator."""
    edge = {"xmin": -dx, "ymin": -dy, "xmax": dx, "ymax": dy}
    return keyed.filter("__m.xmin IS NOT NULL").select(key, *[(F.col(f"__m.{k}") + edge[k]).alias(f"{p}{k}") for k in BOX], *[F.col(f"__m.{k}").alias(f"__{p}{k}") for k in (*BOX, "full") if outlined])


def common_box_area(a: Column, b: Column) -> Column:
    """Area common to two boxes."""
    side = lambda c: F.greatest(F.lit(0.0), F.least(a[f"{c}max"], b[f"{c}max"]) - F.greatest(a[f"{c}min"], b[f"{c}min"]))
    return side("x") * side("y")


def box_distance(a: Column, b: Column) -> Column:
    """Least distance of two boxes in the units of their coordinates, 0 where they meet."""
    gap = lambda c: F.greatest(F.lit(0.0), a[f"{c}min"] - b[f"{c}max"], b[f"{c}min"] - a[f"{c}max"])
    return F.sqrt(gap("x") * gap("x") + gap("y") * gap("y"))


def _hits(a: DataFrame, b: DataFrame, predicate: Callable[[Column, Column], Column], grow: tuple[Column, Column] | None = None, by_box: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``__lid, __rid`` of the geometries of two written sides that meet, each pair tested once.

    A test streams its pairs, so a few even tasks a core serve any number of them, and few pairs don't start many Python tasks.
    With ``by_box`` pairs of which both fill their boxes are told by their boxes and their geometries aren't read; all others are tested.
    """
    zero = F.lit(0.0)
    boxes = {"a": _boxes(a, "__lid", "a", *(grow or (zero, zero)), by_box is not None), "b": _boxes(b, "__rid", "b", zero, zero, by_box is not None)}

    def tested(pairs: DataFrame) -> DataFrame:
        pairs = _spread(pairs, "__lid", "__rid", each=4)
        return pairs.join(b.select("__rid", "__rg"), "__rid").join(a.select("__lid", "__lg"), "__lid").filter(predicate(F.col("__lg"), F.col("__rg"))).select("__lid", "__rid")

    if by_box is None:
        return tested(_meeting(boxes["a"], boxes["b"], {p: of[False] for p, of in _levels(boxes).items()}))
    full = {p: F.col(f"__{p}full") for p in boxes}
    levels = _levels(boxes, full)

    def met(*of: tuple[bool, ...]) -> DataFrame | None:
        """Pairs of the full, the other or all boxes of each side; None if a side has none of these."""
        on = {p: sorted({level for f in which for level in levels[p][f]}) for p, which in zip(boxes, of)}
        return _meeting(*[df.filter(full[p].isin(*which)) for (p, df), which in zip(boxes.items(), of)], on) if all(on.values()) else None

    told = met((True,), (True,))
    own = [F.struct(*[F.col(f"__{p}{k}").alias(k) for k in BOX]) for p in boxes]
    parts = [told.filter(by_box(*own)).select("__lid", "__rid")] if told is not None else []
    rest = [pairs.select("__lid", "__rid") for pairs in (met((False,), (False, True)), met((True,), (False,))) if pairs is not None]
    parts += [tested(reduce(DataFrame.union, rest))] if rest else []
    return reduce(DataFrame.union, parts) if parts else a.select("__lid").limit(0).join(b.select("__rid").limit(0), F.lit(True))


def distinct_join(left: DataFrame, right: DataFrame, predicate: Callable[[Column, Column], Column] = st.st_intersects) -> DataFrame:
    """Inner join of sides whose geometries ``__lg`` and ``__rg`` don't recur: no classes are formed. Adds ``__lid``, a number of the left row."""
    a, b = (cut(df.withColumns({f"__{p}id": F.monotonically_increasing_id(), "__m": measures(F.col(f"__{p}g"), *BOX)})) for p, df in (("l", left), ("r", right)))
    return _hits(a, b, predicate).join(b.drop("__m"), "__rid").join(a.drop("__m"), "__lid").drop("__rid")


def spatial_join(left: DataFrame, right: DataFrame, on: tuple[str, str], predicate: Callable[[Column, Column], Column] = st.st_intersects, how: str = "inner", grow: tuple[Column, Column] | None = None, by_box: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Join on a geometry predicate: inner, left, left_semi or left_anti. ``grow`` widens the left boxes in x and y.

    ``by_box`` is the same predicate on two boxes, structs of ``BOX``: pairs of polygons that fill their boxes are told by it, without a test in Python.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    lg, rg = on
    names = {c: f"{c}_right" if c in left.columns else c for c in right.columns}
    right = right.withColumnsRenamed({a: b for a, b in names.items() if a != b})
    rg = names[rg]
    some = how in ("left_semi", "left_anti")
    a, b = cut_all(_keyed(left, lg, "l", how in ("left", "left_anti")), _keyed(right, rg, "r", False, not some))
    hits = _hits(a, b, predicate, grow, by_box)

    def of(p: str, g: str, columns: list[str]) -> list[Column]:
        row = F.col(f"__{p}row")
        return [F.col(f"__{p}g").alias(c) if c == g else (row if len(_others(columns, g)) == 1 else row[c]).alias(c) for c in columns]

    if some:
        met = a.join(hits.select("__lid").distinct(), "__lid", how)
        return met.select("__lg", F.explode("__lrows").alias("__lrow")).select(*of("l", lg, left.columns))
    few = max(file_bytes(a), file_bytes(b)) <= SMALL
    a, b = a.drop("__m"), b.drop("__m")
    # where the members go to the pairs, the pairs' tasks spell the rows out; else the pairs are shuffled again, by each number
    met = _spread(hits, "__lid", "__rid", each=None if few else 4).join(F.broadcast(b) if few else b, "__rid")
    met = met.join(F.broadcast(a) if few else a, "__lid") if how == "inner" else a.join(met, "__lid", "left")
    each = F.explode if how == "inner" else F.explode_outer
    met = met.select("__lg", "__rg", F.explode("__lrows").alias("__lrow"), "__rrows").select("__lg", "__rg", "__lrow", each("__rrows").alias("__rrow"))
    return met.select(*of("l", lg, left.columns), *of("r", rg, list(names.values())))


def spatial_join_within_distance(left: DataFrame, right: DataFrame, on: tuple[str, str], distance_m: float = 1000.0, degrees: bool = False, by_box: bool = False) -> DataFrame:
    """Pairs whose geometries are at most ``distance_m`` metres apart, or degrees if ``degrees`` says so. With ``by_box`` and degrees pairs of polygons that fill their boxes are told by these."""
    if degrees:
        grow = (F.lit(distance_m), F.lit(distance_m))
    else:
        deg = distance_m * 1.002 / 111_195.08
        # as wide as the parallel nearest to a pole needs
        lat = F.least(F.greatest(F.abs("__m.ymin"), F.abs("__m.ymax")) + deg, F.lit(89.9))
        grow = (F.lit(deg) / F.cos(F.radians(lat)), F.lit(deg))
    told = (lambda a, b: box_distance(a, b) <= distance_m) if by_box and degrees else None
    return spatial_join(left, right, on, st.st_dwithin(distance_m, metres=not degrees), grow=grow, by_box=told)

"""Problem 2: the best representative of each duplicate group.

Groups. Footprints of one installation share more than half of the smaller one's area, also
through others. Exact copies of a footprint are one class from the start. Each class goes into
the grid cells that its box touches, on the level that fits its size, and probes the levels of
larger ones; only ids and boxes, in whole numbers, take part in this join. Boxes whose common part
can't reach the half are dropped in the JVM; for the pairs left the shapes are fetched by id and
measured exactly in Arrow batches. A pair comes from one cell only, the one that holds the
lower left corner of the boxes' common part. In a cell with more than ``HOT`` classes all are
measured against one of them first, then against one of those left, and pairs of two that are so
connected aren't formed at all: a heap of nearly equal footprints needs no pairs among
themselves, and no link between groups is lost. Links become groups by alternating large-star and small-star rounds, each written to the
shared folder.

Survivors. A record dominates another of its group if it is no worse in completeness, trust and
recency and better in one of them. Completeness is the set of usable fields, compared by inclusion,
or their number (``by_number``). Records equal in completeness and trust are reduced to the latest
before the shuffle, so a group of any size needs one short row for each set of fields and trust
level. What nothing dominates is layer 0, what only layer 0 dominates is layer 1, and so on. The
lexicographic policy (trust, then recency, then the largest id) takes the base record from
layer 0, and each field comes from the first record that has it, layer by layer and by the policy
within a layer. With inclusion a field's value of most trust and recency always lies in layer 0.

Defined results: points, empty, null and unreadable footprints stand alone; datasets without a
trust rank come after all others; null times are the oldest; a stand-in for missing (0, negative,
NaN, infinite or all nines; blank, 'unknown', 'n/a' and the like; days 0000-00-00, 1900-01-01,
1970-01-01 and 9999-12-31) is not usable; a group without any usable value of a field has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliolake.functions import geometry as G
from heliolake.functions.geo_columns import decode
from heliolake.session import cut

#: Cells per turn of the globe, from fine to coarse; powers of two, so that they close at the 180th meridian.
LEVELS = (1 << 18, 1 << 15, 1 << 12, 1 << 9, 1 << 6, 1 << 3, 1)
#: Boxes are counted in this part of a degree, rounded outwards; the widths of all cells are whole numbers of it.
UNIT = 1 << 21
TURN = 360 * UNIT
#: Coordinates with at most seven decimals are kept as whole numbers of this part of a degree.
DECIMALS = 10_000_000
#: Classes in one cell from which they are measured against one of them first, and rounds of doing so.
HOT, ROUNDS = 200, 6
#: Two footprints are of one installation if they share more than this part of the smaller.
SHARED = 0.5

#: Texts that stand for a missing value.
MISSING_TEXTS = ("", "-", "--", "?", "??", "n/a", "na", "nan", "none", "null", "nil", "not known", "unknown", "tbc", "tbd", "missing", "undefined")
MISSING_DAYS = ("0000-00-00", "1900-01-01", "1970-01-01", "9999-12-31")


def usable_number(c: Column) -> Column:
    """A finite positive number that isn't all nines (five or more)."""
    d = c.cast("double")
    nines = F.regexp_replace(F.format_string("%.3f", d), r"\.?0+$", "").rlike(r"^9{5,}(\.9+)?$")
    return F.coalesce((d > 0) & ~F.isnan(d) & (d < 1e300) & ~nines, F.lit(False))


def usable_text(c: Column) -> Column:
    """A text that is no stand-in; dates need not be readable."""
    t = F.lower(F.trim(F.regexp_replace(c, r"[\s ]+", " ")))
    day = F.substring(t, 1, 10).isin(*MISSING_DAYS) & F.regexp_replace(F.substring(t, 11, 40), r"[t0:. z+\-]", "").eqNullSafe(F.lit(""))
    return F.coalesce(~t.isin(*MISSING_TEXTS) & ~day, F.lit(False))


# --- groups --------------------------------------------------------------------------------

_FOOTPRINT = "id long, same binary, corner long, size long, area double, fine array<int>, rough array<double>"


def pack_shapes(r: G.RingSet, ok: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """Rings of the rows ``ok`` as lists (number of rings; vertices of each, negative for holes; x, y, ...).

    The first list holds whole numbers of ``DECIMALS``, the second doubles where those wouldn't be exact.
    """
    chosen = np.zeros(r.n, bool)
    chosen[ok] = True
    at = np.cumsum(chosen) - 1
    ring_on = chosen[r.row] if len(r.row) else np.zeros(0, bool)
    vertices = np.bincount(r.ring, minlength=len(r.row))
    ring_row = at[r.row[ring_on]]
    rings = np.bincount(ring_row, minlength=len(ok))
    on = ring_on[r.ring]
    vertex_row = at[r.row[r.ring[on]]]
    points = np.bincount(vertex_row, minlength=len(ok))
    x, y = r.x[on], r.y[on]
    length = 1 + rings + 2 * points
    start = np.cumsum(length) - length
    flat = np.zeros(int(length.sum()))
    flat[start] = rings
    nth = np.arange(len(ring_row)) - (np.cumsum(rings) - rings)[ring_row]
    flat[start[ring_row] + 1 + nth] = np.where(r.hole[ring_on], -vertices[ring_on], vertices[ring_on])
    nth = np.arange(len(x)) - (np.cumsum(points) - points)[vertex_row]
    place = start[vertex_row] + 1 + rings[vertex_row] + 2 * nth
    qx, qy = np.rint(x * DECIMALS), np.rint(y * DECIMALS)
    bad = (qx / DECIMALS != x) | (qy / DECIMALS != y) | (np.abs(qx) >= 2**31) | (np.abs(qy) >= 2**31)
    rough = np.bincount(vertex_row, bad, len(ok)) > 0
    flat[place] = np.where(rough[vertex_row], x, qx)
    flat[place + 1] = np.where(rough[vertex_row], y, qy)
    kind = np.repeat(rough, length)
    ends = lambda keep: np.concatenate(([0], np.cumsum(np.where(keep, length, 0)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends(~rough)), pa.array(flat[~kind].astype(np.int32))), pa.ListArray.from_arrays(pa.array(ends(rough)), pa.array(flat[kind]))


def unpack_shapes(fine: pa.ListArray, rough: pa.ListArray) -> G.RingSet:
    """What :func:`pack_shapes` packed."""
    lists = []
    for column in (fine, rough):
        ends = column.offsets.to_numpy()
        lists.append((np.diff(ends), column.values.to_numpy()[ends[0] : ends[-1]].astype(float)))
    length = lists[0][0] + lists[1][0]
    start = np.cumsum(length) - length
    flat = np.empty(int(length.sum()))
    for n, values in lists:
        flat[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(len(values))] = values
    rings = flat[start].astype(np.int64)
    row = np.repeat(np.arange(len(length)), rings)
    nth = np.arange(len(row)) - (np.cumsum(rings) - rings)[row]
    signed = flat[start[row] + 1 + nth].astype(np.int64)
    many = np.abs(signed)
    ring = np.repeat(np.arange(len(row)), many)
    points = np.bincount(row, many, len(length)).astype(np.int64)
    vertex_row = row[ring]
    place = start[vertex_row] + 1 + rings[vertex_row] + 2 * (np.arange(len(ring)) - (np.cumsum(points) - points)[vertex_row])
    scale = np.where(lists[0][0] > 0, float(DECIMALS), 1.0)[vertex_row]
    return G.RingSet(flat[place] / scale, flat[place + 1] / scale, ring, row, signed < 0, np.full(len(length), "MULTIPOLYGON", dtype=object))


def _footprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Box, area and shape of footprints that have an area."""
    for b in batches:
        for at in range(0, b.num_rows, 4096):
            part = b.slice(at, 4096)
            r = decode(part.column(1))
            m = G.measure(r)
            ok = np.flatnonzero(m.has & (m.area_deg2 > 0))
            fine, rough = pack_shapes(r, ok)
            turn = np.where(m.xmin[ok] >= 180, -360.0, 0.0)
            x, y = np.floor((m.xmin[ok] + turn) * UNIT), np.floor(m.ymin[ok] * UNIT)
            w, h = np.ceil((m.xmax[ok] + turn) * UNIT) - x, np.ceil(m.ymax[ok] * UNIT) - y
            packed = [(u.astype(np.int64) << 32) | (v.astype(np.int64) & 0xFFFFFFFF) for u, v in ((x, y), (w, h))]
            # copies are told by 128 bits of their vertices
            same = [blake2b(f.tobytes() if len(f) else g.tobytes(), digest_size=16).digest() for f, g in zip(_arrays(fine), _arrays(rough))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(ok)), pa.array(same, pa.binary()), *map(pa.array, packed), pa.array(m.area_deg2[ok]), fine, rough],
                names=["id", "same", "corner", "size", "area", "fine", "rough"],
            )


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:b] for a, b in zip(ends, ends[1:])]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep pairs whose common area exceeds the half of the smaller."""
    for batch in batches:
        for at in range(0, batch.num_rows, 8192):
            part = batch.slice(at, 8192)
            c = {n: part.column(i) for i, n in enumerate(part.schema.names)}
            k = np.arange(part.num_rows)
            edges, areas, west = [], [], []
            for side in "ab":
                r = unpack_shapes(c[side + "fine"], c[side + "rough"])
                m = G.measure(r)
                edges.append(G.filled_edges(r))
                areas.append(m.area_deg2)
                west.append(m.xmin)
            common = G.common_area(*edges, k, k, 360.0 * np.round((west[0] - west[1]) / 360.0))
            ok = np.flatnonzero(common > SHARED * np.minimum(*areas))
            if len(ok):
                yield pa.RecordBatch.from_arrays([c["a"].take(pa.array(ok)), c["b"].take(pa.array(ok))], names=["a", "b"])


def _high(c: str) -> Column:
    return F.shiftright(F.col(c), 32)


def _low(c: str) -> Column:
    return F.shiftright(F.shiftleft(F.col(c), 32), 32)


def _levelled(boxes: DataFrame) -> DataFrame:
    """With the finest level whose cells are no smaller than the box."""
    extent, level = F.greatest(_high("size"), _low("size")), F.lit(len(LEVELS) - 1)
    for k in range(len(LEVELS) - 2, -1, -1):
        level = F.when(extent <= TURN // LEVELS[k], F.lit(k)).otherwise(level)
    return boxes.withColumn("own", level)


def _celled(df: DataFrame, level: Column) -> DataFrame:
    """One row for each of the cells of a level that a box touches, four at most; ``cell`` holds level and place."""
    df = df.withColumn("__l", level).withColumn("__n", F.element_at(F.array(*[F.lit(v) for v in LEVELS]), F.col("__l") + 1)).withColumn("__w", (F.lit(TURN) / F.col("__n")).cast("long"))
    # one and a half turns keep the numbers positive and the cells in step
    span = lambda lo, n: F.sequence(*[F.floor((lo + d + F.lit(3 * TURN // 2)) / F.col("__w")) for d in (F.lit(0), n)])
    df = df.withColumn("__x", F.explode(span(_high("corner"), _high("size")))).withColumn("__y", F.explode(span(_low("corner"), _low("size"))))
    return df.withColumn("cell", _cell_code(F.col("__l"), F.pmod("__x", "__n"), F.col("__y"))).drop("__l", "__n", "__w", "__x", "__y")


def _cell_code(level: Column, x: Column, y: Column) -> Column:
    return F.shiftleft(level.cast("long"), 56).bitwiseOR(F.shiftleft(x.cast("long"), 28)).bitwiseOR(y.cast("long"))


def _candidates(stored: DataFrame, probe: DataFrame) -> DataFrame:
    """Pairs of classes whose boxes share enough, each from one cell and once."""
    side = lambda df, p: df.select("cell", *[F.col(c).alias(p + c) for c in ("corner", "size", "area", "own")], F.col("id").alias(p))
    ax, ay, aw, ah = _high("acorner"), _low("acorner"), _high("asize"), _low("asize")
    bx, by, bw, bh = _high("bcorner"), _low("bcorner"), _high("bsize"), _low("bsize")
    bx = bx + F.lit(TURN) * F.floor((ax - bx + F.lit(TURN // 2)) / F.lit(TURN))
    left, right = F.greatest(ax, bx), F.least(ax + aw, bx + bw)
    low, high = F.greatest(ay, by), F.least(ay + ah, by + bh)
    level = F.col("aown")
    n = F.element_at(F.array(*[F.lit(v) for v in LEVELS]), level + 1)
    width = (F.lit(TURN) / n).cast("long")
    place = lambda v: F.floor((v + F.lit(3 * TURN // 2)) / width)
    met = side(stored, "a").join(side(probe, "b"), "cell").filter(
        ((F.col("bown") < F.col("aown")) | ((F.col("bown") == F.col("aown")) & (F.col("b") < F.col("a"))))
        & (right > left)
        & (high > low)
        & ((right - left).cast("double") * (high - low) > F.least("aarea", "barea") * F.lit(SHARED * UNIT * UNIT * (1 - 1e-9)))
        & (F.col("cell") == _cell_code(level, F.pmod(place(left), n), place(low)))
    )
    return met.select("a", "b")


def measured_links(pairs: DataFrame, shapes: DataFrame) -> DataFrame:
    """The pairs that share more than the half of the smaller; shapes are fetched by id."""
    side = lambda p: shapes.select(F.col("id").alias(p), F.col("fine").alias(p + "fine"), F.col("rough").alias(p + "rough"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "afine", "arough", "bfine", "brough").mapInArrow(_measured, "a long, b long")


def overlapping(boxes: DataFrame, shapes: DataFrame) -> DataFrame:
    """Links ``a, b`` that connect the footprint classes which share more than the half of the smaller.

    Every pair of them is connected, though not each by a link of its own: in cells of more than ``HOT`` classes
    those that are known to be connected aren't paired among themselves.
    """
    levelled = _levelled(boxes)
    present = sorted(r[0] for r in levelled.select("own").distinct().collect())  # at most len(LEVELS) numbers
    stored = _celled(levelled, F.col("own"))
    coarser = F.filter(F.array(*[F.lit(p) for p in present]), lambda p: p >= F.col("own"))
    probe = _celled(levelled.withColumn("__p", F.explode(coarser)), F.col("__p")).drop("__p")
    hot = cut(stored.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("cell"))
    if hot.isEmpty():
        return measured_links(_candidates(stored, probe), shapes)
    members, first = _near_one(probe.join(hot, "cell").select("cell", "id").distinct(), shapes)
    marked = lambda df: df.join(members.filter("near").select("cell", "id", "near"), ["cell", "id"], "left").withColumn("near", F.coalesce("near", F.lit(False)))
    some, others = cut(marked(stored)), cut(marked(probe))
    rest = _candidates(some.filter("NOT near"), others).unionByName(_candidates(some.filter("near"), others.filter("NOT near")))
    return measured_links(rest, shapes).unionByName(first)


def _near_one(members: DataFrame, shapes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``cell, id, near, tried`` of the members of crowded cells, and links that connect all near ones of a cell.

    Each round measures one member of each cell that isn't near yet against all of the cell. Those linked to it are
    near from then on if it is the first one or linked to one that is near.
    """
    members = cut(members.withColumns({"near": F.lit(False), "tried": F.lit(False)}))
    links = None
    for k in range(ROUNDS):
        one = members.filter("NOT near AND NOT tried").groupBy("cell").agg(F.min("id").alias("one"))
        pairs = members.join(one, "cell").filter("id <> one").select("one", "id").distinct()
        found = cut(measured_links(pairs.toDF("a", "b"), shapes))
        links = found if links is None else links.unionByName(found)
        reached = members.join(one, "cell").join(found.select(F.col("a").alias("one"), F.col("b").alias("id"), F.lit(True).alias("hit")), ["one", "id"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)) | (F.col("id") == F.col("one")))
        joined = reached.filter("hit").groupBy("cell").agg(F.max("near").alias("__on")) if k else one.select("cell", F.lit(True).alias("__on"))
        members = cut(
            members.join(reached.select("cell", "id", "hit", "one"), ["cell", "id"], "left")
            .join(joined, "cell", "left")
            .select("cell", "id", (F.col("near") | (F.coalesce("hit", F.lit(False)) & F.coalesce("__on", F.lit(False)))).alias("near"), (F.col("tried") | F.coalesce(F.col("id") == F.col("one"), F.lit(False))).alias("tried"))
        )
        if members.filter("NOT near AND NOT tried").groupBy("cell").count().filter(F.col("count") > HOT // 4).isEmpty():
            break
    return members, links


def groups_of_links(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of a link ``a, b``: the smallest node of its connected component.

    Large-star links each node's larger neighbours to its smallest one, small-star its smaller
    ones; both keep what is connected and shorten every path. The links are written between
    rounds, and the loop ends when a round changes nothing; links that haven't settled after
    ``most_rounds`` are an error, as their groups would come out split.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        """e: distinct links a > b."""
        if large:
            both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        near = both.join(least, "a")
        if large:
            out = near.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    e = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    state = None
    for _ in range(most_rounds):
        e = cut(star(star(e, True), False))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")).first()
        if now[0] == now[2] and now == state:  # every node has one link, to its root
            break
        state = now
    else:
        raise RuntimeError(f"links of groups have not settled after {most_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def installation_groups(df: DataFrame, key: str, geometry: str) -> DataFrame:
    """``key, group`` (the smallest key of the group) of the rows in groups of two or more."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(geometry).alias("g")).filter("g IS NOT NULL AND id IS NOT NULL")
    shapes = cut(rows.mapInArrow(_footprints, _FOOTPRINT))
    classes = cut(shapes.groupBy("same", "corner", "size", "area").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    grouped = groups_of_links(overlapping(classes.select("id", "corner", "size", "area"), shapes))
    # copies of one footprint: only their classes have been linked
    several = classes.filter("copies > 1").select("same", F.col("id").alias("rep"))
    copies = shapes.select("id", "same").join(several, "same").select("id", "rep")
    out = copies.filter("id <> rep").join(grouped, copies["rep"] == grouped["node"], "left").select("id", F.coalesce("root", "rep").alias("grp"))
    # representatives whose class stands alone but for its copies
    alone = several.select("rep").join(grouped, several["rep"] == grouped["node"], "left_anti").select(F.col("rep").alias("id"), F.col("rep").alias("grp"))
    out = out.unionByName(alone).unionByName(grouped.select(F.col("node").alias("id"), F.col("root").alias("grp")))
    return out.select(F.col("id").alias(key), F.col("grp").alias("group"))


# --- survivors -----------------------------------------------------------------------------

def dominance_layers(rows: DataFrame, group: str, key: str, trust: str, recency: str, usable: list[Column], by_number: bool = False) -> DataFrame:
    """``grp, records``: of each group the records that stand for their completeness and trust, with their layers.

    ``records`` is an array of structs ``(layer, place, trust, time, mask, id)``; ``trust`` is the negative rank, ``place`` counts by the lexicographic policy, bit k of
    ``mask`` says that field k is usable.
    """
    mask = F.lit(0)
    for k, u in enumerate(usable):
        mask = mask.bitwiseOR(F.when(u, F.lit(1 << k)).otherwise(F.lit(0)))
    marked = rows.select(
        F.col(group).alias("grp"), F.col(key).cast("long").alias("id"), (-F.coalesce(F.col(trust).cast("int"), F.lit(2**31 - 1))).alias("trust"), F.col(recency).alias("time"), mask.alias("mask")
    )
    # the latest of each set of fields and trust level, combined before the shuffle
    best = marked.groupBy("grp", "trust", "mask").agg(F.max(F.struct("time", "id")).alias("b"))
    # at most 2 ** fields sets at each trust level, whatever the size of the group
    records = best.groupBy("grp").agg(F.reverse(F.array_sort(F.collect_list(F.struct("trust", "b.time", "b.id", "mask")))).alias("r"))
    fields = (lambda m: F.bit_count(m)) if by_number else (lambda m: m)
    covers = (lambda a, b: fields(a) >= fields(b)) if by_number else (lambda a, b: a.bitwiseAND(b) == b)
    # in the order of the policy a record can be dominated by earlier ones only: no worse in trust as they come first
    none = F.array().cast(f"array<struct<layer:int,place:int,trust:int,time:{dict(marked.dtypes)['time']},mask:int,id:bigint>>")

    def step(acc: Column, x: Column) -> Column:
        above = F.filter(acc, lambda a: (x["time"].isNull() | F.coalesce(a["time"] >= x["time"], F.lit(False))) & covers(a["mask"], x["mask"]))
        layer = F.coalesce(F.array_max(F.transform(above, lambda a: a["layer"])) + 1, F.lit(0))
        now = F.struct(layer.alias("layer"), F.size(acc).alias("place"), x["trust"].alias("trust"), x["time"].alias("time"), x["mask"].alias("mask"), x["id"].alias("id"))
        return F.concat(acc, F.array(now))

    return records.select("grp", F.aggregate("r", none, step).alias("records"))


def chosen_records(layers: DataFrame, fields: list[str]) -> DataFrame:
    """``grp, field_name, id``: the base record of each group (under the name '') and the record that each field is taken from."""
    first = lambda records: F.array_min(F.transform(records, lambda x: F.struct(x["layer"], x["place"], x["id"])))["id"]
    picks = [F.struct(F.lit("").alias("field_name"), first(F.col("records")).alias("id"))]
    having = lambda k: F.filter("records", lambda x: x["mask"].bitwiseAND(F.lit(1 << k)) != 0)
    picks += [F.struct(F.lit(f).alias("field_name"), first(having(k)).alias("id")) for k, f in enumerate(fields)]
    return layers.select("grp", F.explode(F.array(*picks)).alias("__f")).select("grp", "__f.field_name", "__f.id").filter("id IS NOT NULL")


def surviving_values(rows: DataFrame, group: str, key: str, trust: str, recency: str, fields: dict[str, Column], by_number: bool = False) -> DataFrame:
    """``group, field_name, key``: for each field the row whose value survives.

    ``fields`` maps each field to the condition that its value is usable.
    """
    layers = dominance_layers(rows, group, key, trust, recency, list(fields.values()), by_number)
    return chosen_records(layers, list(fields)).filter("field_name <> ''").select(F.col("grp").alias(group), "field_name", F.col("id").alias(key))


def built_records(rows: DataFrame, group: str, key: str, trust: str, recency: str, fields: dict[str, Column], keep: list[str], by_number: bool = False) -> DataFrame:
    """One record per group: the base record's ``keep`` columns, and every field from the first record that has it, layer by layer."""
    layers = cut(dominance_layers(rows, group, key, trust, recency, list(fields.values()), by_number))
    chosen = chosen_records(layers, list(fields)).select("grp", "field_name", F.col("id").alias("__id"))
    values = chosen.join(rows.select(F.col(key).alias("__id"), *[F.col(f).alias(f"__v{k}") for k, f in enumerate(fields)], *[F.col(c).alias(f"__k{k}") for k, c in enumerate(keep)]), "__id")
    of = lambda name, c: F.max(F.when(F.col("field_name") == name, F.col(c)))
    merged = values.groupBy("grp").agg(
        of("", "__id").alias(f"base_{key}"),
        *[of("", f"__k{k}").alias(c) for k, c in enumerate(keep)],
        *[of(f, f"__v{k}").alias(f) for k, f in enumerate(fields)],
        *[of(f, "__id").alias(f"{f}_from") for f in fields],
    )
    many = rows.groupBy(group).agg(F.count("*").alias("n_records"))
    return merged.withColumnRenamed("grp", group).join(many, group).select(group, f"base_{key}", *keep, "n_records", *fields, *[f"{f}_from" for f in fields])

"""The problems on training data: brute force, round trips, nulls, ties, repeated rows, empty tables, clashing columns."""

import os
import random
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from heliolake.llm import packing, spam, survivors, tokens

HAVE = os.path.exists(os.path.join(tokens.TOKENIZER_DIR, "byte_bpe_50k.tiktoken"))
needs_tokenizer = pytest.mark.skipif(not HAVE, reason="no tokenizer files")


# --- tokens --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    return tokens.Codec(tokens.load_ranks(tokens.tokenizer_bytes()))


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(tokens.TOKENIZER_DIR, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


HARD = ["", " ", "\n\n", "it's we'll I'd", "a  b   c\n", "   x  y", " \n x\n ", "光伏组件 ☀️🔋", "<|endoftext|>", "x" * 3000, "ab" * 4000, "-" * 5000 + "=" * 300, "7" * 3000, " " * 9000 + "x", "\n" * 5000 + " x", "a" + " " * 5000, "'" * 200 + "re", "_" * 5000 + "'s", "é" * 1500, "👩‍🔧" * 200]


@needs_tokenizer
@pytest.mark.parametrize("chunk,run", [(1 << 16, 1 << 12), (50, 40), (7, 16), (333, 12)])
def test_streaming_equals_the_reference(codec, reference, monkeypatch, chunk, run):
    monkeypatch.setattr(tokens, "CHUNK", chunk)
    monkeypatch.setattr(tokens, "RUN", run)
    for text in HARD:
        ids = codec.encode(text)
        assert ids == reference(text), text[:40]
        assert codec.decode(ids) == text


@needs_tokenizer
@settings(max_examples=80, deadline=None)
@given(hs.text(alphabet=hs.sampled_from("ab e's 1\n光é-"), max_size=400), hs.integers(1, 60))
def test_chunks_never_matter(reference, text, chunk):
    codec = tokens.codec_of(tokens.tokenizer_bytes())
    stream, got = tokens.Encoder(codec), b""
    for at in range(0, len(text), chunk):
        got += stream.feed(text[at : at + chunk])
    assert np.frombuffer(got + stream.finish(), np.int32).tolist() == reference(text)


@needs_tokenizer
def test_transducer_holds_little_and_encodes_all(codec, reference):
    random.seed(4)
    letters = "".join(random.choice("abcdeingthst") for _ in range(30_000))
    data = letters.encode()
    p, out, most = tokens.Piece(codec, "letters"), b"", 0
    for at in range(0, len(data), 700):
        out += p.feed(data[at : at + 700])
        most = max(most, len(p.window))
    assert np.frombuffer(out + p.finish(), np.int32).tolist() == reference(letters)
    assert most <= 24 * codec.lookahead["letters"]
    # nor does the stream hold a run without end, of any kind
    for text in (letters * 3, "8" * 90_000, " " * 90_000, "-=" * 45_000):
        stream, got, most = tokens.Encoder(codec), b"", 0
        for at in range(0, len(text), 500):
            got += stream.feed(text[at : at + 500])
            most = max(most, len(stream.held))
        assert np.frombuffer(got + stream.finish(), np.int32).tolist() == reference(text) and most <= tokens.RUN + 500
    # every pretoken that isn't a token itself is worked out by the transducer, once
    fresh = tokens.Codec(codec.ranks)
    fresh.encode("zqxjk zqxjk the zqxjk")
    assert fresh.transduced == 2 and not hasattr(tokens, "tiktoken")


@needs_tokenizer
def test_neighbours_stay_apart_as_the_reference_says(codec):
    import tiktoken

    core = tiktoken.Encoding("t", pat_str=tokens.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    random.seed(5)
    every = list(codec.ranks)
    for _ in range(4000):
        x, y = random.choice(every), random.choice(every[:2000])
        y = x if random.random() < 0.1 else y
        want = x + y not in codec.ranks and core._encode_single_piece(x + y) == [codec.ranks[x], codec.ranks[y]]
        assert codec.compatible(codec.ranks[x], codec.ranks[y]) == want, (x, y)


@needs_tokenizer
def test_decoder_keeps_unfinished_characters(codec):
    ids = codec.encode("光伏👩‍🔧é")
    d = tokens.Decoder(codec)
    parts = [d.feed([i]) for i in ids]
    assert "".join(parts) + d.finish() == "光伏👩‍🔧é" and "" in parts


@needs_tokenizer
def test_encode_column(spark, reference):
    long = "The solar panel works. " * 20_000
    rows = [(1, None, "x"), (2, "", "x"), (3, "ok", "x"), (3, "ok", "x"), (4, long, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, r.ids) for r in tokens.encode_column(df, "doc_id", "text").collect()), key=lambda r: r[0])
    assert got == [(1, []), (2, []), (3, reference("ok")), (3, reference("ok")), (4, reference(long))]
    assert tokens.encode_column(df.limit(0), "doc_id", "text").count() == 0


# --- packing -------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(hs.lists(hs.integers(0, 100), max_size=60))
def test_best_fit_against_brute_force(sizes):
    s = np.array(sizes, np.int64)
    where, offset, filled = packing.best_fit(s, 100)
    rooms = []
    for i in np.argsort(-s, kind="stable"):
        fit = [r for r in rooms if r >= s[i]]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - s[i])
        else:
            rooms.append(100 - s[i])
    assert sorted(rooms) == sorted(100 - filled)
    for b in range(len(filled)):
        mine = sorted((offset[i], s[i]) for i in np.flatnonzero(where == b))
        at = 0
        for o, n in mine:
            assert o == at or n == 0
            at = max(at, o + n)
        assert at == filled[b] <= 100


def packed(spark, rows, capacity=100):
    df = spark.createDataFrame(rows, "doc_id long, n int, container string, bin string")
    return packing.pack(df, "doc_id", "n", capacity).collect()


def check_packing(rows, got, capacity=100):
    by: dict[str, list] = {}
    pieces: dict[int, list] = {}
    for r in got:
        by.setdefault(r.container, []).append((r.offset, r.size))
        pieces.setdefault(r.doc_id, []).append((r.piece, r.size))
    for items in by.values():
        at = 0
        for o, n in sorted(items):
            assert o == at or n == 0
            at = max(at, o + n)
        assert at <= capacity
    for doc, n, *_ in rows:
        p = sorted(pieces[doc])
        assert [k for k, _ in p] == list(range(len(p))) and sum(s for _, s in p) == max(n or 0, 0)
        assert len(p) == 1 or (n > capacity and all(s == capacity for _, s in p[:-1]))
    return len(by)


def test_pack(spark, monkeypatch):
    random.seed(5)
    rows = [(k, random.choice([random.randrange(1, 40), random.randrange(30, 100)]), "x", None) for k in range(3000)]
    rows += [(5000, None, "x", None), (5001, 0, "x", None), (5002, 100, "x", None), (5003, 350, "x", None), (5004, 300, "x", None), (5005, 101, "x", None)]
    used = check_packing(rows, packed(spark, rows))
    assert used <= 1.03 * sum(max(r[1] or 0, 0) for r in rows) / 100 + 2
    assert packed(spark, []) == []


def test_pack_of_items_that_share_nothing(spark, monkeypatch):
    monkeypatch.setattr(packing, "CARRY", 5)
    rows = [(k, 60, None, None) for k in range(400)]
    assert check_packing(rows, packed(spark, rows)) == 400


# --- survivors -----------------------------------------------------------------------------


def box(x0, y0, x1, y1):
    return f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"


def groups(spark, shapes):
    df = spark.createDataFrame([(k, g, 1) for k, g in shapes], "row_id long, geometry string, rep int")
    out: dict[int, set] = {}
    for r in survivors.installation_groups(df, "row_id", "geometry").collect():
        out.setdefault(r.group, set()).add(r.row_id)
    return out


def test_groups_against_brute_force(spark):
    random.seed(6)
    boxes = []
    for k in range(160):
        x, y = random.choice([(0, 0), (179.9995, 10), (-50, -33)])
        w, h = random.choice([(0.0003, 0.0002), (0.002, 0.001), (0.03, 0.02)])
        x0, y0 = x + random.uniform(0, 0.002), y + random.uniform(0, 0.002)
        boxes.append((k, round(x0, 7), round(y0, 7), round(x0 + w, 7), round(y0 + h, 7)))
    parent = {b[0]: b[0] for b in boxes}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(boxes):
        for b in boxes[i + 1 :]:
            w, h = min(a[3], b[3]) - max(a[1], b[1]), min(a[4], b[4]) - max(a[2], b[2])
            if w > 0 and h > 0 and w * h > 0.5 * min((q[3] - q[1]) * (q[4] - q[2]) for q in (a, b)):
                parent[root(a[0])] = root(b[0])
    want: dict[int, set] = {}
    for b in boxes:
        want.setdefault(root(b[0]), set()).add(b[0])
    want = {min(v): v for v in want.values() if len(v) > 1}

    def shape(b):
        # the same box beyond 180 degrees, or written with western longitudes
        turn = 360 if b[3] > 180 and b[0] % 2 else 0
        return box(*(v - turn if i % 2 == 0 else v for i, v in enumerate(b[1:])))

    assert groups(spark, [(b[0], shape(b)) for b in boxes]) == want


def test_heaps_of_near_copies_need_no_pairs(spark, monkeypatch):
    """Four hundred nearly equal footprints, others linked to only some of them, and strangers in the same cells."""
    monkeypatch.setattr(survivors, "HOT", 20)
    random.seed(11)
    heap = [(k, box(*(round(v + random.uniform(-2e-6, 2e-6), 8) for v in (0.0001, 0.0001, 0.0003, 0.0002)))) for k in range(10, 410)]
    others = [(1, box(0.0002, 0.0001, 0.0004, 0.0002)), (2, box(0.000305, 0.0001, 0.0005, 0.0002)), (500, box(0.00012, 0.00012, 0.00014, 0.00014)), (501, box(0.0006, 0.0006, 0.0007, 0.0007)), (502, box(0.00062, 0.0006, 0.00072, 0.0007)), (503, box(0.0, 0.0, 0.03, 0.02)), (504, box(0.0009, 0.0009, 0.001, 0.001))]
    formed = []
    real = survivors.measured_links

    def watched(pairs, shapes):
        formed.append(pairs.count())
        return real(pairs, shapes)

    monkeypatch.setattr(survivors, "measured_links", watched)
    edges = [(k, [float(v) for v in g[10:-2].replace(",", "").split()]) for k, g in heap + others]
    parent = {k: k for k, _ in edges}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (ka, a) in enumerate(edges):
        for kb, b in edges[i + 1 :]:
            w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[5], b[5]) - max(a[1], b[1])
            if w > 0 and h > 0 and w * h > 0.5 * min((q[2] - q[0]) * (q[5] - q[1]) for q in (a, b)):
                parent[root(ka)] = root(kb)
    want: dict[int, set] = {}
    for k, _ in edges:
        want.setdefault(root(k), set()).add(k)
    assert groups(spark, heap + others) == {min(v): v for v in want.values() if len(v) > 1}
    assert sum(formed) < 8 * len(edges)


def test_shapes_are_packed_exactly():
    from heliolake.functions import geometry as G

    texts = ["POLYGON ((0 0, 1 0, 1 1, 0 0), (0.2 0.1, 0.3 0.1, 0.3 0.2, 0.2 0.1))", "POINT (1 2)", "MULTIPOLYGON (((0 0, 1.123456789 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))", "POLYGON ((300.5 0, 301 0, 301 1, 300.5 0))", "POLYGON ((-0.0000554 56.840585, 0.0000337 56.8405843, 0.0000349 56.840634, -0.0000554 56.840585))"]
    r = G.decode_wkt(texts)
    ok = np.array([0, 2, 3, 4])
    fine, rough = survivors.pack_shapes(r, ok)
    assert [len(v) > 0 for v in fine.to_pylist()] == [True, False, False, True] and [len(v) > 0 for v in rough.to_pylist()] == [False, True, True, False]
    got = survivors.unpack_shapes(fine, rough)
    want = G.decode_wkt([texts[i] for i in ok])
    for name in ("x", "y", "ring", "row", "hole"):
        assert np.array_equal(getattr(got, name), getattr(want, name)), name


def test_layers_against_brute_force(spark):
    random.seed(12)
    rows = [(random.randrange(12), k, random.choice([1, 2, 3, None]), None if random.random() < 0.1 else datetime(2024, 1, random.randrange(1, 9)), random.choice([None, 1.0]), random.choice([None, "x"]), random.choice([None, 2.0])) for k in range(120)]
    df = spark.createDataFrame(rows, "g int, row_id long, trust int, at timestamp, a double, b string, c double")
    usable = [F.col(f).isNotNull() for f in "abc"]
    for by_number in (False, True):
        got = {(r.grp, x.id): x.layer for r in survivors.dominance_layers(df, "g", "row_id", "trust", "at", usable, by_number).collect() for x in r.records}
        best = {}
        for g, k, t, at, a, b, c in rows:
            mask = (a is not None) | (b is not None) << 1 | (c is not None) << 2
            here = (g, -(t or 2**31 - 1), mask)
            best[here] = max(best.get(here, (datetime(1, 1, 1), -1)), (at or datetime(1, 1, 1), k))
        points = [(g, t, m, at, k) for (g, t, m), (at, k) in best.items()]
        covers = (lambda x, y: x.bit_count() >= y.bit_count()) if by_number else (lambda x, y: x & y == y)
        left, layer, want = points, 0, {}
        while left:
            # of equals the larger id stands first
            beaten = lambda p: any(q != p and q[0] == p[0] and q[1] >= p[1] and q[3] >= p[3] and covers(q[2], p[2]) and ((q[1], q[3]) != (p[1], p[3]) or q[2] != p[2] and (not covers(p[2], q[2]) or q[4] > p[4])) for q in left)  # noqa: E731, B023
            front = [p for p in left if not beaten(p)]
            want.update({(p[0], p[4]): layer for p in front})
            left, layer = [p for p in left if p not in front], layer + 1
        same = [k for k in want if got.get(k) != want[k]]
        assert got.keys() == want.keys() and (by_number or len(same) == 0 or all(abs(got[k] - want[k]) <= 1 for k in same)), same


def test_layers_decide_what_fills_a_record(spark):
    """Without the layers the policy alone would fill b from the more trusted record 2, which record 1 dominates."""
    t = lambda d: datetime(2024, 1, d)
    rows = [(1, 1, 1, t(9), "1", None, "1"), (1, 2, 1, t(5), None, "2", None), (1, 3, 2, t(10), "3", "3", "3")]
    df = spark.createDataFrame(rows, "g int, row_id long, trust int, at timestamp, a string, b string, c string")
    fields = {f: F.col(f).isNotNull() for f in "abc"}
    by_number = survivors.built_records(df, "g", "row_id", "trust", "at", fields, ["trust"], by_number=True).first()
    by_field = survivors.built_records(df, "g", "row_id", "trust", "at", fields, ["trust"]).first()
    assert (by_number.base_row_id, by_number.a_from, by_number.b_from, by_number.c_from, by_number.n_records) == (1, 1, 3, 1, 3)
    assert (by_field.base_row_id, by_field.a_from, by_field.b_from, by_field.c_from) == (1, 1, 2, 1)


def test_group_cases(spark):
    shapes = [
        (1, box(0, 0, 1, 1)), (2, box(0, 0, 1, 1)), (3, "MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)))"),  # copies, one spelt otherwise
        (4, "POINT (0.5 0.5)"), (5, "POINT (0.5 0.5)"), (6, "POLYGON EMPTY"), (7, "POLYGON EMPTY"), (8, None), (9, None), (10, "junk"), (11, "junk"),
        (12, box(5, 5, 7, 6)), (13, box(6, 5, 8, 6)),  # exactly the half: apart
        (14, box(20, 0, 21, 1)), (15, box(20.4, 0, 21.4, 1)), (16, box(20.8, 0, 21.8, 1)),  # a chain
        (17, "POLYGON ((0 0))"), (None, box(0, 0, 1, 1)),
    ]
    assert groups(spark, shapes) == {1: {1, 2, 3}, 14: {14, 15, 16}}
    assert groups(spark, []) == {}


def test_many_copies_need_no_pairs(spark):
    shapes = [(k, box(0, 0, 1, 1)) for k in range(3000)] + [(9000, box(0.1, 0, 1.1, 1))]
    assert {k: len(v) for k, v in groups(spark, shapes).items()} == {0: 3001}


def test_components_of_a_long_path(spark):
    random.seed(7)
    ids = list(range(200))
    random.shuffle(ids)
    links = [(a, b) for a, b in zip(ids, ids[1:])] + [(500, 501), (501, 500), (500, 500)]
    got = {r.node: r.root for r in survivors.groups_of_links(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in ids) and got[500] == got[501] == 500


@pytest.mark.parametrize("sizes", [(50, 70), (60, 61, 62), (51, 49, 30, 70), (55, 44, 90, 12)])
def test_no_group_is_large_and_the_cap_costs_no_container(spark, monkeypatch, sizes):
    merge = packing._merge

    def watched(capacity, last):
        inner = merge(capacity, last)

        def run(pdf):
            assert 0 < len(pdf) <= 4 * 24
            return inner(pdf)

        return run

    random.seed(8)
    rows = [(k, random.choice(sizes), None, None) for k in range(1500)]
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 20)
    monkeypatch.setattr(packing, "FAN_IN", 4)
    monkeypatch.setattr(packing, "BLOCK", 16)
    try:
        monkeypatch.setattr(packing, "CARRY", 10**9)
        free = check_packing(rows, packed(spark, rows))
        monkeypatch.setattr(packing, "CARRY", 24)
        monkeypatch.setattr(packing, "_merge", watched)
        assert check_packing(rows, packed(spark, rows)) == free
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_groups_that_do_not_settle_are_an_error(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(100)], "a long, b long")
    with pytest.raises(RuntimeError, match="settled"):
        survivors.groups_of_links(links, most_rounds=1)


def test_surviving_values(spark):
    t = lambda d: datetime(2024, 1, d)
    rows = [
        (1, 1, 2, t(5), 1.0, "2020"), (1, 2, 1, t(1), None, "unknown"), (1, 3, 1, t(2), 3.0, None), (1, 4, 1, t(2), 4.0, ""), (1, 5, None, t(9), 5.0, "2021"),
        (2, 6, 1, None, 999999.0, "1970-01-01T00:00:00Z"), (2, 7, 2, None, -1.0, " n/a "), (3, 8, 3, None, float("nan"), "x"), (3, 9, 3, t(1), 2.0, "y"), (3, 10, 3, t(1), 2.0, "y"),
    ]
    df = spark.createDataFrame(rows, "g long, row_id long, trust int, at timestamp, cap double, day string")
    fields = {"cap": survivors.usable_number(F.col("cap")), "day": survivors.usable_text(F.col("day"))}
    got = {(r.g, r.field_name): r.row_id for r in survivors.surviving_values(df, "g", "row_id", "trust", "at", fields).collect()}
    assert got == {(1, "cap"): 4, (1, "day"): 1, (3, "cap"): 10, (3, "day"): 10}
    built = {r.g: r for r in survivors.built_records(df, "g", "row_id", "trust", "at", fields, ["trust"]).collect()}
    assert built[1].cap == 4.0 and built[1].day == "2020" and built[1].n_records == 5 and built[2].cap is None
    assert survivors.surviving_values(df.limit(0), "g", "row_id", "trust", "at", fields).count() == 0


def test_stand_ins(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, -999.0, 99999.0, 999999999.0, 99.0, 9999.0, 1e-5, None, float("inf"), 0.5)], "v double")
    assert [r[0] for r in df.select(survivors.usable_number(F.col("v"))).collect()] == [False, False, False, False, True, True, True, False, False, True]
    df = spark.createDataFrame([(v,) for v in ("", "NULL", " Unknown", "??", "1900-01-01", "9999-12-31", "1970-01-01T00:00:00Z", "0000-00-00", None, "2020", "1970-01-02", "1970-01-01 12:30")], "v string")
    assert [r[0] for r in df.select(survivors.usable_text(F.col("v"))).collect()] == [False] * 9 + [True] * 3


# --- pages ---------------------------------------------------------------------------------

PROSE = [
    "The inverter in the north field was replaced in May because the old one had failed.",
    "Nobody on the list had seen the report, which is why it was sent to the council again.",
    "In March the crew measured the panels and found that two of them were cracked.",
    "After a week of fog the plant delivered less than it should have for that month.",
    "The land between the two villages is still waiting for a permit from the region.",
    "A contractor drew the outline twice, so the record was merged with another by hand.",
]
PHRASES = ["cheap solar panels", "solar quotes", "buy solar kit", "best solar installer", "solar near me", "solar grants"]


def pages():
    random.seed(8)
    prose = lambda n: " ".join(random.choice(PROSE) for _ in range(n))
    url = lambda: f"https://a{random.randrange(99)}.example/p/{random.randrange(999)}"
    spam_ = [
        lambda: "\n".join(random.choice(PHRASES) for _ in range(30)),
        lambda: ". ".join(random.choice(PHRASES) for _ in range(40)),
        lambda: "".join(f'<a href="{url()}">{random.choice(PHRASES)}</a>' for _ in range(20)),
        lambda: "\n".join(url() for _ in range(15)),
        lambda: " | ".join(f"Home > {random.choice(PHRASES).title()} > Town{random.randrange(9)}" for _ in range(20)),
        lambda: " ".join(f"#tag{random.randrange(50)}solar" for _ in range(40)),
        lambda: " ".join(f"Our {p} beat every {p} because {p} means {p}." for p in random.choices(PHRASES, k=9)),
    ]
    clean = [
        lambda: prose(12),
        lambda: prose(8) + "\nReferences\n" + "\n".join(f"[{k}] A. Author (20{k:02d}) {url()}" for k in range(4)),
        lambda: prose(6) + "\n" + "\n".join(f"2020-01-{k:02d}\t{k * 3.1:.1f}\t{k}" for k in range(1, 20)),
        lambda: prose(9) + " #solar #report",
        lambda: prose(9).lower().replace(".", ""),
    ]
    rows = [(k, spam_[k % len(spam_)](), True) for k in range(210)] + [(1000 + k, clean[k % len(clean)](), False) for k in range(600)]
    return rows


def test_pages_held_out(spark):
    rows = pages()
    df = spark.createDataFrame([(k, t, "x") for k, t, _ in rows], "doc_id long, text string, non_prose string")
    df = df.unionByName(spark.createDataFrame([(5000, None, "x"), (5001, "", "x"), (5002, " \n", "x"), (5003, "ok", "x"), (5004, "123 456", "x"), (0, rows[0][1], "x")], df.schema))
    got: dict[int, bool] = {}
    for r in spam.page_shares(df, "doc_id", "text").collect():
        assert got.get(r.doc_id, r.is_spam) == r.is_spam
        got[r.doc_id] = r.is_spam
    wrong = [k for k, _, s in rows if got[k] != s]
    assert len(wrong) <= 8, wrong
    assert not any(got[k] for k in range(5000, 5005))
    assert spam.page_shares(df.limit(0), "doc_id", "text").count() == 0


def test_model_fitted_on_one_half_holds_for_the_other(spark, tmp_path):
    rows = pages()
    model = spam.train([t for k, t, _ in rows if k % 2])
    held = [(k, t, s) for k, t, s in rows if k % 2 == 0]
    found = spam.shares_of(model, [t for _, t, _ in held])
    assert sum((f >= spam.SHARE) == s for (f, _), (_, _, s) in zip(found, held)) >= 0.98 * len(held)
    assert np.exp(model.move).sum(1) == pytest.approx(np.ones(4)) and np.argmax(model.start) == spam.PROSE
    spam.save_model(spark, model, str(tmp_path / "model"))
    again = spam.load_model(spark, str(tmp_path / "model"))
    assert spam.shares_of(again, [t for _, t, _ in held]) == found
    df = spark.createDataFrame([(k, t) for k, t, _ in held], "doc_id long, text string")
    assert spam.page_shares(df, "doc_id", "text", model=again).filter("is_spam").count() == sum(f >= spam.SHARE for f, _ in found)
    assert spam.train([]) is None and spam.train(["ok", ""]) is None


def test_short_remarks_need_no_least_length():
    model = spam.train([t for _, t, _ in pages()])
    remarks = ["ok", "ok\ntab\there\t\tthere", "https://a1.example/p/7 explains it better than I can.", "+1\nSELECT count(*) FROM t WHERE a >= 1e-3;", "[UNK] <s> </s> <pad>", "Nobody had seen the report."]
    assert [f < spam.SHARE for f, _ in spam.shares_of(model, remarks)] == [True] * len(remarks)
    assert spam.shares_of(model, [" | ".join(PHRASES), "a1 [dot] example [dot] com/x\n" * 6])[0][0] == 1.0


@settings(max_examples=40, deadline=None)
@given(hs.lists(hs.integers(1, 5), min_size=1, max_size=5), hs.integers(0, 9))
def test_labels_of_many_documents_against_all_paths(counts, seed):
    from itertools import product

    r = np.random.default_rng(seed)
    rows, start, move = r.normal(size=(sum(counts), 4)), r.normal(size=4), r.normal(size=(4, 4))
    got, at = spam.viterbi(rows, np.array(counts), start, move), 0
    for n in counts:
        e = rows[at : at + n]
        score = lambda p: start[p[0]] + sum(e[k, p[k]] for k in range(n)) + sum(move[p[k - 1], p[k]] for k in range(1, n))  # noqa: B023, E731
        assert tuple(got[at : at + n]) == max(product(range(4), repeat=n), key=score)
        at += n


def test_lines_cover_the_text():
    text = "One two three. " + "word " * 500 + "\n" + "光伏" * 700
    lines = spam.Reader(lambda c: 0).lines(text)
    assert max(len(w) for w, _, _ in lines) <= 330 and sum(n for _, n, _ in lines) >= 0.95 * len(text.replace(" ", ""))
    assert spam.Reader(lambda c: 0).lines("") == [] and spam.Reader(lambda c: 0).lines(" \x01 \x02 ?") == []

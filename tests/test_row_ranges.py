"""Range tombstones over clustering columns: places of rows, markers in newer files, and what they delete."""

import random
import struct
import uuid

import pytest
import sstable_writer as sw
from cells import cell, frame
from pyspark.sql import functions as F

from siltbed.functions import places
from siltbed.operators import reconcile as rc
from siltbed.plans.loader import load_table
from siltbed.sources.sstable import read_sstables
from siltbed.sources.sstable.wire import put_vint

INT = lambda x: struct.pack(">i", x)
DOUBLE = lambda x: struct.pack(">d", x)
#: Kinds of bounds by what ends and what begins there, with or without the bound.
KINDS = {("(", None): 7, ("[", None): 1, (None, ")"): 0, (None, "]"): 6, ("[", ")"): 2, ("(", "]"): 5}


def values(rows):
    return {c["name"]: bytes(c["value"]).decode() for r in rows for c in r["columns"]}


def typed(rnd):
    """(order, a function from Python values to bytes, values in the type's order) for some types."""
    times = sorted((uuid.uuid1(node=rnd.getrandbits(48), clock_seq=rnd.getrandbits(14)) for _ in range(6)), key=lambda u: (u.time, bytes(x ^ 0x80 for x in u.bytes[8:])))
    return [
        ("Int32Type", INT, [-(1 << 31), -70000, -1, 0, 1, 255, 256, 70000, (1 << 31) - 1]),
        ("UTF8Type", str.encode, ["", "a", "ab", "abc", "b", "z\x00", "é"]),
        ("DoubleType", DOUBLE, [-float("inf"), -2.5, -1e-300, -0.0, 0.0, 1e-300, 2.5, float("inf")]),
        ("TimeUUIDType", lambda u: u.bytes, times),
    ]


def test_places_are_in_the_order_of_types(spark):
    rnd = random.Random(3)
    for one, two in [(a, b) for a in typed(rnd) for b in typed(rnd)]:
        for back in ((False, False), (True, False), (False, True), (True, True)):
            order = ((one[0], back[0]), (two[0], back[1]))
            left = [None, *map(one[1], one[2])][:: -1 if back[0] else 1]
            right = [None, *map(two[1], two[2])][:: -1 if back[1] else 1]
            rows = [(a, b) for a in left for b in right]
            at = [places.place_of(r, order) for r in rows]
            assert at == sorted(at) and len(set(at)) == len(at), order
            assert [tuple(places.values_of(a, order)) for a in at] == rows
            for i in rnd.sample(range(len(rows)), 5):
                for n in (1, 2):
                    prefix = rows[i][:n]
                    same = [r[:n] == prefix for r in rows]
                    before, last = same.index(True), len(rows) - 1 - same[::-1].index(True)
                    assert [a >= places.at_or_after(prefix, order, True) for a in at] == [j >= before for j in range(len(rows))]
                    assert [a >= places.at_or_after(prefix, order, False) for a in at] == [j > last for j in range(len(rows))]
                    assert [a <= places.up_to(prefix, order, True) for a in at] == [j <= last for j in range(len(rows))]
                    assert [a <= places.up_to(prefix, order, False) for a in at] == [j < before for j in range(len(rows))]
                    for included in (True, False):
                        assert places.start_of(places.at_or_after(prefix, order, included), order) == (list(prefix), included)
                        hi = places.up_to(prefix, order, included)
                        assert places.up_to(*places.end_of(hi, order)[:1], order, places.end_of(hi, order)[1]) == hi


def test_columns_of_places_agree(spark):
    rnd = random.Random(4)
    for kind, to_bytes, some in typed(rnd):
        for back in (False, True):
            order = ((kind, back), ("UTF8Type", not back))
            rows = [(to_bytes(x), y) for x in some for y in (None, b"", b"x\xff")] + [(None, b"y")]
            df = spark.createDataFrame([([None if v is None else bytearray(v) for v in r],) for r in rows] + [(None,)], "c array<binary>")
            got = [r["p"] for r in df.select(places.place("c", order).alias("p")).collect()]
            assert got == [places.place_of(r, order) for r in rows] + [None]


def marker(t, shape, prefix, *times):
    out = bytes([0x02, KINDS[shape]]) + struct.pack(">H", len(prefix))
    if prefix:
        out += put_vint(0) + b"".join(t.value(k, v) for k, v in zip(t.clustering, prefix, strict=False))
    body = put_vint(7) + b"".join(put_vint(ts - t.min_ts) + put_vint(1) for ts in times)
    return out + put_vint(len(body)) + body


@pytest.mark.parametrize("back", [False, True])
def test_ranges_of_rows_in_files(spark, tmp_path, back):
    t = sw.NewTable([("n", "LongType")], [("st", "UTF8Type")], ["Int32Type", "UTF8Type"])
    header = t.header()
    if back:  # values are written as those of the type itself
        header = sw.NewTable(t.regular, t.static, [f"ReversedType({sw.DB}marshal.Int32Type)", "UTF8Type"]).header()
    rows = [(a, b) for a in (sorted([-2, -1, 0, 1, 2], reverse=back)) for b in ("a", "b", "bb")]
    written = [t.row({"n": (bytes(8), None, {})}, [INT(a), b.encode()], ts=1000 + 10 * i) for i, (a, b) in enumerate(rows)]
    static = t.row({"st": (b"s", None, {})}, ts=1000, static=True)
    p1, p2 = [INT(rows[3][0]), b"b"], [INT(rows[9][0])]
    ranges = [marker(t, ("(", None), p1, 1200), marker(t, ("[", ")"), p2, 1200, 1100), marker(t, (None, "]"), [INT(rows[12][0]), b"a"], 1100)]
    where = tmp_path / "k" / "t"
    sw.write(where / "ma-1-big", [(b"p", t.partition(b"p", [static, *written])), (b"q", t.partition(b"q", written))], header=header)
    sw.write(where / "ma-2-big", [(b"p", t.partition(b"p", ranges)), (b"r", t.partition(b"r", ranges))], header=header)
    cells = read_sstables(spark, [str(where)])
    assert sorted(r["ts"] for r in cells.where("kind = 'rows_deletion' and key = 'p'").collect()) == [1100, 1200]
    got = {(bytes(r["key"]), tuple(bytes(x) for x in r["clustering"])) for r in load_table(spark, [str(where)], now=1).exported().collect()}
    i = lambda a, b: rows.index((a, b))
    gone = {j for j in range(len(rows)) if i(rows[3][0], "b") < j < i(rows[9][0], "a")}  # all their times are below 1200
    gone |= {j for j in range(len(rows)) if i(rows[9][0], "a") <= j <= i(rows[12][0], "a") and 1000 + 10 * j <= 1100}
    left = {(INT(a), b.encode()) for j, (a, b) in enumerate(rows) if j not in gone}
    assert 5 < len(gone) < len(rows) - 3
    assert got == {(b"p", x) for x in left} | {(b"p", ())} | {(b"q", (INT(a), b.encode())) for a, b in rows}


@pytest.mark.parametrize("broken", ["size", "order", "open", "type"])
def test_broken_markers_are_refused(spark, tmp_path, broken):
    t = sw.NewTable([("n", "LongType")], clustering=["DecimalType" if broken == "type" else "Int32Type"])
    one, two = marker(t, ("[", None), [b"\0\0\0\1"], 1200), marker(t, (None, "]"), [b"\0\0\0\2"], 1200)
    bad = {"size": [one[:-1], two], "order": [two, one], "open": [one], "type": [one, two]}[broken]
    sw.write(tmp_path / "k" / "t" / "ma-1-big", [(b"p", t.partition(b"p", bad))], header=t.header())
    with pytest.raises(Exception, match="range tombstones over clustering"):
        read_sstables(spark, [str(tmp_path / "k" / "t")]).collect()


def test_an_unknown_order_matters_for_ranges_only(spark):
    rows = [cell(0, "a", 10, "x", key=b"p", clustering=[b"1"])]
    assert values(rc.reconcile_wide(frame(spark, rows), order=(("DecimalType", False),)).collect()) == {"a": "x"}
    rows.append(cell(0, "", 20, key=b"p", kind="rows_deletion", end=places.BEYOND))
    for order in (None, (("DecimalType", False),)):
        with pytest.raises(Exception, match="order of the clustering"):
            rc.reconcile_wide(frame(spark, rows), order=order).collect()
    rows.append(cell(0, "s", 10, "y", key=b"p", static=True))
    got = rc.reconcile_wide(frame(spark, rows), order=(("UTF8Type", False),)).where(F.size("columns") > 0).collect()
    assert [r["is_static"] for r in got] == [True] and values(got) == {"s": "y"}


def test_ranges_are_written_and_read(spark, tmp_path):
    from siltbed.sources.sstable.writer import Layout, write_sstables

    layout = Layout("md", regular=(("v", "UTF8Type"),), static=(("st", "UTF8Type"),), clustering=("Int32Type", "UTF8Type"))
    up, down = lambda at, yes: places.at_or_after(at, layout.order, yes), lambda at, yes: places.up_to(at, layout.order, yes)
    spans = [(up([], True), down([INT(-5)], False), 3), (up([INT(-5), b"b"], False), down([INT(2), b""], True), 4), (up([INT(2), b""], False), down([], True), 5)]
    rows = [cell(0, lo, ts, key=b"p", kind="rows_deletion", end=hi) for lo, hi, ts in spans]
    rows += [cell(0, "v", 9, f"{a}{b}", key=b"p", clustering=[INT(a), b]) for a in (-7, -5, 2) for b in (b"", b"b", b"c")] + [cell(0, "st", 9, "s", key=b"p", static=True)]
    write_sstables(frame(spark, rows), str(tmp_path), "ks", "t", layout).collect()
    back = read_sstables(spark, [f"{tmp_path}/ks/t"])
    assert sorted(tuple(r) for r in back.where("kind = 'rows_deletion'").select("name", "range_end", "ts").collect()) == sorted(spans)
    assert back.where("kind = 'cell' and name <> ''").count() == 10
    rows.append(cell(0, up([INT(0)], True), 3, key=b"p", kind="rows_deletion", end=down([INT(9)], True)))
    with pytest.raises(Exception, match="overlap"):
        write_sstables(frame(spark, rows), f"{tmp_path}/other", "ks", "t", layout).collect()

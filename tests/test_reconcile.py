import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cells import cell, deletion, frame, rng

from siltbed.operators import reconcile as rc


def values(rows):
    return None if not rows else {c["name"]: bytes(c["value"]).decode() for c in rows[0]["columns"]}


def keep(*names):
    return {n: n for n in names}


def plain_cells(names, ts=10):
    return [cell(0, n, ts, n) for n in names]


CASES = {
    "last write wins": ([cell(0, "a", 10, "x"), cell(1, "a", 20, "y")], {"a": "y"}),
    "a tie goes to the lowest source": ([cell(0, "a", 5, "x"), cell(1, "a", 5, "y")], {"a": "x"}),
    "a tie inside a source goes to the first": ([cell(0, "a", 5, "y", pos=2), cell(0, "a", 5, "x", pos=1)], {"a": "x"}),
    "a newer tombstone hides older versions": ([cell(0, "a", 10, "x"), cell(1, "a", 20, deleted=True)], {}),
    "an older tombstone loses": ([cell(0, "a", 10, deleted=True), cell(1, "a", 20, "y")], {"a": "y"}),
    "a deletion hides what is not newer": ([deletion(0, 20), cell(0, "a", 20, "x"), cell(0, "b", 21, "y")], {"b": "y"}),
    "deleted and empty": ([deletion(0, 20), cell(0, "a", 19, "x")], None),
    "deletions of several sources": ([deletion(0, 10), deletion(1, 30), cell(0, "a", 20, "x"), cell(0, "b", 31, "y")], {"b": "y"}),
    "a deletion without cells reaches other sources": ([deletion(1, 30), cell(0, "a", 20, "x")], None),
    "a range has both ends": ([rng(1, "b", "d", 20), *plain_cells("abcde")], keep("a", "e")),
    "a newer cell outlives a range": ([rng(1, "b", "d", 20), cell(0, "c", 21, "c"), cell(0, "b", 20, "b")], keep("c")),
    "overlapping ranges": ([rng(0, "a", "c", 10), rng(1, "b", "z", 20), cell(0, "c", 15, "c")], {}),
    "a range that starts later has no effect": ([rng(1, "m", "z", 20), cell(0, "a", 10, "a")], keep("a")),
    "a range with a column's name isn't its version": ([rng(1, "a", "a", 5), cell(0, "a", 10, "a"), cell(1, "a", 7, "z")], keep("a")),
    "unnamed cells are no columns": ([cell(0, "", 5, "x"), cell(0, "a", 5, "a")], keep("a")),
    "a live row without columns": ([cell(0, "a", 5, deleted=True), cell(0, "", 4)], {}),
    "NUL in a name": ([cell(0, "a\0b", 5, "x"), cell(0, "a\0c", 5, "y")], {"a\0b": "x", "a\0c": "y"}),
    "byte order of names": ([cell(0, n, 5, n) for n in ("b", "a", "Z", "é", "￿", "\U0001f600")], keep("Z", "a", "b", "é", "￿", "\U0001f600")),
}


def test_rules(spark):
    rows = []
    for i, (cells, _) in enumerate(CASES.values()):
        rows += [(*c[:2], f"{i:03}".encode(), *c[3:]) for c in cells]
    got = {bytes(r["key"]): [r] for r in rc.reconcile(frame(spark, rows)).collect()}
    for i, (name, (_, want)) in enumerate(CASES.items()):
        found = values(got.get(f"{i:03}".encode(), []))
        assert found == want, name
        assert found is None or list(found) == list(want), name


def brute(cells):
    """Row by row, as the rules say."""
    out = {}
    for key in {c[2] for c in cells}:
        mine = [c for c in cells if c[2] == key]
        dels = [c[9] for c in mine if c[6] == "row_deletion"]
        ranges = [(c[7], c[8], c[9]) for c in mine if c[6] == "range_tombstone"]
        live = {}
        for name in {c[7] for c in mine if c[6] == "cell"}:
            w = min((c for c in mine if c[6] == "cell" and c[7] == name), key=lambda c: (-c[9], c[0], c[14]))
            if name and not w[10] and not (dels and max(dels) >= w[9]) and not any(a <= name <= b and w[9] <= t for a, b, t in ranges):
                live[name] = w[13]
        if live or not dels:
            out[key] = live
    return out


names = st.sampled_from(["", "a", "b", "c", "d"])
versions = st.builds(lambda s, n, t, d, k, p: cell(s, n, t, f"{s}{n}{t}{p}", d, key=k, pos=p), st.integers(0, 2), names, st.integers(0, 6), st.booleans(), st.sampled_from([b"k", b"l"]), st.integers(0, 3))
dels = st.builds(lambda s, t, k: deletion(s, t, k), st.integers(0, 2), st.integers(0, 6), st.sampled_from([b"k", b"l"]))
spans = st.builds(lambda s, a, b, t, k: rng(s, min(a, b), max(a, b), t, k), st.integers(0, 2), names, names, st.integers(0, 6), st.sampled_from([b"k", b"l"]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(versions, versions, dels, spans), min_size=1, max_size=25, unique_by=lambda c: (c[0], c[2], c[6], c[7], c[9], c[14])))
def test_against_row_by_row_in_any_order_and_split(spark, cells):
    want = brute(cells)
    shuffled = list(cells)
    random.Random(1).shuffle(shuffled)
    half = len(cells) // 2
    one = rc.reconcile(frame(spark, shuffled))
    assert {bytes(r["key"]): {c["name"]: bytes(c["value"]) for c in r["columns"]} for r in one.collect()} == want
    two = rc.union_sources(frame(spark, shuffled[:half]), frame(spark, shuffled[half:]))
    long = {(bytes(r["key"]), r["name"]): bytes(r["value"]) for r in rc.merge(two).collect()}
    assert long == {(k, n): v for k, cs in want.items() for n, v in cs.items()}


def test_merging_again_changes_nothing(spark):
    df = frame(spark, [c for cells, _ in CASES.values() for c in cells])
    once = rc.exploded(rc.reconcile(df))
    again = once.select(F.lit(0).alias("src"), "key", F.lit("cell").alias("kind"), "name", F.lit(None).cast("string").alias("range_end"), "ts", F.lit(False).alias("deleted"), "ttl", "expires_at", "value", F.lit(0).cast("long").alias("pos"))
    assert sorted(map(str, rc.exploded(rc.reconcile(again)).collect())) == sorted(map(str, once.collect()))


def test_variants_agree(spark):
    rnd = random.Random(4)
    rows = [cell(s := rnd.randrange(3), rnd.choice("abcdef"), rnd.randrange(50), f"v{i}", rnd.random() < 0.2, key=bytes([rnd.randrange(5)]), pos=i) for i in range(400)]
    df = frame(spark, rows)
    a = sorted(map(str, rc.latest(df).select("key", "name", "ts", "value", "deleted").collect()))
    assert a == sorted(map(str, rc.latest_by_window(df).select("key", "name", "ts", "value", "deleted").collect()))
    three = rc.merge_two_by_two([df.where(F.col("src") == i) for i in range(3)])
    assert sorted(map(str, three.select("key", "name", "ts", "value").collect())) == sorted(map(str, rc.latest(df).select("key", "name", "ts", "value").collect()))
    marks = frame(spark, [rng(0, "b", "d", 30, bytes([k])) for k in range(3)])
    w = rc.latest(df)
    one, two = rc.drop_covered(w, rc.ranges(marks)), rc.drop_covered_by_arrays(w, rc.ranges(marks))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.select(*one.columns).collect()))


def test_wide_rows(spark):
    rows = [
        deletion(0, 10, b"p"),
        cell(0, "a", 10, "gone", key=b"p", clustering=[b"1"]),
        cell(0, "a", 11, "x", key=b"p", clustering=[b"2"]),
        cell(1, "a", 12, "y", key=b"p", clustering=[b"2"]),
        cell(1, "a", 20, "old", key=b"p", clustering=[b"3"]),
        deletion(0, 20, b"p", [b"3"]),
        cell(0, "s", 11, "static", key=b"p", static=True),
        cell(0, "a", 1, "q", key=b"q", clustering=[b"1"]),
    ]
    got = {(bytes(r["key"]), None if r["clustering"] is None else bytes(r["clustering"][0])): values([r]) for r in rc.reconcile_wide(frame(spark, rows)).collect()}
    assert got == {(b"p", b"2"): {"a": "y"}, (b"p", None): {"s": "static"}, (b"q", b"1"): {"a": "q"}}


def test_expired_columns_go_only_if_asked(spark):
    df = frame(spark, [cell(0, "a", 5, "old", expires_at=900), cell(0, "b", 5, "new", expires_at=1500)])
    assert values(rc.reconcile(df).collect()) == {"a": "old", "b": "new"}
    assert values(rc.reconcile(df, drop_expired_at=1000).collect()) == {"b": "new"}


@pytest.mark.parametrize("f", [rc.reconcile, rc.merge, rc.latest, rc.reconcile_wide])
def test_no_cells(spark, f):
    assert f(frame(spark, [])).count() == 0


def test_one_scan_and_partial_aggregation(spark, tmp_path):
    frame(spark, [cell(0, "a", 1, "x")]).write.parquet(str(tmp_path / "c"))
    plan = rc.reconcile(spark.read.parquet(str(tmp_path / "c")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "partial_max_by" in plan and "clustering" not in plan.split("ReadSchema")[1]


def test_values_move_once_without_combining(spark):
    rows = [cell(s, n, 10 * s + i, f"v{s}{n}", key=bytes([k])) for s in range(2) for k in range(4) for i, n in enumerate("abc")] + [deletion(1, 11, bytes([2])), rng(0, "a", "b", 30, bytes([3]))]
    df = frame(spark, rows)
    one, two = rc.reconcile(df), rc.reconcile(df, combine=False)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    plan = rc.reconcile(df, combine=False)._jdf.queryExecution().executedPlan().toString()  # not run, so it holds one plan
    assert plan.count("Exchange hashpartitioning") == 1

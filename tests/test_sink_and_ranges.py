import random

import pytest
from pyspark.sql import functions as F

from cells import cell, deletion, frame

from siltbed.functions import tokens
from siltbed.operators import reconcile, scan_range, sink, ttl
from siltbed.plans.loader import RECORD, records

E_ = None
TTLS = [
    ([1500, 1200], 1, ("exported", 500), ("exported", 200)),
    ([1500, E_], 1, ("exported", None), ("exported", 500)),
    ([E_, E_], 1, ("exported", None), ("exported", None)),
    ([900], 1, ("expired", None), ("expired", None)),
    ([1001], 1, ("exported", 1), ("exported", 1)),
    ([1000], 1, ("expired", None), ("expired", None)),
    ([], 1, ("expired", None), ("exported", None)),
    ([1500], 600, ("expired", None), ("expired", None)),
    ([900, 1500], 1, ("exported", 500), ("expired", None)),
]


@pytest.mark.parametrize("mode", ttl.MODES)
def test_expiry_of_records(spark, mode):
    rows = []
    for i, (times, _, _, _) in enumerate(TTLS):
        rows.append(cell(0, "", 1, key=bytes([i])))
        rows += [cell(0, f"c{j}", 5, "x", key=bytes([i]), expires_at=t) for j, t in enumerate(times)]
    for least in (1, 600):
        got = {bytes(r["key"])[0]: r for r in records(frame(spark, rows), now=1000, min_ttl=least, expiry=mode).collect()}
        for i, (times, limit, latest, nearest) in enumerate(TTLS):
            want = latest if mode == "latest" else nearest
            if limit == least:
                assert got[i]["status"] == want[0], (i, mode)
                assert got[i]["status"] != "exported" or (got[i]["ttl"], len(got[i]["bins"])) == (want[1], len(times))


def test_limits_and_modes_are_checked():
    for bad in (0, -1, 1 << 32):
        with pytest.raises(ValueError):
            ttl.check_min_ttl(bad)
    with pytest.raises(ValueError):
        ttl.expiry(mode="first")
    with pytest.raises(ValueError):
        sink.WritePolicy(in_flight=0)


def test_aggregate_form_of_expiry(spark):
    df = frame(spark, [cell(0, "a", 1, "x", key=b"1", expires_at=5), cell(0, "b", 1, "x", key=b"1"), cell(0, "a", 1, "x", key=b"2", expires_at=5), cell(0, "b", 1, "x", key=b"2", expires_at=9)])
    assert {bytes(r["key"]): r["expiry"] for r in ttl.fold_expiry(df).collect()} == {b"1": None, b"2": 9}
    assert {bytes(r["key"]): r["expiry"] for r in ttl.fold_expiry(df, mode="nearest").collect()} == {b"1": 5, b"2": 5}


def test_statuses_are_disjoint_and_eternal_is_set(spark):
    rows = [cell(0, "a", 5, "x", key=b"new"), cell(0, "a", 5, "x", key=b"there"), deletion(0, 9, b"gone"), cell(0, "a", 5, "x", key=b"late", expires_at=5), cell(0, "a", 5, deleted=True, key=b"gone")]
    target = spark.createDataFrame([(bytearray(b"there"),), (bytearray(b"there"),), (bytearray(b"other"),)], "key binary")
    got = records(frame(spark, rows), now=1000, eternal=0, target=target)
    assert sink.summary(got).collect()[0].asDict() == {"exported": 1, "failed": 0, "skipped": 1, "expired": 1, "existing": 1}
    r = got.where("status = 'exported'").collect()[0]
    assert (bytes(r["key"]), r["ttl"], {k: bytes(v) for k, v in r["bins"].items()}) == (b"new", 0, {"a": b"x"})


def test_target_creates_only(spark, tmp_path):
    t = sink.TableTarget(spark, str(tmp_path / "t"), "key int, v string", ["key"])
    assert t.read().count() == 0
    t.load(spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "key int, v string"))
    more = spark.createDataFrame([(2, "changed"), (3, "c")], "key int, v string")
    assert sink.existing(more, t.read(), ["key"]).count() == 1
    for _ in range(2):
        t.load(more)
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "b"), (3, "c")]


class Client:
    """Fails at first for some keys, always for others."""

    log: list = []

    def __init__(self):
        self.tries, self.there = {}, {b"there"}

    def put(self, key, bins, ttl):
        self.tries[key] = self.tries.get(key, 0) + 1
        if key in self.there:
            raise sink.Exists
        if key.startswith(b"busy") and self.tries[key] < 3 or key == b"down":
            raise sink.Retry("timeout")
        if key == b"bad":
            raise ValueError("no such bin")
        self.there.add(key)

    def close(self):
        Client.log.append(self.tries)


def test_writing_retries_and_classifies():
    keys = [b"a", b"busy1", b"busy2", b"down", b"bad", b"there", b"z"]
    pauses = []
    policy = sink.WritePolicy(retries=4, in_flight=2, sleep=pauses.append)
    got = {k: s for k, s, _ in sink.write_partition(({"key": k, "bins": {}, "ttl": None} for k in keys), Client, policy)}
    assert got == {b"a": "exported", b"busy1": "exported", b"busy2": "exported", b"down": "failed", b"bad": "failed", b"there": "existing", b"z": "exported"}
    assert Client.log[-1][b"down"] == 5 and pauses and max(pauses) <= policy.longest_pause


def test_writing_from_spark(spark):
    df = spark.createDataFrame([(bytearray(b"a"), {"x": bytearray(b"1")}, 5), (bytearray(b"there"), {}, None), (bytearray(b"busy"), None, None)], RECORD)
    got = {bytes(r["key"]): r["status"] for r in sink.write_records(df, Client, sink.WritePolicy(pause=0.001)).collect()}
    assert got == {b"a": "exported", b"there": "existing", b"busy": "exported"}


def test_text_and_names(spark):
    df = reconcile.reconcile(frame(spark, [cell(0, "b", 1, "x", key=b"k", expires_at=7), cell(0, "a", 1, b"\x00\xff", key=b"k"), cell(0, "", 1, key=b"\x01")]))
    got = {bytes(r["key"]): (r["t"], r["h"]) for r in df.select("key", sink.record_text().alias("t"), sink.resume_hint().alias("h")).collect()}
    assert got == {b"k": ("k:\na=00ff\nb=x (timeout=7)", "-s k"), b"\x01": ("01:", "-S 01")}
    assert sink.target_names("k", "t") == ("k", "t", []) and len(sink.target_names("k", "t", "n", "t")[2]) == 1


def test_seeking_and_resuming(spark):
    rnd = random.Random(1)
    keys = sorted({f"{rnd.randrange(10**6)}" for _ in range(300)})
    df = spark.createDataFrame([(k,) for k in keys], "key string").withColumn("token", tokens.random_token("key")).cache()
    order = [r["key"] for r in df.orderBy("token", "key").collect()]
    got = scan_range.ordinals(df, ["token", "key"])
    assert [r["key"] for r in got.orderBy("ordinal").collect()] == order and {r["ordinal"] for r in got.collect()} == set(range(1, len(order) + 1))
    for i in (0, 150, len(order) - 1):
        at = tokens.random_token(F.lit(order[i])), F.lit(order[i])
        assert {r["key"] for r in scan_range.seek(df, *at).collect()} == set(order[i:])
        assert [r["key"] for r in scan_range.next_key(df, *at).collect()] == order[i + 1 : i + 2]
    assert scan_range.first_key(df).collect()[0]["key"] == order[0] and scan_range.first_key(df.where("false")).count() == 0
    assert scan_range.ordinals(df.where("false"), ["key"]).count() == 0


def test_first_unsent_and_source_order(spark):
    df = spark.createDataFrame([("a", 3, "failed"), ("b", 2, "failed"), ("c", 1, "exported")], "key string, ordinal int, status string")
    assert sink.first_unsent(df).collect()[0]["key"] == "b" and sink.first_unsent(df.where("key = 'c'")).count() == 0
    s = spark.createDataFrame([("f2", 5, "x"), ("f1", 9, "a"), ("f2", 9, "y"), ("f0", 9, "a")], "source string, token int, key string")
    assert [r["source"] for r in scan_range.source_order(s).orderBy("src").collect()] == ["f2", "f0", "f1"]


def test_writing_at_once_bounds_and_classifies():
    import threading
    import time

    class Busy(Client):
        most = now = 0
        lock = threading.Lock()

        def put(self, key, bins, ttl):
            with Busy.lock:
                Busy.now += 1
                Busy.most = max(Busy.most, Busy.now)
            try:
                time.sleep(0.005)
                super().put(key, bins, ttl)
            finally:
                with Busy.lock:
                    Busy.now -= 1

    keys = [b"a%d" % i for i in range(40)] + [b"busy1", b"down", b"bad", b"there"]
    taken = []
    rows = (taken.append(k) or {"key": k, "bins": {}, "ttl": None} for k in keys)
    policy = sink.WritePolicy(retries=3, in_flight=8, threads=4, pause=0.001)
    written = sink.write_partition(rows, Busy, policy)
    first = next(written)
    assert len(taken) <= 8
    got = {k: s for k, s, _ in [first, *written]}
    assert 1 < Busy.most <= 4 and len(got) == len(keys)
    assert (got[b"busy1"], got[b"down"], got[b"bad"], got[b"there"]) == ("exported", "failed", "failed", "existing")


def test_attempts_end_with_the_time_they_may_take():
    policy = sink.WritePolicy(retries=10**6, timeout=0.05, pause=0.005)
    for threads in (1, 3):
        policy.threads = threads
        got = list(sink.write_partition(iter([{"key": b"down", "bins": {}, "ttl": None}]), Client, policy))
        assert got == [(b"down", "failed", "timeout")]


def test_row_keys_differ_as_rows_do(spark):
    rows = [(b"a", [b"b"], False), (b"a", [b"b", b""], False), (b"a", [None], False), (b"a", [], True), (b"a", None, True), (b"a", [], False), (b"a\0", [], False), (b"a", [b"b"], True)]
    df = spark.createDataFrame([(bytearray(k), c and [None if x is None else bytearray(x) for x in c], s) for k, c, s in rows], "key binary, clustering array<binary>, is_static boolean")
    got = [bytes(r["k"]) for r in df.select(sink.row_key().alias("k")).collect()]
    assert len(set(got)) == 7 and got[0] == b"\0\1a\0\0\1b\0"

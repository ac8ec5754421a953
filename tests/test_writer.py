import struct

import pytest

from cells import cell, deletion, frame

from siltbed.operators import shared
from siltbed.sources.sstable import read_sstables
from siltbed.sources.sstable.writer import Layout, write_sstables

OLD_CELLS = [
    cell(0, "a", 5, "x", key=b"k1"),
    cell(0, "b", 6, deleted=True, key=b"k1"),
    cell(0, "c", 7, "z" * 300, key=b"k1", expires_at=1000),
    deletion(0, 9, b"k2"),
    cell(0, "d", 10, "v", key=b"k2"),
    cell(1, "a", 8, "y", key=b"k1"),
    cell(1, "", 1, key=b"k3"),
]


def long_form(df):
    return sorted(((bytes(r["key"]), r["kind"], r["name"] or "", r["ts"], r["deleted"], r["expires_at"], None if r["value"] is None or r["deleted"] else bytes(r["value"])) for r in df.collect()), key=str)


@pytest.mark.parametrize("version, codec", [("a", None), ("hc", "SnappyCompressor"), ("ib", "DeflateCompressor"), ("jb", "LZ4Compressor"), ("la", None)])
def test_older_layouts_come_back(spark, tmp_path, version, codec):
    df = frame(spark, OLD_CELLS)
    layout = Layout(version, "RandomPartitioner" if version == "a" else "Murmur3Partitioner", codec, chunk=64, every=1)
    for _ in range(2):  # a task that runs again writes the same
        got = write_sstables(df, str(tmp_path), "ks", "t", layout).collect()
        assert sorted((r["file"], r["partitions"]) for r in got) == [(0, 2), (1, 2)]
    assert not list(tmp_path.rglob("*.db.*"))
    back = read_sstables(spark, [str(tmp_path / "ks" / "t")], split_bytes=64)
    want = [(b"k3", "cell", "", 0, False, None, None) if c[2] == "" and c[1] == "cell" and c[0] == b"k3" else c for c in long_form(df)]
    assert long_form(back) == sorted(want, key=str)


def test_newer_layout_comes_back(spark, tmp_path):
    c = [struct.pack(">i", i) for i in range(3)]
    names = [f"c{i}" for i in range(70)]
    schema = "src int, key binary, clustering array<binary>, is_static boolean, kind string, name string, range_end string, ts long, deleted boolean, ttl long, expires_at long, value binary"
    row = lambda at, name, ts, value=b"v", static=False, kind="cell", ttl=None, expires=None, deleted=False: (0, bytearray(b"p"), at and [bytearray(x) for x in at], static, kind, name, None, ts, deleted, ttl, expires, value and bytearray(value))
    rows = [row([c[0], b""], "c3", 5, ttl=4, expires=900), row([c[0], b""], "c69", 6, b""), row([c[0], b""], "", 4, None), row([c[1], b"x"], None, 7, None, kind="row_deletion")]
    rows += [row([c[2], b"y"], n, 8, n.encode()) for n in names[:60]] + [row([c[1], b"z"], "c1", 9, None, deleted=True), row(None, "st", 3, b"s", static=True), row(None, None, 2, None, kind="row_deletion")]
    layout = Layout("md", regular=tuple((n, "UTF8Type") for n in names), static=(("st", "UTF8Type"),), clustering=("Int32Type", "UTF8Type"), chunk=100)
    write_sstables(spark.createDataFrame(rows, schema), str(tmp_path), "ks", "t", layout).collect()
    plain = lambda r: (r["clustering"] and [bytes(x) for x in r["clustering"]], r["is_static"], r["kind"], r["name"] or "", r["ts"], r["deleted"], r["ttl"], r["expires_at"], bytes(r["value"] or b""))
    got = sorted((plain(r) for r in read_sstables(spark, [str(tmp_path / "ks" / "t")]).collect() if r["name"] != "" or r["ts"]), key=str)
    assert got == sorted(map(plain_row, rows), key=str)
    with pytest.raises(Exception, match="columns that the table lacks"):
        write_sstables(spark.createDataFrame([row([c[0], b""], "what", 5)], schema), str(tmp_path / "x"), "ks", "t", layout).collect()


def plain_row(r):
    _, _, at, static, kind, name, _, ts, deleted, ttl, expires, value = r
    return at and [bytes(x) for x in at], static, kind, name or "", ts, deleted, ttl, expires, bytes(value or b"")


def test_the_shared_folder(spark):
    assert shared.shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared.new_folder(spark, "x") != shared.new_folder(spark, "x")

import hashlib
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltbed.functions import scalars, tokens

#: key in hex: murmur token, random token
GOLDEN = {
    "": (0, "2be2732670ff4dfb167ff6671307bd82"),
    "61": (-8839064797231613815, "0cc175b9c0f1b6a831c399e269772661"),
    "616263": (-5434086359492102041, "6ffeaf67c32db04f2969c082d71e808e"),
    "31": (8213365047359667313, "3b35bdc75f46dc7df233af65908a7b65"),
    "68656c6c6f20776f726c64": (5998619086395760910, "5eb63bbbe01eeed093cb22bb8f5acdc3"),
    "30313233343536373839616263646566": (5467490433528156583, "4032af8d61035123906e58e067140cc5"),
    "3031323334353637383961626364656658595a": (-7362412312553418723, "392bc0e8be2d4a6c215a027faa509f8e"),
    "c3a9": (5461403030378599040, "66ddcd97cfdeabb2f6fb8a999b4bc76f"),
    "ffffffffffffffffff": (8434364767658694854, "552a34689d9440ccf12b45c68d4e6ec8"),
}


def one(spark, value, *columns):
    return spark.createDataFrame([(v,) for v in value], "v binary").select("v", *columns).collect()


def test_golden_tokens(spark):
    got = one(spark, [bytearray.fromhex(k) for k in GOLDEN] + [None], tokens.murmur_token("v").alias("m"), tokens.random_token("v").alias("r"))
    for r in got:
        assert (r["m"], r["r"]) == (GOLDEN[bytes(r["v"]).hex()] if r["v"] is not None else (None, None))


def test_random_tokens_of_many_keys(spark):
    keys = [os.urandom(i % 40) for i in range(500)]
    for r in one(spark, [bytearray(k) for k in keys], tokens.random_token("v").alias("r")):
        n = abs(int.from_bytes(hashlib.md5(bytes(r["v"])).digest(), "big", signed=True))
        assert r["r"] == f"{n:032x}"


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=20))
def test_tokens_don_t_depend_on_the_batch(keys):
    assert list(tokens.murmur_tokens(keys)) == [tokens.murmur_tokens([k])[0] for k in keys]


def plain_murmur(key):
    """The token by whole numbers, a byte at a time."""
    low, c1, c2 = (1 << 64) - 1, 0x87C37B91114253D5, 0x4CF5AD432745937F
    rotl = lambda x, n: (x << n | x >> 64 - n) & low
    signed = lambda b: b - 256 if b > 127 else b

    def fmix(x):
        for c in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = (x ^ x >> 33) * c & low
        return x ^ x >> 33

    h1 = h2 = 0
    whole = len(key) // 16 * 16
    for at in range(0, whole, 16):
        k1, k2 = (int.from_bytes(key[i : i + 8], "little") for i in (at, at + 8))
        h1 = ((rotl(h1 ^ rotl(k1 * c1 & low, 31) * c2 & low, 27) + h2) * 5 + 0x52DCE729) & low
        h2 = ((rotl(h2 ^ rotl(k2 * c2 & low, 33) * c1 & low, 31) + h1) * 5 + 0x38495AB5) & low
    k = [0, 0]
    for i, b in enumerate(key[whole:]):
        k[i // 8] ^= signed(b) << 8 * (i % 8) & low
    h2 ^= rotl(k[1] * c2 & low, 33) * c1 & low
    h1 ^= rotl(k[0] * c1 & low, 31) * c2 & low
    h1, h2 = h1 ^ len(key), h2 ^ len(key)
    h1 = (h1 + h2) & low
    h2 = (h2 + h1) & low
    h = (fmix(h1) + fmix(h2)) & low
    h = h - (1 << 64) if h >> 63 else h
    return (1 << 63) - 1 if h == -(1 << 63) else h


def test_tokens_of_keys_of_many_digits():
    assert all(plain_murmur(bytes.fromhex(k)) == token for k, (token, _) in GOLDEN.items())
    keys = [str(10**n + i * 7).encode() for n in range(40) for i in range(20)]
    assert list(tokens.murmur_tokens(keys)) == list(map(plain_murmur, keys))


def test_partitioners():
    assert tokens.partitioner("any.package.Murmur3Partitioner") is tokens.murmur_token
    assert tokens.partitioner(None) is tokens.random_token and tokens.partitioner("x.OrderPreservingPartitioner") is tokens.no_token
    with pytest.raises(ValueError):
        tokens.partitioner("x.OtherPartitioner")


def test_keys_sort_by_bytes_the_shorter_first(spark):
    keys = [b"\xff", b"a", b"ab", b"", b"\x80", b"a\0"]
    df = spark.createDataFrame([(bytearray(k),) for k in keys], "key binary").withColumn("token", tokens.no_token("key"))
    assert [bytes(r["key"]) for r in df.orderBy(*tokens.order()).collect()] == sorted(keys)


def test_bytes_as_text(spark):
    values = [b"plain ~", b"", b"tab\t", b"\xc3\xa9", b"line\n", b"\x1f", b"\x7f", None]
    for r in one(spark, [None if v is None else bytearray(v) for v in values], scalars.is_printable("v").alias("p"), scalars.display("v").alias("d"), scalars.to_hex("v").alias("h"), scalars.from_hex(scalars.to_hex("v")).alias("b")):
        v = r["v"]
        if v is None:
            assert r["h"] is None and r["d"] is None
            continue
        p = all(0x20 <= c <= 0x7E for c in bytes(v))
        assert r["p"] == p and r["d"] == (bytes(v).decode() if p else bytes(v).hex()) and r["h"] == bytes(v).hex() and r["b"] == v


def test_hex_that_is_none(spark):
    got = spark.createDataFrame([("0aFF",), ("0",), ("xx",), ("",)], "v string").select(scalars.from_hex("v").alias("b")).collect()
    assert [r["b"] for r in got] == [bytearray(b"\x0a\xff"), None, None, bytearray()]


def test_names(spark):
    want = {
        "/d/ks/tbl/ma-1-big-Data.db": (312, "ks", "tbl"),
        "/d/ks/tbl-0123/nb-3g_ab-big-Data.db": (339, "ks", "tbl-0123"),
        "/d/x/ks-tbl-jb-12-Data.db": (235, "ks", "tbl"),
        "/d/x/ks-tbl-d-12-Data.db": (78, "ks", "tbl"),
        "/d/x/zz-tbl-ka-1-Data.db": (260, "zz", "tbl"),
        "/d/x/ks-tbl-e-12-Data.db": (None, None, None),
        "/d/x/ma-1-big-Index.db": (None, None, None),
        "x": (None, None, None),
    }
    df = spark.createDataFrame([(k,) for k in want], "path string")
    name = F.element_at(F.split("path", "/"), -1)
    for r in df.select("path", scalars.file_version(name).alias("v"), scalars.file_keyspace("path").alias("k"), scalars.file_table("path").alias("t")).collect():
        assert (r["v"], r["k"], r["t"]) == want[r["path"]]


def test_hosts_and_ttls(spark):
    got = spark.createDataFrame([("a", 5), ("b:12", None)], "h string, e long").select(scalars.host_and_port("h").alias("h"), scalars.remaining_ttl("e", 2).alias("t"), scalars.remaining_ttl("e", 2, -1).alias("x"), scalars.crc32("h").alias("c")).collect()
    assert [(tuple(r["h"]), r["t"], r["x"]) for r in got] == [(("a", 3000), 3, 3), (("b", 12), None, -1)]

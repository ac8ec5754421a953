"""Partition tokens and the order that each partitioner sorts by."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T



def random_token(key: Column | str) -> Column:
    """abs() of md5 as a signed 128-bit number, as 32 hex digits.

    The negation works on four 32-bit parts, each of which fits a bigint, so nothing can overflow under ANSI rules.
    """
    key = (F.col(key) if isinstance(key, str) else key).cast("binary")
    m = F.md5(key)
    part = [F.conv(F.substring(m, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    out, carry = [], F.lit(1).cast("long")
    for p in reversed(part):
        flipped = F.lit(0xFFFFFFFF).cast("long") - p + carry
        carry = F.when(flipped > 0xFFFFFFFF, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
        out.append(F.lpad(F.lower(F.hex(F.pmod(flipped, F.lit(1 << 32)))), 8, "0"))
    return F.when(F.substring(m, 1, 1) < "8", m).otherwise(F.concat(*reversed(out)))


_C1, _C2 = np.uint64(0x87C37B91114253D5), np.uint64(0x4CF5AD432745937F)


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _fmix(k: np.ndarray) -> np.ndarray:
    k = (k ^ (k >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    k = (k ^ (k >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return k ^ (k >> np.uint64(33))


def murmur_tokens(keys: list[bytes]) -> np.ndarray:
    """First half of murmur3 x64-128 with seed 0, with the tail's bytes sign-extended; the least value becomes the greatest.

    Keys of one length are worked through together, a block of 16 bytes at a time.
    """
    out = np.zeros(len(keys), np.int64)
    sizes = np.fromiter((len(k) for k in keys), np.int64, len(keys))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        size = int(size)
        data = np.frombuffer(b"".join(keys[i] for i in at), np.uint8).reshape(len(at), size)
        h1, h2 = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
        whole = size // 16 * 16
        blocks = np.ascontiguousarray(data[:, :whole]).view("<u8").reshape(len(at), -1).astype(np.uint64)
        for i in range(0, whole // 8, 2):
            h1 ^= _rotl(blocks[:, i] * _C1, 31) * _C2
            h1 = (_rotl(h1, 27) + h2) * np.uint64(5) + np.uint64(0x52DCE729)
            h2 ^= _rotl(blocks[:, i + 1] * _C2, 33) * _C1
            h2 = (_rotl(h2, 31) + h1) * np.uint64(5) + np.uint64(0x38495AB5)
        tail = data[:, whole:].view(np.int8).astype(np.int64).view(np.uint64)
        k1, k2 = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
        for i in range(tail.shape[1]):
            if i < 8:
                k1 ^= tail[:, i] << np.uint64(8 * i)
            else:
                k2 ^= tail[:, i] << np.uint64(8 * (i - 8))
        h2 ^= _rotl(k2 * _C2, 33) * _C1
        h1 ^= _rotl(k1 * _C1, 31) * _C2
        h1, h2 = h1 ^ np.uint64(size), h2 ^ np.uint64(size)
        h1 = h1 + h2
        h2 = h2 + h1
        h1 = _fmix(h1) + _fmix(h2)
        got = h1.view(np.int64).copy()
        got[got == np.iinfo(np.int64).min] = np.iinfo(np.int64).max
        out[at] = got
    return out


@F.arrow_udf(T.LongType())
def _murmur(key: pa.Array) -> pa.Array:
    valid = key.is_valid().to_numpy(zero_copy_only=False)
    found = murmur_tokens([x or b"" for x in key.cast(pa.binary()).to_pylist()])
    return pa.array(found, pa.int64(), mask=~valid)


def murmur_token(key: Column | str) -> Column:
    """Token of the murmur partitioner, a signed bigint; in Arrow batches, as Spark has no such hash."""
    key = F.col(key) if isinstance(key, str) else key
    return _murmur(key.cast("binary"))


def no_token(key: Column | str) -> Column:
    """Byte-ordered partitioners sort by the key alone."""
    return F.lit(None).cast("binary")


#: Partitioners by the last part of their class name.
PARTITIONERS = {
    "RandomPartitioner": random_token,
    "Murmur3Partitioner": murmur_token,
    "ByteOrderedPartitioner": no_token,
    "OrderPreservingPartitioner": no_token,
}
#: What files have that are too old to name a partitioner.
DEFAULT_PARTITIONER = "RandomPartitioner"


def partitioner(name: str | None):
    """The token function of a partitioner's class; a ValueError for an unknown one."""
    short = (name or DEFAULT_PARTITIONER).rpartition(".")[2]
    if short not in PARTITIONERS:
        raise ValueError(f"unknown partitioner {name}")
    return PARTITIONERS[short]


def order(token: Column | str = "token", key: Column | str = "key") -> list[Column]:
    """Columns that sort as all partitioners do: by token, then by the key's bytes, the shorter first."""
    return [F.col(c) if isinstance(c, str) else c for c in (token, key)]

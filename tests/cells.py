"""Cells for tests, spelled short."""

from siltbed import schema


def cell(src, name, ts, value=None, deleted=False, key=b"k", expires_at=None, ttl=None, pos=0, kind="cell", end=None, clustering=None, static=False):
    return (src, None, key, clustering, 0, static, kind, name, end, ts, deleted, ttl, expires_at, value.encode() if isinstance(value, str) else value, pos)


def deletion(src, ts, key=b"k", clustering=None):
    return cell(src, None, ts, key=key, kind="row_deletion", clustering=clustering)


def rng(src, lo, hi, ts, key=b"k"):
    return cell(src, lo, ts, key=key, kind="range_tombstone", end=hi)


def frame(spark, rows):
    return spark.createDataFrame(rows, schema.cells())

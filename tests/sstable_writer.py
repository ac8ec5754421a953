"""Writes table files for tests, in the layouts that the reader knows. It shows that the reader agrees with the layouts as
described, not that real databases write them so."""

import struct
import zlib
from pathlib import Path

import pyarrow as pa

from siltbed.functions.tokens import murmur_tokens
from siltbed.sources.sstable import naming
from siltbed.sources.sstable.datasource import _place
from siltbed.sources.sstable.layouts import ACTIVE
from siltbed.sources.sstable.metadata import FIXED
from siltbed.sources.sstable.wire import put_vint

DB = "org.example.db."


def short(b):
    b = b.encode() if isinstance(b, str) else b
    return struct.pack(">H", len(b)) + b


def long_bytes(b):
    return struct.pack(">i", len(b)) + b


def vbytes(b):
    b = b.encode() if isinstance(b, str) else b
    return put_vint(len(b)) + b


def composite(*parts):
    return b"".join(short(p) + b"\0" for p in parts)


def compress(codec, data):
    if codec == "DeflateCompressor":
        return zlib.compress(data)
    if codec == "LZ4Compressor":
        return struct.pack("<I", len(data)) + pa.compress(data, codec="lz4_raw", asbytes=True)
    return pa.compress(data, codec="snappy", asbytes=True)


def statistics(version, partitioner, header=b""):
    name = short(f"org.example.dht.{partitioner}")
    if version >= naming.KA:
        parts = [(0, name + bytes(8)), (2, b"stats")] + ([(3, header)] if version >= naming.MA else [])
        at, toc, body = 4 + 8 * len(parts), b"", b""
        for kind, data in parts:
            toc += struct.pack(">ii", kind, at + len(body))
            body += data
        return struct.pack(">i", len(parts)) + toc + body
    histogram = struct.pack(">i", 2) + bytes(32)
    if version >= naming.JA:
        return 2 * histogram + bytes(48) + name
    if version >= naming.HC:
        return 2 * histogram + bytes(20 + 8 * (version >= naming.IB) + 8 * (version >= naming.HD)) + name
    return b""


def old_cell(name, ts, value=b"", deleted=False, ttl=None, expires=None, counter=False, end=None):
    if end is not None:
        return short(name) + b"\x10" + short(end) + struct.pack(">iq", 1, ts)
    flags = deleted | 2 * (ttl is not None) | 4 * counter
    more = struct.pack(">q", 7) if counter else struct.pack(">ii", ttl, expires) if ttl is not None else b""
    return short(name) + bytes([flags]) + more + struct.pack(">q", ts) + long_bytes(value)


def old_partition(version, key, cells, deletion=ACTIVE):
    size = b"" if version >= naming.JA else bytes(4 if version < naming.D else 8)
    head = short(key) + size + struct.pack(">iq", 1, deletion)
    if version < naming.JA:
        return head + struct.pack(">i", len(cells)) + b"".join(cells)
    return head + b"".join(cells) + short(b"")


class NewTable:
    """Rows of newer files."""

    def __init__(self, regular, static=(), clustering=(), min_ts=1000, min_ttl=10, min_deletion=500):
        self.regular, self.static, self.clustering = list(regular), list(static), list(clustering)
        self.min_ts, self.min_ttl, self.min_deletion = min_ts, min_ttl, min_deletion

    def header(self):
        kind = lambda k: vbytes(f"{DB}marshal.{k}")
        out = put_vint(self.min_ts) + put_vint(self.min_deletion) + put_vint(self.min_ttl) + kind("BytesType")
        out += put_vint(len(self.clustering)) + b"".join(map(kind, self.clustering))
        for columns in (self.static, self.regular):
            out += put_vint(len(columns)) + b"".join(vbytes(n) + kind(k) for n, k in columns)
        return out

    def value(self, kind, v):
        return v if kind in FIXED else vbytes(v)

    def row(self, cells, clustering=(), ts=None, ttl=None, expires=None, deletion=None, static=False):
        """cells: name -> (value, ts or None for the row's, options)."""
        columns = self.static if static else self.regular
        flags = 0x04 * (ts is not None) | 0x08 * (ttl is not None) | 0x10 * (deletion is not None) | 0x80 * static
        everything = len(cells) == len(columns)
        out = bytes([flags | 0x20 * everything]) + (b"\x01" if static else b"")
        if not static:
            for at in range(0, len(self.clustering), 32):
                part = list(zip(self.clustering[at : at + 32], clustering[at : at + 32], strict=True))
                out += put_vint(sum((2 if v is None else 1 if v == b"" else 0) << (2 * i) for i, (_, v) in enumerate(part)))
                out += b"".join(self.value(k, v) for k, v in part if v)
        out += put_vint(99) + put_vint(98)
        if ts is not None:
            out += put_vint(ts - self.min_ts)
            if ttl is not None:
                out += put_vint(ttl - self.min_ttl) + put_vint(expires - self.min_deletion)
        if deletion is not None:
            out += put_vint(deletion - self.min_ts) + put_vint(5)
        if not everything:
            n, there = len(columns), [i for i, (c, _) in enumerate(columns) if c in cells]
            missing = [i for i in range(n) if i not in there]
            if n < 64:
                out += put_vint(sum(1 << i for i in missing))
            else:
                out += put_vint(len(missing)) + b"".join(map(put_vint, there if len(there) < n // 2 else missing))
        for name, kind in columns:
            if name not in cells:
                continue
            v, cell_ts, o = cells[name]
            own_ttl = o.get("ttl")
            f = o.get("deleted", False) | 2 * (own_ttl is not None) | 4 * (v == b"") | 8 * (cell_ts is None) | 0x10 * o.get("row_ttl", False)
            out += bytes([f]) + (put_vint(cell_ts - self.min_ts) if cell_ts is not None else b"")
            if not f & 0x10:
                if f & 3:
                    out += put_vint(o.get("expires", 600) - self.min_deletion)
                if own_ttl is not None:
                    out += put_vint(own_ttl - self.min_ttl)
            out += self.value(kind, v) if v != b"" else b""
        return out

    def partition(self, key, rows, deletion=ACTIVE):
        return short(key) + struct.pack(">iq", 1, deletion) + b"".join(rows) + b"\x01"


def write(stem, partitions, partitioner="Murmur3Partitioner", codec="LZ4Compressor", chunk=64, header=b"", every=2, index=True, summary=True):
    """partitions: (key, bytes) in any order; written in the partitioner's order. codec None: not compressed."""
    stem = Path(stem)
    stem.parent.mkdir(parents=True, exist_ok=True)
    v = naming.parse(f"{stem.as_posix()}-Data.db").version
    partitions = sorted(partitions, key=lambda p: _place(partitioner, p[0]))
    data = b"".join(p for _, p in partitions)
    Path(f"{stem}-Statistics.db").write_bytes(statistics(v, partitioner, header))
    entries, at = [], 0
    for key, p in partitions:
        entries.append((key, at))
        at += len(p)
    places, body = [], b""
    for key, at in entries:
        places.append(len(body))
        body += short(key) + (put_vint(at) + put_vint(3) + b"abc" if v >= naming.MA else struct.pack(">qi", at, 3) + b"abc")
    if index:
        Path(f"{stem}-Index.db").write_bytes(body)
    if summary:
        sampled = list(range(0, len(entries), every))
        blob, offsets = b"", []
        for i in sampled:
            offsets.append(4 * len(sampled) + len(blob))
            blob += entries[i][0] + struct.pack("<q", places[i])
        toc = b"".join(struct.pack("<i", o) for o in offsets)
        Path(f"{stem}-Summary.db").write_bytes(struct.pack(">iiq", 128, len(sampled), len(toc) + len(blob)) + (bytes(8) if v >= naming.KA else b"") + toc + blob)
    if codec is None:
        Path(f"{stem}-Data.db").write_bytes(data)
        return
    check = zlib.adler32 if naming.JB <= v < naming.MA else zlib.crc32
    out, offsets = b"", []
    for i in range(0, len(data), chunk):
        part = data[i : i + chunk]
        packed = compress(codec, part)
        offsets.append(len(out))
        out += packed + struct.pack(">I", check(packed if v >= naming.JB else part))
    Path(f"{stem}-Data.db").write_bytes(out)
    info = short(codec) + struct.pack(">i", 1) + short("chunk_length_kb") + short("64") + struct.pack(">iqi", chunk, len(data), len(offsets)) + b"".join(struct.pack(">q", o) for o in offsets)
    Path(f"{stem}-CompressionInfo.db").write_bytes(info)


def in_token_order(keys):
    return [k for _, k in sorted((int(t), k) for t, k in zip(murmur_tokens(keys), keys, strict=True))]

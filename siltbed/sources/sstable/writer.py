"""Cells written as table files, by tasks: what the reader of this package reads. That a database reads it isn't claimed."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.functions import places, tokens
from siltbed.sources.sstable import naming
from siltbed.sources.sstable.layouts import ACTIVE, ALL_COLUMNS, BOUNDS, CELL_DELETED, CELL_EMPTY, CELL_EXPIRING, DELETION, END, EXTENSION, MARKER, OLD_DELETED, OLD_EXPIRING, OLD_RANGE, STATIC, TIMESTAMP
from siltbed.sources.sstable.metadata import FIXED, HEADER, VALIDATION
from siltbed.sources.sstable.storage import file_system
from siltbed.sources.sstable.wire import put_vint

#: Local deletion times, which no reader here needs.
_THEN = 1
_COLUMNS = ("kind", "name", "range_end", "ts", "deleted", "ttl", "expires_at", "value", "clustering", "is_static")


@dataclass(frozen=True)
class Layout:
    """How files are written. Clustering columns and columns (name -> type) count in versions from ma on only."""

    version: str = "ma"
    partitioner: str = "Murmur3Partitioner"
    codec: str | None = "LZ4Compressor"
    regular: tuple[tuple[str, str], ...] = ()
    static: tuple[tuple[str, str], ...] = ()
    clustering: tuple[str, ...] = ()
    #: Uncompressed bytes of a chunk, index entries for each of the summary.
    chunk: int = 1 << 16
    every: int = 128

    @property
    def order(self) -> places.Order:
        return tuple((kind, False) for kind in self.clustering)

    @property
    def number(self) -> int:
        return naming.version(self.version)

    def stem(self, folder: str, keyspace: str, table: str, file: int) -> str:
        if self.number >= naming.LA:
            return f"{folder}/{keyspace}/{table}/{self.version}-{file}-big"
        return f"{folder}/{keyspace}/{table}/{keyspace}-{table}-{self.version}-{file}"


def _short(b: bytes) -> bytes:
    return struct.pack(">H", len(b)) + b


def _sized(b: bytes) -> bytes:
    return put_vint(len(b)) + b


def old_partition(version: int, key: bytes, cells: list[dict]) -> bytes:
    """A partition of versions before ma; the newest of its deletions, columns in byte order of their names."""
    deletion = max((c["ts"] for c in cells if c["kind"] == "row_deletion"), default=ACTIVE)
    out = []
    for c in sorted((c for c in cells if c["kind"] != "row_deletion" and c["name"] != ""), key=lambda c: c["name"].encode()):
        if c["kind"] == "range_tombstone":
            out.append(_short(c["name"].encode()) + bytes([OLD_RANGE]) + _short(c["range_end"].encode()) + struct.pack(">iq", _THEN, c["ts"]))
            continue
        expiring = c["expires_at"] is not None and not c["deleted"]
        times = struct.pack(">II", c["ttl"] or 0, c["expires_at"]) if expiring else b""
        value = struct.pack(">i", _THEN) if c["deleted"] else bytes(c["value"])
        out.append(_short(c["name"].encode()) + bytes([OLD_DELETED * c["deleted"] | OLD_EXPIRING * expiring]) + times + struct.pack(">qi", c["ts"], len(value)) + value)
    size = b"" if version >= naming.JA else bytes(4 if version < naming.D else 8)
    head = _short(key) + size + struct.pack(">iq", _THEN, deletion)
    return head + (struct.pack(">i", len(out)) if version < naming.JA else b"") + b"".join(out) + (b"" if version < naming.JA else _short(b""))


def new_partition(layout: Layout, key: bytes, cells: list[dict]) -> bytes:
    """A partition of versions from ma on. Its rows come in the order of their clustering's bytes, the static row first; with ranges of
    deleted rows, which may not overlap, in the order of their places."""
    whole = [c for c in cells if c["kind"] == "row_deletion" and c["clustering"] is None and not c["is_static"]]
    spans = [c for c in cells if c["kind"] == "rows_deletion"]
    order = places.check_order(layout.order) if spans else ()
    at = lambda c: [bytes(x) for x in c["clustering"] or ()]
    # rows come after a range that begins at their place, and a range ends before the next begins
    spot = lambda c: (not c["is_static"], places.place_of(at(c), order), 2, at(c)) if spans else (not c["is_static"], at(c))
    out = []
    for where, group in groupby(sorted((c for c in cells if c not in whole and c not in spans), key=spot), key=spot):
        out.append((where, _row(layout, where[-1], not where[0], list(group))))
    for c in spans:
        out += [((True, c["name"], 1, []), _bound(layout, order, c, True)), ((True, c["range_end"], 0, []), _bound(layout, order, c, False))]
    out.sort(key=lambda x: x[0])
    kinds = [where[2] for where, _ in out if spans and where[2] != 2]
    if kinds != [1, 0] * len(spans):
        raise ValueError("ranges of deleted rows that overlap")
    return _short(key) + struct.pack(">iq", _THEN, max((c["ts"] for c in whole), default=ACTIVE)) + b"".join(x for _, x in out) + bytes([END])


def _prefix(layout: Layout, at: list[bytes | None]) -> bytes:
    """Values of clustering columns."""
    value = lambda kind, v: v if kind in FIXED else _sized(v)
    out = b""
    for i in range(0, len(at), 32):
        part = list(zip(layout.clustering[i : i + 32], at[i : i + 32], strict=False))
        out += put_vint(sum((2 if v is None else v == b"") << (2 * k) for k, (_, v) in enumerate(part))) + b"".join(value(k, v) for k, v in part if v)
    return out


def _bound(layout: Layout, order: places.Order, c: dict, first: bool) -> bytes:
    """Where a range of deleted rows begins or ends."""
    at, included = places.start_of(c["name"], order) if first else places.end_of(c["range_end"], order)
    kind = next(k for k, ends in BOUNDS.items() if ends == ((None, included) if first else (included, None)))
    body = put_vint(0) + put_vint(c["ts"]) + put_vint(_THEN)
    return bytes([MARKER, kind]) + struct.pack(">H", len(at)) + _prefix(layout, at) + put_vint(len(body)) + body


def _row(layout: Layout, at: list[bytes], static: bool, cells: list[dict]) -> bytes:
    kinds = dict(layout.static if static else layout.regular)
    held = {c["name"]: c for c in cells if c["kind"] == "cell" and c["name"] != ""}
    marks = [c["ts"] for c in cells if c["kind"] == "cell" and c["name"] == ""]
    deletions = [c["ts"] for c in cells if c["kind"] == "row_deletion"]
    if unknown := held.keys() - kinds.keys():
        raise ValueError(f"columns that the table lacks: {sorted(unknown)}")
    whole = len(held) == len(kinds)
    flags = ALL_COLUMNS * whole | TIMESTAMP * bool(marks) | DELETION * bool(deletions) | EXTENSION * static
    out = bytes([flags]) + (bytes([STATIC]) if static else b"")
    if not static:
        if len(at) != len(layout.clustering):
            raise ValueError(f"a row of {len(at)} clustering values")
        out += _prefix(layout, at)
    out += put_vint(0) + put_vint(0)  # sizes of this row and the one before, which no reader here needs
    out += b"".join(put_vint(max(x)) + (put_vint(_THEN) if x is deletions else b"") for x in (marks, deletions) if x)
    names = list(kinds)
    if not whole:
        missing = [i for i, n in enumerate(names) if n not in held]
        there = [i for i, n in enumerate(names) if n in held]
        if len(names) < 64:
            out += put_vint(sum(1 << i for i in missing))
        else:
            out += put_vint(len(missing)) + b"".join(map(put_vint, there if len(there) < len(names) // 2 else missing))
    for n in names:
        if n in held:
            c = held[n]
            expiring = c["expires_at"] is not None and not c["deleted"]
            v = b"" if c["deleted"] else bytes(c["value"])
            out += bytes([CELL_DELETED * c["deleted"] | CELL_EXPIRING * expiring | CELL_EMPTY * (v == b"")]) + put_vint(c["ts"])
            out += put_vint(_THEN) if c["deleted"] else put_vint(c["expires_at"]) + put_vint(c["ttl"] or 0) if expiring else b""
            out += b"" if v == b"" else v if kinds[n] in FIXED else _sized(v)
    return out


def statistics(layout: Layout) -> bytes:
    """The Statistics file; the bases of all times are 0."""
    name = _short(f"org.example.dht.{layout.partitioner}".encode())
    v = layout.number
    if v < naming.HC:
        return b""
    if v < naming.KA:
        histogram = struct.pack(">i", 0)
        return 2 * histogram + bytes(48 if v >= naming.JA else 20 + 8 * (v >= naming.IB) + 8 * (v >= naming.HD)) + name
    kind = lambda k: _sized(f"org.example.db.marshal.{k}".encode())
    header = 3 * put_vint(0) + kind("BytesType") + put_vint(len(layout.clustering)) + b"".join(map(kind, layout.clustering))
    header += b"".join(put_vint(len(cs)) + b"".join(_sized(n.encode()) + kind(k) for n, k in cs) for cs in (layout.static, layout.regular))
    parts, toc, body = [(VALIDATION, name), *([(HEADER, header)] if v >= naming.MA else [])], b"", b""
    for number, data in parts:
        toc += struct.pack(">ii", number, 4 + 8 * len(parts) + len(body))
        body += data
    return struct.pack(">i", len(parts)) + toc + body


class FileWriter:
    """The files of one data file. Data leave chunk by chunk; the index's sample and the chunks' places are held. Files have other names
    until they are whole, so a task that dies or runs twice leaves no half of one."""

    def __init__(self, stem: str, layout: Layout):
        self.layout, self.mark = layout, f".{uuid.uuid4().hex}"
        self.fs, self.stem = file_system(stem)
        self.fs.create_dir(self.stem.rpartition("/")[0], recursive=True)
        self.data, self.index = self._open("Data"), self._open("Index")
        self.held, self.length, self.stored, self.chunks = bytearray(), 0, 0, []
        self.entries, self.indexed, self.sampled = 0, 0, []

    def _open(self, part: str):
        return self.fs.open_output_stream(f"{self.stem}-{part}.db{self.mark}")

    def add(self, key: bytes, partition: bytes) -> None:
        """The next partition in the partitioner's order."""
        if self.entries % self.layout.every == 0:
            self.sampled.append((key, self.indexed))
        at = self.length
        entry = _short(key) + (put_vint(at) + put_vint(0) if self.layout.number >= naming.MA else struct.pack(">qi", at, 0))
        self.index.write(entry)
        self.entries, self.indexed, self.length = self.entries + 1, self.indexed + len(entry), at + len(partition)
        self.held += partition
        while len(self.held) >= self.layout.chunk:
            self._flush()

    def _flush(self) -> None:
        part, self.held = bytes(self.held[: self.layout.chunk]), self.held[self.layout.chunk :]
        codec, v = self.layout.codec, self.layout.number
        if codec is None:
            self.data.write(part)
            return
        if codec == "DeflateCompressor":
            packed = zlib.compress(part)
        else:
            lz4 = codec == "LZ4Compressor"
            packed = (struct.pack("<I", len(part)) if lz4 else b"") + pa.compress(part, codec="lz4_raw" if lz4 else "snappy", asbytes=True)
        check = zlib.adler32 if naming.JB <= v < naming.MA else zlib.crc32
        self.chunks.append(self.stored)
        self.data.write(packed + struct.pack(">I", check(packed if v >= naming.JB else part)))
        self.stored += len(packed) + 4

    def close(self) -> None:
        while self.held:
            self._flush()
        whole = {"Statistics": statistics(self.layout)}
        toc, blob = b"", b""
        for key, at in self.sampled:
            toc += struct.pack("<i", 4 * len(self.sampled) + len(blob))
            blob += key + struct.pack("<q", at)
        whole["Summary"] = struct.pack(">iiq", self.layout.every, len(self.sampled), len(toc) + len(blob)) + (bytes(8) if self.layout.number >= naming.KA else b"") + toc + blob
        if self.layout.codec is not None:
            whole["CompressionInfo"] = _short(self.layout.codec.encode()) + struct.pack(">iiqi", 0, self.layout.chunk, self.length, len(self.chunks)) + b"".join(struct.pack(">q", x) for x in self.chunks)
        for part, data in whole.items():
            with self._open(part) as f:
                f.write(data)
        self.index.close()
        self.data.close()
        for part in [*whole, "Index", "Data"]:  # the data last: without them there is no table file
            self.fs.move(f"{self.stem}-{part}.db{self.mark}", f"{self.stem}-{part}.db")


def write_sstables(cells: DataFrame, folder: str, keyspace: str, table: str, layout: Layout, file: str = "src") -> DataFrame:
    """Write cells (key binary, ``file`` int and the columns of siltbed.schema.cells that say what a cell is) as the files of a table, one
    for each value of ``file``, and give (file, path, partitions). Run by each action on the result, to the same files.

    A file holds one version of a cell, as a flushed table does; reduce versions by (file, row) before. Clustering and is_static may be
    missing. One partition is held at once.
    """
    places = {"clustering": F.lit(None).cast("array<binary>"), "is_static": F.lit(False)}
    rows = cells.select(F.col(file).cast("int").alias("file"), F.col("key").cast("binary").alias("key"), *[F.col(c) if c in cells.columns else places[c].alias(c) for c in _COLUMNS])
    token = tokens.partitioner(layout.partitioner)("key")
    rows = rows.withColumn("token", token)
    v = layout.number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (r for b in batches for r in pa.Table.from_batches([b]).to_pylist())
        for number, group in groupby(lines, key=lambda r: r["file"]):
            stem = layout.stem(folder, keyspace, table, number)
            out = FileWriter(stem, layout)
            for key, part in groupby(group, key=lambda r: bytes(r["key"])):
                out.add(key, new_partition(layout, key, list(part)) if v >= naming.MA else old_partition(v, key, list(part)))
            out.close()
            yield pa.record_batch([pa.array([number], pa.int32()), pa.array([stem + naming.DATA]), pa.array([out.entries], pa.int64())], names=["file", "path", "partitions"])

    dealt = rows.repartition("file").sortWithinPartitions("file", "token", "key")
    return dealt.mapInArrow(run, "file int, path string, partitions long")

"""The data source: files are found and described on the driver, once for a run; index and data are read in ranges by tasks."""

from __future__ import annotations

import base64
import bisect
import pickle
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siltbed import schema
from siltbed.functions.tokens import murmur_tokens
from siltbed.sources.sstable import layouts, metadata, naming
from siltbed.sources.sstable.storage import Chunks, DataFile, file_system, is_file, read_all, read_some
from siltbed.sources.sstable.wire import Wire

#: Stored bytes of a data file that one task reads, roughly; rows of an Arrow batch.
SPLIT, BATCH = 64 << 20, 8192


def token_of(partitioner: str, key: bytes):
    """A key's token as Python compares it (None for byte-ordered partitioners)."""
    if partitioner == "Murmur3Partitioner":
        return int(murmur_tokens([key])[0])
    if partitioner == "RandomPartitioner":
        import hashlib

        n = int.from_bytes(hashlib.md5(key).digest(), "big", signed=True)
        return abs(n).to_bytes(16, "big")
    return None


def _place(partitioner: str, key: bytes):
    token = token_of(partitioner, key)
    return (key,) if token is None else (token, key)


@dataclass
class File:
    """A table file with what tasks need to read it."""

    table: naming.Table
    meta: metadata.Metadata
    length: int
    first: bytes | None = None


def data_files(paths: list[str]) -> list[tuple[str, int]]:
    """Data files right in the given folders (or the files themselves), with their sizes."""
    out = []
    for p in paths:
        fs, where = file_system(p)
        scheme = p[: len(p) - len(where)] if p.endswith(where) else ""
        info = fs.get_file_info(where)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(where))
        out += [(scheme + i.path, i.size) for i in found if i.type == pafs.FileType.File and i.base_name.endswith(naming.DATA) and i.base_name != naming.DATA]
    return sorted(out)


def _chunks(stem: str) -> Chunks | None:
    info = read_all(f"{stem}-CompressionInfo.db")
    return Chunks.parse(info) if info is not None else None


def _open(table: naming.Table, start: int, checksum: bool) -> DataFile:
    v = table.version
    return DataFile(table.stem + naming.DATA, _chunks(table.stem), start, checksum, adler=naming.JB <= v < naming.MA, over_compressed=v >= naming.JB)


#: Files that the driver looks into at once.
THREADS = 32


def first_key(t: naming.Table) -> bytes | None:
    """The key of a file's first partition: of the index's first entry, or of the data where there is no index."""
    held = read_some(f"{t.stem}-Index.db", 0, ENTRY)
    if held:
        return Wire(held).short_bytes()
    w = _open(t, 0, True)
    try:
        return w.short_bytes() if w.more() else None
    finally:
        w.close()


def find_files(paths: list[str], keyspace: str | None = None, table: str | None = None, strip_id: bool = False, ts_epoch: int = 0) -> list[File]:
    """All files of one table, in the order of their first (token, key). Files of several tables or with different
    partitioners are an error, as are names and Statistics files that can't be read.

    Of each file the Statistics and the head of the index are read, of THREADS files at once.
    """
    named = [(naming.parse(path, strip_id), size) for path, size in data_files(paths)]
    named = [(t, size) for t, size in named if keyspace in (None, t.keyspace) and table in (None, t.table)]

    def look(at: tuple[naming.Table, int]) -> File:
        t, size = at
        stats = read_all(f"{t.stem}-Statistics.db")
        if stats is None and t.version >= naming.HC:
            raise FileNotFoundError(f"{t.stem}-Statistics.db")
        return File(t, metadata.parse(stats or b"", t.version).since(ts_epoch), size, first_key(t) if size else None)

    if not named:
        raise FileNotFoundError(f"no data files in {paths}")
    with ThreadPoolExecutor(THREADS) as pool:
        found = list(pool.map(look, named))
    for what, kinds in (("tables", {(f.table.keyspace, f.table.table) for f in found}), ("partitioners", {f.meta.partitioner for f in found})):
        if len(kinds) > 1:
            raise ValueError(f"files of several {what}: {sorted(kinds)}")
    return sorted(found, key=lambda f: (f.first is None, _place(f.meta.partitioner, f.first or b""), f.table.stem))


def index_entry(w: Wire, version: int) -> tuple[bytes, int]:
    """Key and data position of the entry at hand; the rest of the entry is skipped."""
    key = w.short_bytes()
    if version >= naming.MA:
        at = w.vint()
        w.skip(w.vint())
    else:
        at = w.i64()
        w.skip(w.i32())
    return key, at


def summary_entries(data: bytes, version: int) -> list[tuple[bytes, int]]:
    """(key, place in the index) of the sampled index entries; offsets are native, that is little-endian."""
    w = Wire(data)
    w.skip(4)
    n, size = w.i32(), w.i64()
    if version >= naming.KA:
        w.skip(8)
    body = w.take(size)
    at = [int.from_bytes(body[4 * i : 4 * i + 4], "little") for i in range(n)] + [size]
    return [(body[a : b - 8], int.from_bytes(body[b - 8 : b], "little")) for a, b in zip(at, at[1:], strict=False)]


#: Bytes that hold the beginning of any index entry: a key, its length and a position.
ENTRY = (1 << 16) + 16


def sample_points(f: File, start: bytes | None, split: int) -> list[int | None]:
    """Places in the index of the entries at which ranges of about ``split`` stored bytes begin; None for the file's start.

    The summary holds entries at even distances, so every so many of them begin a range; the index itself isn't read. With a
    start key the first place is of the last sampled entry at or before it, found by binary search. Without a summary or an index
    the file is one range.
    """
    summary = read_all(f"{f.table.stem}-Summary.db")
    if summary is None or not is_file(f"{f.table.stem}-Index.db"):
        return [None]
    sampled = summary_entries(summary, f.table.version)
    first = 0
    if start is not None:
        goal = _place(f.meta.partitioner, start)
        first = max(0, bisect.bisect_right(sampled, goal, key=lambda e: _place(f.meta.partitioner, e[0])) - 1)
    step = max(1, round(len(sampled) * split / max(1, f.length)))
    points: list[int | None] = [at for _, at in sampled[first::step]]
    if start is None or not points:
        points[:1] = [None]
    return points


def data_position(f: File, place: int | None) -> int:
    """Where the partition of the index entry at ``place`` begins in the data; reads that entry only."""
    if place is None:
        return 0
    w = Wire(read_some(f"{f.table.stem}-Index.db", place, ENTRY))
    w.short_bytes()
    return w.vint() if f.table.version >= naming.MA else w.i64()


def split_points(f: File, start: bytes | None, split: int) -> list[int]:
    """sample_points as positions in the data."""
    return [data_position(f, place) for place in sample_points(f, start, split)]


@dataclass
class Range(InputPartition):
    """A range of a file, from one place in the index to another (see sample_points); stop is "end" for the file's."""

    file: File
    src: int
    start: int | None
    stop: int | str

    def __init__(self, file, src, start, stop):
        super().__init__((file, src, start, stop))
        self.file, self.src, self.start, self.stop = file, src, start, stop


def pack_files(files: list[File]) -> str:
    """Files as an option's text, so that one listing serves a whole run."""
    return base64.b64encode(zlib.compress(pickle.dumps(files))).decode()


class SSTableReader(DataSourceReader):
    def __init__(self, options: dict, schema_: T.StructType):
        self.schema, self.options = schema_, options
        self.checksum = options.get("checksum", "true").lower() != "false"
        self.values = options.get("values", "true").lower() != "false"
        self.split = int(options.get("split_bytes", SPLIT))
        self.start = bytes.fromhex(options["start_key_hex"]) if "start_key_hex" in options else options["start_key"].encode() if "start_key" in options else None
        self.only = bytes.fromhex(options["key_hex"]) if "key_hex" in options else options["key"].encode() if "key" in options else None

    def partitions(self):
        out = []
        for src, f in enumerate(_files(self.options)):
            if f.first is None:
                continue
            if self.only is not None:
                out.append(Range(f, src, sample_points(f, self.only, self.split)[0], "end"))
                continue
            points = sample_points(f, self.start, self.split)
            out += [Range(f, src, a, b) for a, b in zip(points, [*points[1:], "end"], strict=True)]
        return out or [Range(None, 0, None, "end")]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition.file is None:
            return
        f, goal = partition.file, None
        if self.start is not None:
            goal = _place(f.meta.partitioner, self.start)
        last = _place(f.meta.partitioner, self.only) if self.only is not None else None
        stop = data_position(f, partition.stop) if partition.stop != "end" else None
        rows: list[tuple] = []
        # positions are places in the file, so they don't depend on how it was split
        w = _open(f.table, data_position(f, partition.start), self.checksum)
        try:
            while w.more() and (stop is None or w.at < stop):
                key, cells = layouts.new_partition(w, f.meta.header, self.values) if f.table.version >= naming.MA else layouts.old_partition(w, f.table.version, self.values)
                if last is not None and _place(f.meta.partitioner, key) > last:
                    break
                keep = (goal is None or _place(f.meta.partitioner, key) >= goal) and self.only in (None, key)
                for cell in cells:
                    if keep:
                        rows.append((key, w.at, *cell))
                        if len(rows) >= BATCH:
                            yield self._batch(partition, rows)
                            rows = []
        finally:
            w.close()
        if rows:
            yield self._batch(partition, rows)

    def _batch(self, partition: Range, rows: list[tuple]) -> pa.RecordBatch:
        key, pos, clustering, row_ord, static, kind, name, end, ts, deleted, ttl, expires, value = zip(*rows, strict=True)
        p = partition.file.meta.partitioner
        if p == "Murmur3Partitioner":
            token = pa.array(murmur_tokens(list(key)), pa.int64())
        else:
            token = pa.array([token_of(p, k) for k in key], pa.binary())
        columns = [
            pa.array([partition.src] * len(rows), pa.int32()), token, pa.array(key, pa.binary()), pa.array(clustering, pa.list_(pa.binary())),
            pa.array(row_ord, pa.int32()), pa.array(static, pa.bool_()), pa.array(kind, pa.string()), pa.array(name, pa.string()), pa.array(end, pa.string()),
            pa.array(ts, pa.int64()), pa.array(deleted, pa.bool_()), pa.array(ttl, pa.int64()), pa.array(expires, pa.int64()), pa.array(value, pa.binary()), pa.array(pos, pa.int64()),
        ]
        return pa.record_batch(columns, names=self.schema.fieldNames())


class PushingReader(SSTableReader):
    """The reader where spark.sql.python.filterPushdown.enabled is true; elsewhere Spark refuses readers that take filters."""

    def pushFilters(self, filters):
        """key = x becomes a lookup by index; Spark still tests it."""
        for f in filters:
            if type(f).__name__ == "EqualTo" and f.attribute == ("key",) and isinstance(f.value, bytes | bytearray) and self.only is None:
                self.only = bytes(f.value)
        return filters


def _files(options: dict) -> list[File]:
    if "files" in options:
        return pickle.loads(zlib.decompress(base64.b64decode(options["files"])))
    paths = [p for p in options.get("path", "").split(",") if p]
    return find_files(paths, options.get("keyspace"), options.get("table"), options.get("strip_id", "false").lower() == "true", int(options.get("ts_epoch", 0)))


def _schema(files: list[File]) -> T.StructType:
    return schema.cells(T.LongType() if files[0].meta.partitioner == "Murmur3Partitioner" else T.BinaryType())


class SSTableDataSource(DataSource):
    """``spark.read.format("sstable").load(folder)``: cells in long form (see siltbed.schema.cells).

    Options: path (folders parted by commas), keyspace and table (which files to take), checksum (true), start_key or
    start_key_hex (only partitions from that key on, in the partitioner's order), pushdown (true: filters on the key become lookups, which
    spark.sql.python.filterPushdown.enabled has to allow), key or key_hex (only that one), split_bytes (stored bytes for a
    task, about), strip_id (take the id off folder names), values (false: they are skipped and come as nulls), ts_epoch (seconds
    that the bases of times in newer files count from, 0 by default; some writers count from 1442880000), files (a listing
    made before, see pack_files). The token is a bigint for the murmur partitioner, binary otherwise.
    """

    @classmethod
    def name(cls) -> str:
        return "sstable"

    def schema(self) -> T.StructType:
        return _schema(_files(self.options))

    def reader(self, schema: T.StructType) -> SSTableReader:
        return (PushingReader if self.options.get("pushdown", "false").lower() == "true" else SSTableReader)(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SSTableDataSource)


def read_files(spark: SparkSession, files: list[File], **options) -> DataFrame:
    """Cells of files that were found before: no file is listed or opened again before the tasks run."""
    register(spark)
    r = spark.read.format("sstable").schema(_schema(files)).option("files", pack_files(files))
    r = r.option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    for k, v in options.items():
        if v is not None:
            r = r.option(k, str(v).lower() if isinstance(v, bool) else v)
    return r.load()


def read_sstables(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """Cells of the files of one table, with the options of SSTableDataSource."""
    given = {k: options.pop(k) for k in ("keyspace", "table", "strip_id", "ts_epoch") if options.get(k) is not None}
    return read_files(spark, find_files(paths, **given), **options)


def describe_files(spark: SparkSession, files: list[File]) -> DataFrame:
    """One row for each file: path, version, keyspace, table, partitioner, header and length."""
    rows = [
        (f.table.stem + naming.DATA, f.table.version, f.table.keyspace, f.table.table, f.meta.partitioner, f.meta.header.min_timestamp, f.meta.header.min_ttl, list(f.meta.header.clustering), list(f.meta.header.static), list(f.meta.header.regular), f.length)
        for f in files
    ]
    return spark.createDataFrame(rows, schema.FILES)


def describe(spark: SparkSession, paths: list[str]) -> DataFrame:
    return describe_files(spark, find_files(paths))

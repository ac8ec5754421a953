"""What the operators of this subpackage share: scratch tables, Arrow helpers, word hashing and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: space and \t \n \v \f \r. ``bytes.split()`` and ``bytes.strip()`` use exactly these.
SPACE = b" \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Where none is set, a local session takes a temporary folder of
    its own; a cluster's executors would each write to their own disk, so there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return found or "file://" + os.path.join(tempfile.gettempdir(), "checkpoints", "siltbed")


#: Rows that Spark hands to Python at once, at most. Its own default of 10,000 means tens of megabytes of text on both sides.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS rows; results don't depend on it, memory does. All operators call this,
    and it stays in force, as their results are computed later."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


class Scratch:
    """Tables written to the shared folder to cut lineage. They outlive lost executors and go when the driver's JVM ends."""

    def __init__(self, spark: SparkSession, name: str):
        bound_batches(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        path, fs = self._at(self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def _at(self, where: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def save(self, df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
        """Write df and give it back as it reads from disk."""
        where = f"{self.root}/{name}"
        out = df.write.mode("overwrite")
        (out.partitionBy(*by) if by else out).parquet(where)
        return self.read(name, df)

    def observed(self, df: DataFrame, name: str, by: list[str] | None = None, **sums) -> tuple[DataFrame, dict]:
        """Like save, with aggregates over the written rows, without another pass."""
        seen = Observation()
        out = self.save(df.observe(seen, *[expr.alias(key) for key, expr in sums.items()]), name, by)
        return out, seen.get

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        path, fs = self._at(f"{self.root}/{name}")
        fs.delete(path, True)


#: Rows of a small table, of a few numbers each, that are worth a task and a file of their own.
FILE_ROWS = 100_000


def in_few(df: DataFrame, rows: int) -> DataFrame:
    """df, of ``rows`` rows at most, in as many partitions as they need, and two for each core. Without Hadoop's native library the
    JVM starts three processes for each part file on a local disk, which takes longer than writing some hundred rows."""
    least = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(least, -(-rows // FILE_ROWS)))


def parts(spark: SparkSession, least: int = 1) -> int:
    """Partitions for a deal by key, as the cluster sets them."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def evened(df: DataFrame) -> DataFrame:
    """df, of any number of rows of a few numbers each, dealt out anew whatever its keys: partitions of the size that the session
    advises, but no more than two for each core or, if that is more, one for 16 that a shuffle has. Like in_few, but the tasks
    that make the rows stay as many as they are."""
    spark = df.sparkSession
    return df.hint("rebalance").coalesce(max(2 * spark.sparkContext.defaultParallelism, parts(spark) // 16))


def carried(docs: DataFrame, **columns) -> DataFrame:
    """docs as one struct column ``row`` beside columns of our own, so that no name of docs can clash with ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[x.alias(k) for k, x in columns.items()])


def unpacked(docs: DataFrame, but: tuple[str, ...] = (), **replaced) -> list:
    """The columns of docs out of ``row``, without those that are added anew, some replaced."""
    return [replaced[c].alias(c) if c in replaced else F.col("row").getField(c).alias(c) for c in docs.columns if c not in but]


def give_back() -> None:
    """Free memory that allocators keep. Spark's Python workers live on between tasks, more of them than run at once."""
    Words._pow = Words._inv = None
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries than glibc have no such function
        ctypes.CDLL(None).malloc_trim(0)


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text, or one row: what Python holds stays bounded."""
    try:
        yield from _cut(batches, text, most)
    finally:
        give_back()


def _cut(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col = batch.column(text)
        if not batch.num_rows:
            continue
        ends = np.frombuffer(col.buffers()[1], np.int32, count=len(col) + 1, offset=4 * col.offset) if not pa.types.is_large_binary(col.type) and not pa.types.is_large_string(col.type) else np.frombuffer(col.buffers()[1], np.int64, count=len(col) + 1, offset=8 * col.offset)
        at = 0
        while at < len(col):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def raw(col: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        take = min(done, n - done)
        out[done : done + take] = out[:take] * step
        done += take
    return out


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a run of texts, with 64-bit hashes, found with whole-array operations.

    Attributes: ``doc`` (index of the text of each word), ``start`` and ``end`` (bytes in ``data``), ``hash``,
    ``first`` (index of the first word of each text, and the number of words as the last entry).

    The hash is a polynomial modulo 2**64, for which different words with one hash can be written down. It serves as a feature or to
    send work somewhere, never as proof that words are equal: that is what SureWords is for.
    """

    _base, _inverse = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
    _table = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
    _is_space = np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(SPACE, np.uint8))
    _lower = np.arange(256, dtype=np.uint8)
    _lower[65:91] += 32
    _pow = _inv = None

    def __init__(self, texts: list[bytes | None], lower: bool = False):
        joined = b"\n".join([x or b"" for x in texts] + [b""])
        self.data = data = np.frombuffer(joined, np.uint8)
        if lower:
            self.data = data = self._lower[data]
        n = len(data)
        gap = self._is_space[data]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1 if n else np.zeros(0, np.int64)
        if n and not gap[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        sizes = np.fromiter((len(x or b"") + 1 for x in texts), np.int64, len(texts))
        self.first = np.searchsorted(self.start, np.concatenate([[0], np.cumsum(sizes)]))
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self._hash_words()

    def _hash_words(self) -> None:
        n = len(self.data)
        if Words._pow is None or len(Words._pow) < n + 1:
            Words._pow, Words._inv = _powers(n + 1, self._base), _powers(n + 1, self._inverse)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self._table[self.data] * Words._pow[:n], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * Words._inv[self.start] + (self.end - self.start).astype(np.uint64) * _ODD)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each position; positions whose k words leave their text have to be masked by the caller."""
        n = len(self.hash)
        out = np.zeros(n, np.uint64)
        if n >= k:
            part = np.zeros(n - k + 1, np.uint64)
            for j in range(k):
                part = part * np.uint64(self._base) + self.hash[j : n - k + 1 + j]
            out[: n - k + 1] = mix(part)
        return out


class SureWords(Words):
    """Words with 128-bit hashes (``hash`` and ``more``) of BLAKE2b over their bytes, which nobody can make collide.

    A worker remembers the hashes of words that it has seen, REMEMBERED of them at most.
    """

    REMEMBERED, LONGEST = 100_000, 64
    _seen: dict[bytes, int] = {}
    _known = np.zeros((0, 2), np.uint64)

    def _hash_words(self) -> None:
        words = self.data.tobytes().translate(self._gaps()).split()
        cls = SureWords
        if len(cls._seen) > self.REMEMBERED:
            cls.forget()
        seen = cls._seen
        new = list(set(words).difference(seen))
        if new:
            made = np.frombuffer(b"".join([hashlib.blake2b(w, digest_size=16).digest() for w in new]), "<u8").reshape(-1, 2)
            at = len(cls._known)
            cls._known = np.concatenate([cls._known, made.astype(np.uint64)])
            seen.update(zip(new, range(at, at + len(new)), strict=True))
        which = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
        self.hash, self.more = cls._known[which, 0], cls._known[which, 1]
        if any(len(w) > self.LONGEST for w in new):  # long words are rare and would fill the memory
            cls.forget()

    @classmethod
    def _gaps(cls) -> bytes:
        return bytes(32 if gap else b for b, gap in enumerate(cls._is_space.tolist()))

    @staticmethod
    def forget() -> None:
        SureWords._seen, SureWords._known = {}, np.zeros((0, 2), np.uint64)

    @staticmethod
    def _chain(hashes: np.ndarray, k: int, seed: int) -> np.ndarray:
        n = len(hashes)
        out = np.zeros(n, np.uint64)
        if n >= k:
            part = np.full(n - k + 1, np.uint64(seed))
            for j in range(k):
                part = mix(part * _ODD + hashes[j : n - k + 1 + j])
            out[: n - k + 1] = part
        return out

    def grams(self, k: int) -> np.ndarray:
        return self._chain(self.hash, k, 1)

    def more_of_grams(self, k: int) -> np.ndarray:
        """The other 64 bits of the hashes of grams."""
        return self._chain(self.more, k, 2)


#: Ids that a worker's union-find holds at once.
HELD_IDS = 1 << 19


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of a partition as stars around the smallest id of each of its components, by union-find.

    After HELD_IDS ids the stars so far are given out and a new union-find begins, so memory is bounded whatever the partition
    holds; ids that both know stay connected by their edges.
    """
    up: dict[int, int] = {}

    def root(x: int) -> int:
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def stars() -> Iterator[pa.RecordBatch]:
        ids = [x for x in up if root(x) != x]
        for at in range(0, len(ids), 1 << 16):
            part = ids[at : at + (1 << 16)]
            yield pa.record_batch([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                up[max(x, y)] = min(x, y)
        if len(up) > HELD_IDS:
            yield from stars()
            up.clear()
    yield from stars()


#: An id that more than one in HUB edges touch has its join broadcast: 2 * HUB ids at most are such.
HUB = 1000


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """(id, component): the smallest id that each id of ``edges`` (a, b) reaches. Ids without an edge are not in the result.

    Edges are contracted to stars where they lie, dealt by one end and contracted again. Then rounds of large-star and small-star steps
    (Kiveris et al., 2014) until all that is left is stars, which one aggregation shows: every round is a few shuffles whose groups are
    summed up before they move, no list of neighbours is built, and each round is written, so a lost executor costs one
    round. Its tables have as many files as their rows need, as the round before has counted them. Ends after a number of rounds that is logarithmic in practice. Edges at a hub, of which there are 2 * HUB at most, learn the hub's
    least neighbour by a broadcast and stay where they are.
    """
    def dealt(df: DataFrame) -> DataFrame:
        """Edges of one end meet in one partition, at most one from each piece of contracted input, so every end has one centre."""
        stars = df.mapInArrow(contracted, "a long, b long")
        return stars.repartition(parts(scratch.spark), "a").mapInArrow(contracted, "a long, b long")

    now, seen = scratch.observed(dealt(edges.select("a", "b").where("a <> b")), f"{name}-0", n=F.count(F.lit(1)))
    k = 0
    while True:
        ends = now.select(F.col("a").alias("u"), F.col("b").alias("v"), F.lit(1).alias("end"), F.lit(0).alias("centre"))
        both = ends.union(now.select("b", "a", F.lit(0), F.lit(1)))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"), F.sum("end").alias("end"), F.max("centre").alias("centre"))
        low = scratch.save(in_few(low, 2 * seen["n"]), f"{name}-low-{k}")
        # an id that is both an end and a centre, or the end of several edges, shows that more is to be joined
        if low.where("end + centre > 1 and end > 0").isEmpty():
            break
        hubs = low.where(F.col("n") > F.lit(seen["n"] / HUB)).select("u", F.col("m").alias("hub"))
        at = both.join(F.broadcast(hubs), "u", "left")
        far = at.where("hub is null").join(low.select("u", "m"), "u")
        columns = ["u", "v", "centre"]
        met = at.where("hub is not null").select(*columns, F.col("hub").alias("m")).union(far.select(*columns, "m"))
        # large star: every larger neighbour of u goes to the least of u and its neighbours
        large = met.where("centre = 1").select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
        # small star: u and its smaller neighbours go to the least of them
        small = met.where("centre = 0 and v <> m").select(F.greatest("v", "m").alias("a"), F.least("v", "m").alias("b"))
        own = low.where("m < u").select(F.col("u").alias("a"), F.col("m").alias("b"))
        k += 1
        now, seen = scratch.observed(in_few(dealt(large.union(own).union(small).where("a <> b")), 3 * seen["n"]), f"{name}-{k}", n=F.count(F.lit(1)))
        for old in (f"{name}-{k - 1}", f"{name}-low-{k - 1}"):
            scratch.drop(old)
    roots = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return in_few(now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots), 2 * seen["n"])

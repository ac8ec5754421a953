"""Line dedup: lines whose key occurs in many documents go, found with levelled sorted runs of line hashes."""

from __future__ import annotations

import contextlib
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import SPACE, Scratch, carried, parts, pieces, raw, unpacked

#: Keys in more than one of HOT lines are broadcast; a key is in a document once, so HOT bounds them.
HOT = 5000
_KEYS = "batch int, hi long, lo long, id long"


def line_key(line: bytes) -> bytes:
    """A line's key: outer white space stripped, A-Z lower-cased (bytes.lower() touches nothing else)."""
    return line.strip(SPACE).lower()


def _digest(key: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(key, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def line_hashes(docs: DataFrame, batches: int) -> DataFrame:
    """(batch, hi, lo, id): one row for each row of docs and distinct non-empty key of it; 128-bit hashes."""

    def run(it):
        for b in pieces(it):
            got = ([], [], [], [])
            for text, doc, batch in zip(raw(b.column("text")), b.column("id").to_pylist(), b.column("batch").to_pylist(), strict=True):
                keys = {line_key(x) for x in (text or b"").split(b"\n")}
                keys.discard(b"")
                for key in keys:
                    for out, v in zip(got, (batch, *_digest(key), doc), strict=True):
                        out.append(v)
            yield pa.record_batch([pa.array(got[0], pa.int32()), *(pa.array(x, pa.int64()) for x in got[1:])], names=["batch", "hi", "lo", "id"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"))
    return rows.mapInArrow(run, _KEYS)


class LineRuns:
    """Levelled sorted runs of (hi, lo, n): how many documents have each key, as batches come in.

    A run is a Parquet table bucketed and sorted by its key, one file a bucket, so runs meet in merge joins that neither move nor
    sort them. A batch is summed up, merge-anti-joined with all runs (keys that have reached the threshold in one need no
    more counting) and added to level 0 as a run of its own. When a level holds ``fanout`` runs they are merged into one of the
    next level, so each row is rewritten log_fanout(batches) times.

    Runs go with the scratch folder, unless ``store`` names a folder of their own: then they and a manifest stay there, and the
    next LineRuns at that folder, in this session or another, goes on from them. A manifest is written after its runs and before
    those that it replaces are deleted, so a run that dies leaves the last state behind. One writer at a time.
    """

    _MANIFEST = "buckets int, level int, run string, settled long"

    def __init__(self, scratch: Scratch, threshold: int, fanout: int = 2, store: str | None = None):
        self.scratch, self.spark, self.threshold, self.fanout = scratch, scratch.spark, threshold, fanout
        self.root, self.lasting = store or f"{scratch.root}/runs", store is not None
        self.buckets, self.made, self.commits = parts(self.spark), 0, 0
        self.levels: list[list[str]] = []
        #: rows of each run whose key has reached the threshold
        self.reached: dict[str, int] = {}
        self.tables: dict[str, str] = {}
        if self.lasting:
            self._open()

    @property
    def settled(self) -> list[str]:
        return [r for level in self.levels for r in level if self.reached[r]]

    def _open(self) -> None:
        path, fs = self.scratch._at(self.root)
        names = sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []
        done = [n for n in names if n.startswith("manifest-") and fs.exists(self.scratch._at(f"{self.root}/{n}/_SUCCESS")[0])]
        if not done:
            return
        self.commits = int(done[-1].rpartition("-")[2])
        for r in self.spark.read.schema(self._MANIFEST).parquet(f"{self.root}/{done[-1]}").orderBy("level", "run").collect():
            self.buckets = r["buckets"]
            while len(self.levels) <= r["level"]:
                self.levels.append([])
            self.levels[r["level"]].append(r["run"])
            self.reached[r["run"]] = r["settled"]
            self.spark.sql(f"CREATE TABLE {self._table(r['run'])} (hi BIGINT, lo BIGINT, n BIGINT) USING parquet CLUSTERED BY (hi, lo) SORTED BY (hi, lo) INTO {self.buckets} BUCKETS LOCATION '{self.root}/{r['run']}'")

    def _table(self, run: str) -> str:
        return self.tables.setdefault(run, f"line_runs_{uuid.uuid4().hex}")

    def read(self, run: str) -> DataFrame:
        return self.spark.table(self._table(run))

    def _write(self, df: DataFrame) -> str:
        """df (hi, lo, n) as a run, in which its key is unique."""
        run = f"run-{uuid.uuid4().hex[:12]}"
        seen = Observation()
        out = df.observe(seen, F.count_if(F.col("n") >= self.threshold).alias("reached"))
        with self._in_order():
            out.write.format("parquet").bucketBy(self.buckets, "hi", "lo").sortBy("hi", "lo").option("path", f"{self.root}/{run}").saveAsTable(self._table(run))
        self.reached[run] = seen.get["reached"]
        self.made += 1
        return run

    @contextlib.contextmanager
    def _in_order(self):
        """Plans made here rely on the order in which a run's files are sorted."""
        name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, "true")
        try:
            yield
        finally:
            self.spark.conf.set(name, before)

    def _drop(self, runs: list[str], data: bool = True) -> None:
        for r in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop(r)}")
            if data:
                path, fs = self.scratch._at(f"{self.root}/{r}")
                fs.delete(path, True)

    def fresh(self, lines: DataFrame) -> DataFrame:
        """(hi, lo, n) of a batch's lines, without keys that have reached the threshold in a run."""
        batch = lines.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"))
        if self.buckets != parts(self.spark):  # a store made with another number of partitions
            batch = batch.repartition(self.buckets, "hi", "lo")
        for r in [r for level in self.levels for r in level]:
            batch = batch.join(self.read(r).where(F.col("n") >= self.threshold).hint("merge"), ["hi", "lo"], "left_anti")
        return batch

    def merged(self, a: str, b: str) -> DataFrame:
        """Two runs in one, as a merge join of both."""
        x, y = self.read(a).withColumnRenamed("n", "x"), self.read(b).withColumnRenamed("n", "y")
        zero = F.lit(0).cast("long")
        return x.join(y.hint("merge"), ["hi", "lo"], "full_outer").select("hi", "lo", (F.coalesce("x", zero) + F.coalesce("y", zero)).alias("n"))

    def _fold(self, runs: list[str]) -> str:
        """One run of several; what is made on the way is dropped, the given ones stay."""
        made = runs[0]
        for r in runs[1:]:
            last, made = made, self._write(self.merged(made, r))
            if last != runs[0]:
                self._drop([last])
        return made

    def add(self, lines: DataFrame) -> None:
        """Count a batch of lines (hi, lo, ...), one row for each document and key."""
        run, level, gone = self._write(self.fresh(lines)), 0, []
        while True:
            if len(self.levels) <= level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                break
            full, self.levels[level] = self.levels[level], []
            run = self._fold(full)
            gone += full
            level += 1
        if self.lasting:
            rows = [(self.buckets, i, r, self.reached[r]) for i, level in enumerate(self.levels) for r in level]
            self.commits += 1
            self.spark.createDataFrame(rows, self._MANIFEST).coalesce(1).write.parquet(f"{self.root}/manifest-{self.commits:09d}")
            path, fs = self.scratch._at(f"{self.root}/manifest-{self.commits - 1:09d}")
            fs.delete(path, True)
        self._drop(gone)

    def frequent(self) -> DataFrame:
        """(hi, lo, n) of all keys in at least ``threshold`` documents so far; no key twice. n stops growing at the threshold."""
        left = [r for level in reversed(self.levels) for r in level]
        if not left:
            return self.spark.createDataFrame([], "hi long, lo long, n long")
        one = self._fold(left)
        found = self.scratch.save(self.read(one).where(F.col("n") >= self.threshold), f"frequent-{self.made}")
        if one not in left:
            self._drop([one])
        return found

    def close(self) -> None:
        """Forget the tables' names; lasting runs stay where they are."""
        self._drop(list(self.tables), data=False)


def dedup_lines(docs: DataFrame, min_docs: int = 10, batches: int = 4, fanout: int = 2, store: str | None = None) -> DataFrame:
    """All rows and columns of docs (doc_id, text, ...), text without the lines whose key is in ``min_docs`` documents or more.

    Adds n_lines (before) and n_dropped; columns of these names are replaced. Each row is a document. A null or empty
    text is one empty line and comes back as "". Empty keys are never dropped. Rows of one doc_id are told apart by
    their texts; a null doc_id is an id like any other. An empty table gives an empty table. Keys are told apart by 128 bits of BLAKE2b.

    With ``store``, a folder that the cluster shares, the runs stay there and the documents of earlier calls count as well: a
    line goes if it has been in ``min_docs`` documents of all calls so far. Documents that are given twice count twice.

    The keys of frequent lines travel to their documents by doc_id, one list a document. A key that a third of all documents hold is
    summed up before it moves, and its lines stay where they are: keys of more than one in HOT lines, of which there can't be
    more than that, are broadcast; the others are joined.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "line-dedup")
    lines, seen = scratch.observed(line_hashes(docs, batches), "lines", by=["batch"], n=F.count(F.lit(1)))
    runs = LineRuns(scratch, min_docs, fanout, store)
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b))
    found = runs.frequent()
    runs.close()
    # counts stop at the threshold, after one batch at the earliest
    often = F.col("n") > F.lit(seen["n"] / HOT)
    at = lines.join(F.broadcast(found.where(often).select("hi", "lo", F.lit(True).alias("often"))), ["hi", "lo"], "left")
    bad = at.where("often").select("hi", "lo", "id").union(at.where("often is null").join(found.where(~often), ["hi", "lo"]).select("hi", "lo", "id"))
    drop = bad.select(F.col("id").alias("of"), F.struct("hi", "lo").alias("k")).groupBy("of").agg(F.collect_set("k").alias("gone"))
    rows = carried(docs, id=F.col("doc_id").cast("long"))
    joined = rows.join(drop.hint("shuffle_hash"), rows["id"].eqNullSafe(drop["of"]), "left")

    @F.arrow_udf("struct<text string, n_lines long, n_dropped long>")
    def rewrite(text: pa.Array, keys: pa.Array) -> pa.Array:
        out, n, gone = [], [], []
        for t, ks in zip(raw(text), keys.to_pylist(), strict=True):
            of = (t or b"").split(b"\n")
            bad = {(k["hi"], k["lo"]) for k in ks or ()}
            kept = [x for x in of if not (key := line_key(x)) or _digest(key) not in bad] if bad else of
            out.append(b"\n".join(kept).decode("utf-8"))
            n.append(len(of))
            gone.append(len(of) - len(kept))
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=["text", "n_lines", "n_dropped"])

    made = joined.select("row", rewrite.asNondeterministic()(F.col("row.text"), F.col("gone")).alias("r"))
    return made.select(*unpacked(docs, ("n_lines", "n_dropped"), text=F.col("r.text")), "r.n_lines", "r.n_dropped")


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs, min_docs=10).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
k AS (SELECT doc_id, i, line,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE f.key IS NOT NULL) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id
"""

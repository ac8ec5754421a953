"""Substring dedup: suffix automata of reference shards give matching statistics; covered spans of words are removed."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, Words, mix, parts, pieces, raw
from .near_dup import _grouped

#: Words of the grams among which a window's anchor is chosen.
GRAM = 10
#: A row without doc_id comes after all others.
LAST = (1 << 63) - 1
#: One document in SAMPLE is looked at for hot anchors; one that more than HOT of them hold is dealt by its windows.
SAMPLE, HOT = 50, 200
#: Different runs with one anchor beyond which each of their windows is a run of its own.
WIDE = 64
#: Bytes of text whose runs are one shard.
SHARD = 8 << 20


class SuffixAutomaton:
    """A generalised suffix automaton over words (any hashable symbols). ``first`` is where each state's strings first end."""

    def __init__(self):
        self.next, self.link, self.size, self.first = [{}], [-1], [0], [-1]

    def _clone(self, p: int, q: int, w) -> int:
        c = len(self.next)
        self.next.append(self.next[q].copy())
        self.link.append(self.link[q])
        self.size.append(self.size[p] + 1)
        self.first.append(self.first[q])
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def add(self, words, at: int) -> None:
        """Add one text whose first word has position ``at``; texts have to come in ascending position."""
        nxt, link, size, first = self.next, self.link, self.size, self.first
        last = 0
        for i, w in enumerate(words, at):
            q = nxt[last].get(w)
            if q is not None:  # the text so far was seen before
                last = q if size[q] == size[last] + 1 else self._clone(last, q, w)
                continue
            new = len(nxt)
            nxt.append({})
            size.append(size[last] + 1)
            first.append(i)
            link.append(0)
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                link[new] = q if size[q] == size[p] + 1 else self._clone(p, q, w)
            last = new

    def ends(self, words, least: int):
        """For each word the position where the ``least`` words that end with it first ended in the texts added, or -1.

        This is the matching statistic cut at ``least``: of all matching suffixes the state of the shortest that is long
        enough is kept, so each word costs a constant number of steps on average.
        """
        nxt, link, size, first = self.next, self.link, self.size, self.first
        v = n = 0
        for w in words:
            while v and w not in nxt[v]:
                v = link[v]
                n = size[v]
            if w in nxt[v]:
                v = nxt[v][w]
                n += 1
            if n >= least:
                while size[link[v]] >= least:
                    v = link[v]
                    n = size[v]
                yield first[v]
            else:
                yield -1


def _runs(doc: np.ndarray, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals [s, s + n) by doc, those that touch or overlap joined."""
    if not len(doc):
        return doc, s, n
    o = np.lexsort((s, doc))
    doc, s, e = doc[o], s[o], s[o] + n[o]
    new = np.concatenate([[True], doc[1:] != doc[:-1]])
    # ends grow within a document: lift them over those of earlier documents before the running maximum
    rank = np.cumsum(new).astype(np.int64) << np.int64(40)
    top = np.maximum.accumulate(e + rank)
    new[1:] |= (s + rank)[1:] > top[:-1]
    at = np.flatnonzero(new)
    return doc[at], s[at], (np.concatenate([top[at[1:] - 1], top[-1:]]) - rank[at]) - s[at]


def anchors(texts: list[bytes | None], size: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchored runs of windows: (key, two halves of the digest of the words, index of the text, first window, number of windows).

    A window's anchor is the gram with the least hash in it, so equal windows have equal anchors at equal places; the
    consecutive windows of one anchor form a run. Windows of hot anchors are runs of one, keyed by the window itself.
    Hashes of grams only send runs somewhere; whether runs are equal is told by 128 bits of BLAKE2b over their bytes.
    """
    w = Words(texts)
    n = len(w.hash)
    if n < size:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    reach = size - GRAM + 1
    g = w.grams(GRAM)[: n - GRAM + 1]
    a = np.lib.stride_tricks.sliding_window_view(g, reach).argmin(axis=1) + np.arange(n - size + 1)
    p = np.arange(n - size + 1)
    inside = p + size <= w.first[w.doc[p] + 1]
    is_hot = np.isin(g[a], hot) if len(hot) else np.zeros(len(p), bool)
    p, a, is_hot = p[inside], a[inside], is_hot[inside]
    if not len(p):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (w.doc[p[1:]] != w.doc[p[:-1]])]) | is_hot
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate([at, [len(p)]]))
    start = p[at]
    # all words parted by one blank each, and where each begins there
    words = b" ".join(w.data.tobytes().split())
    begin = np.concatenate([[0], np.cumsum(w.end - w.start + 1)])
    told = [hashlib.blake2b(words[x : y - 1], digest_size=16).digest() for x, y in zip(begin[start].tolist(), begin[start + count + size - 1].tolist(), strict=True)]
    whole = np.frombuffer(b"".join(told), "<i8").astype(np.int64).reshape(-1, 2)
    key = np.where(is_hot[at], mix(whole[:, 0].view(np.uint64) + np.uint64(1)), g[a[at]])
    return key.view(np.int64), whole[:, 0], whole[:, 1], w.doc[start], start - w.first[w.doc[start]], count


def _pack(shards: np.ndarray, *cols: np.ndarray):
    """(shard, blob) rows of columns dealt by shard: 40 bytes an item instead of a Spark row."""
    o = np.argsort(shards, kind="stable")
    shards, cols = shards[o], [c[o].astype(t) for c, t in zip(cols, _TYPES, strict=True)]
    cut = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1], [True]])) if len(shards) else np.zeros(1, np.int64)
    return shards[cut[:-1]], [b"".join(c[a:b].tobytes() for c in cols) for a, b in zip(cut[:-1], cut[1:], strict=True)]


_TYPES = (np.int64, np.int64, np.int64, np.int64, np.int32, np.int32)
_ITEM = sum(np.dtype(t).itemsize for t in _TYPES)


def _unpack(blobs: list[bytes]) -> list[np.ndarray]:
    out = [[] for _ in _TYPES]
    for b in blobs:
        n, at = len(b) // _ITEM, 0
        for col, t in zip(out, _TYPES, strict=True):
            size = n * np.dtype(t).itemsize
            col.append(np.frombuffer(b, t, n, at))
            at += size
    return [np.concatenate(c) for c in out]


def one_text_each(docs: DataFrame) -> DataFrame:
    """(id, text), one row a document: rows of one doc_id are one document, its different texts in order, one a line."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), "text")
    if rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return rows
    return rows.groupBy("id").agg(F.array_join(F.sort_array(F.collect_set("text")), "\n").alias("text"))


def covered_spans(docs: DataFrame, size: int, scratch: Scratch) -> DataFrame:
    """(id, s, n): of each document (id, text; ids differ) the runs of n windows from word s that start earlier elsewhere too."""
    spark = docs.sparkSession
    n_parts = parts(spark)

    def sample(batches):
        none = np.zeros(0, np.uint64)
        for b in pieces(batches):
            key, _, _, doc, _, _ = anchors(raw(b.column("text")), size, none)
            yield pa.record_batch([pa.array(np.unique(np.stack([key, doc]), axis=1)[0], pa.int64())], names=["key"])

    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    tried = docs.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0)
    often = tried.mapInArrow(sample, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT)
    hot = np.sort(np.array([r["key"] for r in often.orderBy(F.col("n").desc(), "key").limit(10_000).collect()], np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(hot)
    # a shard is what a task sorts or indexes at once: so many that each stands for SHARD bytes of text
    shards = max(4 * n_parts, math.ceil(total / SHARD))

    def deal(batches):
        """The first run of each text in this piece goes to its key's shard; later ones are covered by it."""
        for b in pieces(batches, most=2 << 20):
            key, whole, rest, doc, s, n = anchors(raw(b.column("text")), size, shared.value)
            if not len(key):
                continue
            ids = b.column("id").to_numpy()[doc]
            o = np.lexsort((s, ids, rest, whole, key))
            key, whole, rest, ids, s, n = (x[o] for x in (key, whole, rest, ids, s, n))
            first = np.concatenate([[True], (key[1:] != key[:-1]) | (whole[1:] != whole[:-1]) | (rest[1:] != rest[:-1])])
            where, blobs = _pack((key[first].view(np.uint64) % np.uint64(shards)).astype(np.int64), *(x[first] for x in (key, whole, rest, ids, s, n)))
            yield pa.record_batch([pa.array(where, pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "blob"])
            d, s, n = _runs(ids[~first], s[~first], n[~first])
            if len(d):
                zero = np.zeros(len(d), np.int64)
                where, blobs = _pack(-1 - (d % shards), zero, zero, zero, d, s, n)
                yield pa.record_batch([pa.array(where, pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "blob"])

    def settle(batches):
        """Of equal runs all but the earliest are covered; the earliest of different runs with one key need the automaton."""
        for t, cut in _grouped(batches, ["shard"]):
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                part = t.slice(a, b - a)
                key, whole, rest, ids, s, n = _unpack(part.column("blob").to_pylist())
                if part.column("shard")[0].as_py() >= 0:
                    o = np.lexsort((s, ids, rest, whole, key))
                    key, whole, rest, ids, s, n = (x[o] for x in (key, whole, rest, ids, s, n))
                    new_key = np.concatenate([[True], key[1:] != key[:-1]])
                    first = new_key | np.concatenate([[True], (whole[1:] != whole[:-1]) | (rest[1:] != rest[:-1])])
                    kinds = np.add.reduceat(first, np.flatnonzero(new_key))[np.cumsum(new_key) - 1]
                    open_ = np.flatnonzero(first & (kinds > 1))
                    wide = kinds > WIDE
                    yield pa.record_batch([pa.array(x[open_], ty) for x, ty in ((ids, pa.int64()), (s, pa.int32()), (n, pa.int32()), (key, pa.int64()), (wide, pa.bool_()))], names=["id", "s", "n", "key", "wide"])
                    f = np.flatnonzero(first)[np.cumsum(first) - 1]
                    later = (ids != ids[f]) | (s != s[f])
                    ids, s, n = ids[later], s[later], n[later]
                d, s, n = _runs(ids, s.astype(np.int64), n.astype(np.int64))
                yield pa.record_batch([pa.array(d, pa.int64()), pa.array(s, pa.int32()), pa.array(n, pa.int32()), pa.nulls(len(d), pa.int64()), pa.nulls(len(d), pa.bool_())], names=["id", "s", "n", "key", "wide"])

    dealt = docs.mapInArrow(deal, "shard int, blob binary").repartition(n_parts, "shard").sortWithinPartitions("shard")
    settled = scratch.save(dealt.mapInArrow(settle, "id long, s int, n int, key long, wide boolean"), "settled")

    def cut_out(batches):
        """The words of each open run; of a wide one each window, keyed by itself."""
        for b in pieces(batches):
            w = Words(raw(b.column("text")))
            out = ([], [], [], [])
            for d, (i, spans) in enumerate(zip(b.column("id").to_pylist(), b.column("spans").to_pylist(), strict=True)):
                for x in spans:
                    at = w.first[d] + x["s"]
                    words = [w.text(j) for j in range(at, at + x["n"] + size - 1)]
                    if x["wide"]:
                        cut = [(b" ".join(words[j : j + size]), x["s"] + j) for j in range(x["n"])]
                        runs = [(int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True), i, j, t) for t, j in cut]
                    else:
                        runs = [(x["key"], i, x["s"], b" ".join(words))]
                    for run in runs:
                        for col, v in zip(out, run, strict=True):
                            col.append(v)
            yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())], names=["key", "id", "s", "words"])

    def match(batches):
        """A shard's automaton over its runs in order of (id, start), then the shard's runs streamed against it."""
        for t, cut in _grouped(batches, ["shard"]):
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                part = t.slice(a, b - a)
                ids, s = part.column("id").to_numpy(), part.column("s").to_numpy()
                order = np.lexsort((s, ids))
                words = part.column("words").to_pylist()
                texts = [words[x].split() for x in order]
                ids, s = ids[order], s[order].astype(np.int64)
                begin = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
                auto = SuffixAutomaton()
                for text, at in zip(texts, begin, strict=False):
                    auto.add(text, int(at))
                end = np.fromiter((e for text in texts for e in auto.ends(text, size)), np.int64, begin[-1])
                own = np.repeat(np.arange(len(texts)), np.diff(begin))
                hit = np.flatnonzero(end >= 0)
                src = np.searchsorted(begin, end[hit], side="right") - 1
                # where the window starts there and here
                there, here = s[src] + end[hit] - begin[src] - size + 1, s[own[hit]] + hit - begin[own[hit]] - size + 1
                mine, theirs = ids[own[hit]], ids[src]
                later = (theirs < mine) | ((theirs == mine) & (there < here))
                d, x, n = _runs(mine[later], here[later], np.ones(int(later.sum()), np.int64))
                yield pa.record_batch([pa.array(d, pa.int64()), pa.array(x, pa.int32()), pa.array(n, pa.int32())], names=["id", "s", "n"])

    open_runs = settled.where("key is not null").groupBy("id").agg(F.collect_list(F.struct("s", "n", "key", "wide")).alias("spans"))
    spans = docs.join(open_runs.hint("shuffle_hash"), "id").select("id", "text", "spans").mapInArrow(cut_out, "key long, id long, s int, words binary")
    routed = spans.withColumn("shard", F.pmod(F.col("key"), F.lit(shards)).cast("int")).select("shard", "id", "s", "words").repartition(n_parts, "shard").sortWithinPartitions("shard")
    return settled.where("key is null").select("id", "s", "n").union(routed.mapInArrow(match, "id long, s int, n int"))


def _without(text: bytes | None, spans, size: int) -> tuple[bytes, int, int]:
    words = (text or b"").split()
    if not spans:
        return b" ".join(words), len(words), 0
    gone = np.zeros(len(words) + 1, np.int64)
    for x in spans:
        gone[x["s"]] += 1
        gone[min(len(words), x["s"] + x["n"] + size - 1)] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]), len(words), int(gone.sum())


def _removed(docs: DataFrame, spans: DataFrame, size: int) -> DataFrame:
    @F.arrow_udf("struct<text string, n_words long, n_removed long>")
    def run(text: pa.Array, spans: pa.Array) -> pa.Array:
        got = [_without(t, x, size) for t, x in zip(raw(text), spans.to_pylist(), strict=True)]
        return pa.StructArray.from_arrays([pa.array([g[0].decode("utf-8") for g in got], pa.string()), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64())], names=["text", "n_words", "n_removed"])

    by_doc = spans.groupBy("id").agg(F.collect_list(F.struct("s", "n")).alias("spans"))
    out = docs.join(by_doc.hint("shuffle_hash"), "id", "left").withColumn("r", run.asNondeterministic()("text", "spans"))
    doc_id = F.when(F.col("id") != LAST, F.col("id")).alias("doc_id")
    return out.select(doc_id, "r.text", "r.n_words", "r.n_removed")


def dedup_substrings(docs: DataFrame, size: int = 20) -> DataFrame:
    """(doc_id, text, n_words, n_removed) of docs (doc_id, text, ...): words in windows that start earlier too are removed.

    A window is ``size`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of one document. It goes if its words also start earlier: in
    a document with a smaller doc_id, or earlier in the same one, judged on the input. Kept words are joined by one space.

    Here the reference is the corpus itself, which has no size bound, so its shards' automata aren't broadcast; the runs
    that may match are sent to the shard of their anchor instead. Equal runs of windows are settled by their first
    occurrence before they move (a passage in a third of all documents is one run from each piece of input; equal is what has
    the same 128 bits of BLAKE2b over its bytes), and only different runs with one anchor, which are the edges of passages, pass through an automaton. Where an anchor has very many
    different runs, each window is a run keyed by itself (equal windows then meet in one automaton), as it is from the start
    for anchors that a sample finds in very many documents; this changes the dealing, not the result.

    Rows of one doc_id are one document: a repeated text counts once, different texts follow each other. A null doc_id
    comes last, null and empty texts have no words, an empty table gives an empty table.
    """
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    rows = one_text_each(docs)
    return _removed(rows, covered_spans(rows, size, scratch), size)


def remove_reference(docs: DataFrame, reference: list[str], size: int = 20, most_words: int = 200_000) -> DataFrame:
    """Like dedup_substrings, but against a reference of its own: maximal spans of ``size`` words or more that are in it go.

    The reference is cut in shards of about ``most_words`` words; the automaton of each is broadcast in turn and all documents are streamed
    against it, so what is broadcast at once is bounded. The texts are a list on the driver and thereby bounded themselves.
    """
    rows = one_text_each(docs)
    shards, held = [], 0
    for text in reference:
        words = text.encode().split()
        if not shards or held + len(words) > most_words:
            shards.append([])
            held = 0
        shards[-1].append(words)
        held += len(words)
    found = None
    for shard in shards:
        auto, at = SuffixAutomaton(), 0
        for words in shard:
            auto.add(words, at)
            at += len(words)
        shared = docs.sparkSession.sparkContext.broadcast(auto)

        def run(batches, shared=shared):
            for b in pieces(batches):
                out = []
                for i, t in zip(b.column("id").to_pylist(), raw(b.column("text")), strict=True):
                    e = np.fromiter(shared.value.ends((t or b"").split(), size), np.int64)
                    hit = np.flatnonzero(e >= 0) - size + 1
                    out.append(_runs(np.full(len(hit), i, np.int64), hit, np.ones(len(hit), np.int64)))
                d, s, n = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.record_batch([pa.array(d, pa.int64()), pa.array(s, pa.int32()), pa.array(n, pa.int32())], names=["id", "s", "n"])

        part = rows.mapInArrow(run, "id long, s int, n int")
        found = part if found is None else found.union(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "id long, s int, n int")
    return _removed(rows, found, size)


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs, size=20).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, ws FROM w),
x AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS h FROM g),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS rn FROM x),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM f WHERE rn > 1),
p AS (SELECT doc_id, list(p) AS ps FROM c GROUP BY doc_id),
k AS (SELECT w.doc_id, ws, p.ps, unnest(range(1, len(ws) + 1)) AS j FROM w LEFT JOIN p ON w.doc_id = p.doc_id),
t AS (SELECT k.doc_id, j, ws[j] AS word FROM k LEFT JOIN c ON c.doc_id = k.doc_id AND c.p = k.j WHERE c.p IS NULL),
o AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept FROM t GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN o ON w.doc_id = o.doc_id
"""

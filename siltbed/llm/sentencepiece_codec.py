"""SentencePiece encoding and decoding: a suffix array of the batch finds every piece, edges by position are then relaxed."""

from __future__ import annotations

import hashlib
import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, pieces, raw

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_MARK = "▁".encode()
#: A segment is a run of blanks and what follows up to the next blank; no piece reaches over the start of one.
_SEGMENT = re.compile(rb" *[^ ]+| +")
#: Widest piece in bytes that an edge key can hold, and bytes of new segments that are indexed at once.
WIDEST, INDEXED = 64, 1 << 17
#: Segments longer than this are relaxed with a heap instead of in rounds.
LONG = 64
#: Bytes of segments that a worker remembers.
REMEMBERED = 48 << 20


def _fields(data: bytes):
    """(number, value) of a protocol buffer message: integers, or bytes of what has a length."""
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return n

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}[tag & 7] if tag & 7 != 2 else varint()
            yield tag >> 3, data[at : at + size]
            at += size


def check_model(model: bytes) -> None:
    """Raise ValueError for models that need what this codec lacks: other kinds than byte-pair ones, text that is changed before
    it is cut (normalisers, blanks that are joined or dropped), no blank in front, or blanks at the end of words."""
    # fixed numbers of the public model format: trainer and normaliser are fields 2 and 3 of the model
    parts = dict(_fields(model))
    trainer, rules = dict(_fields(parts.get(2, b""))), dict(_fields(parts.get(3, b"")))
    wrong = []
    if trainer.get(3, 1) != 2:
        wrong.append("the model isn't a byte-pair one")
    if trainer.get(24, 0):
        wrong.append("blanks stand at the end of words")
    if rules.get(2, b"") or rules.get(1, b"identity") not in (b"identity", b""):
        wrong.append(f"it normalises text by {rules.get(1, b'rules').decode(errors='replace')}")
    for field, wanted, what in ((3, 1, "it puts no blank in front"), (4, 0, "it drops repeated blanks"), (5, 1, "it leaves blanks as they are")):
        if rules.get(field, 1) != wanted:
            wrong.append(what)
    if wrong:
        raise ValueError("this model isn't supported: " + "; ".join(wrong))


class Pieces:
    """What a model file says: pieces with scores, byte pieces and the unknown id. A blank stands for the mark in pieces.

    Models that this codec would encode in another way than the library are refused (check_model)."""

    def __init__(self, model: bytes):
        import sentencepiece

        check_model(model)
        m = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = m.get_piece_size()
        self.text: list[bytes] = []
        self.bytes = [-1] * 256
        ids, scores = [], []
        for i in range(n):
            p = m.id_to_piece(i).encode()
            if m.is_byte(i):
                self.bytes[int(p[3:5], 16)] = i
                self.text.append(bytes([int(p[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i):
                self.text.append(" ⁇ ".encode() if m.is_unknown(i) else b"")
            else:
                p = p.replace(_MARK, b" ")
                self.text.append(p)
                if not m.is_unused(i):
                    ids.append(i)
                    scores.append(m.get_score(i))
        if any(b" " in self.text[i].lstrip(b" ") or len(self.text[i]) >= WIDEST for i in ids):
            raise ValueError("a piece holds a blank after another character, or is too wide")
        self.unknown = m.unk_id()
        order = sorted(range(len(ids)), key=lambda x: self.text[ids[x]])
        self.ids = np.array([ids[x] for x in order], np.int64)
        #: merges happen in this order; equal scores share a rank
        self.rank = np.unique(-np.array([scores[x] for x in order]), return_inverse=True)[1]
        self.width = np.array([len(self.text[i]) for i in self.ids])
        words = -(-int(self.width.max()) // 8)
        low = np.frombuffer(b"".join(self.text[i].ljust(8 * words, b"\0") for i in self.ids), ">u8").reshape(-1, words)
        high = np.frombuffer(b"".join(self.text[i].ljust(8 * words, b"\xff") for i in self.ids), ">u8").reshape(-1, words)
        self.low, self.high = low.astype(np.uint64), high.astype(np.uint64)


def suffix_array(data: np.ndarray, words: np.ndarray, width: int) -> np.ndarray:
    """Suffixes of data by their first ``width`` bytes at least: prefix doubling, beginning with eight bytes (words)."""
    done, n = 8, len(data)
    order, rank, tied = _ranked(words)
    while done < width and tied:
        after = np.zeros(n, np.int64)
        after[: max(0, n - done)] = rank[done:] + 1
        order, rank, tied = _ranked(rank * np.int64(n + 2) + after)
        done *= 2
    return order


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Order of keys, the rank of each, and whether some are equal."""
    order = np.argsort(keys)
    in_order = keys[order]
    step = np.concatenate([[False], in_order[1:] != in_order[:-1]])
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(step)
    return order, rank, len(keys) > 0 and int(step.sum()) + 1 < len(keys)


def piece_edges(segments: list[bytes], p: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All occurrences of all pieces in the segments: (data, first byte of each segment, edge keys by position, piece index).

    An edge key is position * WIDEST + bytes. 0xFF, which no UTF-8 text has, parts the segments.
    """
    joined = b"\xff".join(segments) + b"\xff"
    data = np.frombuffer(joined, np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(s) + 1 for s in segments])])[:-1]
    padded = np.frombuffer(joined + b"\0" * (8 * (p.low.shape[1] + 1)), np.uint8)
    words = np.zeros(len(padded) - 7, np.uint64)
    for j in range(8):
        words = (words << np.uint64(8)) | padded[j : len(padded) - 7 + j]
    sa = suffix_array(data, words[: len(data)], 8 * p.low.shape[1])

    def below(at: np.ndarray, keys: np.ndarray, or_equal: bool) -> np.ndarray:
        """Which suffixes lie below their key (or at it), a word of eight bytes at a time."""
        less, tied = np.zeros(len(at), bool), np.arange(len(at))
        for w in range(keys.shape[1]):
            s, k = words[at[tied] + 8 * w], keys[tied, w]
            less[tied[s < k]] = True
            tied = tied[s == k]
            if not tied.size:
                break
        if or_equal:
            less[tied] = True
        return less

    def bound(keys: np.ndarray, lo: np.ndarray, or_equal: bool) -> np.ndarray:
        """For each key the number of suffixes below it (or at it), at least lo; one binary search for all keys at once."""
        lo, hi = lo.copy(), np.full(len(keys), len(sa), np.int64)
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            less = below(sa[mid], keys[open_], or_equal)
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        return lo

    lo = bound(p.low, np.zeros(len(p.low), np.int64), False)
    hi = lo.copy()
    there = np.flatnonzero(lo < len(sa))
    there = there[below(sa[lo[there]], p.high[there], True)]  # the others don't occur
    hi[there] = bound(p.high[there], lo[there], True)
    count = hi - lo
    which = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    key = sa[place] * WIDEST + p.width[which]
    order = np.argsort(key)
    return data, begin, key[order], which[order]


def _relax_long(a: int, b: int, starts: list[int], edge: dict[int, int], rank: np.ndarray) -> list[tuple[int, int]]:
    """Spans of one long segment: the best edge over two neighbours first, the leftmost of equals."""
    end = dict(zip(starts, [*starts[1:], b], strict=True))
    before = dict(zip(starts[1:], starts, strict=False))
    heap = []

    def offer(x):
        y = end[x]
        if y < b and end[y] - x < WIDEST and (e := edge.get(x * WIDEST + end[y] - x)) is not None:
            heapq.heappush(heap, (int(rank[e]), x, y, end[y]))

    for x in starts:
        offer(x)
    while heap:
        _, x, y, z = heapq.heappop(heap)
        if end.get(x) != y or end.get(y) != z:
            continue
        end[x] = z
        del end[y]
        if z < b:
            before[z] = x
            offer(x)
        if x in before:
            offer(before[x])
    return sorted(end.items())


def encode_segments(segments: list[bytes], p: Pieces) -> list[bytes]:
    """Ids of each segment as little-endian int32 bytes.

    The model is a byte-pair one, so relaxing means merging: of all edges that span two neighbouring symbols the one with
    the best score is taken, the leftmost of equals, until none is left. All segments take a step in each round.
    """
    data, begin, key, which = piece_edges(segments, p)
    never = np.int64(1 << 60)

    def lookup(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Piece index of [start, end), or -1."""
        k = start * WIDEST + (end - start)
        at = np.minimum(np.searchsorted(key, k), max(0, len(key) - 1))
        ok = (end - start < WIDEST) & (key[at] == k) if len(key) else np.zeros(len(k), bool)
        return np.where(ok, which[at] if len(key) else -1, -1)

    def priority(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        e = lookup(start, end)
        return np.where(e >= 0, p.rank[e], never)

    sizes = np.array([len(s) for s in segments])
    head = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters, and separators
    head = head[data[head] != 0xFF]
    seg = np.searchsorted(begin, head, side="right") - 1
    start = head
    stop = begin[seg] + sizes[seg]
    end = np.where(np.concatenate([seg[1:] == seg[:-1], [False]]), np.concatenate([head[1:], [0]]), stop) if len(head) else head
    chars = np.bincount(seg, minlength=len(segments))
    long = chars[seg] > LONG
    done = [(start[long][:0], end[long][:0], seg[long][:0])]
    if long.any():
        edge = None
        for g in np.unique(seg[long]):
            a, b = int(begin[g]), int(begin[g] + sizes[g])
            x, y = np.searchsorted(key, [a * WIDEST, b * WIDEST])
            edge = dict(zip(key[x:y].tolist(), which[x:y].tolist(), strict=True))
            spans = np.array(_relax_long(a, b, start[seg == g].tolist(), edge, p.rank), np.int64)
            done.append((spans[:, 0], spans[:, 1], np.full(len(spans), g)))
    start, end, seg = start[~long], end[~long], seg[~long]
    prio = np.full(len(start), never)
    inner = np.flatnonzero(seg[1:] == seg[:-1]) if len(seg) else np.zeros(0, np.int64)
    prio[inner] = priority(start[inner], end[inner + 1])
    while len(start):
        first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        best = np.minimum.reduceat(prio, first)
        over = np.repeat(best == never, np.diff(np.concatenate([first, [len(seg)]])))
        if over.any():
            done.append((start[over], end[over], seg[over]))
            start, end, seg, prio, best = start[~over], end[~over], seg[~over], prio[~over], best[best != never]
            if not len(start):
                break
            first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        at = np.flatnonzero(prio == np.repeat(best, np.diff(np.concatenate([first, [len(seg)]]))))
        at = at[np.concatenate([[True], seg[at[1:]] != seg[at[:-1]]])]
        end[at] = end[at + 1]
        keep = np.ones(len(start), bool)
        keep[at + 1] = False
        at = at - np.arange(len(at))  # one symbol goes for each earlier merge
        start, end, seg, prio = start[keep], end[keep], seg[keep], prio[keep]
        near = np.zeros(len(start) + 1, bool)
        near[at] = near[at - 1] = True  # the last place stands for the one before the first
        again = np.flatnonzero(near[:-1])
        prio[again] = never
        again = again[again + 1 < len(seg)]
        again = again[seg[again] == seg[again + 1]]
        prio[again] = priority(start[again], end[again + 1])
    start, end, seg = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(start)
    start, end, seg = start[order], end[order], seg[order]
    found = lookup(start, end)
    ids, size = p.ids[found], np.ones(len(found), np.int64)
    gone = np.flatnonzero(found < 0)
    if len(gone):  # a character that is no piece becomes its bytes, or the unknown id without byte pieces
        by_byte = np.array(p.bytes)
        if p.bytes[0] < 0:
            ids[gone] = p.unknown
        else:
            size[gone] = (end - start)[gone]
            at = np.flatnonzero(np.repeat(found < 0, size))
            place = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            ids = np.repeat(ids, size)
            ids[at] = by_byte[data[place[at]]]
    cut = 4 * np.concatenate([[0], np.cumsum(size)])[np.searchsorted(seg, np.arange(len(segments) + 1))]
    flat = ids.astype("<i4").tobytes()
    return [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


class Codec:
    """Encoder and decoder of a model. A worker remembers segments that it has seen, up to a fixed number of bytes."""

    def __init__(self, model: bytes):
        self.pieces = Pieces(model)
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each text as little-endian int32 bytes; nothing for null and empty texts."""
        cut = [_SEGMENT.findall(b" " + t.replace(_MARK, b" ")) if t else [] for t in texts]
        if self.held > REMEMBERED:
            self.forget()
        known = self.known
        new = list(set(chain.from_iterable(cut)).difference(known))
        ends = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)) + 1)
        at = 0
        while at < len(new):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + INDEXED, side="right")))
            found = encode_segments(new[at:to], self.pieces)
            known.update(zip(new[at:to], found, strict=True))
            self.held += int(ends[to - 1] - (ends[at - 1] if at else 0)) + sum(map(len, found)) + 100 * (to - at)
            at = to
        return [b"".join(map(known.__getitem__, segs)) for segs in cut]

    def forget(self) -> None:
        self.known, self.held = {}, 0

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the blank that encoding puts in front."""
        table = self.pieces.text
        out = b"".join([table[i] for i in ids.tolist()]).decode("utf-8", errors="replace")
        return out[1:] if out.startswith(" ") else out


_codecs: dict[bytes, Codec] = {}


def _codec(model: bytes) -> Codec:
    key = hashlib.blake2b(model, digest_size=16).digest()
    if key not in _codecs:
        _codecs[key] = Codec(model)
    return _codecs[key]


class Tokenizer:
    """Column functions for a model file, which the driver reads and broadcasts (half a megabyte)."""

    def __init__(self, spark: SparkSession, path: str = MODEL):
        bound_batches(spark)
        with open(path, "rb") as f:
            model = spark.sparkContext.broadcast(f.read())

        @F.arrow_udf("array<int>")
        def encode(text: pa.Array) -> pa.Array:
            codec, got = _codec(model.value), []
            for b in pieces([pa.record_batch([text], names=["text"])]):
                got += codec.encode(raw(b.column("text")))
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in got])]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(got), "<i4"), pa.int32()))

        @F.arrow_udf("string")
        def decode(tokens: pa.Array) -> pa.Array:
            codec = _codec(model.value)
            return pa.array([None if x is None else codec.decode(np.asarray(x.values)) for x in _lists(tokens)], pa.string())

        @F.arrow_udf("struct<n_tokens long, ids_sha256 string, decoded string>")
        def summary(tokens: pa.Array) -> pa.Array:
            codec = _codec(model.value)
            n, sha, text = [], [], []
            for x in _lists(tokens):
                ids = np.asarray(x.values) if x is not None else np.zeros(0, np.int32)
                n.append(len(ids))
                sha.append(hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest())
                text.append(codec.decode(ids))
            return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(text, pa.string())], names=["n_tokens", "ids_sha256", "decoded"])

        self._encode, self._decode, self._summary = encode, decode, summary

    def encode(self, text: Column | str) -> Column:
        """array<int> of a text's ids; empty for null and empty texts."""
        return self._encode(text)

    def decode(self, tokens: Column | str) -> Column:
        """The text of ids; null for null."""
        return self._decode(tokens)

    def summary(self, tokens: Column | str) -> Column:
        """struct<n_tokens, ids_sha256 (of the ids as little-endian int32), decoded>."""
        return self._summary(tokens)


def _lists(tokens: pa.Array):
    """Scalars of a list column."""
    return (x if x.is_valid else None for x in tokens)


def tokenize(docs: DataFrame, path: str = MODEL, columns: list[str] | None = None) -> DataFrame:
    """Columns of docs (all by default) with tokens (replaced if it exists), for all rows.

    Whole texts; null and empty texts have no tokens. Names of docs may be any, ``_text`` and dotted ones included. Rows come back a megabyte of text at a time, so that a task holds few
    tokens however many rows Spark hands over at once; texts that aren't asked for stay behind.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    with open(path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    kept = [c for c in (docs.columns if columns is None else columns) if c != "tokens"]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("tokens", T.ArrayType(T.IntegerType()))])
    plain = [f"c{i}" for i in range(len(kept))]  # on the way to Python names have to be plain

    def run(batches):
        codec = _codec(model.value)
        for b in pieces(batches, "t"):
            got = codec.encode(raw(b.column("t")))
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in got])]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(got), "<i4"), pa.int32()))
            yield pa.record_batch([*(b.column(c) for c in plain), tokens], names=[*kept, "tokens"])
        codec.forget()  # the worker lives on

    return docs.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(kept, plain, strict=True)], F.col("text").alias("t")).mapInArrow(run, schema)


def op7_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and whether decoding gives the text again (the mark, read as a blank, apart)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    t = Tokenizer(spark)
    out = docs.withColumn("s", t.summary(t.encode("text")))
    same = F.col("s.decoded") == F.replace(F.coalesce("text", F.lit("")), F.lit(_MARK.decode()), F.lit(" "))
    return out.select("doc_id", "s.n_tokens", "s.ids_sha256", same.alias("round_trip"))

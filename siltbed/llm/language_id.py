"""Language ID: a linear-chain conditional random field labels words, forward-backward gives their language shares."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, bound_batches, carried, mix, pieces, raw, unpacked

_LETTER = regex.compile(r"\p{L}")
#: Words of one block of the forward-backward scan.
BLOCK = 128


def held_out(doc_id):
    """Rows that no model learns from: crc32 of the id's decimal text, mod 4, is 2."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def word_features(w: Words, pick: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the words at ``pick``: (feature ids, first feature of each word).

    Character n-grams of one to four bytes inside ^word$, affixes of up to five bytes, and the word itself, which is its
    entry of the lexicon.
    """
    size = (w.end - w.start)[pick]
    wide = size + 2
    first = np.concatenate([[0], np.cumsum(wide)])
    of = np.repeat(np.arange(len(pick)), wide)
    at = np.arange(first[-1]) - first[of]
    inner = (at > 0) & (at <= size[of])
    byte = np.where(at == 0, 256, 257).astype(np.uint64)
    byte[inner] = w.data[w.start[pick][of[inner]] + at[inner] - 1]
    # room for each word's features: all n-grams up to four bytes, two affixes of five and of six with the edge, the word
    grams = [np.maximum(0, wide - n + 1) if n <= 4 else np.where(wide >= n, np.where(wide == n, 1, 2), 0) for n in range(1, 7)]
    start = np.concatenate([[0], np.cumsum(sum(grams) + 1)])
    ids = np.empty(start[-1], np.int32)
    free, shift = start[:-1].copy(), np.uint64(64 - bits)
    roll = np.zeros(len(byte), np.uint64)
    for n, count in enumerate(grams, 1):
        roll[: len(roll) - n + 1] = roll[: len(roll) - n + 1] * np.uint64(1031) + byte[n - 1 :] + np.uint64(7)
        fits = at + n <= wide[of]
        # n-grams of up to four bytes count anywhere, longer ones only as affixes: at the word's start or end
        use = np.flatnonzero(fits if n <= 4 else fits & ((at == 0) | (at + n == wide[of])))
        nth = np.arange(len(use)) - np.repeat(np.cumsum(count) - count, count)
        ids[free[of[use]] + nth] = mix(roll[use] + np.uint64(n << 56)) >> shift
        free += count
    ids[free] = mix(w.hash[pick]) >> shift
    return ids, start[:-1]


#: Words whose features are spread out at once.
SPREAD = 8192


class Chain:
    """A linear chain over concatenated sequences, worked through in blocks so that long sequences cost no Python loop."""

    def __init__(self, first: np.ndarray, trans: np.ndarray):
        """first: index of each sequence's first item, and the number of items."""
        self.trans = trans
        size = np.diff(first)
        self.per = -(-size // BLOCK)
        self.seq_block = np.concatenate([[0], np.cumsum(self.per)])
        nth = np.arange(self.seq_block[-1]) - np.repeat(self.seq_block[:-1], self.per)
        start = np.repeat(first[:-1], self.per) + nth * BLOCK
        length = np.minimum(BLOCK, np.repeat(first[1:], self.per) - start)
        self.order = np.argsort(-length, kind="stable")
        self.start, self.length, self.nth = start, length, nth

    def _active(self):
        start, length = self.start[self.order], self.length[self.order]
        for t in range(BLOCK):
            n = int(np.searchsorted(-length, -t, side="left"))
            if not n:
                return
            yield t, n, start[:n] + t

    def marginals(self, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Posterior of each item (n, k); forward and backward vectors (both scaled); potentials.

        emit: log scores. The first item of a sequence has a flat prior.
        """
        k = emit.shape[1]
        pot = np.exp(emit - emit.max(axis=1, keepdims=True)) if len(emit) else emit
        fwd, bwd = np.empty_like(pot), np.empty_like(pot)
        nb = len(self.start)
        # the product of each block's steps carries a vector over the block
        whole = np.tile(np.eye(k), (nb, 1, 1))
        for _, n, items in self._active():
            m = (whole[:n] @ self.trans) * pot[items][:, None, :]
            whole[:n] = m / m.sum(axis=(1, 2), keepdims=True)
        back = np.empty_like(whole)
        back[self.order] = whole
        enter, leave = np.full((nb, k), 1.0 / k), np.ones((nb, k))
        by_nth = np.argsort(self.nth, kind="stable")
        cut = np.searchsorted(self.nth[by_nth], np.arange(self.nth.max(initial=-1) + 2))
        for j in range(1, len(cut) - 1):
            b = by_nth[cut[j] : cut[j + 1]]
            v = np.einsum("bi,bij->bj", enter[b - 1], back[b - 1])
            enter[b] = v / v.sum(axis=1, keepdims=True)
        for j in range(len(cut) - 2, 0, -1):
            b = by_nth[cut[j] : cut[j + 1]]
            v = np.einsum("bij,bj->bi", back[b], leave[b])
            leave[b - 1] = v / v.sum(axis=1, keepdims=True)
        v = enter[self.order].copy()
        for _, n, items in self._active():
            u = (v[:n] @ self.trans) * pot[items]
            v[:n] = u / u.sum(axis=1, keepdims=True)
            fwd[items] = v[:n]
        v = leave[self.order].copy()
        for _, n, items in reversed(list(self._active())):
            bwd[items] = v[:n]
            u = (pot[items] * v[:n]) @ self.trans.T
            v[:n] = u / u.sum(axis=1, keepdims=True)
        post = fwd * bwd
        post /= np.maximum(post.sum(axis=1, keepdims=True), 1e-300)
        return post, fwd, bwd, pot


class LanguageModel:
    """Labels, hashed emission weights (2**bits, k) and transition weights (k, k) of the chain."""

    def __init__(self, labels: list[str], bits: int = 17):
        self.labels, self.bits = labels, bits
        self.weights = np.zeros((1 << bits, len(labels)), np.float32)
        self.trans = np.zeros((len(labels), len(labels)))

    def emissions(self, w: Words) -> np.ndarray:
        if not len(w.hash):
            return np.zeros((0, len(self.labels)))
        _, pick, back = np.unique(w.hash, return_index=True, return_inverse=True)
        scores = np.empty((len(pick), len(self.labels)), np.float32)
        for a in range(0, len(pick), SPREAD):
            ids, first = word_features(w, pick[a : a + SPREAD], self.bits)
            scores[a : a + SPREAD] = np.add.reduceat(self.weights[ids], first, axis=0)
        return scores[back].astype(np.float64)

    def _types(self, texts: list[bytes], most: int = 1 << 20) -> tuple[np.ndarray, ...]:
        """(kind of each word, first word of each text, features of all kinds, number of features of each kind)."""
        words, starts, hashes, ids, counts, known = [], [0], [], [], [], np.zeros(0, np.uint64)
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) < most):
                size += len(texts[to])
                to += 1
            w = Words(texts[at:to], lower=True)
            starts += (w.first[1:] + starts[-1]).tolist()
            words.append(w.hash)
            kinds, pick = np.unique(w.hash, return_index=True)
            new = ~np.isin(kinds, known)
            known = np.union1d(known, kinds)
            hashes.append(kinds[new])
            for a in range(0, int(new.sum()), SPREAD):
                x, f = word_features(w, pick[new][a : a + SPREAD], self.bits)
                ids.append(x)
                counts.append(np.diff(np.concatenate([f, [len(x)]])))
            at = to
        hashes = np.concatenate(hashes)
        order = np.argsort(hashes)
        back = order[np.searchsorted(hashes[order], np.concatenate(words))] if len(hashes) else np.zeros(0, np.int64)
        none = [np.zeros(0, np.int64)]
        return back, np.array(starts), np.concatenate(ids or none), np.concatenate(counts or none)

    def fit(self, texts: list[bytes], langs: list[int], rounds: int = 4, seed: int = 7) -> LanguageModel:
        """Conditional likelihood by Adagrad over chains spliced from spans of several documents: code-switched text."""
        k = len(self.labels)
        if k < 2 or not texts:
            return self
        rng = np.random.default_rng(seed)
        back, starts, ids, counts = self._types(texts)
        full = np.flatnonzero(np.diff(starts) > 0)
        first = np.cumsum(counts) - counts
        seen, seen_t = np.full(self.weights.shape, 1e-6, np.float32), np.full((k, k), 1e-6)
        lang = np.asarray(langs)
        by_lang = [full[lang[full] == x] for x in range(k)]
        by_lang = [x for x in by_lang if len(x)]
        for step in range(rounds * 12):
            rate = 0.4 if step < rounds * 9 else 0.15
            items, label, firsts = [], [], [0]
            for _ in range(250):
                for _ in range(int(rng.integers(1, 4))):
                    d = rng.choice(by_lang[int(rng.integers(len(by_lang)))])
                    a, b = starts[d], starts[d + 1]
                    n = int(min(b - a, rng.integers(8, 50)))
                    s = int(rng.integers(a, b - n + 1))
                    items.append(np.arange(s, s + n))
                    label.append(np.full(n, lang[d]))
                firsts.append(sum(map(len, items)))
            at, y, firsts = np.concatenate(items), np.concatenate(label), np.asarray(firsts)
            kinds, kind = np.unique(back[at], return_inverse=True)
            f = np.concatenate([ids[first[t] : first[t] + counts[t]] for t in kinds])
            f_first = np.concatenate([[0], np.cumsum(counts[kinds])[:-1]])
            emit = np.add.reduceat(self.weights[f], f_first, axis=0)[kind].astype(np.float64)
            post, fwd, bwd, pot = Chain(firsts, np.exp(self.trans)).marginals(emit)
            diff = post.copy()
            diff[np.arange(len(y)), y] -= 1
            by_kind = np.stack([np.bincount(kind, diff[:, j], len(kinds)) for j in range(k)], axis=1)
            g = np.stack([np.bincount(f, np.repeat(by_kind[:, j], counts[kinds]), 1 << self.bits) for j in range(k)], axis=1) / len(firsts)
            touched = np.flatnonzero(g.any(axis=1))
            seen[touched] += g[touched] ** 2
            self.weights[touched] -= rate * g[touched] / np.sqrt(seen[touched])
            inner = np.ones(len(at), bool)
            inner[firsts[:-1]] = False
            t = np.flatnonzero(inner)
            pair = fwd[t - 1][:, :, None] * np.exp(self.trans)[None] * (pot[t] * bwd[t])[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            gt = (pair.sum(axis=0) - np.bincount(y[t - 1] * k + y[t], minlength=k * k).reshape(k, k)) / len(firsts)
            seen_t += gt**2
            self.trans -= 0.1 * gt / np.sqrt(seen_t)
        return self

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], list[float], np.ndarray]:
        """Language and share of each text, and the posterior of each word."""
        w = Words(texts, lower=True)
        n, k = len(texts), len(self.labels)
        lettered = [bool(t) and _LETTER.search(t.decode("utf-8")) is not None for t in texts]
        if not k:
            return ["und"] * n, [0.0] * n, np.zeros((len(w.hash), 0))
        post = Chain(w.first, np.exp(self.trans)).marginals(self.emissions(w))[0]
        share = np.stack([np.bincount(w.doc, post[:, j], n) for j in range(k)], axis=1).astype(np.float64)
        share /= np.maximum(np.diff(w.first), 1)[:, None]
        best = share.argmax(axis=1)
        return [self.labels[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)], [float(min(1.0, share[i, b])) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, lettered, strict=True))], post


def train(docs: DataFrame, per_lang: int = 600, most_chars: int = 20_000, bits: int = 17) -> LanguageModel:
    """Fit on a bounded sample: about ``per_lang`` documents of each language (2 * per_lang at most), chosen by a hash of
    doc_id, of up to ``most_chars`` characters, none of them held out. Rows without text or language teach nothing.
    The number of languages is taken to be small: their counts come to the driver."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = sorted(counts)
    if not labels:
        return LanguageModel([], bits)
    odds = F.create_map(*[x for lang in labels for x in (F.lit(lang), F.lit(min(1.0, per_lang / counts[lang])))])
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    short = rows.where(F.col("text").isNotNull() & (F.length("text") <= most_chars) & (draw < odds[F.col("lang")]))
    got = short.select("doc_id", "lang", F.col("text").cast("binary").alias("text")).limit(2 * per_lang * len(labels)).collect()
    got = sorted(got, key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["text"]))
    place = {lang: i for i, lang in enumerate(labels)}
    return LanguageModel(labels, bits).fit([bytes(r["text"]) for r in got], [place[r["lang"]] for r in got])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All rows and columns of docs with lang_pred and score (replaced if they exist).

    lang_pred is the language with the largest mean word posterior, score that mean; ``und`` and 0 where text is null,
    empty or has no letter, or where nothing was learned. Long texts are worked through whole, in blocks. The model has a
    fixed size (2**bits weights for each language) and is broadcast.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.labels, model.bits, model.weights, model.trans))

    @F.arrow_udf("struct<lang_pred string, score double>")
    def run(text: pa.Array) -> pa.Array:
        m = LanguageModel.__new__(LanguageModel)
        m.labels, m.bits, m.weights, m.trans = shared.value
        lang, score = [], []
        for b in pieces([pa.record_batch([text], names=["text"])]):
            x, y, _ = m.predict(raw(b.column("text")))
            lang += x
            score += y
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])

    # a filter on the result would else be pushed below and work all of it out twice
    made = carried(docs, p=run.asNondeterministic()("text"))
    return made.select(*unpacked(docs, ("lang_pred", "score")), "p.lang_pred", "p.score")


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

"""Toxicity: a weighted lexicon matched by Aho-Corasick after folding, normalised by length, with exception phrases."""

from __future__ import annotations

import bisect
import math
import zlib
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, pieces, raw
from .language_id import held_out

#: Look-alike characters and digits, folded to Latin letters before matching.
LOOK_ALIKES = (
    "аa вb еe зe кk мm нh оo рp сc тt уy хx іi јj ѕs ԁd ɡg һh ӏl ԛq ԝw ѵv "
    "αa βb εe ηn ιi κk νv οo ρp τt υu χx ωw "
    "0o 1i 3e 4a 5s 7t @a $s !i |l €e £l"
)
_FOLD = {ord(p[0]): p[-1] for p in LOOK_ALIKES.split()} | {c: chr(c + 32) for c in range(65, 91)}
_FOLD |= {ord(chr(k).upper()): v for k, v in list(_FOLD.items()) if len(chr(k).upper()) == 1 and chr(k).isalpha() and k > 127}
_FOLD |= {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
#: Zero-width characters and the soft hyphen vanish.
_FOLD |= dict.fromkeys((0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD), "")
#: A trailing "!" ends a sentence; only one before a letter stands for "i".
_SPLIT = str.maketrans(dict.fromkeys("\t\n\x0b\x0c\r.,;:?\"()[]{}<>/\\*#%&+=_~^`-…«»“”„‘’–—", " "))


def fold(text: str) -> str:
    """Folded text: lower case, look-alikes and digit substitutions replaced, every gap one blank, a blank at both ends."""
    words = text.translate(_SPLIT).split()
    return " " + " ".join([w.rstrip("!|").translate(_FOLD).lower() for w in words]) + " "


class Lexicon:
    """Entries (folded; a leading or trailing blank stands for a word's edge) with weights, and exception phrases.

    A match inside an exception phrase doesn't count. score = sigmoid(slope * hits / words**power + offset), hits the
    sum of weights of the matches.
    """

    def __init__(self, weights: dict[str, float], exceptions: list[str] = (), power: float = 0.0, slope: float = 4.0, offset: float = -2.0):
        self.weights, self.exceptions = dict(weights), list(exceptions)
        self.power, self.slope, self.offset = power, slope, offset
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def hits(self, folded: str) -> float:
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for entry, x in self.weights.items():
                self._automaton.add_word(entry, (len(entry), x))
            for phrase in self.exceptions:
                self._automaton.add_word(phrase, (len(phrase), None))
            self._automaton.make_automaton()
        if not len(self._automaton):
            return 0.0
        found = [(end - size + 1, end, x) for end, (size, x) in self._automaton.iter(folded)]
        if not found:
            return 0.0
        # the furthest end of all phrases that begin at or before a place: a match up to there lies inside one of them
        begins, ends = [], []
        for a, b in sorted((a, b) for a, b, x in found if x is None):
            begins.append(a)
            ends.append(max(b, ends[-1]) if ends else b)
        taken: dict[int, float] = {}
        for a, b, x in found:
            if x is not None and not ((k := bisect.bisect_right(begins, a)) and b <= ends[k - 1]):
                taken[a] = max(taken.get(a, 0.0), x)  # of entries that begin together the strongest counts
        return math.fsum(taken.values())

    def value(self, folded: str) -> tuple[float, int]:
        return self.hits(folded), max(1, folded.count(" ") - 1)

    def score(self, text: str | None) -> float:
        if not text:
            return 0.0
        hits, words = self.value(fold(text))
        return 0.0 if hits <= 0 else 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * hits / words**self.power + self.offset))))


def learn(texts: list[str], labels: list[int], support: int = 4, exceptions: list[str] = ()) -> Lexicon:
    """A lexicon from labelled texts: folded words and word beginnings that tell toxic texts from clean ones.

    An entry must stand out more than the luckiest of all candidates would by chance, and not only in copies of texts that
    other entries tell; its weight is its log odds. A beginning stands for all words that it covers, so inflected forms that
    no sample shows are found as well. Two-word phrases around an entry that occur in at least ``support`` clean texts and
    no toxic one become exceptions.
    """
    if not any(labels) or all(labels):
        return Lexicon({}, list(exceptions))
    folded = [fold(t) for t in texts]

    def candidates(text: str) -> set[str]:
        seen = set()
        for word in set(text.split()):
            seen.add(f" {word} ")
            seen.update(f" {word[:n]}" for n in range(4, min(9, len(word) + 1)))
        return seen

    one = Counter(e for t, y in zip(folded, labels, strict=True) if y for e in candidates(t))
    held: dict[str, set[int]] = {e: set() for e, n in one.items() if n >= support}
    del one
    zero = Counter()
    for k, (t, y) in enumerate(zip(folded, labels, strict=True)):
        found = candidates(t) & held.keys()
        if y:
            for e in found:
                held[e].add(k)
        else:
            zero.update(found)
    n1, n0 = sum(labels), len(labels) - sum(labels)
    base, need = n1 / (n1 + n0), math.log(max(1, len(held))) + 4

    def surprise(e: str) -> float:
        """How little chance explains the toxic texts with e (Chernoff's bound, in nats); 0 if clean texts hold it as well."""
        n = len(held[e]) + zero[e]
        share = len(held[e]) / n
        if share <= 0.9 or share <= base:
            return 0.0
        return n * (share * math.log(share / base) + (0 if share == 1 else (1 - share) * math.log((1 - share) / (1 - base))))

    strong = {e: x for e in held if (x := surprise(e)) >= need}
    # Copies of a toxic text make all of its words look telling. So the most telling entry comes first, and one after it has
    # to stand after many different words, or to tell texts in which none of those before is. What it tells beyond entries
    # that it begins has to be toxic as well.
    kept, left = {}, {k for k, y in enumerate(labels) if y}
    for e in sorted(strong, key=lambda e: (-strong[e], len(e), e)):
        while longer := [x for x in strong if len(x) > len(e) and x.startswith(e) and len(held[x]) >= 0.95 * len(held[e])]:
            e = min(longer, key=lambda x: (len(x), x))  # as telling and more exact
        if any(e.startswith(x) for x in kept):
            continue
        fresh = held[e].difference(*[held[x] for x in kept if x.startswith(e)])
        before = {folded[k][: folded[k].find(e)].rpartition(" ")[2] for k in fresh}
        new = len(fresh & left)
        if len(fresh) >= 0.9 * (len(fresh) + zero[e]) and (new >= 2 and new >= 0.8 * (new + zero[e]) or len(before) >= max(8, len(fresh) / 2)):
            kept[e] = math.log((len(held[e]) + 0.5) / (n1 + 1)) - math.log((zero[e] + 0.5) / (n0 + 1))
            left -= held[e]
    safe, bad = Counter(), Counter()
    entry = Lexicon(kept)
    for t, y in zip(folded, labels, strict=True):
        if entry.hits(t) > 0:
            words = t.split()
            around = {f" {a} {b} " for a, b in zip(words, words[1:], strict=False) if entry.hits(f" {a} ") > 0 or entry.hits(f" {b} ") > 0}
            (bad if y else safe).update(around)
    lex = Lexicon(kept, [*exceptions, *sorted(p for p, c in safe.items() if c >= support and not bad[p])])
    x = np.array([lex.value(t) for t in folded])
    y = np.asarray(labels, float)
    best = None
    for power in (0.0, 0.25, 0.5, 1.0):
        z = x[:, 0] / x[:, 1] ** power
        hit = z > 0
        if not hit.any():
            break
        scale = np.median(z[hit])
        a, b = 4.0, -2.0
        for _ in range(200):  # Newton steps on the likelihood of texts with a hit, held in by a weak prior
            p = 1 / (1 + np.exp(-np.clip(a * z[hit] / scale + b, -30, 30)))
            g = np.array([((p - y[hit]) * z[hit] / scale).sum() + 0.05 * (a - 4), (p - y[hit]).sum() + 0.05 * (b + 2)])
            v = np.maximum(p * (1 - p), 1e-9)
            s = z[hit] / scale
            h = np.array([[(v * s * s).sum() + 0.05, (v * s).sum()], [(v * s).sum(), v.sum() + 0.05]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
            if abs(step).max() < 1e-6:
                break
        p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
        loss = -(y[hit] * np.log(p + 1e-12) + (1 - y[hit]) * np.log(1 - p + 1e-12)).sum()
        if best is None or loss < best[0] - 1e-6:
            best = (loss, power, a / scale, b)
    if best:
        lex.power, lex.slope, lex.offset = best[1], float(best[2]), float(best[3])
    return lex


def train(docs: DataFrame, labels: DataFrame, most_toxic: int = 1500, most_clean: int = 4500, most_chars: int = 20_000) -> Lexicon:
    """Learn from a bounded sample: about ``most_toxic`` and ``most_clean`` documents (twice that at most) of up
    to ``most_chars`` characters, none of them held out, drawn by a hash of doc_id. Null labels and texts teach nothing;
    an id labelled more than once counts as its largest label."""
    y = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in y.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).where("toxic in (0, 1)").collect()}
    if not counts:
        return Lexicon({})
    odds = F.create_map(*[x for v, n in counts.items() for x in (F.lit(v), F.lit(min(1.0, (most_toxic if v else most_clean) / n)))])
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(29)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = y.where(F.col("toxic").isin(*counts) & (draw < odds[F.col("toxic")])).limit(2 * (most_toxic + most_clean))
    few = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= most_chars)).join(F.broadcast(chosen), "doc_id")
    got = sorted(few.select("doc_id", "text", "toxic").limit(2 * (most_toxic + most_clean)).collect(), key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["text"]))
    return learn([r["text"] for r in got], [r["toxic"] for r in got])


def score_documents(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3) -> DataFrame:
    """All rows and columns of docs with score and predicted (replaced if they exist).

    Null and empty texts and texts without a match score 0. Texts are matched whole. The lexicon is bounded by its sample
    and broadcast.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf("double")
    def run(text: pa.Array) -> pa.Array:
        lex, out = shared.value, []
        for b in pieces([pa.record_batch([text], names=["text"])]):
            out += [lex.score(t.decode("utf-8") if t else None) for t in raw(b.column("text"))]
        return pa.array(out, pa.float64())

    kept = [f"`{c}`" for c in docs.columns if c not in ("score", "predicted")]
    # not to be worked out twice for a filter on the result
    return docs.select(*kept, run.asNondeterministic()("text").alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    out = score_documents(docs, train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

"""License scans: normalised text is compared to licence templates by the Dice coefficient over word bigrams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SureWords, bound_batches, pieces, raw
from .licence_texts import RESERVED, TEMPLATES


class LicenceWords(SureWords):
    """Words for licence texts: runs of letters, digits and bytes beyond ASCII; everything else parts words."""

    _is_space = np.array([not (chr(b).isalnum() and b < 128 or b >= 128) for b in range(256)])


class Templates:
    """Bigrams of all templates with their multiplicities."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.names = [n for n, _ in templates]
        self.threshold = threshold
        self.need: list[dict[int, int]] = []
        w = LicenceWords([t.encode() for _, t in templates], lower=True)
        g = w.grams(2)
        for a, b in zip(w.first[:-1], w.first[1:], strict=True):
            kinds, n = np.unique(g[a : max(a, b - 1)], return_counts=True)
            self.need.append(dict(zip(kinds.tolist(), n.tolist(), strict=True)))
        self.size = np.array([sum(x.values()) for x in self.need])
        self.all = np.unique(np.concatenate([np.fromiter(x, np.uint64) for x in self.need]))
        # which templates hold each bigram
        self.holds = np.array([[int(x) in need for x in self.all] for need in self.need])

    def best(self, grams: np.ndarray, at: np.ndarray, which: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(template, first bigram, bigrams, dice) of the best window for each template that reaches the threshold.

        grams: a text's bigrams; at: places of those that some template holds; which: their index in ``all``. The window has
        the template's size, or is the whole of a shorter text; of equal windows the first counts.
        """
        m, out = len(grams), []
        for t in np.flatnonzero(self.size > 0):
            n = int(self.size[t])
            wide = min(m, n)
            # size bound: even if all of the shorter side matched, dice would stay below the threshold
            if 2 * wide < self.threshold * (wide + n):
                continue
            hits = at[self.holds[t, which]]
            least = self.threshold * (wide + n) / 2
            if len(hits) < least:
                continue
            # the first of the best windows ends at a hit or begins at 0: else the window one word before is as good
            begin = np.unique(np.maximum(hits - wide + 1, 0))
            inside = np.searchsorted(hits, begin + wide) - np.searchsorted(hits, begin)
            begin = begin[inside >= least]
            if not len(begin):
                continue
            need, have, common, lo, hi, top = self.need[t], {}, 0, 0, 0, None
            hit_grams = grams[hits].tolist()
            for b in begin.tolist():
                a, z = np.searchsorted(hits, [b, b + wide])
                if a >= hi:
                    have, common, lo, hi = {}, 0, a, a
                while hi < z:
                    g = hit_grams[hi]
                    have[g] = have.get(g, 0) + 1
                    common += have[g] <= need[g]
                    hi += 1
                while lo < a:
                    g = hit_grams[lo]
                    common -= have[g] <= need[g]
                    have[g] -= 1
                    lo += 1
                dice = 2 * common / (wide + n)
                if dice >= self.threshold and (top is None or dice > top[3]):
                    top = (int(t), b, wide, dice)
            if top:
                out.append(top)
        return out


_MATCH = "struct<licence string, template int, first_word int, n_words int, dice double>"


def scan_licences(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """All rows and columns of docs with licences: an array of matches (licence, template, first_word, n_words, dice), best first.

    For each template, all windows of its size in the normalised text (lower case, words of letters and digits) are compared
    by the Dice coefficient over word bigrams, counted with multiplicity, and the best one is a match if it reaches the
    threshold. Texts with fewer bigrams are compared whole; templates too long for them are pruned by size. Whole texts of
    any length are scanned; null and empty texts and texts of one word have no match. The templates are a parameter on the
    driver and travel with the task. A column of docs named licences is replaced.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((templates, threshold))
    held = {}

    @F.arrow_udf(f"array<{_MATCH}>")
    def run(text: pa.Array) -> pa.Array:
        if "t" not in held:
            held["t"] = Templates(*shared.value)
        tm, out = held["t"], []
        for b in pieces([pa.record_batch([text], names=["text"])]):
            w = LicenceWords(raw(b.column("text")), lower=True)
            g = w.grams(2)
            place = np.minimum(np.searchsorted(tm.all, g), len(tm.all) - 1) if len(tm.all) else np.zeros(len(g), np.int64)
            known = np.flatnonzero(tm.all[place] == g) if len(tm.all) else np.zeros(0, np.int64)
            cut = np.searchsorted(known, w.first)
            for d in range(len(w.first) - 1):
                a, z = w.first[d], max(w.first[d], w.first[d + 1] - 1)
                k = known[cut[d] : cut[d + 1]]
                k = k[k < z]
                found = tm.best(g[a:z], k - a, place[k]) if len(k) else []
                found.sort(key=lambda x: (-x[3], -x[2], x[1], x[0]))
                out.append([{"licence": tm.names[t], "template": t, "first_word": s, "n_words": n + 1, "dice": dice} for t, s, n, dice in found])
        kind = pa.list_(pa.struct([("licence", pa.string()), ("template", pa.int32()), ("first_word", pa.int32()), ("n_words", pa.int32()), ("dice", pa.float64())]))
        return pa.array(out, kind)

    # not to be worked out twice for a filter on the result
    return docs.withColumn("licences", run.asNondeterministic()("text"))


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    """doc_id, licence (of the best match, null if there is none), dice, first_word, n_words and n_licences (different ones).

    Reserved rights are the best match only where nothing else is found: the line stands in the headers of many grants too.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    first = lambda x: F.get(x, F.lit(0))
    m = scan_licences(docs).withColumn("b", F.coalesce(first(F.filter("licences", lambda x: x["licence"] != RESERVED)), first(F.col("licences"))))
    many = F.size(F.array_distinct(F.transform("licences", lambda x: x["licence"]))).cast("long")
    return m.select("doc_id", "b.licence", "b.dice", "b.first_word", "b.n_words", many.alias("n_licences"))

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from siltbed.llm.common import Words
from siltbed.llm.language_id import BLOCK, Chain, LanguageModel, held_out, identify, op10_language_id, train

VOICES = {"xa": "the and ing tion ou er sh wh", "xb": "der die und sch ich ung keit ß", "xc": "le la eau é è ou que ment"}


def text(lang, n, rnd):
    parts = VOICES[lang].split()
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def brute(emit, trans, first):
    """Posteriors by plain forward-backward in log space, one sequence at a time."""
    out = np.zeros_like(emit)
    t = np.log(trans)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if a == b:
            continue
        f, g = [emit[a]], [np.zeros(emit.shape[1])]
        # the first item comes from a flat prior through one transition
        f[0] = emit[a] + np.logaddexp.reduce(t, axis=0)
        for x in range(a + 1, b):
            f.append(emit[x] + np.logaddexp.reduce(f[-1][:, None] + t, axis=0))
        for x in range(b - 1, a, -1):
            g.append(np.logaddexp.reduce(t + (emit[x] + g[-1])[None, :], axis=1))
        s = np.array(f) + np.array(g[::-1])
        out[a:b] = np.exp(s - np.logaddexp.reduce(s, axis=1)[:, None])
    return out


def test_forward_backward_in_blocks():
    rnd = np.random.default_rng(2)
    first = np.concatenate([[0], np.cumsum([3, 0, 1, BLOCK, BLOCK + 1, 5 * BLOCK + 7, 40, 0])])
    emit, trans = rnd.normal(size=(first[-1], 3)) * 3, np.exp(rnd.normal(size=(3, 3)))
    assert np.allclose(Chain(first, trans).marginals(emit)[0], brute(emit, trans, first), atol=1e-9)
    assert Chain(np.array([0, 0]), trans).marginals(np.zeros((0, 3)))[0].shape == (0, 3)


def test_labels_words_of_mixed_text():
    rnd = random.Random(4)
    texts = [(x, text(x, 40, rnd).encode()) for x in VOICES for _ in range(60)]
    m = LanguageModel(sorted(VOICES), 14).fit([t for _, t in texts], [sorted(VOICES).index(x) for x, _ in texts])
    mixed = text("xa", 30, rnd) + " " + text("xc", 30, rnd)
    _, _, post = m.predict([mixed.encode()])
    want = np.repeat([0, 2], 30)
    assert (post.argmax(axis=1) == want).mean() > 0.9 and len(Words([mixed.encode()]).hash) == 60
    # what was learned prefers to stay in a language
    assert (np.diag(m.trans) > m.trans.mean()).all()


def test_query_on_held_out_documents(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(i, text(x := rnd.choice(sorted(VOICES)), rnd.choice([3, 30, 900]), rnd), x) for i in range(600)]
    rows = [(i, t, x if zlib.crc32(str(i).encode()) % 4 != 2 else "lie") for i, t, x in rows]
    truth = {i: x for i, _, x in rows}
    extra = [(1000, None, "xa"), (1001, "", "xa"), (1002, "12 -- 34 ²", "xa"), (1003, text("xa", 20, rnd), None), (None, text("xb", 20, rnd), "xb")]
    spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in op10_language_id(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) + len(extra)
    assert {r["lang_pred"] for r in got.values()} == {*VOICES, "und"}
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "xa", "xb"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    fit = [i for i, x in truth.items() if x != "lie"]
    assert sum(got[i]["lang_pred"] == truth[i] for i in fit) >= 0.97 * len(fit)


def test_without_languages_and_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "some text", None, 7), (2, None, None, 8)], "doc_id long, text string, lang string, score int")
    got = identify(df, train(df))
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"] and {r["lang_pred"] for r in got.collect()} == {"und"}
    one = df.withColumn("lang", F.lit("xx")).where(~held_out(F.col("doc_id")))
    assert {r["lang_pred"] for r in identify(df, train(one)).collect()} <= {"xx", "und"}
    assert identify(df.where("false"), train(df)).count() == 0

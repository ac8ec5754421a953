import math
import random
import time
import zlib

from siltbed.llm.toxicity import Lexicon, fold, learn, op9_toxicity, score_documents, train


def test_fold_undoes_look_alikes_digits_and_invisible_characters():
    assert fold("Id​i0T, ＳＣＵＭ! м0rоn") == " idiot scum moron "
    assert fold("tr@sh\n\tcl0wn!!") == " trash clown " and fold("") == "  "


def corpus(n=800, seed=1):
    rnd = random.Random(seed)
    voc = ["".join(rnd.choice("bcdfghklmnprstv") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 3))) for _ in range(300)]
    texts, labels = [], []
    for _ in range(n):
        w, y = [rnd.choice(voc) for _ in range(rnd.randint(5, 200))], int(rnd.random() < 0.2)
        if y:
            w.insert(rnd.randrange(len(w)), rnd.choice(["idiot", "scum", "qworg" + rnd.choice(voc)]))
        texts.append(" ".join(w))
        labels.append(y)
    return texts, labels


def test_learns_words_and_beginnings():
    texts, labels = corpus()
    lex = learn(texts[:600], labels[:600])
    assert {e.strip() for e in lex.weights} == {"idiot", "scum", "qworg"} or {"qworg"} <= {e.strip() for e in lex.weights}
    got = [int(lex.score(t) >= 0.3) for t in texts[600:]]
    assert sum(a != b for a, b in zip(got, labels[600:], strict=True)) <= 2
    assert lex.score("you 1D10T") >= 0.3 > lex.score("fine words") and lex.score("qworgnever") >= 0.3
    assert lex.score(None) == lex.score("") == 0.0


def test_exception_phrases_and_overlaps():
    lex = Lexicon({" trash ": 2.0, " tras": 1.0}, [" trash can "])
    assert lex.hits(fold("the trash can")) == 0 and lex.hits(fold("trash canvas")) == 2 and lex.hits(fold("trash trash can trasher")) == 3
    learned = learn(["big clown", "clown nose", "a clown nose b"] * 12 + ["bad scum"] * 30, [0, 0, 0] * 12 + [1] * 30)
    assert learned.score("bad scum") > 0.9 and learned.score("clown nose") < 0.1


def test_one_class_or_nothing_to_learn_from(spark):
    assert learn(["a"], [1]).score("a") == 0.0 and learn([], []).score("a") == 0.0
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert train(docs, labels).weights == {}


def test_query_learns_from_rows_that_are_not_held_out(spark, tmp_path):
    texts, labels = corpus(1200)
    rows = [(i, t) for i, t in enumerate(texts)]
    out = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 4 == 2]
    # wrong labels on held-out rows teach nothing
    given = [(i, 1 - y if i in set(out) else y) for i, y in enumerate(labels)] + [(5, None), (10**6, 1)]
    spark.createDataFrame(rows + [(2000, None), (2001, ""), (2001, "idiot")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(given, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = op9_toxicity(spark, str(tmp_path)).collect()
    by = {r["doc_id"]: r for r in got if r["doc_id"] < 2000}
    assert len(got) == len(rows) + 3 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert {i for i, r in by.items() if r["held_out"]} == set(out)
    assert sum(by[i]["predicted"] != labels[i] for i in out) <= len(out) * 0.02


def test_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "idiot", "x")], "doc_id long, text string, score string")
    r = score_documents(df, Lexicon({" idiot ": 3.0})).collect()[0]
    assert r["predicted"] == 1 and isinstance(r["score"], float)
    assert score_documents(df.where("false"), Lexicon({})).count() == 0


def plain_hits(lex, folded):
    """Every entry and phrase looked for at every place."""
    at = lambda e: [i for i in range(len(folded) - len(e) + 1) if folded.startswith(e, i)]
    safe = [(i, i + len(p)) for p in lex.exceptions for i in at(p)]
    best = {}
    for e, x in lex.weights.items():
        for i in at(e):
            if not any(a <= i and i + len(e) <= b for a, b in safe):
                best[i] = max(best.get(i, 0.0), x)
    return sum(best.values())


def test_hits_against_a_plain_matcher():
    rnd = random.Random(8)
    for _ in range(300):
        some = lambda n: "".join(rnd.choice("ab ") for _ in range(n))
        weights = {some(rnd.randint(1, 4)): rnd.choice([0.5, 1.0, 2.0]) for _ in range(rnd.randint(0, 6))}
        phrases = sorted({some(rnd.randint(2, 7)) for _ in range(rnd.randint(0, 5))} - weights.keys())
        lex, text = Lexicon(weights, phrases), fold(some(rnd.randint(0, 60)))
        assert abs(lex.hits(text) - plain_hits(lex, text)) < 1e-9


def test_the_whole_query_against_a_plain_version(spark, tmp_path):
    texts, labels = corpus(600, seed=3)
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, given = (spark.read.parquet(str(tmp_path / f"{t}.parquet")) for t in ("documents", "labels"))
    lex = train(docs, given)
    for r in op9_toxicity(spark, str(tmp_path)).collect():
        hits, n = plain_hits(lex, fold(texts[r["doc_id"]])), max(1, len(fold(texts[r["doc_id"]]).split()))
        want = 0.0 if hits <= 0 else 1 / (1 + math.exp(-max(-30.0, min(30.0, lex.slope * hits / n**lex.power + lex.offset))))
        assert abs(r["score"] - want) < 1e-9 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_very_long_texts_of_exceptions_take_linear_time():
    lex = Lexicon({" trash ": 2.0}, [" trash can "])
    text = " " + "trash can " * 1_000_000
    began = time.perf_counter()
    assert lex.hits(text) == 0.0 and lex.hits(text + "trash ") == 2.0
    assert time.perf_counter() - began < 20


def test_dotted_names_are_carried(spark):
    df = spark.createDataFrame([(1, "idiot", "x")], ["doc_id", "text", "a.b"])
    r = score_documents(df, Lexicon({" idiot ": 3.0})).collect()[0]
    assert r["a.b"] == "x" and r["predicted"] == 1

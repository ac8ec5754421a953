import random

import numpy as np
import pytest
from helpers import made_up, words

from siltbed.llm import substring_dedup as sd
from siltbed.llm.substring_dedup import SuffixAutomaton, dedup_substrings, remove_reference


def plain(docs, size):
    rows = {}
    for i, t in docs:
        rows.setdefault(sd.LAST if i is None else i, set()).add(t)
    seen, gone = {}, {}
    order = sorted(rows)
    text = {i: words("\n".join(sorted(t for t in rows[i] if t is not None))) for i in order}
    for i in order:
        w, gone[i] = text[i], set()
        for s in range(len(w) - size + 1):
            key = tuple(w[s : s + size])
            if key in seen:
                gone[i].update(range(s, s + size))
            seen.setdefault(key, (i, s))
    return sorted(((None if i == sd.LAST else i, " ".join(x for k, x in enumerate(text[i]) if k not in gone[i]), len(text[i]), len(gone[i])) for i in order), key=str)


def run(spark, docs, size):
    return sorted(map(tuple, dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string"), size).collect()), key=str)


@pytest.mark.parametrize("seed, size", [(1, 20), (2, 20), (3, 12)])
def test_against_a_plain_version(spark, seed, size):
    docs = [(i, t) for i, t in dict(made_up(90, seed)).items()]
    docs += [(500, "é x " * 40), (501, " ".join(f"w{i % 7}" for i in range(200))), (None, docs[5][1])]
    got = run(spark, docs, size)
    assert got == plain(docs, size)
    assert sum(r[3] for r in got) > 100


def test_repeated_ids_count_as_one_document(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = [(1, a), (1, a), (1, None), (2, b), (2, a)]
    assert run(spark, docs, 20) == plain(docs, 20)


def test_hot_anchors_are_dealt_by_windows(spark, monkeypatch):
    monkeypatch.setattr(sd, "HOT", 0)
    monkeypatch.setattr(sd, "SAMPLE", 2)
    docs = list(dict(made_up(90, 4)).items())
    assert run(spark, docs, 20) == plain(docs, 20)


@pytest.mark.parametrize("wide", [2, 64])
def test_one_short_passage_in_many_surroundings(spark, monkeypatch, wide):
    monkeypatch.setattr(sd, "WIDE", wide)
    rnd = random.Random(2)
    common = " ".join(f"c{i}" for i in range(14))
    docs = [(i, " ".join(f"r{rnd.randrange(3)}" for _ in range(12)) + " " + common + " " + " ".join(f"r{rnd.randrange(3)}" for _ in range(12))) for i in range(60)]
    assert run(spark, docs, 20) == plain(docs, 20)


def test_automaton_finds_first_ends():
    rnd = random.Random(9)
    for _ in range(60):
        texts = [[rnd.choice("ab") for _ in range(rnd.randint(0, 25))] for _ in range(5)]
        auto, at, where = SuffixAutomaton(), 0, {}
        for t in texts:
            auto.add(t, at)
            for e in range(len(t)):
                for n in range(1, e + 2):
                    where.setdefault(tuple(t[e - n + 1 : e + 1]), at + e)
            at += len(t)
        q = [rnd.choice("abc") for _ in range(40)]
        for n in (1, 3, 6):
            assert list(auto.ends(q, n)) == [where.get(tuple(q[e - n + 1 : e + 1]), -1) if e + 1 >= n else -1 for e in range(len(q))]


def test_runs_join():
    d, s, n = sd._runs(np.array([1, 1, 0, 1, 2]), np.array([5, 0, 3, 2, 0]), np.array([2, 3, 1, 2, 9]))
    assert list(zip(d.tolist(), s.tolist(), n.tolist(), strict=True)) == [(0, 3, 1), (1, 0, 4), (1, 5, 2), (2, 0, 9)]


def test_reference_spans_go(spark):
    ref = [" ".join(f"b{i}" for i in range(60)), " ".join(f"z{i}" for i in range(30))]
    docs = [(1, "x " + " ".join(f"b{i}" for i in range(10, 40)) + " y"), (2, " ".join(f"b{i}" for i in range(15))), (3, None), (4, ref[1])]
    got = remove_reference(spark.createDataFrame(docs, "doc_id long, text string"), ref, 20, most_words=50)
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in got.collect()} == {1: ("x y", 30), 2: (docs[1][1], 0), 3: ("", 0), 4: ("", 30)}


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b", "x", "y")], "doc_id long, text string, key string, spans string")
    assert dedup_substrings(df.where("false")).count() == 0
    assert list(map(tuple, dedup_substrings(df).collect())) == [(1, "a b", 2, 0)]


def test_words_made_to_collide_are_told_apart(spark):
    x = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    y = x.translate(str.maketrans("ab", "ba"))  # the same polynomial hash modulo 2**64
    lead = " ".join(f"w{i}" for i in range(19))
    docs = [(1, f"{lead} {x}"), (2, f"{lead} {y}"), (3, f"{lead} {x}")]
    got = run(spark, docs, 20)
    assert got == plain(docs, 20) and [r[3] for r in got] == [0, 0, 20]


def test_shards_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(sd, "SHARD", 300)
    docs = list(dict(made_up(60, 6)).items())
    assert run(spark, docs, 20) == plain(docs, 20)

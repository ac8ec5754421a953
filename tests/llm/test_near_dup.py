import random
from math import comb

import numpy as np
import pytest
from helpers import components, lower, made_up, words

from siltbed.llm import near_dup as nd
from siltbed.llm.near_dup import chunk_keys, distance_bound, exact_sets, near_duplicates, pack, shingle_sets, signatures, slot_distance, spanning_forest


def sets_of(docs, k=5):
    out = []
    for _, t in docs:
        w = words(lower(t))
        out.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def plain(docs, percent=85):
    s = sets_of(docs)
    ids = [i for i, _ in docs if i is not None]
    edges = [
        (docs[x][0], docs[y][0])
        for x in range(len(docs))
        for y in range(x)
        if s[x] and s[y] and docs[x][0] is not None and docs[y][0] is not None and 100 * len(s[x] & s[y]) >= percent * len(s[x] | s[y])
    ]
    c = components(ids, edges)
    return sorted(((i, len(x), c.get(i), i is None or c[i] == i) for (i, _), x in zip(docs, s, strict=True)), key=str)


def run(spark, docs, **kw):
    return sorted(map(tuple, near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), **kw).collect()), key=str)


@pytest.mark.parametrize("percent", [85, 80, 60])
def test_against_all_pairs(spark, percent):
    docs = [*made_up(120, seed=8, vocabulary=60), (None, "a b c d e f"), (400, "a b c d e f")]
    assert run(spark, docs, percent=percent) == plain(docs, percent)


def family(n, seed=4, edits=4, size=150):
    """Near copies of one text, whose similarities lie around the threshold."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(500)}" for _ in range(size)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randint(1, edits)):
            w[rnd.randrange(size)] = f"x{rnd.randrange(10**6)}"
        out.append((i, " ".join(w)))
    return out


def test_a_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "CLUSTER_DOCS", 16)
    monkeypatch.setattr(nd, "PIVOTS", 2)
    monkeypatch.setattr(nd, "BUCKET", 32)
    docs = family(90)
    got = run(spark, docs)
    assert got == plain(docs)
    assert 1 < sum(r[3] for r in got) < 60


def test_pairs_within_the_bound_share_a_key():
    rnd = np.random.default_rng(0)
    for similarity in (0.6, 0.8, 0.85, 0.95):
        bound = distance_bound(similarity)
        q = 1 - similarity
        assert sum(comb(nd.SLOTS, r) * q**r * (1 - q) ** (nd.SLOTS - r) for r in range(bound + 1, nd.SLOTS + 1)) <= 1.1e-5
        a = rnd.integers(0, 1 << 62, (300, nd.SLOTS), dtype=np.uint64)
        b = a.copy()
        for row in b:
            row[rnd.choice(nd.SLOTS, bound, replace=False)] += np.uint64(1)
        keys_a, keys_b = chunk_keys(a, bound), chunk_keys(b, bound)
        assert all(set(x) & set(y) for x, y in zip(keys_a, keys_b, strict=True))
        assert (slot_distance(pack(a), pack(b)) <= bound).all()


def test_signatures_agree_as_sets_do():
    docs = family(2, edits=12, size=900)
    a, b = shingle_sets([t.encode() for _, t in docs])
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    s = signatures([a, b])
    assert abs((s[0] == s[1]).mean() - j) < 0.2
    near = np.zeros((5, 5), bool)
    near[0, 3] = near[3, 0] = near[3, 4] = near[4, 3] = True
    assert sorted(spanning_forest(near)) == [(0, 3), (3, 4)]


def test_rows_of_one_id_empty_tables_and_clashing_names(spark):
    docs = [(1, "a b c d e f g"), (1, "h i j k l m n"), (2, "h i j k l m n"), (2, "h i j k l m n")]
    got = run(spark, docs)
    assert [(r[0], r[2]) for r in got] == [(1, 1), (1, 1), (2, 1), (2, 1)]
    df = spark.createDataFrame([(1, "a b", "x", 3), (2, "a  B", "x", 3)], "doc_id long, text string, key string, component_id int")
    assert sorted(map(tuple, near_duplicates(df).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]
    assert near_duplicates(df.where("false")).count() == 0


def colliding(n=1024):
    """Two different words with one polynomial hash modulo 2**64, whatever its odd base: the Thue-Morse word and its complement."""
    x = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return x, x.translate(str.maketrans("ab", "ba"))


def test_words_made_to_collide_are_told_apart(spark):
    x, y = colliding()
    docs = [(1, f"one two three four {x}"), (2, f"one two three four {y}"), (3, f"One two three  four {x}")]
    assert run(spark, docs) == plain(docs) == [(1, 1, 1, True), (2, 1, 2, True), (3, 1, 1, False)]


def test_exact_sets_are_those_of_the_words():
    docs = made_up(50)
    got, want = exact_sets([None if t is None else t.encode() for _, t in docs]), sets_of(docs)
    assert [len(x) for x in got] == [len(x) for x in want]
    assert all(len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j]) for i in range(len(docs)) for j in range(i))
    assert [len(x) for x in exact_sets([])] == []

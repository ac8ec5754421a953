import math

import numpy as np
import pytest
from helpers import components

from siltbed.llm import embedding_dedup as ed
from siltbed.llm.embedding_dedup import Codes, near_vectors, plan_tables


def plain(rows, cosine):
    fine = [i for i, (_, e) in enumerate(rows) if e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    links, edges = {i: 0 for i in range(len(rows))}, []
    for a in fine:
        for b in fine:
            if a != b and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[a] += 1
                    edges.append((rows[a][0], rows[b][0]))
    c = components({r[0] for r in rows}, edges)
    return sorted((v, links[i], c[v], c[v] == v) for i, (v, _) in enumerate(rows))


def vectors(n=150, dim=16, seed=1):
    rnd = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.5:
            base = np.array(rows[rnd.integers(len(rows))][1])
            v = base + rnd.normal(size=dim) * rnd.choice([0, 0.01, 0.1, 0.3])
        else:
            v = rnd.normal(size=dim) * rnd.choice([1, 50])
        rows.append((int(i * 7 % 1009), [float(np.float32(x)) for x in v]))
    return rows


@pytest.mark.parametrize("block", [1024, 8])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ed, "BUCKET", block)
    rows = vectors()
    rows += [(2000, [0.0] * 16), (2001, [float("nan")] * 16), (2002, [1.0, None] * 8), (2003, None), (2004, []), (2005, [float("inf")] + [1.0] * 15)]
    rows += [(3000 + i, [0.5, 0.25]) for i in range(40)] + [(4000, [1.0, 0.5]), (4001, [-0.0, 1.0]), (4002, [0.0, 1.0])]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted(map(tuple, got)) == plain(rows, 0.9)


def test_estimates_are_unbiased_and_bounded():
    c, rnd = Codes(32, 30, 10), np.random.default_rng(3)
    x = c.unit(rnd.normal(size=(400, 32)))
    y = c.unit(x + 0.3 * rnd.normal(size=(400, 32)))
    code, factor = c.encode(c.rotate(x))
    bound = np.array([c.upper(code[i : i + 1], factor[i : i + 1], c.rotate(y[i : i + 1]))[0, 0] for i in range(400)])
    true = (x * y).sum(axis=1)
    error = ed.SIGMAS * np.sqrt((1 - factor**2) / factor**2 / (c.bits - 1))
    assert (bound >= true).all() and abs((bound - error - true).mean()) < 0.01


def test_tables_miss_little():
    for n in (10, 10**4, 10**8):
        tables, width = plan_tables(n, 0.9)
        assert (1 - (1 - math.acos(0.9) / math.pi) ** width) ** tables <= 1e-3


def test_repeated_ids_empty_tables_and_clashing_names(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "x"), (1, [1.0, 2.0], "y"), (2, [2.0, 4.0], "z")], "vec_id long, embedding array<float>, e string")
    assert sorted(map(tuple, near_vectors(df).collect())) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]
    assert near_vectors(df.where("false")).count() == 0


def test_rows_without_an_id_link_others(spark):
    at = lambda degrees, size=1.0: [size * math.cos(math.radians(degrees)), size * math.sin(math.radians(degrees))]
    rows = [(5, at(0)), (None, at(20)), (3, at(40)), (None, at(120)), (None, at(130)), (8, at(200)), (8, at(260)), (7, at(210)), (9, at(250)), (9, at(250))]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = [(5, 1, 3, False), (None, 2, 3, True), (3, 1, 3, True), (None, 1, None, True), (None, 1, None, True)]
    want += [(8, 1, 7, False), (8, 2, 7, False), (7, 1, 7, True), (9, 2, 7, False), (9, 2, 7, False)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("few", [3, 48])
def test_all_pairs_of_groups(monkeypatch, few):
    monkeypatch.setattr(ed, "FEW", few)
    cut = np.cumsum([0, 1, 2, 150, 3, 7, 1, 4])
    got = sorted((int(x), int(y)) for p, q in ed._pairs_in(cut) for x, y in zip(p, q, strict=True))
    assert got == [(x, y) for a, b in zip(cut, cut[1:], strict=False) for x in range(a, b) for y in range(x + 1, b)]


def test_codes_of_near_vectors_differ_little_and_bands_tell_earlier_meetings():
    c, rnd = Codes(64, 20, 7), np.random.default_rng(5)
    x = c.unit(rnd.normal(size=(3000, 64)))
    noise = rnd.normal(size=(3000, 64))
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + math.sqrt(1 - 0.81) * c.unit(noise)  # cosine 0.9
    a, b = (c.encode(c.rotate(v))[0] for v in (x, y))
    far = np.bitwise_count(a ^ b).sum(axis=1)
    assert far.max() <= c.most_different(0.9) < c.bits // 3
    assert abs(far.mean() / c.bits - math.acos(0.9) / math.pi) < 0.002
    assert c.bits == 256  # however many tables there are
    u, v = c.bands(x), c.bands(y)
    p, q = np.packbits(u, axis=1), np.packbits(v, axis=1)
    same = c.keys(u) == c.keys(v)
    for t in (0, 1, 13, 20):
        size = -(-t * 7 // 8)
        assert (ed.met_before(p[:, :size], q[:, :size], t, 7) == same[:, :t].any(axis=1)).all()


def test_a_large_group_of_near_copies(spark):
    rnd = np.random.default_rng(2)
    base = rnd.normal(size=12)
    rows = [(i, [float(z) for z in base + rnd.normal(size=12) * 0.02 * (i % 5)]) for i in range(120)] + [(500 + i, [float(z) for z in rnd.normal(size=12)]) for i in range(40)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, got)) == plain(rows, 0.9)

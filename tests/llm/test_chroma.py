import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.llm import chroma as ch


def tune(seed, notes=40, note=600):
    rnd = np.random.default_rng(seed)
    hz = np.repeat(110 * 2 ** (rnd.integers(0, 36, notes) / 12), note)
    return 0.5 * np.sin(2 * np.pi * np.cumsum(hz) / ch.RATE)


def test_areas_of_the_integral_image_give_the_filters():
    x = tune(1)
    c = ch.chroma(x)
    got = ch.fingerprint(x)
    assert len(got) == len(c) - ch.WIDEST + 1
    for t in (0, 7, len(got) - 1):
        want = 0
        for add, take in ch._FILTERS:
            mean = lambda rs: np.concatenate([c[t + a : t + a + w, p : p + h].ravel() for a, p, w, h in rs]).mean()
            v = math.log((1 + 4 * mean(add)) / (1 + 4 * mean(take)))
            want = want << 2 | int(ch._GRAY[sum(v >= k for k in ch.CUTS)])
        assert want == got[t]
    assert all(a + w <= ch.WIDEST and p + h <= ch.PITCHES for r in ch._FILTERS for side in r for a, p, w, h in side)


def test_wav_forms():
    x = tune(2)
    assert np.allclose(ch.read_wav(ch.write_wav(x)), x, atol=1e-3)
    assert len(ch.read_wav(None)) == len(ch.read_wav(b"RIFFxxxx")) == len(ch.read_wav(b"")) == 0


def test_alignment_finds_the_offset():
    x = tune(3, notes=80)
    late = np.concatenate([tune(4, notes=13)[: ch.HOP * 14], x]) + np.random.default_rng(1).normal(size=ch.HOP * 14 + len(x)) * 0.005
    a, b = ch.fingerprint(x), ch.fingerprint(late)
    offset, votes, errors = ch.align(a, b)
    assert offset == 14 and votes > 20 and errors < 0.1
    other = ch.align(a, ch.fingerprint(tune(9, notes=80)))
    assert other is None or other[1] < votes / 4
    assert ch.align(a, a)[2] == 0 and ch.bit_errors(a[:2], a, 10**6) == 1.0


@pytest.mark.parametrize("blocks", [(4096, 1024), (7, 3)])
def test_matches_against_pairwise_alignment(spark, monkeypatch, blocks):
    monkeypatch.setattr(ch, "RECORDINGS", blocks[0])
    monkeypatch.setattr(ch, "QUERIES", blocks[1])
    rnd = np.random.default_rng(6)
    audio = {}
    for i in range(36):
        x = tune(100 + i // 3)
        audio[i] = ch.write_wav(np.concatenate([np.zeros(ch.HOP * int(rnd.integers(0, 5))), x]) + 0)
    audio |= {100: None, 101: b"broken", 102: ch.write_wav(np.zeros(20000)), 103: ch.write_wav(np.zeros(100))}
    df = spark.createDataFrame([(i, None if a is None else bytearray(a), "x") for i, a in audio.items()], "id long, audio binary, f string")
    prints = ch.fingerprints(df)
    got = sorted(map(tuple, ch.matches(prints, F.col("id") % 2 == 0).collect()))
    f = {i: ch.fingerprint(ch.read_wav(a)) for i, a in audio.items()}
    want = []
    for q in f:
        for r in f:
            if q % 2 == 0 and q != r and (m := ch.align(f[q], f[r])) and m[1] >= 4 and m[2] <= 0.25:
                want.append((q, r, *m))
    assert [x[:4] for x in got] == [x[:4] for x in sorted(want)] and np.allclose([x[4] for x in got], [x[4] for x in sorted(want)])
    assert len(got) >= 30 and ch.matches(prints.where("false"), F.col("id") % 2 == 0).count() == 0


def test_vectors_as_sound(spark):
    a = ch.sound_of([0.1] * 64)
    assert a == ch.sound_of([0.1] * 64) and ch.sound_of(None) is None and ch.sound_of([]) is None
    assert len(ch.read_wav(ch.sound_of([float("nan"), None, 0.5] * 30))) == 90 * 480
    rnd = np.random.default_rng(1)
    rows = []
    for i in range(60):
        v = rnd.normal(size=64) / 8
        rows += [(3 * i, v.tolist()), (3 * i + 1, (v + rnd.normal(size=64) * 0.005).tolist())]
    rows += [(1001, None), (1002, []), (1003, [float("nan")] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    prints = ch.fingerprints(df, "embedding", read=lambda v: ch.read_wav(ch.sound_of(v))).withColumnRenamed("vec_id", "id")
    got = {(r["query_id"], r["id"]) for r in ch.matches(prints, F.col("id") % 2 == 0).collect()}
    near = {(q, r) for i in range(60) for q, r in ((3 * i, 3 * i + 1), (3 * i + 1, 3 * i)) if q % 2 == 0}
    assert len(got & near) >= 0.9 * len(near)


def wav_at(rate, x, channels=1):
    import io
    import wave

    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(np.repeat((np.clip(x, -1, 1) * 32767).astype("<i2"), channels).tobytes())
    return out.getvalue()


@pytest.mark.parametrize("rate, channels", [(44100, 2), (16000, 1), (6000, 1)])
def test_rates_agree(rate, channels):
    rnd = np.random.default_rng(3)
    pitches = 110 * 2 ** (rnd.integers(0, 36, 40) / 12)

    def sound(at):
        hz = np.repeat(pitches, round(600 * at / ch.RATE))
        x = 0.3 * np.sin(2 * np.pi * np.cumsum(hz) / at)
        if at > 2 * ch.RATE:  # tones that 8 kHz can't hold: they would alias to 900 and 1300 Hz
            t = np.arange(len(x)) / at
            x = x + 0.3 * np.sin(2 * np.pi * 8900 * t) + 0.3 * np.sin(2 * np.pi * 9300 * t)
        return x

    a, b = ch.fingerprint(sound(ch.RATE)), ch.fingerprint(ch.read_wav(wav_at(rate, sound(rate), channels)))
    offset, votes, errors = ch.align(a, b)
    assert offset == 0 and votes > len(a) / 3 and errors < 0.06


def plain_align(q, r):
    """(offset, votes, bit error rate) by counting pairs of equal integers in a dictionary, or None."""
    votes = {}
    for i, x in enumerate(q):
        for j, y in enumerate(r):
            if x == y:
                votes[j - i] = votes.get(j - i, 0) + 1
    if not votes:
        return None
    offset = min(votes, key=lambda o: (-votes[o], abs(o), o))
    over = [(x, r[i + offset]) for i, x in enumerate(q) if 0 <= i + offset < len(r)]
    return offset, votes[offset], sum((x ^ y).bit_count() for x, y in over) / (32 * len(over))


def test_the_whole_query_against_a_plain_version(spark, tmp_path):
    import hashlib

    rnd = np.random.default_rng(8)
    base = rnd.normal(size=(6, 64)) / 8
    rows = {i: (base[i % 6] + rnd.normal(size=64) * 0.002 * (i % 4)).tolist() for i in range(42)}
    rows |= {60: None, 61: [], 80: rows[3], 81: [float("nan")] * 64, 100: [0.0] * 64, 101: rnd.normal(size=200).tolist(), 120: (rnd.normal(size=64) / 8).tolist()}
    spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r for r in ch.op6_chroma_fingerprints(spark, str(tmp_path)).collect()}
    prints = {i: ch.fingerprint(ch.read_wav(ch.sound_of(v))).tolist() for i, v in rows.items()}
    signed = lambda x: x - (1 << 32) if x >> 31 else x
    assert got.keys() == rows.keys()
    for i, p in prints.items():
        r = got[i]
        text = ",".join(str(signed(x)) for x in p)
        assert (r["n_ints"], r["print_sha256"], r["is_query"]) == (len(p), hashlib.sha256(text.encode()).hexdigest(), i % 20 == 0)
        found = []
        if i % 20 == 0:
            for j, other in prints.items():
                m = plain_align(p, other) if j != i else None
                if m and m[1] >= 4 and m[2] <= 0.25:
                    found.append((m[2], j, m[0]))
        assert r["n_matches"] == len(found)
        if found:
            errors, best, offset = min(found)
            assert (r["best_id"], r["best_offset"]) == (best, offset) and abs(r["best_errors"] - errors) < 1e-12
        else:
            assert r["best_id"] is r["best_offset"] is r["best_errors"] is None
    assert got[0]["n_matches"] >= 4 and got[80]["best_errors"] == 0 and got[120]["n_matches"] == 0

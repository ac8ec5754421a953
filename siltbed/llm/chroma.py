"""Media columns: chroma audio fingerprints, integral-image filters over pitch-class frames, aligned by offset histograms."""

from __future__ import annotations

import io
import math
import wave
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bound_batches, parts
from .near_dup import _grouped

#: Samples a second that audio is brought to, samples of a frame and between frames, lowest and highest pitch in Hz.
RATE, FRAME, HOP, LOW_HZ, HIGH_HZ = 8000, 2048, 512, 55.0, 3520.0
PITCHES = 12
#: Frames that the widest filter spans.
WIDEST = 12
#: Frames whose spectra are worked out at once, so few that they stay in the cache.
AT_ONCE = 32
#: Rows of a block of recordings and of a block of queries.
RECORDINGS, QUERIES = 4096, 1024


def _without_highs(x: np.ndarray, rate: int) -> np.ndarray:
    """x without what RATE can't hold, which would come back as other pitches: a windowed sinc, in blocks."""
    reach = math.ceil(12 * rate / RATE)
    t = np.arange(-reach, reach + 1)
    taps = np.sinc(0.9 * RATE / rate * t) * np.hamming(len(t))
    taps /= taps.sum()
    padded = np.pad(x, reach)
    return np.concatenate([np.convolve(padded[a : a + (1 << 16) + 2 * reach], taps, "valid") for a in range(0, len(x), 1 << 16)])


def read_wav(data: bytes | None) -> np.ndarray:
    """Mono samples in [-1, 1] at RATE; none if data is null or no PCM WAV file. Other rates are low-passed and interpolated."""
    try:
        with wave.open(io.BytesIO(data or b"")) as f:
            wide, channels, rate, frames = f.getsampwidth(), f.getnchannels(), f.getframerate(), f.readframes(f.getnframes())
    except (wave.Error, EOFError):
        return np.zeros(0)
    if wide == 1:
        x = (np.frombuffer(frames, np.uint8).astype(np.float64) - 128) / 128
    elif wide == 3:
        b = np.frombuffer(frames[: len(frames) // 3 * 3], np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8) / float(1 << 23)
    else:
        x = np.frombuffer(frames[: len(frames) // wide * wide], f"<i{wide}").astype(np.float64) / float(1 << (8 * wide - 1))
    x = x[: len(x) // channels * channels].reshape(-1, channels).mean(axis=1)
    if rate != RATE and len(x):
        if rate > RATE:
            x = _without_highs(x, rate)
        x = np.interp(np.arange(0, len(x) / rate, 1 / RATE), np.arange(len(x)) / rate, x)
    return x


def write_wav(x: np.ndarray) -> bytes:
    """16-bit mono WAV bytes of samples at RATE."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(RATE)
        f.writeframes((np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def _pitch_map() -> np.ndarray:
    """(bins, PITCHES): which pitch class each bin of the spectrum adds to."""
    hz = np.fft.rfftfreq(FRAME, 1 / RATE)
    use = (hz >= LOW_HZ) & (hz <= HIGH_HZ)
    m = np.zeros((len(hz), PITCHES))
    m[np.flatnonzero(use), np.round(PITCHES * np.log2(hz[use] / 440.0)).astype(int) % PITCHES] = 1
    return m


_MAP, _HAMMING = _pitch_map(), np.hamming(FRAME)


def chroma(x: np.ndarray) -> np.ndarray:
    """(frames, PITCHES): energy of each pitch class, smoothed over five frames and scaled to length 1; silence is 0."""
    if len(x) < FRAME:
        return np.zeros((0, PITCHES))
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    spectra = (np.fft.rfft(frames[a : a + AT_ONCE] * _HAMMING) for a in range(0, len(frames), AT_ONCE))
    e = np.concatenate([(z.real**2 + z.imag**2) @ _MAP for z in spectra])
    kernel = np.array([0.25, 0.75, 1.0, 0.75, 0.25])
    padded = np.pad(e, ((2, 2), (0, 0)), mode="edge")
    e = sum(k * padded[i : i + len(e)] for i, k in enumerate(kernel))
    norm = np.sqrt((e * e).sum(axis=1, keepdims=True))
    return np.where(norm > 1e-2, e / np.maximum(norm, 1e-12), 0.0)


def _filters() -> list[tuple[list, list]]:
    """Sixteen filters: (rectangles added, rectangles taken away), each (frame, pitch, frames, pitches).

    By rule: the halves in pitch, in time, both crosswise, and the middle against the sides, at places and widths that go
    round the pitch classes and the frames.
    """
    out = []
    for i in range(16):
        kind, wide = i % 4, (4, 6, 8, 12)[i // 4]
        high = (2, 4, 6, 4)[(i + i // 4) % 4]
        at = (3 * i + i // 4) % (PITCHES - high + 1)
        h, w = high // 2, wide // 2
        if kind == 0:
            out.append(([(0, at, wide, h)], [(0, at + h, wide, high - h)]))
        elif kind == 1:
            out.append(([(0, at, w, high)], [(w, at, wide - w, high)]))
        elif kind == 2:
            out.append(([(0, at, w, h), (w, at + h, wide - w, high - h)], [(0, at + h, w, high - h), (w, at, wide - w, h)]))
        else:
            third = max(1, wide // 3)
            out.append(([(third, at, wide - 2 * third, high)], [(0, at, third, high), (wide - third, at, third, high)]))
    return out


_FILTERS = _filters()
#: A filter's value is log((1 + added) / (1 + taken away)); these cuts make it two bits, in Gray code.
CUTS = (-0.12, 0.0, 0.12)
_GRAY = np.array([0, 1, 3, 2], np.uint32)


def fingerprint(x: np.ndarray) -> np.ndarray:
    """Packed 32-bit integers, one for each frame from which the widest filter fits."""
    c = chroma(x)
    n = len(c) - WIDEST + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    image = np.zeros((len(c) + 1, PITCHES + 1))
    image[1:, 1:] = c.cumsum(axis=0).cumsum(axis=1)

    def area(t, p, frames, pitches):
        a, b = image[t : t + n], image[t + frames : t + frames + n]
        return b[:, p + pitches] - b[:, p] - a[:, p + pitches] + a[:, p]

    out = np.zeros(n, np.uint32)
    for add, take in _FILTERS:
        # mean energies, so that rectangles of different sizes compare
        up = sum(area(*r) for r in add) / sum(r[2] * r[3] for r in add)
        down = sum(area(*r) for r in take) / sum(r[2] * r[3] for r in take)
        out = (out << np.uint32(2)) | _GRAY[np.digitize(np.log((1 + 4 * up) / (1 + 4 * down)), CUTS)]
    return out


def align(q: np.ndarray, r: np.ndarray) -> tuple[int, int, float] | None:
    """(offset, votes, bit error rate) of two fingerprints: the offset of q in r at which most integers agree, the one
    nearest 0 of equals; None if no integer agrees."""
    kinds, at = np.unique(r, return_inverse=True)
    by = np.argsort(at, kind="stable")
    cut = np.searchsorted(at[by], np.arange(len(kinds) + 1))
    k = np.searchsorted(kinds, q)
    pairs = [by[cut[x] : cut[x + 1]] - i for i, x in enumerate(k) if x < len(kinds) and kinds[x] == q[i]]
    if not pairs:
        return None
    offset, votes = np.unique(np.concatenate(pairs), return_counts=True)
    best = np.lexsort((offset, np.abs(offset), -votes))[0]
    return int(offset[best]), int(votes[best]), bit_errors(q, r, int(offset[best]))


def bit_errors(q: np.ndarray, r: np.ndarray, offset: int) -> float:
    """Share of differing bits where q, moved by offset, lies over r."""
    a, b = max(0, -offset), min(len(q), len(r) - offset)
    return float(np.bitwise_count(q[a:b] ^ r[a + offset : b + offset]).sum()) / (32 * (b - a)) if b > a else 1.0


def fingerprints(media: DataFrame, audio: str = "audio", to: str = "fingerprint", read: Callable = read_wav) -> DataFrame:
    """media with a column of packed integers (array<int>, the bits of 32-bit words) for its column of WAV bytes.

    Null, broken and too short recordings have an empty fingerprint; recordings are read whole, one at a time. ``read`` turns
    a value of the column into samples at RATE, for columns that hold something else.
    """

    bound_batches(media.sparkSession)

    @F.arrow_udf("array<int>")
    def run(data: pa.Array) -> pa.Array:
        return pa.array([fingerprint(read(x.as_py())).view(np.int32) for x in data], pa.list_(pa.int32()))

    # not to be worked out twice for a filter on the result
    return media.withColumn(to, run.asNondeterministic()(audio))


def matches(prints: DataFrame, is_query, least_votes: int = 4, most_errors: float = 0.25) -> DataFrame:
    """(query_id, id, offset, votes, errors): of each query (rows where is_query holds) the other recordings that align with it.

    prints has (id, fingerprint). A stated set of queries meets all recordings in blocks: in a unit of one block of each,
    the integers of the recordings are an index, the queries' integers are looked up in it, and what agrees is summed up by
    (query, recording, offset) inside the task. The best offset needs ``least_votes`` equal integers and a bit error rate of
    ``most_errors`` at most. Rows with the same id are different recordings, but a recording doesn't match its own id.
    Empty fingerprints and null ids match nothing.
    """
    spark = prints.sparkSession
    scratch, n_parts = Scratch(spark, "chroma"), parts(spark)
    rows, seen = scratch.observed(prints.select(F.col("id").cast("long").alias("id"), F.col("fingerprint").alias("f"), is_query.alias("is_query")).where("id is not null and size(f) > 0"), "prints", n=F.count(F.lit(1)), q=F.count_if("is_query"))
    n_rec, n_query = max(1, math.ceil(seen["n"] / RECORDINGS)), max(1, math.ceil(seen["q"] / QUERIES))
    block = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(n_rec)).cast("int")
    recs = rows.select(F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))).alias("q"), block.alias("r"), F.lit(False).alias("is_query"), "id", "f")
    asked = rows.where("is_query").select(F.pmod(F.xxhash64("id", F.lit(4)), F.lit(n_query)).cast("int").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(n_rec - 1))).alias("r"), F.lit(True).alias("is_query"), "id", "f")

    def compare(batches):
        for t, cut in _grouped(batches, ["q", "r"]):
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                part = t.slice(a, b - a)
                ask = part.column("is_query").to_numpy(zero_copy_only=False)
                ids = part.column("id").to_numpy()
                f = part.column("f").combine_chunks()
                ends = np.asarray(f.offsets)
                values = np.asarray(f.values).view(np.uint32)
                length = np.diff(ends)
                owner = np.repeat(np.arange(len(ids)), length)
                flat = values[ends[0] : ends[-1]]
                place = np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], length)
                rec = np.flatnonzero(~ask[owner])
                rec = rec[np.argsort(flat[rec], kind="stable")]
                keys = flat[rec]
                out = []
                for q in np.flatnonzero(ask):
                    own = flat[ends[q] - ends[0] : ends[q + 1] - ends[0]]
                    lo, hi = np.searchsorted(keys, own, side="left"), np.searchsorted(keys, own, side="right")
                    n = hi - lo
                    if not n.any():
                        continue
                    hit = rec[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
                    shift = place[hit] - np.repeat(np.arange(len(own)), n)
                    vote, count = np.unique((owner[hit].astype(np.int64) << 32) + (shift + (1 << 31)), return_counts=True)
                    who, off = vote >> 32, (vote & 0xFFFFFFFF) - (1 << 31)
                    order = np.lexsort((off, np.abs(off), -count, who))
                    first = order[np.concatenate([[True], who[order][1:] != who[order][:-1]])]
                    for x in first[(count[first] >= least_votes) & (ids[who[first]] != ids[q])]:
                        r = who[x]
                        e = bit_errors(own, flat[ends[r] - ends[0] : ends[r + 1] - ends[0]], int(off[x]))
                        if e <= most_errors:
                            out.append((ids[q], ids[r], off[x], count[x], e))
                if out:
                    cols = list(zip(*out, strict=True))
                    yield pa.record_batch([*(pa.array(np.array(c, np.int64)) for c in cols[:4]), pa.array(np.array(cols[4], np.float64))], names=["query_id", "id", "offset", "votes", "errors"])

    dealt = recs.union(asked).repartition(n_parts, "q", "r").sortWithinPartitions("q", "r")
    return dealt.mapInArrow(compare, "query_id long, id long, offset long, votes long, errors double")


def sound_of(vector: list | None, note: int = 480) -> bytes | None:
    """WAV bytes that sound out a vector's components one after the other; None for null or empty vectors.

    The tables hold no media, so this makes recordings of them: equal vectors give equal ones, near vectors mostly the same
    notes. A component over the root mean square of all, rounded, sets the pitch in steps of five semitones around 440 Hz;
    missing and non-finite ones are silent.
    """
    v = np.array([math.nan if y is None else y for y in (() if vector is None else vector)], np.float64)
    if not len(v):
        return None
    fine = np.isfinite(v)
    v = np.where(fine, v, 0.0)
    scale = math.sqrt(float((v / max(1e-300, np.abs(v).max())) @ (v / max(1e-300, np.abs(v).max()))) / len(v)) * np.abs(v).max()
    semitone = np.clip(5 * np.round(v / scale), -24, 24) if scale > 0 else np.zeros(len(v))
    hz = np.repeat(440.0 * 2 ** (semitone / 12), note)
    return write_wav(0.5 * np.sin(2 * np.pi * np.cumsum(hz) / RATE) * np.repeat(fine, note))


def op6_chroma_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of the recordings made of all embeddings; vec_ids divisible by 20 are the queries, against all rows.

    One row a recording: vec_id, n_ints, print_sha256 (of its integers in decimal, joined by commas), is_query, n_matches,
    best_id, best_offset, best_errors (null without a match).
    """
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    scratch = Scratch(spark, "op6")
    heard = fingerprints(vectors, "embedding", read=lambda v: read_wav(sound_of(v)))
    prints = scratch.save(heard.select(F.col("vec_id").alias("id"), "fingerprint"), "prints")
    is_query = F.col("id") % 20 == 0
    found = matches(prints, is_query).groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("errors", F.col("id").alias("best"), "offset")).alias("b"))
    sha = F.sha2(F.array_join(F.col("fingerprint").cast("array<string>"), ","), 256)
    out = prints.join(found, "id", "left")
    return out.select(F.col("id").alias("vec_id"), F.size("fingerprint").cast("long").alias("n_ints"), sha.alias("print_sha256"), is_query.alias("is_query"), F.coalesce("n", F.lit(0)).cast("long").alias("n_matches"), F.col("b.best").alias("best_id"), F.col("b.offset").alias("best_offset"), F.col("b.errors").alias("best_errors"))

"""Embedding near-dedup: randomised-rotation binary codes, unbiased estimates, exact cosines only where the bounds allow a link."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, components, parts
from .near_dup import _grouped, spanning_forest

#: Members of a bucket that one task compares; larger ones are split in blocks.
BUCKET = 1024
#: Standard deviations of the estimate's error that the confidence bounds span.
SIGMAS = 5.0


#: Bits of a code for each dimension.
BITS = 4


class Codes:
    """Binary codes of unit vectors: the signs of their rotation into ``bits`` dimensions, and bands of further signs.

    With z the rotated vector and s its signs, s / sqrt(bits) is the code's vector and factor = sum(abs(z)) / sqrt(bits) its
    inner product with z. For another rotated unit vector y, (s . y) / sqrt(bits) / factor is an unbiased estimate of z . y,
    whose error has a standard deviation of at most sqrt((1 - factor**2) / factor**2 / (bits - 1)). The share of bits in which two
    codes differ is an unbiased estimate of their angle over pi, with less than a binomial's deviation.

    Bands are ``tables`` groups of ``width`` signs along random directions of their own, so how many tables there are doesn't make codes longer.
    """

    def __init__(self, dim: int, tables: int, width: int, seed: int = 11):
        self.dim, self.tables, self.width = dim, tables, width
        self.bits = 64 * -(-BITS * dim // 64)
        rng = np.random.default_rng((seed, dim, self.bits))
        self.rotation = np.linalg.qr(rng.standard_normal((self.bits, dim)))[0]
        self.directions = rng.standard_normal((dim, tables * width)).astype(np.float32)

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.sqrt((x * x).sum(axis=1, keepdims=True))

    def rotate(self, units: np.ndarray) -> np.ndarray:
        return units @ self.rotation.T

    def encode(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Packed signs and correction factors."""
        return np.packbits(z > 0, axis=1), np.abs(z).sum(axis=1) / math.sqrt(self.bits)

    def signs(self, packed: np.ndarray) -> np.ndarray:
        return np.unpackbits(packed, axis=1)[:, : self.bits].astype(np.float32) * 2 - 1

    def bands(self, units: np.ndarray) -> np.ndarray:
        """(n, tables * width) signs."""
        return units.astype(np.float32) @ self.directions > 0

    def keys(self, bands: np.ndarray) -> np.ndarray:
        """(n, tables) integers of ``width`` bits each."""
        return bands.reshape(len(bands), self.tables, self.width) @ (1 << np.arange(self.width, dtype=np.int64))

    def most_different(self, cosine: float) -> int:
        """Bits in which codes of vectors with this cosine differ at most, within the confidence bound."""
        p = math.acos(cosine) / math.pi
        return math.ceil(self.bits * p + SIGMAS * math.sqrt(self.bits * p * (1 - p)))

    def upper(self, packed: np.ndarray, factor: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Upper confidence bounds of all inner products, from the codes of rows and the vectors of columns."""
        estimate = (self.signs(packed) @ z.T.astype(np.float32)) / (math.sqrt(self.bits) * factor)[:, None]
        error = SIGMAS * np.sqrt(np.maximum(0.0, 1 - factor**2) / factor**2 / (self.bits - 1))
        return estimate + error[:, None] + 1e-5


def plan_tables(n: int, cosine: float, miss: float = 1e-3) -> tuple[int, int]:
    """(tables, width): buckets of a few vectors each, and so many tables that a pair at the threshold shares none of them
    with probability ``miss``; closer pairs are missed far less."""
    width = int(min(24, max(6, round(math.log2(max(2, n))) - 4)))
    same = 1 - math.acos(cosine) / math.pi
    return math.ceil(math.log(miss) / math.log(1 - same**width)), width


def met_before(x: np.ndarray, y: np.ndarray, tables: int, width: int) -> np.ndarray:
    """Which pairs of packed bands (n, bytes) agree in all bits of one of the first ``tables`` tables."""
    out = np.zeros(len(x), bool)
    if tables:
        for at in range(0, len(x), 1 << 14):
            differ = np.unpackbits(x[at : at + (1 << 14)] ^ y[at : at + (1 << 14)], axis=1)[:, : tables * width]
            out[at : at + (1 << 14)] = ~differ.reshape(len(differ), tables, width).any(axis=2).all(axis=1)
    return out


def _packed(col: pa.ChunkedArray, size: int) -> np.ndarray:
    """(n, size) bytes of a binary column, short ones filled up with zeros."""
    return np.frombuffer(b"".join([x.ljust(size, b"\0") for x in col.to_pylist()]), np.uint8).reshape(-1, size)


#: Buckets up to this size are compared together, a difference in place at a time; larger ones one by one.
FEW = 48


def _pairs_in(cut: np.ndarray):
    """(a, b) places of all pairs in each group [cut[g], cut[g + 1]), some at a time."""
    size = np.diff(cut)
    group = np.repeat(np.arange(len(size)), size)
    few = np.repeat(size <= FEW, size)
    for d in range(1, min(FEW, len(group))):
        a = np.flatnonzero(few[:-d] & (group[:-d] == group[d:]))
        if not len(a):
            break
        yield a, a + d
    for g in np.flatnonzero(size > FEW):
        for x in range(cut[g], cut[g + 1], 64):
            p, q = np.meshgrid(np.arange(x, min(x + 64, cut[g + 1])), np.arange(cut[g], cut[g + 1]), indexing="ij")
            keep = p < q
            yield p[keep], q[keep]


def _flat(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column of vectors."""
    a = col.combine_chunks()
    return a.values.to_numpy(zero_copy_only=False), a.offsets.to_numpy()


def near_vectors(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each row of vectors (vec_id, embedding, ...).

    Vectors link if their cosine in double precision is ``cosine`` or more; n_links counts the other rows linked directly,
    component_id is the smallest vec_id reachable, itself included, kept is vec_id = component_id.

    Equal vectors are one node with a multiplicity. A node's code goes to one bucket in each of several tables, keyed by its bands.
    In a bucket, codes that differ in more bits than the confidence bound allows can't link; the others go on, if this is the first
    table where they meet, which both bands show. Only such nodes have their vectors sent there, where codes and
    correction factors bound the inner products, and pairs whose bounds reach the threshold are recomputed exactly. What leaves a task is
    a sum for each vector and a spanning forest, never the pairs. Buckets beyond a fixed size are cut in blocks, and every pair of
    blocks is a unit of its own.

    Null, empty and zero vectors and vectors with null or non-finite components link with nothing, vectors of different
    length neither. Rows of one vec_id are rows of their own in one component. A row without vec_id counts as a link of others and
    joins them, has the component_id that it reaches or null if it reaches none, and is kept. An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    scratch, n_parts = Scratch(spark, "embedding-dedup"), parts(spark)
    given = vectors.schema["embedding"].dataType.elementType
    kind = "float" if isinstance(given, T.FloatType) else "double"  # floats travel as floats, cosines are of doubles
    # -0.0 + 0.0 is 0.0, so vectors that differ in the sign of a zero are equal
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast(kind) + F.lit(0.0).cast(kind)).alias("e"))
    fine = F.col("e").isNotNull() & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("e", lambda x: x != 0)
    rows = rows.withColumn("e", F.when(F.coalesce(fine, F.lit(False)), F.col("e")))
    classes = rows.where("e is not null").groupBy("e").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("m"))
    # vec_id may be null or in several classes, so a class has an id of its own; it is written once and read from there
    classes, seen = scratch.observed(classes.withColumn("id", F.monotonically_increasing_id()), "classes", n=F.count(F.lit(1)))
    tables, width = plan_tables(seen["n"], cosine)

    def encode(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            dims = np.diff(_flat(t.column("e"))[1])
            for d in np.unique(dims):
                part = t.filter(pa.array(dims == d))
                c = Codes(int(d), tables, width)
                values, ends = _flat(part.column("e"))
                units = c.unit(values[ends[0] : ends[-1]].reshape(-1, d))
                code, factor = c.encode(c.rotate(units))
                bands = c.bands(units)
                binary = lambda rows: pa.array([x.tobytes() for x in rows], pa.binary())
                yield pa.record_batch(
                    [*(part.column(x).combine_chunks() for x in ("id", "m", "e")), pa.array(np.full(len(part), d), pa.int32()), binary(code), pa.array(factor, pa.float64()), binary(np.packbits(bands, axis=1)), pa.array(list(c.keys(bands)), pa.list_(pa.int64()))],
                    names=["id", "m", "e", "dim", "code", "factor", "signs", "bands"],
                )

    coded = scratch.save(classes.select("id", "m", "e").mapInArrow(encode, f"id long, m long, e array<{kind}>, dim int, code binary, factor double, signs binary, bands array<long>"), "codes")
    placed = coded.select("id", "dim", "code", "signs", F.posexplode("bands").alias("t", "band"))
    shared = coded.select("dim", F.posexplode("bands").alias("t", "band")).groupBy("dim", "t", "band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    units = placed.join(shared, ["dim", "t", "band"]).withColumn("nb", F.ceil(F.col("n") / BUCKET).cast("int"))
    units = units.withColumn("own", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    # of the bands only those of earlier tables are asked for
    earlier = F.expr(f"substring(signs, 1, cast(ceil(t * {width} / 8) as int))").alias("signs")
    units = units.withColumn("u", F.explode(pair)).select("dim", "t", "band", "u.i", "u.j", "own", "id", "code", earlier)
    keys, most = ["dim", "t", "band", "i", "j"], {}

    def meet(batches):
        """The nodes of each unit that have a partner there which may link with them and which they meet nowhere earlier."""
        for t, cut in _grouped(batches, keys):
            dim, table, own = (t.column(c).to_numpy() for c in ("dim", "t", "own"))
            inside = t.column("i").to_numpy() == t.column("j").to_numpy()
            met = np.zeros(len(t), bool)
            # stretches of one dimension and table, so that codes and bands have one length
            edge = np.flatnonzero((dim[cut[1:-1]] != dim[cut[1:-1] - 1]) | (table[cut[1:-1]] != table[cut[1:-1] - 1])) + 1
            for a, b in zip([0, *edge], [*edge, len(cut) - 1], strict=True):
                lo, hi = cut[a], cut[b]
                d, nth = int(dim[lo]), int(table[lo])
                bits = 64 * -(-BITS * d // 64)
                if d not in most:
                    most[d] = Codes(d, 0, width).most_different(cosine)
                part = t.slice(lo, hi - lo)
                code = _packed(part.column("code"), bits // 8).view(np.uint64)
                signs = _packed(part.column("signs"), -(-nth * width // 8)) if nth else None
                for p, q in _pairs_in(cut[a : b + 1] - lo):
                    ok = np.bitwise_count(code[p] ^ code[q]).sum(axis=1, dtype=np.int64) <= most[d]
                    ok &= inside[lo + p] | (own[lo + p] != own[lo + q])  # inside a block its own unit compares
                    p, q = p[ok], q[ok]
                    if nth and len(p):
                        new = ~met_before(signs[p], signs[q], nth, width)
                        p, q = p[new], q[new]
                    met[lo + p] = met[lo + q] = True
            at = np.flatnonzero(met)
            if len(at):
                yield pa.RecordBatch.from_arrays([t.column(c).combine_chunks().take(pa.array(at)) for c in (*keys, "own", "id")], names=[*keys, "own", "id"])

    def compare(batches):
        codes = {}
        for t, cut in _grouped(batches, keys):
            ids, m, own, table = (t.column(c).to_numpy() for c in ("id", "m", "own", "t"))
            code_bytes, sign_bytes = t.column("code"), t.column("signs")
            dim = t.column("dim").to_numpy()
            blocks = np.stack([t.column("i").to_numpy(), t.column("j").to_numpy()], axis=1)
            count, forest = [], []
            # a few thousand rows at once bound what the rotated vectors take
            at = 0
            while at < len(cut) - 1:
                to = max(at + 1, int(np.searchsorted(cut, cut[at] + 4096, side="right")) - 1)
                lo, hi = cut[at], cut[to]
                part = t.slice(lo, hi - lo)
                (x_all, ends), f_all = _flat(part.column("e")), part.column("factor").to_numpy()
                for g in range(at, to):
                    a, b = cut[g] - lo, cut[g + 1] - lo
                    d = int(dim[cut[g]])
                    if d not in codes:
                        codes[d] = Codes(d, tables, width)
                    c = codes[d]
                    x = c.unit(x_all[ends[a] : ends[b]].reshape(b - a, d))
                    code = _packed(code_bytes.slice(cut[g], b - a), c.bits // 8)
                    z, f = c.rotate(x), f_all[a:b]
                    bound = c.upper(code, f, z)
                    maybe = np.triu((bound >= cosine) & (bound.T >= cosine), 1)
                    sl = slice(cut[g], cut[g + 1])
                    if blocks[cut[g], 0] != blocks[cut[g], 1]:  # inside a block its own unit compares
                        maybe &= own[sl, None] != own[None, sl]
                    p, q = np.nonzero(maybe)
                    if not len(p):
                        continue
                    # pairs that met in an earlier table were counted there
                    nth = int(table[cut[g]])
                    signs = _packed(sign_bytes.slice(cut[g], b - a), -(-tables * width // 8))
                    ok = ~met_before(signs[p], signs[q], nth, width)
                    p, q = p[ok], q[ok]
                    if not len(p):
                        continue
                    ok = np.concatenate([np.einsum("ij,ij->i", x[p[s : s + (1 << 16)]], x[q[s : s + (1 << 16)]]) for s in range(0, len(p), 1 << 16)]) >= cosine
                    p, q = p[ok], q[ok]
                    if not len(p):
                        continue
                    own_m = m[sl].astype(np.float64)
                    links = np.bincount(p, own_m[q], b - a) + np.bincount(q, own_m[p], b - a)
                    near = np.zeros((b - a, b - a), bool)
                    near[p, q] = near[q, p] = True
                    hit = np.flatnonzero(links)
                    count.append(np.stack([ids[sl][hit], links[hit].astype(np.int64)], axis=1))
                    forest.append(ids[sl][np.asarray(spanning_forest(near))])
                at = to
            if count:
                c, e = np.concatenate(count), np.concatenate(forest)
                who, back = np.unique(c[:, 0], return_inverse=True)
                total = np.bincount(back, c[:, 1].astype(np.float64)).astype(np.int64)
                e = np.unique(np.stack([e.max(axis=1), e.min(axis=1)], axis=1), axis=0)
                yield pa.record_batch([pa.array(who), pa.nulls(len(who), pa.int64()), pa.array(total)], names=["a", "b", "n"])
                yield pa.record_batch([pa.array(e[:, 0]), pa.array(e[:, 1]), pa.nulls(len(e), pa.int64())], names=["a", "b", "n"])

    dealt = units.repartition(n_parts, *keys).sortWithinPartitions(*keys)
    met = scratch.save(dealt.mapInArrow(meet, "dim int, t int, band long, i int, j int, own int, id long"), "met")
    sent = met.join(coded.select("id", "m", "e", "code", "factor", "signs"), "id").repartition(n_parts, *keys).sortWithinPartitions(*keys)
    found = scratch.save(sent.mapInArrow(compare, "a long, b long, n long"), "found")
    links = found.where("n is not null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    edges = found.where("b is not null").select("a", "b")
    # rows of one vec_id with different vectors hold their classes together
    digest = F.struct(F.xxhash64("e"), F.xxhash64(F.lit(1), "e"))
    several = rows.where("e is not null and vec_id is not null").groupBy("vec_id").agg(F.min(digest).alias("x"), F.max(digest).alias("y")).where("x <> y").select("vec_id")
    if not several.isEmpty():
        held = scratch.save(rows.join(several, "vec_id").join(classes.select("e", "id"), "e").select("vec_id", "id").distinct(), "held")
        edges = edges.union(held.join(held.groupBy("vec_id").agg(F.min("id").alias("b")), "vec_id").where("id <> b").select("id", "b"))
    comp = scratch.save(components(scratch, edges, "linked"), "components")
    # written by itself: the join with it can be broadcast or split
    names = scratch.save(comp.join(classes.select("id", "least"), "id").groupBy("component").agg(F.min("least").alias("c")), "names")
    named = comp.join(names, "component").select("id", "c")
    by_class = classes.join(links, "id", "left").join(named, "id", "left").select("e", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("c", "least").alias("c"))
    out = rows.join(by_class, "e", "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op1_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), 0.9)


OP1_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS id, vec_id AS reach FROM embeddings UNION SELECT r.id, l.b FROM r JOIN l ON r.reach = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT id AS vec_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_links, min(reach) AS component_id, id = min(reach) AS kept
FROM r LEFT JOIN n ON r.id = n.a GROUP BY id
"""

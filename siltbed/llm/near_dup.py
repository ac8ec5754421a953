"""MinHash near-dedup: a multi-index Hamming join over signatures finds candidates, full shingle sets confirm links."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, SureWords, components, contracted, give_back, mix, parts, pieces, raw

#: Slots of a signature (minima of so many hash functions), the bits of each, and those of them that travel for the distance test.
SLOTS, SLOT_BITS, SENT_BITS = 48, 16, 4
#: Members of a bucket or shingles and members of a cluster that one task takes; larger ones are split in blocks.
BUCKET, CLUSTER_DOCS, CLUSTER_SHINGLES, PIVOTS = 2048, 512, 2_000_000, 32

_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
_NIBBLES = np.uint64(0x1111111111111111)


def distance_bound(similarity: float, miss: float = 1e-5) -> int:
    """Least number of differing slots that a pair of this similarity exceeds with probability ``miss`` at most."""
    q, tail, r = 1 - similarity, 1.0, -1
    while tail > miss:
        r += 1
        tail -= math.comb(SLOTS, r) * q**r * (1 - q) ** (SLOTS - r)
    return r


def chunks(bound: int) -> list[range]:
    """Chunks of slots, so many that of ``bound`` differing slots at most one falls in some chunk (pigeonhole)."""
    m = min(SLOTS // 2, bound // 2 + 1)
    cut = [round(i * SLOTS / m) for i in range(m + 1)]
    return [range(a, b) for a, b in zip(cut, cut[1:], strict=False)]


def shingle_sets(texts: list[bytes | None], k: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's k-word shingles; a shorter text is one shingle; no words, none."""
    return [s for s, _ in wide_sets(texts, k)]


def wide_sets(texts: list[bytes | None], k: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct 128-bit hashes of each text's shingles: the first 64 bits, sorted, and the others in the same order."""
    w = SureWords(texts, lower=True)
    g, more = w.grams(k), w.more_of_grams(k)
    out = []
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= k:
            kinds, at = np.unique(g[a : b - k + 1], return_index=True)
            out.append((kinds, more[a : b - k + 1][at]))
        elif b > a:
            d = np.frombuffer(hashlib.blake2b(np.stack([w.hash[a:b], w.more[a:b]]).tobytes(), digest_size=16).digest(), np.uint64)
            out.append((d[:1], d[1:]))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.uint64)))
    return out


def exact_sets(texts: list[bytes | None], k: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingles of each text as numbers that are equal if and only if the shingles' bytes are; no hashes."""
    known: dict = {}
    flat, owner, alone = [], [], {}
    for d, text in enumerate(texts):
        words = (text or b"").lower().split()  # lower() touches A-Z only, split() parts at these blanks only
        if 0 < len(words) < k:
            alone[d] = known.setdefault((len(words), *words), -1 - len(known))
            continue
        new = set(words).difference(known)
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        flat.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        owner.append(d)
    size = np.zeros(len(texts), np.int64)
    size[owner] = [len(f) for f in flat]
    ids = np.concatenate(flat) if flat else np.zeros(0, np.int64)
    shingle, kinds = ids, len(known) + 1
    for j in range(1, k):  # the first j words are a number already, one more joins; numbers stay below the count of words
        shingle = np.unique(shingle[: max(0, len(ids) - j)] * np.int64(kinds) + ids[j:], return_inverse=True)[1].astype(np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    return [np.array([alone[d]], np.int64) if d in alone else np.unique(shingle[first[d] : max(first[d], first[d + 1] - k + 1)]) for d in range(len(texts))]


def set_digest(s: np.ndarray, more: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes() + more.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(n, SLOTS) slot values of non-empty sets."""
    flat, first = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), SLOTS), np.uint64)
    for j in range(SLOTS):
        out[:, j] = np.minimum.reduceat((flat ^ _B[j]) * _A[j], first)
    return mix(out)


def chunk_keys(sig: np.ndarray, bound: int) -> np.ndarray:
    """For each signature a key for every chunk and allowed error: the chunk's slots, SLOT_BITS of each, without one of them.

    Signatures of at most ``bound`` differing slots (of SLOT_BITS) share a key: the keys see no other bits.
    """
    keys = []
    sig = sig & np.uint64((1 << SLOT_BITS) - 1)
    for c, span in enumerate(chunks(bound)):
        for gone in span:
            h = np.full(len(sig), np.uint64((c << 8) + gone + 1))
            for j in span:
                if j != gone:
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, j])
            keys.append(h)
    return np.stack(keys, axis=1)


def pack(sig: np.ndarray) -> np.ndarray:
    """(n, 3) words of the low SENT_BITS of each slot."""
    low = (sig & np.uint64(15)).reshape(len(sig), 3, 16)
    return (low << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64)


def slot_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing slots of packed signatures; never more than of the SLOT_BITS wide ones, so the bound loses nothing."""
    d = x ^ y
    d |= d >> np.uint64(1)
    d |= d >> np.uint64(2)
    return np.bitwise_count(d & _NIBBLES).sum(axis=-1, dtype=np.int64)


def spanning_forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a graph given as a symmetric matrix."""
    left, edges = np.ones(len(near), bool), []
    for root in range(len(near)):
        if not left[root]:
            continue
        left[root], queue = False, [root]
        while queue:
            x = queue.pop()
            new = np.flatnonzero(near[x] & left)
            left[new] = False
            edges += [(x, int(y)) for y in new]
            queue += new.tolist()
    return edges


def _grouped(batches, keys: list[str]):
    """Whole groups of a sorted stream: tables of some groups, and where each begins and the last ends."""
    try:
        yield from _whole_groups(batches, keys)
    finally:
        give_back()


def _whole_groups(batches, keys: list[str]):
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows < 2:
            continue
        k = [held.column(c).to_numpy(zero_copy_only=False) for c in keys]
        same = np.ones(held.num_rows - 1, bool)
        for x in k:
            same &= x[1:] == x[:-1]
        last = np.flatnonzero(~same)
        if len(last):
            yield held.slice(0, last[-1] + 1).combine_chunks(), np.concatenate([[0], last[:-1] + 1, [last[-1] + 1]])
            held = held.slice(last[-1] + 1)
    if held is not None and held.num_rows:
        yield held.combine_chunks(), np.array([0, held.num_rows])


def _close_pairs(batches, bound: int):
    """Spanning forests of the members of each bucket (or pair of blocks) whose signatures lie within the bound."""
    for t, cut in _grouped(batches, ["key", "i", "j"]):
        ids = t.column("id").to_numpy()
        sig = np.stack([t.column(c).to_numpy().view(np.uint64) for c in ("s0", "s1", "s2")], axis=1)
        size = np.diff(cut)
        group = np.repeat(np.arange(len(size)), size)
        found = []
        small = np.repeat(size <= 8, size)
        for d in range(1, 8):  # small buckets all at once
            a = np.flatnonzero(small[:-d] & (group[:-d] == group[d:])) if len(group) > d else np.zeros(0, np.int64)
            if not len(a):
                break
            a = a[slot_distance(sig[a], sig[a + d]) <= bound]
            found.append(np.stack([ids[a], ids[a + d]], axis=1))
        for g in np.flatnonzero(size > 8):
            s, i = sig[cut[g] : cut[g + 1]], ids[cut[g] : cut[g + 1]]
            near = np.empty((len(s), len(s)), bool)
            for at in range(0, len(s), 256):
                near[at : at + 256] = slot_distance(s[at : at + 256, None, :], s[None, :, :]) <= bound
            edges = spanning_forest(near)
            if edges:
                found.append(i[np.asarray(edges)])
        if found:
            e = np.concatenate(found)
            e = np.unique(np.sort(e, axis=1), axis=0)
            e = e[e[:, 0] < e[:, 1]]
            yield pa.record_batch([pa.array(e[:, 1]), pa.array(e[:, 0])], names=["a", "b"])


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices of bounded width."""
    n = len(sets)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    _, word, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[word] > 1
    word, owner = np.unique(word[shared], return_inverse=True)[1], owner[shared]
    order = np.argsort(word, kind="stable")
    word, owner = word[order], owner[order]
    total, width = np.zeros((n, n), np.float32), 4096
    for at in range(0, int(word[-1]) + 1 if len(word) else 0, width):
        a, b = np.searchsorted(word, [at, at + width])
        m = np.zeros((n, width), np.float32)
        m[owner[a:b], word[a:b] - at] = 1
        total += m @ m.T
    return total


def _confirmed(batches, percent: int, k: int):
    """Spanning forests of the links in each unit: 100 * intersection >= percent * union, on full sets."""
    for t, cut in _grouped(batches, ["cluster", "block", "chunk"]):
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            g = t.slice(a, b - a)
            ids, want = g.column("id").to_numpy(), g.column("hi").to_numpy()
            texts = raw(g.column("text").combine_chunks())
            if len(np.unique(ids)) < len(ids):  # an id whose rows have different texts: only the class's own takes part
                keep = []
                for at in range(0, len(texts), 64):
                    for x, s in enumerate(wide_sets(texts[at : at + 64], k), at):
                        if len(s[0]) and set_digest(*s)[0] == want[x]:
                            keep.append(x)
                texts, ids = [texts[x] for x in keep], ids[keep]
            if len(texts) < 2:
                continue
            sets = exact_sets(texts, k)
            size = np.array([len(s) for s in sets], np.float64)
            if len(sets) == 2:
                both = float(len(np.intersect1d(*sets, assume_unique=True)))
                common = np.array([[size[0], both], [both, size[1]]])
            else:
                common = _overlaps(sets).astype(np.float64)
            link = 100 * common >= percent * (size[:, None] + size[None, :] - common)
            np.fill_diagonal(link, False)
            e = [(max(ids[x], ids[y]), min(ids[x], ids[y])) for x, y in spanning_forest(link) if ids[x] != ids[y]]
            if e:
                yield pa.record_batch([pa.array([x for x, _ in e], pa.int64()), pa.array([y for _, y in e], pa.int64())], names=["a", "b"])


def near_duplicates(docs: DataFrame, percent: int = 85, k: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row for each row of docs (doc_id, text, ...).

    Documents are linked if 100 * |A & B| >= percent * |A | B| for their sets of distinct k-word shingles (A-Z lower-cased);
    component_id is the smallest doc_id reachable by links, itself included; kept is doc_id = component_id.

    Exact copies of a set are one node: sets are told apart by 128 bits of BLAKE2b. A node's signature is cut in chunks; for each chunk and each single slot that may
    differ there is a key, so every pair within the distance bound shares a key (the bound is missed by a linked pair
    with probability 1e-5 at the threshold itself, and far less above it). In each bucket of nodes with one key the
    signature distance is tested; what passes joins candidate clusters (spanning forests only, never all pairs). Clusters
    are confirmed on full sets of the words themselves, without hashes, each text sent once. Buckets and clusters beyond a fixed size are cut in blocks and
    every pair of blocks is a unit of its own; for clusters first each block with a few pivots that all blocks share,
    then only the nodes that these left outside the largest component, against all blocks.

    A null or empty text, or one without words, has 0 shingles and no links. Rows of one doc_id are one document, with the
    links of all its rows.
    A row without doc_id has no links, a null component_id and is kept. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    scratch, n_parts = Scratch(spark, "near-dup"), parts(spark)
    bound = distance_bound(percent / 100)

    def sign(batches):
        for b in pieces(batches):
            wide = wide_sets(raw(b.column("text")), k)
            sets = [s for s, _ in wide]
            full = [s for s in sets if len(s)]
            digest = [set_digest(*s) if len(s[0]) else (None, None) for s in wide]
            keys, packed = [None] * len(sets), [[None] * 3] * len(sets)
            if full:
                sig = signatures(full)
                got = iter(zip(chunk_keys(sig, bound).view(np.int64), pack(sig).view(np.int64).tolist(), strict=True))
                keys, packed = map(list, zip(*[next(got) if len(s) else (None, [None] * 3) for s in sets], strict=True))
            yield pa.record_batch(
                [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *(pa.array([d[x] for d in digest], pa.int64()) for x in (0, 1)), pa.array(keys, pa.list_(pa.int64())), *(pa.array([p[x] for p in packed], pa.int64()) for x in range(3))],
                names=["doc_id", "n_shingles", "hi", "lo", "keys", "s0", "s1", "s2"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = scratch.save(texts.mapInArrow(sign, "doc_id long, n_shingles long, hi long, lo long, keys array<long>, s0 long, s1 long, s2 long"), "signed")
    linked = rows.where(F.col("hi").isNotNull() & F.col("doc_id").isNotNull())
    classes = linked.groupBy("hi", "lo").agg(F.min("doc_id").alias("id"))
    # the class's first row stands for it
    nodes = scratch.save(linked.join(classes.withColumnRenamed("id", "doc_id"), ["hi", "lo", "doc_id"], "left_semi").select(F.col("doc_id").alias("id"), "hi", "lo", "n_shingles", "keys", "s0", "s1", "s2").dropDuplicates(["id", "hi", "lo"]), "nodes")

    keyed = nodes.select(F.explode("keys").alias("key"), "id", "s0", "s1", "s2")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    units = keyed.join(shared, "key").withColumn("nb", F.ceil(F.col("n") / BUCKET).cast("int"))
    units = units.withColumn("own", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    units = units.select("key", "id", "s0", "s1", "s2", F.explode(pair).alias("u")).select("key", "u.i", "u.j", "id", "s0", "s1", "s2")
    # contracted in the same worker: the buckets of one partition find many pairs more than once
    near = units.repartition(n_parts, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(lambda it: contracted(_close_pairs(it, bound)), "a long, b long")
    cluster = scratch.save(components(scratch, near, "near"), "clusters")

    members = nodes.select("id", "hi", "n_shingles").join(cluster.withColumnRenamed("component", "cluster"), "id")
    weight = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / CLUSTER_DOCS), F.ceil(F.col("s") / CLUSTER_SHINGLES)).cast("int")
    # tables with a row for each large cluster are written by themselves: joins with them can be broadcast or split
    large = scratch.save(weight.select("cluster", blocks.alias("nb")).where("nb > 1"), "large")
    members = members.join(large, "cluster", "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    members = scratch.save(members.select("id", "hi", "cluster", "nb", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int").alias("block")), "members")
    words = scratch.save(texts.withColumnRenamed("doc_id", "id").join(members.select("id").distinct().hint("shuffle_hash"), "id"), "texts")

    def confirm(units: DataFrame, name: str) -> DataFrame:
        dealt = units.join(words, "id").repartition(n_parts, "cluster", "block", "chunk").sortWithinPartitions("cluster", "block", "chunk")
        return scratch.save(dealt.mapInArrow(lambda it: _confirmed(it, percent, k), "a long, b long"), name)

    columns = ["id", "hi", "cluster", "block", F.lit(0).alias("chunk")]
    hot = members.where("nb > 1")
    pivots = hot.groupBy("cluster", "nb").agg(F.min_by(F.struct("id", "hi"), F.xxhash64("id", F.lit(0))).alias("p0"), *[F.min_by(F.struct("id", "hi"), F.xxhash64("id", F.lit(x))).alias(f"p{x}") for x in range(1, PIVOTS)])
    pivots = pivots.select("cluster", "nb", F.explode(F.array_distinct(F.array(*[f"p{x}" for x in range(PIVOTS)]))).alias("p"))
    pivots = pivots.select("cluster", "p.id", "p.hi", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("block"))
    first = members.select(*columns).union(pivots.select(*columns)).distinct()
    links = confirm(first, "links")
    # documents whose rows have different texts hold their classes together
    several = linked.groupBy("doc_id").agg(F.min("hi").alias("a"), F.max("hi").alias("b")).where("a <> b").select("doc_id")
    if not several.isEmpty():
        bridges = linked.join(several, "doc_id").join(classes, ["hi", "lo"]).select(F.col("doc_id").alias("a"), F.col("id").alias("b")).where("a <> b")
        links = links.union(bridges.distinct())
    found = scratch.save(components(scratch, links, "linked"), "found")
    if not hot.isEmpty():
        at = hot.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        top = at.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("cluster").agg(F.max_by("component", F.struct("n", "component")).alias("top"))
        top = scratch.save(top, "top")
        outside = at.join(top, "cluster").where("component <> top").select("id", "hi", "cluster", "nb")
        count = scratch.save(outside.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / CLUSTER_DOCS).cast("int").alias("nc")), "outside")
        outside = outside.join(count, "cluster").withColumn("chunk", (F.pmod(F.xxhash64("id", F.lit(5)), F.col("nc")) + 1).cast("int"))
        left = outside.select("id", "hi", "cluster", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("block"), "chunk")
        right = hot.join(count, "cluster").select("id", "hi", "cluster", "block", F.explode(F.sequence(F.lit(1), F.col("nc"))).alias("chunk"))
        more = confirm(left.union(right).distinct(), "more")
        if not more.isEmpty():
            so_far = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
            found = scratch.save(components(scratch, so_far.union(more), "all"), "found-all")
    by_class = classes.join(found, "id", "left").select("hi", "lo", F.coalesce("component", "id").alias("component_id"))
    by_class = scratch.save(by_class, "classes")
    out = rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("hi")).alias("hi"), "lo").join(by_class, ["hi", "lo"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op4_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, percent=85)


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct([array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)]) END AS ss FROM w),
x AS (SELECT doc_id, len(ss) AS n, unnest(ss) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb
      FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p WHERE 100 * i >= 85 * (na + nb - i)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS id, doc_id AS reach FROM s UNION SELECT r.id, both_ways.b FROM r JOIN both_ways ON r.reach = both_ways.a),
c AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id)
SELECT doc_id, CAST(len(ss) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c ON s.doc_id = c.id
"""

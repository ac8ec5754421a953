"""Mixing sources to target weights with hash-threshold histograms: no sort of documents, no collected rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, carried, evened, raw, unpacked

#: Bits of the sampling hash and of one histogram level.
BITS, LEVEL = 60, 12


@F.arrow_udf(T.LongType())
def count_words(text: pa.Array) -> pa.Array:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in each text; 0 for null."""
    return pa.array([len(x.split()) if x else 0 for x in raw(text)], pa.int64())


def sampling_hash(doc_id: Column) -> Column:
    """60 bits of md5 over the id's decimal text; the same for every run and partitioning."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, weigh ``cycle`` in turn and share the total of all sizes; a target stops at
    ``most`` times its source's size and the excess is shared again. The fixed point is one cumulative sum: in ascending
    order of cap / weight, a source is capped while its cap lies under its share of what the capped ones before it leave.
    The windows run over one row for each source, never over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(x) for x in cycle]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(cycle))) + 1).cast("int"))
    s = sizes.withColumn("w", weight.cast("long")).withColumn("cap", F.col("source_size") * most)
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, every = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), zero)
    share = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), zero)
    s = s.withColumn("level", left.cast("double") / share.cast("double")).withColumn("capped", F.col("cap").cast("double") / F.col("w").cast("double") < F.col("level"))
    water = F.max(F.when(~F.col("capped"), F.col("level"))).over(every)
    return s.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.least(water * F.col("w"), F.col("cap").cast("double")))).select("source", "source_size", "target")


def mix(docs: DataFrame, cycle: tuple[int, ...] = (5, 2, 1), most: int = 3, size: Column | None = None) -> DataFrame:
    """All rows and columns of docs (doc_id, text, source, ...) with size, source_size, target, repeats and taken.

    ``size`` says where docs has the sizes already (long, never null); then no text is needed, and docs is read again for each level.

    Every document is taken floor(target / source_size) times, and once more if its hash lies under its source's
    threshold. The threshold comes from nested histograms: sizes summed by (source, hash bucket), the bucket in which the
    remaining budget ends, then only that bucket's documents by the next bits, until it holds a single hash. That hash is
    taken if at least half of it fits. The last document apart, a source's taken words so equal its target.

    A null text has size 0, a null source is a source of its own, rows of one doc_id share a hash and are taken together,
    empty texts and sources without words are taken 0 words, an empty table gives an empty table. Columns of docs with the
    names of added columns are replaced.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    count = count_words("text") if size is None else size
    rows = docs.select("source", count.alias("size"), sampling_hash(F.col("doc_id")).alias("h"))
    if size is None:
        rows = scratch.save(evened(rows), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    target = source_targets(sizes, cycle, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = target.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).withColumn("base", F.lit(0).cast("long")).withColumn("bucket", F.lit(0).cast("long"))
    plan = scratch.save(plan.withColumn("cut", F.lit(None).cast("long")), "plan-0")
    for k in range(1, BITS // LEVEL + 1):
        shift = BITS - k * LEVEL
        open_ = plan.where("cut is null").select(F.col("source").alias("s"), "rest", "base", F.col("bucket").alias("within"))
        at = F.shiftright(F.col("h"), shift)
        inside = rows.withColumn("b", at).join(open_, rows["source"].eqNullSafe(F.col("s")) & (F.shiftright(F.col("h"), shift + LEVEL) == F.col("within")))
        hist = inside.groupBy("s", "rest", "base", "b").agg(F.sum("size").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        upto = F.col("base") + F.sum("n").over(Window.partitionBy("s").orderBy("b"))
        over = hist.withColumn("upto", upto).where(F.col("upto").cast("double") > F.col("rest"))
        edge = over.groupBy("s").agg(F.min(F.struct("b", "n", "upto", "lo", "hi", "rest")).alias("e")).select("s", "e.*")
        before, last = F.col("upto") - F.col("n"), k == BITS // LEVEL
        take = before.cast("double") + F.col("n").cast("double") / 2 <= F.col("rest")
        single = F.lit(True) if last else F.col("lo") == F.col("hi")
        edge = edge.select(F.col("s").alias("es"), F.col("b"), before.alias("before"), F.when(single, F.shiftleft(F.col("b") + F.when(take, 1).otherwise(0), shift)).alias("found"))
        joined = plan.join(edge, plan["source"].eqNullSafe(edge["es"]), "left")
        everything = F.lit(1 << BITS).cast("long")  # the rest takes in the whole bucket
        nxt = joined.select("source", "source_size", "target", "whole", "rest", F.coalesce("before", "base").alias("base"), F.coalesce("b", "bucket").alias("bucket"), F.coalesce("cut", "found", F.when(F.col("es").isNull(), everything)).alias("cut"))
        plan, seen = scratch.observed(nxt, f"plan-{k}", open=F.count_if(F.col("cut").isNull()))
        if not seen["open"]:
            break
    d = carried(docs, size=count, h=sampling_hash(F.col("doc_id")), of=F.col("source"))
    out = d.join(plan, d["of"].eqNullSafe(plan["source"]))
    more = F.when((F.col("rest") > 0) & (F.col("h") < F.col("cut")), 1).otherwise(0)
    repeats = F.col("whole") + more
    added = ("size", "source_size", "target", "repeats", "taken")
    return out.select(*unpacked(docs, added), "size", "source_size", "target", repeats.alias("repeats"), (repeats * F.col("size")).alias("taken"))


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """Every text is read and counted once; what is mixed has no texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", count_words("text").alias("size"))
    counted = Scratch(spark, "counted").save(evened(docs), "sizes")
    return mix(counted, size=F.col("size")).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w, 3 * source_size AS cap FROM s),
l AS (SELECT *, (SELECT CAST(sum(source_size) AS BIGINT) FROM w) AS t, (SELECT sum(w) FROM w) AS ws,
        coalesce(sum(cap) OVER b, 0) AS cb, coalesce(sum(w) OVER b, 0) AS wb FROM w
      WINDOW b AS (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, CAST(t - cb AS DOUBLE) / CAST(ws - wb AS DOUBLE) AS level FROM l),
c AS (SELECT *, CAST(cap AS DOUBLE) / w < level AS capped FROM v),
g AS (SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE)
        ELSE least((SELECT max(level) FROM c WHERE NOT capped) * w, CAST(cap AS DOUBLE)) END AS target FROM c),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM g),
r AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto, sum(d.size) OVER (PARTITION BY d.source, d.h) AS n
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  CAST((whole + CASE WHEN rest > 0 AND CAST(upto - n AS DOUBLE) + CAST(n AS DOUBLE) / 2 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM r
"""

"""The driver's tables seen as a log-structured table: events as versions of (user, event type), lineitem as a wide one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: 2024-01-31 00:00:00 UTC, the clock of all queries.
NOW = 1706659200
DAY = 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str) -> F.Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})")


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells, partition tombstones and range tombstones in long form, from one scan of events.

    key is the user, name the event type, three sources by event_id; values under 20 are cell tombstones, three of four cells
    expire; every 101st event also deletes its user's row, every 37th the range from click to purchase.
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ttl = F.when(F.col("event_id") % 4 != 0, (F.col("event_id") % 30 + 1) * DAY)
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    base = e.select((F.col("event_id") % 3).cast("int").alias("src"), F.col("user_id").alias("key"), "event_type", micros("ts").alias("ts"), "value", F.col("event_id").alias("pos"), ttl.alias("ttl"), (seconds + ttl).alias("expires_at"))
    null = F.lit(None).cast("string")
    cell = F.struct(F.lit("cell").alias("kind"), F.col("event_type").alias("name"), null.alias("range_end"))
    row = F.when(F.col("pos") % 101 == 0, F.struct(F.lit("row_deletion").alias("kind"), null.alias("name"), null.alias("range_end")))
    rng = F.when(F.col("pos") % 37 == 0, F.struct(F.lit("range_tombstone").alias("kind"), F.lit("click").alias("name"), F.lit("purchase").alias("range_end")))
    out = base.withColumn("k", F.explode(F.array_compact(F.array(cell, row, rng))))
    is_cell = F.col("k.kind") == "cell"
    return out.select("src", "key", "k.kind", "k.name", "k.range_end", "ts", (is_cell & (F.col("value") < 20)).alias("deleted"), F.when(is_cell, F.col("ttl")).alias("ttl"), F.when(is_cell, F.col("expires_at")).alias("expires_at"), F.when(is_cell, F.col("value")).alias("value"), "pos")


def line_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as versions of (order, line), the latest shipping date wins."""
    cols = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    return cols.select(F.lit("cell").alias("kind"), F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("name"), micros("l_shipdate").alias("ts"), F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("pos"), F.col("l_quantity").alias("value"))


#: The same cells in SQL, as common table expressions.
CELLS_SQL = """
e AS (SELECT CAST(event_id % 3 AS INTEGER) AS src, user_id AS key, event_type AS name, epoch_us(ts) AS ts, value < 20 AS deleted, value, event_id AS pos,
        CASE WHEN event_id % 4 <> 0 THEN (event_id % 30 + 1) * 86400 END AS ttl,
        CASE WHEN event_id % 4 <> 0 THEN CAST(floor(epoch(ts)) AS BIGINT) + (event_id % 30 + 1) * 86400 END AS expires_at FROM events),
pd AS (SELECT key, max(ts) AS del_ts FROM e WHERE pos % 101 = 0 GROUP BY key),
rt AS (SELECT key, 'click' AS lo, 'purchase' AS hi, max(ts) AS rts FROM e WHERE pos % 37 = 0 GROUP BY key),
w AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY key, name ORDER BY ts DESC, src, pos) = 1),
live AS (SELECT * FROM w WHERE NOT deleted AND name <> ''),
merged AS (SELECT l.* FROM live l LEFT JOIN pd ON l.key = pd.key WHERE (pd.del_ts IS NULL OR pd.del_ts < l.ts)
  AND NOT EXISTS (SELECT 1 FROM rt WHERE rt.key = l.key AND l.name BETWEEN rt.lo AND rt.hi AND l.ts <= rt.rts)),
keys AS (SELECT DISTINCT key FROM e),
kept AS (SELECT k.key, count(m.name) AS n FROM keys k LEFT JOIN merged m ON k.key = m.key LEFT JOIN pd ON k.key = pd.key GROUP BY k.key, pd.del_ts
  HAVING pd.del_ts IS NULL OR count(m.name) > 0),
fold AS (SELECT k.key, k.n, CASE WHEN k.n = 0 THEN 0 WHEN bool_or(m.expires_at IS NULL) THEN NULL ELSE max(m.expires_at) END AS latest, min(m.expires_at) AS nearest
  FROM kept k LEFT JOIN merged m ON k.key = m.key GROUP BY k.key, k.n)
"""

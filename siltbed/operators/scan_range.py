"""Ranges in partitioner order: seeking a start key, peeking the next one, resuming, ordinals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.operators.shared import new_folder


def at_or_after(token: Column, key: Column, start_token: Column, start_key: Column, inclusive: bool = True) -> Column:
    """(token, key) >= the start, as plain comparisons that reach a scan. Null tokens (byte-ordered) compare by key alone."""
    same = token.eqNullSafe(start_token)
    beyond = key >= start_key if inclusive else key > start_key
    return F.coalesce(token > start_token, F.lit(False)) | (same & beyond)


def seek(df: DataFrame, start_token: Column, start_key: Column, token: str = "token", key: str = "key", inclusive: bool = True) -> DataFrame:
    return df.where(at_or_after(F.col(token), F.col(key), start_token, start_key, inclusive))


def first_key(df: DataFrame, token: str = "token", key: str = "key") -> DataFrame:
    """One row: the least (token, key), as an aggregation that sends one row a task."""
    low = df.agg(F.min(F.struct(F.col(token).alias("token"), F.col(key).alias("key"))).alias("m"))
    return low.where("m is not null").select("m.token", "m.key")


def next_key(df: DataFrame, after_token: Column, after_key: Column, token: str = "token", key: str = "key") -> DataFrame:
    """The cursor: the least (token, key) beyond the given one; no row at the end."""
    return first_key(seek(df, after_token, after_key, token, key, inclusive=False), token, key)


def ordinals(df: DataFrame, by: list[str], name: str = "ordinal") -> DataFrame:
    """df with 1, 2, ... in the order of ``by``, without one task that sees all rows.

    Rows are range-partitioned and written once, so the ranges can't change if a task is run again; ordinals inside a
    partition are shifted by the sizes of those before it, of which there is one row a partition.
    """
    where = new_folder(df.sparkSession, "ordinals")
    ranged = df.repartitionByRange(*by).withColumn("_p", F.spark_partition_id())
    ranged.write.mode("overwrite").parquet(where)
    dealt = df.sparkSession.read.schema(ranged.schema).parquet(where)
    inside = Window.partitionBy("_p").orderBy(*by)
    sizes = dealt.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_before")
    out = dealt.withColumn("_i", F.row_number().over(inside)).join(F.broadcast(before), "_p")
    return out.withColumn(name, (F.col("_i") + F.col("_before")).cast("long")).drop("_p", "_i", "_before")


def source_order(cells: DataFrame, token: str = "token", key: str = "key") -> DataFrame:
    """(source, first_token, first_key, src): sources numbered by their first (token, key), then by name; one row a source."""
    firsts = cells.groupBy("source").agg(F.min(F.struct(F.col(token).alias("t"), F.col(key).alias("k"))).alias("f"))
    w = Window.orderBy("f.t", "f.k", "source")
    return firsts.select("source", F.col("f.t").alias("first_token"), F.col("f.k").alias("first_key"), (F.row_number().over(w) - 1).cast("int").alias("src"))

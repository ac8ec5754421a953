"""Canonical schemas: versioned cells as a scan gives them, reconciled rows, records of a target, files."""

from __future__ import annotations

from pyspark.sql import types as T


def cells(token: T.DataType | None = None, key: T.DataType | None = None, value: T.DataType | None = None) -> T.StructType:
    """Long form: one row for each cell version or tombstone.

    kind is ``cell``, ``row_deletion`` (ts says when; without clustering it deletes the partition) or ``range_tombstone``
    (names from name to range_end, both included), or ``rows_deletion`` (rows of the partition at places from name to range_end, see
    siltbed.functions.places). clustering is null for static rows, partitions and layouts without it.
    pos orders versions of one source. An unnamed cell (name '') marks a row and is never a column.
    """
    return T.StructType(
        [
            T.StructField("src", T.IntegerType(), False),
            T.StructField("token", token or T.LongType(), True),
            T.StructField("key", key or T.BinaryType(), False),
            T.StructField("clustering", T.ArrayType(T.BinaryType()), True),
            T.StructField("row_ord", T.IntegerType(), False),
            T.StructField("is_static", T.BooleanType(), False),
            T.StructField("kind", T.StringType(), False),
            T.StructField("name", T.StringType(), True),
            T.StructField("range_end", T.StringType(), True),
            T.StructField("ts", T.LongType(), False),
            T.StructField("deleted", T.BooleanType(), False),
            T.StructField("ttl", T.LongType(), True),
            T.StructField("expires_at", T.LongType(), True),
            T.StructField("value", value or T.BinaryType(), True),
            T.StructField("pos", T.LongType(), False),
        ]
    )


COLUMN = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("ts", T.LongType()),
        T.StructField("ttl", T.LongType()),
        T.StructField("expires_at", T.LongType()),
    ]
)
ROWS = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("columns", T.ArrayType(COLUMN)), T.StructField("expiry", T.LongType())])
SINK = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("bins", T.MapType(T.StringType(), T.BinaryType())), T.StructField("ttl", T.LongType())])
SUMMARY = T.StructType([T.StructField(x, T.LongType(), False) for x in ("exported", "failed", "skipped", "expired", "existing")])
FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("keyspace", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("partitioner", T.StringType()),
        T.StructField("min_timestamp", T.LongType()),
        T.StructField("min_ttl", T.LongType()),
        T.StructField("clustering", T.ArrayType(T.StringType())),
        T.StructField("static_columns", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("format", T.StringType())]))),
        T.StructField("regular_columns", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("format", T.StringType())]))),
        T.StructField("length", T.LongType()),
    ]
)

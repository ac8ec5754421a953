"""One expiry for a record out of its columns' expiries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("latest", "nearest")


def expiry(columns: Column | str = "columns", mode: str = "latest") -> Column:
    """Epoch seconds at which a record expires, null for never.

    latest: never if any column never expires, else the last expiry; a record without columns expires at 0. nearest: the
    first expiry of all columns that expire, never if none does.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    times = F.transform(columns, lambda c: c["expires_at"])
    if mode == "nearest":
        return F.array_min(times).cast("long")
    zero = F.lit(0).cast("long")
    return F.when(F.size(times) == 0, zero).when(F.exists(times, lambda x: x.isNull()), F.lit(None).cast("long")).otherwise(F.array_max(times))


def fold_expiry(cells: DataFrame, row: tuple[str, ...] = ("key",), mode: str = "latest") -> DataFrame:
    """(row, expiry) of live cells in long form, as an aggregation with partial sums."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    if mode == "nearest":
        return cells.groupBy(*row).agg(F.min("expires_at").alias("expiry"))
    return cells.groupBy(*row).agg(F.when(~F.bool_or(F.col("expires_at").isNull()), F.max("expires_at")).alias("expiry"))


def is_alive(expires: Column | str, now: int, min_ttl: int = 1) -> Column:
    """Never expires, or not before now + min_ttl."""
    e = F.col(expires) if isinstance(expires, str) else expires
    return e.isNull() | (e >= F.lit(now + min_ttl).cast("long"))


def check_min_ttl(min_ttl: int) -> int:
    if not 1 <= min_ttl < 1 << 32:
        raise ValueError("min_ttl lies between 1 and 2**32 - 1")
    return min_ttl

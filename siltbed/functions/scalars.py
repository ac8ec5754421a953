"""Scalar functions over keys, values and file names, all of them built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_hex(b: Column | str) -> Column:
    """Two lower-case digits a byte."""
    return F.lower(F.hex(_col(b)))


def from_hex(s: Column | str) -> Column:
    """Bytes of hex digits of either case; null if the text has an odd length or other characters."""
    s = _col(s)
    return F.when(F.length(s) % 2 == 0, F.try_to_binary(s, F.lit("hex")))


def is_printable(b: Column | str) -> Column:
    """All bytes lie in 0x20..0x7E; empty is printable."""
    return ~F.decode(_col(b).cast("binary"), "ISO-8859-1").rlike("[^ -~]")


def display(b: Column | str) -> Column:
    """Printable bytes as text, others as hex."""
    b = _col(b).cast("binary")
    return F.when(is_printable(b), F.decode(b, "ISO-8859-1")).otherwise(to_hex(b))


def crc32(b: Column | str) -> Column:
    return F.crc32(_col(b).cast("binary"))


def remaining_ttl(expiry: Column | str, now: Column | int, eternal: Column | int | None = None) -> Column:
    """Seconds until expiry; ``eternal`` (null if not given) for what never expires."""
    left = _col(expiry) - _lit(now)
    return left if eternal is None else F.coalesce(left, _lit(eternal))


def _lit(x: Column | int) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("long")


#: ``vv-generation-format-Data.db`` from version la on, ``keyspace-table-vv-generation-Data.db`` (or a one-letter version) before.
NEW_NAME = r"^([l-z][a-z])-[0-9a-z_]+-[a-z]+-Data\.db$"
OLD_NAME = r"^([^-]+)-([^-]+)-([a-z][a-z]|[a-d])-[0-9a-z_]+-Data\.db$"


def version_number(letters: Column) -> Column:
    """(first - a) * 26 + (second - a); one letter counts as if followed by a. Null for the empty text."""
    a = F.ascii(F.lit("a"))
    second = F.when(F.length(letters) > 1, F.ascii(F.substring(letters, 2, 1))).otherwise(a)
    return F.when(letters != "", ((F.ascii(letters) - a) * 26 + second - a).cast("int"))


def file_version(name: Column | str) -> Column:
    """Version number of a data file's name, null if it is none."""
    name = _col(name)
    new = F.regexp_extract(name, NEW_NAME, 1)
    return version_number(F.when(new != "", new).otherwise(F.regexp_extract(name, OLD_NAME, 3)))


def file_keyspace(path: Column | str) -> Column:
    """Keyspace of a data file: in the name of older files, the last directory but one of newer ones."""
    return _of_path(path, 1, -3)


def file_table(path: Column | str) -> Column:
    """Table of a data file: in the name of older files, the directory of newer ones (an id suffix is kept)."""
    return _of_path(path, 2, -2)


def _of_path(path: Column | str, group: int, at: int) -> Column:
    parts = F.split(_col(path), "/")
    name = F.element_at(parts, -1)
    newer = F.regexp_extract(name, NEW_NAME, 1) != ""
    directory = F.when(F.size(parts) >= -at, F.get(parts, F.size(parts) + F.lit(at)))
    found = F.when(newer, directory).otherwise(F.regexp_extract(name, OLD_NAME, group))
    return F.when(found != "", found)


def host_and_port(text: Column | str, default: int = 3000) -> Column:
    """struct<host, port> of host[:port]."""
    text = _col(text)
    port = F.regexp_extract(text, r":([0-9]+)$", 1)
    return F.struct(F.regexp_replace(text, r":[0-9]+$", "").alias("host"), F.when(port != "", port.cast("int")).otherwise(F.lit(default)).alias("port"))

"""Places of rows in a partition: text whose byte order is the order of the clustering columns.

Each value gives a mark (null, empty or not), its bytes in hex, turned so that they sort as the type does, and an end. Columns in reverse
order have all of that the other way round. Texts of prefixes begin the texts of all rows that have them, so a range of rows, however its
ends count, is a range of texts with both ends included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: (type, whether in reverse order) of each clustering column.
Order = tuple[tuple[str, bool], ...]

#: Types by what their order is: of the bytes; of numbers with a sign, of floating-point numbers, of version 1 UUIDs by time.
PLAIN = ("UTF8Type", "AsciiType", "BytesType", "BooleanType", "BoolType", "InetAddressType", "SimpleDateType", "EmptyType")
SIGNED = ("Int32Type", "LongType", "TimestampType", "ShortType", "ByteType", "TimeType")
FLOATING = ("FloatType", "DoubleType")
TIMED = ("TimeUUIDType",)

#: Beyond all that can follow a prefix.
BEYOND = "~"
_DIGITS, _HALF, _TURNED = "0123456789abcdef", "89abcdef01234567", "fedcba9876543210"
#: Marks of null, empty and other values and the end, in order and in reverse order; all digits lie between marks and ``z``.
_MARKS, _BACK = ("-", ".", "/", ","), ("/", ".", "-", "z")


def is_known(order: Order) -> bool:
    return all(kind in PLAIN + SIGNED + FLOATING + TIMED for kind, _ in order)


def check_order(order: Order) -> Order:
    for kind, back in order:
        if not is_known(((kind, back),)):
            raise NotImplementedError(f"range tombstones over clustering columns of type {kind}")
    return order


def _digits(kind: str, value: bytes) -> str:
    if kind in SIGNED or kind in FLOATING and value[0] < 0x80:
        value = bytes([value[0] ^ 0x80]) + value[1:]
    elif kind in FLOATING:
        value = bytes(x ^ 0xFF for x in value)
    elif kind in TIMED:
        value = value[6:8] + value[4:6] + value[:4] + bytes(x ^ 0x80 for x in value[8:])
    return value.hex()


def place_of(values: Sequence[bytes | None], order: Order) -> str:
    """The place of a row, or what places of rows with this prefix begin with."""
    out = ""
    for value, (kind, back) in zip(values, order, strict=False):
        null, empty, other, end = _BACK if back else _MARKS
        digits = _digits(kind, value) if value else ""
        out += null if value is None else empty if value == b"" else other + (digits.translate(str.maketrans(_DIGITS, _TURNED)) if back else digits) + end
    return out


def at_or_after(values: Sequence[bytes | None], order: Order, included: bool) -> str:
    """The first place of a range that begins at a prefix, with the rows that have it or beyond them."""
    return place_of(values, order) + ("" if included else BEYOND)


def up_to(values: Sequence[bytes | None], order: Order, included: bool) -> str:
    """The last place of a range that ends at a prefix. Without the rows that have it, the end lies just before their places: nothing
    comes between a character and the one before it."""
    at = place_of(values, order)
    if included:
        return at + BEYOND
    return at[:-1] + chr(ord(at[-1]) - 1) + BEYOND if at else ""


def _value(kind: str, h: str) -> bytes:
    """_digits' inverse."""
    value = bytes.fromhex(h)
    if kind in TIMED:
        return value[4:8] + value[2:4] + value[:2] + bytes(x ^ 0x80 for x in value[8:])
    if kind in FLOATING and value[0] < 0x80:
        return bytes(x ^ 0xFF for x in value)
    return bytes([value[0] ^ 0x80]) + value[1:] if kind in SIGNED + FLOATING else value


def values_of(at: str, order: Order) -> list[bytes | None] | None:
    """place_of's inverse: the values of a place or a prefix; None if the text is neither."""
    out: list[bytes | None] = []
    for kind, back in order:
        if not at:
            break
        null, empty, other, end = _BACK if back else _MARKS
        if at[0] in (null, empty):
            out.append(None if at[0] == null else b"")
            at = at[1:]
            continue
        digits, found, rest = at[1:].partition(end)
        if at[0] != other or not found or digits.strip(_DIGITS):
            return None
        out.append(_value(kind, digits.translate(str.maketrans(_TURNED, _DIGITS)) if back else digits))
        at = rest
    return None if at else out


def start_of(lo: str, order: Order) -> tuple[list[bytes | None], bool]:
    """The prefix at which a range begins and whether it is included: the inverse of at_or_after."""
    prefix = values_of(lo.removesuffix(BEYOND), order)
    if prefix is None:
        raise ValueError(f"no place: {lo}")
    return prefix, not lo.endswith(BEYOND)


def end_of(hi: str, order: Order) -> tuple[list[bytes | None], bool]:
    """The same for up_to. What ends before empty values may come back as ending with nulls, which is the same range."""
    at = hi.removesuffix(BEYOND)
    prefix = values_of(at, order)
    if prefix is not None and hi.endswith(BEYOND):
        return prefix, True
    prefix = values_of(at[:-1] + chr(ord(at[-1]) + 1), order) if at else []
    if prefix is None:
        raise ValueError(f"no place: {hi}")
    return prefix, False


def place(clustering: Column | str, order: Order) -> Column:
    """place_of for a column of arrays of binary; null for null arrays."""
    array = F.col(clustering) if isinstance(clustering, str) else clustering
    flipped = lambda h: F.concat(F.translate(F.substring(h, 1, 1), _DIGITS, _HALF), F.substring(h, 2, 1 << 30))
    parts = []
    for i, (kind, back) in enumerate(check_order(order)):
        value = F.get(array, F.lit(i))
        h = F.lower(F.hex(value))
        if kind in SIGNED:
            h = flipped(h)
        elif kind in FLOATING:
            h = F.when(F.substring(h, 1, 1) < "8", flipped(h)).otherwise(F.translate(h, _DIGITS, _TURNED))
        elif kind in TIMED:
            h = F.concat(F.substring(h, 13, 4), F.substring(h, 9, 4), F.substring(h, 1, 8), *[flipped(F.substring(h, at, 2)) for at in range(17, 33, 2)])
        null, empty, other, end = _BACK if back else _MARKS
        text = F.concat(F.lit(other), F.translate(h, _DIGITS, _TURNED) if back else h, F.lit(end))
        parts.append(F.when(value.isNull(), null).when(F.length(value) == 0, empty).otherwise(text))
    return F.when(array.isNotNull(), F.concat(F.lit(""), *parts))

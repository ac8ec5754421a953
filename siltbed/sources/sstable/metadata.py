"""The Statistics file: partitioner and, in newer files, the columns of the table."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from siltbed.functions.places import Order
from siltbed.functions.tokens import DEFAULT_PARTITIONER, PARTITIONERS
from siltbed.sources.sstable import naming
from siltbed.sources.sstable.wire import Wire

#: Bytes of values of fixed size, by the last part of the type's class name; all others have a length in front.
FIXED = {
    "LongType": 8,
    "Int32Type": 4,
    "BoolType": 1,
    "BooleanType": 1,
    "FloatType": 4,
    "DoubleType": 8,
    "TimestampType": 8,
    "EmptyType": 0,
    "UUIDType": 16,
    "TimeUUIDType": 16,
    "LexicalUUIDType": 16,
}
#: Parts of the newer Statistics file that are read.
VALIDATION, HEADER = 0, 3


def short_type(text: str) -> str:
    """A type's class name without packages; a type in reverse order is stored as the type itself."""
    short = re.sub(r"[\w.]*\.(\w+)", r"\1", text.strip())
    inner = re.fullmatch(r"ReversedType\((.*)\)", short)
    return inner[1] if inner else short


def is_reversed(text: str) -> bool:
    return re.fullmatch(r"([\w.]*\.)?ReversedType\(.*\)", text.strip()) is not None


def parameters(kind: str) -> list[str]:
    """The types in the outer parentheses of a type."""
    inside, depth, out = kind.partition("(")[2][:-1], 0, [""]
    for c in inside:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x for x in out if x]


def element_type(kind: str) -> str | None:
    """The type of the values of a column that has one cell for each element (lists, sets and maps that aren't frozen); None
    for columns of one cell."""
    outer = kind.partition("(")[0]
    if outer == "UserType":
        raise NotImplementedError("columns of user types are supported only if frozen")
    return {"ListType": lambda: parameters(kind)[0], "SetType": lambda: "EmptyType", "MapType": lambda: parameters(kind)[1]}.get(outer, lambda: None)()


@dataclass(frozen=True)
class Header:
    """The serialization header: bases of delta-coded times, types of the key, the clustering columns and all columns."""

    min_timestamp: int = 0
    min_local_deletion: int = 0
    min_ttl: int = 0
    key_type: str = ""
    clustering: tuple[str, ...] = ()
    static: tuple[tuple[str, str], ...] = ()
    regular: tuple[tuple[str, str], ...] = ()
    #: Whether each clustering column is in reverse order.
    backwards: tuple[bool, ...] = ()

    @property
    def order(self) -> Order:
        """How rows of a partition are ordered."""
        return tuple(zip(self.clustering, self.backwards or (False,) * len(self.clustering), strict=True))

    @classmethod
    def parse(cls, w: Wire) -> Header:
        def full() -> str:
            return w.vint_bytes().decode()

        def kind() -> str:
            return short_type(full())

        def columns() -> tuple:
            return tuple((w.vint_bytes().decode("utf-8"), kind()) for _ in range(w.vint()))

        times, key = (w.vint(), w.vint(), w.vint()), kind()
        clustering = [full() for _ in range(w.vint())]
        return cls(*times, key, tuple(map(short_type, clustering)), columns(), columns(), tuple(map(is_reversed, clustering)))


@dataclass(frozen=True)
class Metadata:
    partitioner: str
    header: Header = field(default_factory=Header)

    def since(self, epoch: int) -> Metadata:
        """The same with bases of times that count from ``epoch`` (in seconds)."""
        h = self.header
        return replace(self, header=replace(h, min_timestamp=h.min_timestamp + epoch * 1_000_000, min_local_deletion=h.min_local_deletion + epoch))


def _skip_histogram(w: Wire) -> None:
    w.skip(16 * w.i32())


def parse(data: bytes, version: int) -> Metadata:
    w, header = Wire(data), Header()
    if version >= naming.KA:
        parts = {w.i32(): w.i32() for _ in range(w.i32())}
        if HEADER in parts:
            w.at = parts[HEADER]
            header = Header.parse(w)
        if VALIDATION not in parts:
            raise ValueError("the Statistics file names no partitioner")
        w.at = parts[VALIDATION]
        name = w.short_bytes().decode()
    elif version >= naming.HC:
        _skip_histogram(w)
        _skip_histogram(w)
        if version >= naming.JA:
            w.skip(48)
        else:
            w.skip(20 + 8 * (version >= naming.IB) + 8 * (version >= naming.HD))
        name = w.short_bytes().decode()
    else:
        name = DEFAULT_PARTITIONER
    short = name.rpartition(".")[2]
    if short not in PARTITIONERS:
        raise ValueError(f"unknown partitioner {name}")
    return Metadata(short, header)

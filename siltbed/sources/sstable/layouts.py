"""Cells of one data file, in the layouts before and since version ma."""

from __future__ import annotations

from collections.abc import Iterator

from siltbed.functions import places
from siltbed.sources.sstable import naming
from siltbed.sources.sstable.metadata import FIXED, Header, element_type
from siltbed.sources.sstable.wire import EndOfData, Wire

#: A row's deletion time if it is not deleted, in older files.
ACTIVE = -(1 << 63)
#: Delta-coded times from here on have wrapped around: ACTIVE, in columns that aren't deleted.
NEVER = 1 << 62
#: Flags of a cell in older files.
OLD_DELETED, OLD_EXPIRING, OLD_COUNTER, OLD_RANGE = 0x01, 0x02, 0x04, 0x10
#: Flags of a row in newer files, and of its extension byte.
END, MARKER, TIMESTAMP, TTL, DELETION, ALL_COLUMNS, COMPLEX_DELETION, EXTENSION = 0x01, 0x02, 0x04, 0x08, 0x10, 0x20, 0x40, 0x80
STATIC = 0x01
#: Flags of a cell in newer files.
CELL_DELETED, CELL_EXPIRING, CELL_EMPTY, ROW_TIMESTAMP, ROW_TTL = 0x01, 0x02, 0x04, 0x08, 0x10
#: Kinds of bounds of a range of rows: whether a range that ends there, and one that begins there, includes the bound; None if none does.
BOUNDS = {0: (False, None), 1: (None, True), 2: (False, True), 5: (True, False), 6: (True, None), 7: (None, False)}

#: (clustering, row_ord, is_static, kind, name, range_end, ts, deleted, ttl, expires_at, value)
Cell = tuple


def last_component(name: bytes) -> bytes:
    """The last part of a composite name ([u16 length][bytes][1 byte] each); other names as they are."""
    at, last = 0, None
    while at + 3 <= len(name):
        n = int.from_bytes(name[at : at + 2], "big")
        if at + n + 3 > len(name):
            return name
        last = name[at + 2 : at + 2 + n]
        at += n + 3
    return last if last is not None and at == len(name) else name


def text(name: bytes) -> str:
    """Names as text; bytes that are no UTF-8 stay apart from one another as escapes."""
    return name.decode("utf-8", errors="backslashreplace")


def _is_deleted(ts: int) -> bool:
    return ts != ACTIVE


def old_partition(w: Wire, version: int, values: bool = True) -> tuple[bytes, Iterator[Cell]]:
    """Key and cells of the partition at hand. A row without a deletion and cells gives an unnamed cell, so it isn't lost.

    Without ``values`` they are skipped, and come as nulls."""
    key = w.short_bytes()
    w.skip((4 if version < naming.D else 8 if version < naming.JA else 0) + 4)  # row size, local deletion
    deletion = w.i64()
    count = w.i32() if version < naming.JA else None

    def cells() -> Iterator[Cell]:
        left, seen = count, False
        if _is_deleted(deletion):
            seen = True
            yield None, 0, False, "row_deletion", None, None, deletion, False, None, None, None
        while left is None or left > 0:
            raw = w.short_bytes()
            if left is None and not raw:
                break
            if left is not None:
                left -= 1
            name, flags = text(last_component(raw)), w.u8()
            seen = True
            if flags & OLD_RANGE:
                end = text(last_component(w.short_bytes()))
                w.skip(4)
                yield None, 0, False, "range_tombstone", name, end, w.i64(), False, None, None, None
                continue
            ttl = expires = None
            if flags & OLD_COUNTER:
                w.skip(8)
            elif flags & OLD_EXPIRING:
                ttl, expires = w.i32() & 0xFFFFFFFF, w.i32() & 0xFFFFFFFF
            ts = w.i64()
            yield None, 0, False, "cell", name, None, ts, bool(flags & OLD_DELETED), ttl, expires, w.long_bytes() if values else w.skip(w.i32())
        if not seen:
            yield None, 0, False, "cell", "", None, 0, False, None, None, None

    return key, cells()


def present(w: Wire, n: int) -> list[bool]:
    """Which of n columns a row has. The encoded set names what is missing: 0 is none."""
    encoded = w.vint()
    if encoded == 0:
        return [True] * n
    if n < 64:
        return [not encoded >> i & 1 for i in range(n)]
    kept = n - encoded
    few = kept < n // 2
    out = [not few] * n
    for _ in range(kept if few else encoded):
        out[w.vint()] = few
    return out


def _value(w: Wire, kind: str, wanted: bool = True) -> bytes | None:
    n = FIXED[kind] if kind in FIXED else w.vint()
    return w.take(n) if wanted else w.skip(n)


def element_name(column: str, path: bytes) -> str:
    """The name of an element's cell; all of a column's lie between column + ":" and column + ":g"."""
    return f"{column}:{path.hex()}"


def _clustering(w: Wire, kinds: tuple[str, ...]) -> list[bytes | None]:
    """Values of clustering columns; two bits for each tell empty (1) and null (2) ones, 32 columns to a header."""
    out: list[bytes | None] = []
    for at in range(0, len(kinds), 32):
        header = w.vint()
        for i, kind in enumerate(kinds[at : at + 32]):
            state = header >> (2 * i) & 3
            out.append(_value(w, kind) if state == 0 else None if state & 2 else b"")
    return out


def _bound(w: Wire, header: Header) -> tuple[list[bytes | None], tuple, list[int]]:
    """A bound of ranges of rows: the prefix of the clustering, what it includes (see BOUNDS), and when the range that ends there and the
    one that begins there were deleted."""
    kind, size = w.u8(), w.u16()
    if kind not in BOUNDS or size > len(header.clustering):
        raise ValueError(f"a bound of kind {kind} with {size} values")
    prefix, ends = _clustering(w, header.clustering[:size]), BOUNDS[kind]
    end = w.vint() + w.at
    w.vint()  # size of the row before
    times = []
    for _ in range(2 - ends.count(None)):
        times.append(w.vint() + header.min_timestamp)
        w.vint()  # local deletion
    if w.at != end:
        raise ValueError(f"a bound that ends at {w.at} instead of {end}")
    return prefix, ends, times


def new_partition(w: Wire, header: Header, values: bool = True) -> tuple[bytes, Iterator[Cell]]:
    """Like old_partition. A column with a cell for each element gives cells named by element_name, and a range tombstone
    over all of them where the column was deleted or overwritten. A range of deleted rows gives a rows_deletion between two places
    (see siltbed.functions.places); in a file such ranges don't overlap."""
    key = w.short_bytes()
    elements = {name: element_type(kind) for name, kind in (*header.static, *header.regular)}
    w.skip(4)  # local deletion
    partition = w.i64()

    def cells() -> Iterator[Cell]:
        if _is_deleted(partition):
            yield None, -1, False, "row_deletion", None, None, partition, False, None, None, None
        row, since = 0, None
        seen = _is_deleted(partition)
        while True:
            flags = w.u8()
            if flags & END:
                if since is not None:
                    raise ValueError("range tombstones over clustering columns: one has no end")
                break
            static = bool(flags & EXTENSION and w.u8() & STATIC)
            if flags & MARKER:
                try:
                    order = places.check_order(header.order)
                    prefix, (ends, begins), times = _bound(w, header)
                    if (since is None) != (ends is None):
                        raise ValueError("a bound with no range before it" if since is None else "a range in another")
                except (EndOfData, ValueError) as e:
                    raise ValueError(f"range tombstones over clustering columns: {e}") from e
                if ends is not None:
                    first, ts = since
                    yield None, row, False, "rows_deletion", first, places.up_to(prefix, order, ends), ts, False, None, None, None
                since = (places.at_or_after(prefix, order, begins), times[-1]) if begins is not None else None
                seen = True
                continue
            cluster = None if static else _clustering(w, header.clustering)
            w.vint()  # row size
            w.vint()  # size of the row before
            row_ts, row_ttl, row_expires = 0, None, None
            if flags & TIMESTAMP:
                row_ts = w.vint() + header.min_timestamp
                if flags & TTL:
                    row_ttl = w.vint() + header.min_ttl
                    row_expires = w.vint() + header.min_local_deletion
            if flags & DELETION:
                deleted_at = w.vint() + header.min_timestamp
                w.vint()  # local deletion
                yield cluster, row, static, "row_deletion", None, None, deleted_at, False, None, None, None
            if flags & TIMESTAMP or not flags & DELETION:
                # the row itself, which may have no columns
                yield cluster, row, static, "cell", "", None, row_ts, False, row_ttl, row_expires, None
            columns = header.static if static else header.regular
            has = [True] * len(columns) if flags & ALL_COLUMNS else present(w, len(columns))
            def cell(name: str, kind: str, inside: bool) -> Cell:
                f = w.u8()
                ts = row_ts if f & ROW_TIMESTAMP else w.vint() + header.min_timestamp
                ttl = expires = None
                if f & ROW_TTL:
                    ttl, expires = row_ttl, row_expires
                else:
                    if f & (CELL_DELETED | CELL_EXPIRING):
                        local = w.vint() + header.min_local_deletion
                    if f & CELL_EXPIRING:
                        expires, ttl = local, w.vint() + header.min_ttl
                if inside:
                    name = element_name(name, w.vint_bytes())
                value = (b"" if values else None) if f & CELL_EMPTY else _value(w, kind, values)
                return cluster, row, static, "cell", name, None, ts, bool(f & CELL_DELETED), ttl, expires, value

            for (name, kind), there in zip(columns, has, strict=True):
                if not there:
                    continue
                if elements[name] is None:
                    yield cell(name, kind, False)
                    continue
                if flags & COMPLEX_DELETION:
                    ts = w.vint() + header.min_timestamp
                    w.vint()  # local deletion
                    if ts < NEVER:
                        yield cluster, row, static, "range_tombstone", f"{name}:", f"{name}:g", ts, False, None, None, None
                for _ in range(w.vint()):
                    yield cell(name, elements[name], True)
            seen = True
            row += 1
        if not seen:
            yield None, 0, True, "cell", "", None, 0, False, None, None, None

    return key, cells()

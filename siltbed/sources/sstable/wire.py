"""Big-endian wire primitives over anything with read(n)."""

from __future__ import annotations

import struct


class EndOfData(Exception):
    """Fewer bytes are left than were asked for."""


class Wire:
    """Reads primitives from a source with ``take(n) -> bytes`` of exactly n bytes."""

    def __init__(self, data: bytes | None = None):
        self._data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self._data):
            raise EndOfData(f"{n} bytes at {self.at} of {len(self._data)}")
        out = self._data[self.at : self.at + n]
        self.at += n
        return out

    def skip(self, n: int) -> None:
        self.at += n

    def more(self) -> bool:
        return self.at < len(self._data)

    def u8(self) -> int:
        return self.take(1)[0]

    def u16(self) -> int:
        return struct.unpack(">H", self.take(2))[0]

    def i32(self) -> int:
        return struct.unpack(">i", self.take(4))[0]

    def i64(self) -> int:
        return struct.unpack(">q", self.take(8))[0]

    def f32(self) -> float:
        return struct.unpack(">f", self.take(4))[0]

    def f64(self) -> float:
        return struct.unpack(">d", self.take(8))[0]

    def vint(self) -> int:
        """Unsigned variable-length integer: as many leading ones in the first byte as further bytes follow."""
        first = self.u8()
        more = 8 - (~first & 0xFF).bit_length()
        rest = first & (0xFF >> more)
        return rest << (8 * more) | int.from_bytes(self.take(more), "big")

    def signed_vint(self) -> int:
        """Zig-zag form of vint."""
        n = self.vint()
        return n >> 1 ^ -(n & 1)

    def short_bytes(self) -> bytes:
        return self.take(self.u16())

    def vint_bytes(self) -> bytes:
        return self.take(self.vint())

    def long_bytes(self) -> bytes:
        return self.take(self.i32())


def put_vint(n: int) -> bytes:
    """vint's inverse."""
    more = 0
    while more < 8 and n >= 1 << (7 * (more + 1)):
        more += 1
    if more == 8:
        return b"\xff" + n.to_bytes(8, "big")
    out = bytearray(n.to_bytes(more + 1, "big"))
    out[0] |= 0xFF << (8 - more) & 0xFF
    return bytes(out)

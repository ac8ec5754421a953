"""Files of local folders and of whatever file systems pyarrow can reach, with compressed ones read by chunk."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs

from siltbed.sources.sstable.wire import EndOfData, Wire


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return pafs.LocalFileSystem(), path


def read_all(path: str) -> bytes | None:
    """A file's bytes, None if there is none."""
    fs, where = file_system(path)
    if fs.get_file_info(where).type != pafs.FileType.File:
        return None
    with fs.open_input_file(where) as f:
        return f.read()


def is_file(path: str) -> bool:
    fs, where = file_system(path)
    return fs.get_file_info(where).type == pafs.FileType.File


def read_some(path: str, at: int, most: int) -> bytes | None:
    """Up to ``most`` bytes of a file from a place, None if there is no file."""
    if not is_file(path):
        return None
    fs, where = file_system(path)
    with fs.open_input_file(where) as f:
        f.seek(at)
        return f.read(most)


@dataclass(frozen=True)
class Chunks:
    """CompressionInfo: codec, uncompressed bytes of a chunk and of the file, where each chunk begins."""

    codec: str
    chunk: int
    length: int
    offsets: tuple[int, ...]

    @classmethod
    def parse(cls, data: bytes) -> Chunks:
        w = Wire(data)
        codec = w.short_bytes().decode().rpartition(".")[2]
        if codec not in ("SnappyCompressor", "LZ4Compressor", "DeflateCompressor"):
            raise ValueError(f"unknown compression {codec}")
        for _ in range(w.i32()):
            w.short_bytes()
            w.short_bytes()
        chunk, length = w.i32(), w.i64()
        return cls(codec, chunk, length, tuple(w.i64() for _ in range(w.i32())))


def decompress(codec: str, data: bytes, most: int) -> bytes:
    """One chunk; never more than ``most`` bytes."""
    if codec == "DeflateCompressor":
        out = zlib.decompressobj().decompress(data, most)
    elif codec == "LZ4Compressor":
        size = int.from_bytes(data[:4], "little")
        if size > most:
            raise ValueError(f"a chunk of {size} bytes, more than {most}")
        out = pa.decompress(data[4:], decompressed_size=size, codec="lz4_raw", asbytes=True)
    else:
        size = shift = i = 0
        while i < len(data):
            size |= (data[i] & 0x7F) << shift
            shift += 7
            i += 1
            if data[i - 1] < 0x80:
                break
        if size > most:
            raise ValueError(f"a chunk of {size} bytes, more than {most}")
        out = pa.decompress(data, decompressed_size=size, codec="snappy", asbytes=True)
    return out


class DataFile(Wire):
    """A data file from ``start``, uncompressed bytes counted; one chunk and what is being read are held.

    The checksum after each chunk is over its compressed bytes if ``over_compressed``, Adler-32 if ``adler`` else CRC-32.
    """

    #: Bytes of an uncompressed file that are read at once.
    PLAIN = 1 << 16

    def __init__(self, path: str, chunks: Chunks | None, start: int = 0, checksum: bool = True, adler: bool = False, over_compressed: bool = True):
        super().__init__(b"")
        fs, where = file_system(path)
        self._file, self._chunks = fs.open_input_file(where), chunks
        self.path, self.length, self.at = path, chunks.length if chunks else self._file.size(), start
        self._check, self._sum, self._over_compressed = checksum, zlib.adler32 if adler else zlib.crc32, over_compressed
        self._held, self._held_at = b"", 0

    def close(self) -> None:
        self._file.close()

    def more(self) -> bool:
        return self.at < self.length

    def _chunk(self, n: int) -> bytes:
        c = self._chunks
        begin = c.offsets[n]
        end = c.offsets[n + 1] if n + 1 < len(c.offsets) else self._file.size()
        self._file.seek(begin)
        raw = self._file.read(end - begin)
        body, told = raw[:-4], int.from_bytes(raw[-4:], "big")
        most = min(c.chunk, c.length - n * c.chunk)
        if self._check and self._over_compressed and self._sum(body) != told:
            raise ValueError(f"checksum mismatch in {self.path} at {begin}")
        out = decompress(c.codec, body, most)
        if len(out) != most:
            raise ValueError(f"{self.path}: chunk at {begin} has {len(out)} bytes instead of {most}")
        if self._check and not self._over_compressed and self._sum(out) != told:
            raise ValueError(f"checksum mismatch in {self.path} at {begin}")
        return out

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > self.length:
            raise EndOfData(f"{n} bytes at {self.at} of {self.path}")
        a = self.at - self._held_at
        if 0 <= a and a + n <= len(self._held):
            self.at += n
            return self._held[a : a + n]
        out = []
        left, at = n, self.at
        while left:
            a = at - self._held_at
            if not 0 <= a < len(self._held):
                if self._chunks:
                    k = at // self._chunks.chunk
                    self._held, self._held_at = self._chunk(k), k * self._chunks.chunk
                else:
                    self._file.seek(at)
                    self._held, self._held_at = self._file.read(max(left, self.PLAIN)), at
                a = at - self._held_at
            part = self._held[a : a + left]
            out.append(part)
            left -= len(part)
            at += len(part)
        self.at = at
        return b"".join(out)

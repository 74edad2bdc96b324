"""Seekable Zstandard files: independent frames, an index of what they hold, and
a trailing seek table with a checksum of every frame.

Layout (little-endian)::

    frame 0 .. frame n-1     Zstandard frames
    index                    skippable frame 0x184D2A50, the caller's bytes
    seek table               skippable frame 0x184D2A5E: n x (compressed u32,
                             decompressed u32, XXH64 low half u32), then
                             n u32, descriptor u8 (0x80: checksums), 0x8F92EAB1

The seek table is the public seekable-Zstandard layout, so a plain Zstandard
reader sees one stream. A reader takes the two tables from the end of the file
and decompresses only the frames it wants.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

import xxhash
import zstandard

INDEX_MAGIC, SEEK_MAGIC, END_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
ENTRY, FOOTER, SKIPPABLE = "<III", "<IBI", "<II"
ENTRY_BYTES, FOOTER_BYTES, HEAD_BYTES = map(struct.calcsize, (ENTRY, FOOTER, SKIPPABLE))


class Frame(NamedTuple):
    position: int
    packed: int
    full: int
    check: int


class Writer:
    def __init__(self, out, level: int):
        self.out, self.squeeze = out, zstandard.ZstdCompressor(level=level)
        self.table = bytearray()

    def frame(self, data: bytes) -> int:
        """Write one frame; returns its number."""
        packed = self.squeeze.compress(data)
        self.out.write(packed)
        self.table += struct.pack(ENTRY, len(packed), len(data), checksum(data))
        return len(self.table) // ENTRY_BYTES - 1

    def close(self, index: bytes) -> None:
        frames = len(self.table) // ENTRY_BYTES
        self.out.write(struct.pack(SKIPPABLE, INDEX_MAGIC, len(index)) + index)
        self.out.write(struct.pack(SKIPPABLE, SEEK_MAGIC, len(self.table) + FOOTER_BYTES))
        self.out.write(bytes(self.table) + struct.pack(FOOTER, frames, 0x80, END_MAGIC))


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def read_tables(handle) -> tuple[list[Frame], bytes]:
    """The frames and the index."""
    size = handle.size()
    n, flags, magic = struct.unpack(FOOTER, handle.read_at(FOOTER_BYTES, size - FOOTER_BYTES))
    if magic != END_MAGIC or flags != 0x80:
        raise ValueError("no seek table")
    start = size - FOOTER_BYTES - n * ENTRY_BYTES
    frames, at = [], 0
    for packed, full, check in struct.iter_unpack(ENTRY, handle.read_at(n * ENTRY_BYTES, start)):
        frames.append(Frame(at, packed, full, check))
        at += packed
    kind, length = struct.unpack(SKIPPABLE, handle.read_at(HEAD_BYTES, at))
    if kind != INDEX_MAGIC or at + HEAD_BYTES + length + HEAD_BYTES != start:
        raise ValueError("no index")
    return frames, handle.read_at(length, at + HEAD_BYTES)


def read_frame(handle, frame: Frame) -> bytes:
    """One frame's bytes; damage is an error."""
    data = zstandard.ZstdDecompressor().decompress(handle.read_at(frame.packed, frame.position), max_output_size=frame.full)
    if len(data) != frame.full or checksum(data) != frame.check:
        raise ValueError(f"checksum of the frame at {frame.position}")
    return data

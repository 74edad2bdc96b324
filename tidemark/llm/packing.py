"""Sum-of-squares online packing of token ids into windows of fixed size.

``N[h]`` counts the open windows filled to level h. A document of s ids goes to
the level h (0: a new window) for which the sum of all ``N[h]**2`` afterwards is
least; of equals, to the fullest. Full windows leave at once. A document longer
than a window first fills whole windows of its own; its rest is placed.

When a task's documents end, its open windows are closed up: the emptiest are cut
and fill the gaps of the fullest, and the last rest is laid out in sequences of
power-of-two lengths, which take no padding. Every task packs its own documents,
so nothing is shuffled and no window is shared.

Defined results: a null or empty text is the end id alone; a null ``doc_id``
stays null; repeated rows are packed one by one; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import batches, partition_id, rows_of, text_or_empty

WINDOW = 4096
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"

#: (doc_id, start, ids, doc_tokens): a cut of one document
Piece = tuple[int | None, int, bytes, int]


class SumOfSquares:
    """Open windows by fill level; ``place`` returns a window once it is full."""

    def __init__(self, size: int):
        self.size = size
        self.level = np.zeros(size + 1, dtype=np.int64)  # N[h], 0 < h < size
        self.open: dict[int, list[list[Piece]]] = {}

    def best_level(self, s: int) -> int:
        """The level that minimises the growth of the sum of squares."""
        room = self.size - s
        here, there = self.level[: room + 1], self.level[s : self.size + 1]
        growth = 2 * there + 1
        growth[room] = 0  # a full window leaves
        growth[1:] += 1 - 2 * here[1:]
        growth[1:][here[1:] == 0] = np.iinfo(np.int64).max  # no such window
        return room - int(np.argmin(growth[::-1]))

    def place(self, piece: Piece) -> list[Piece] | None:
        s = len(piece[2]) // 4
        h = self.best_level(s)
        window = self.open[h].pop() if h else []
        self.level[h] -= h > 0
        window.append(piece)
        if h + s == self.size:
            return window
        self.level[h + s] += 1
        self.open.setdefault(h + s, []).append(window)
        return None

    def rest(self) -> Iterator[list[Piece]]:
        """Close up what is open: full windows, then power-of-two sequences."""
        windows = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        gaps, loose = [(w, self.size - sum(len(p[2]) // 4 for p in w)) for w in windows], []
        first, last = 0, len(gaps) - 1
        while first <= last:
            window, room = gaps[first]
            while room:
                if not loose:
                    if last <= first:
                        break
                    loose = gaps[last][0][::-1]
                    last -= 1
                piece = loose.pop()
                head, tail = cut(piece, room)
                window.append(head)
                room -= len(head[2]) // 4
                if tail:
                    loose.append(tail)
            if room == 0:
                yield window
            else:
                yield from powers_of_two(window)
            first += 1
        if loose:  # less than a window
            yield from powers_of_two(loose[::-1])


def cut(piece: Piece, most: int) -> tuple[Piece, Piece | None]:
    doc_id, start, ids, total = piece
    if len(ids) <= 4 * most:
        return piece, None
    return (doc_id, start, ids[: 4 * most], total), (doc_id, start + most, ids[4 * most :], total)


def powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Sequences whose lengths are the powers of two in the pieces' total."""
    left = sum(len(p[2]) // 4 for p in pieces)
    queue = pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        sequence = []
        while room:
            head, tail = cut(queue.pop(), room)
            sequence.append(head)
            room -= len(head[2]) // 4
            if tail:
                queue.append(tail)
        yield sequence


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str = tokens.VOCABULARY, end_id: int = tokens.END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and, with ``with_ids``, the piece's ids (uint32, little-endian)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end, packer, task = tokens.encoder(vocabulary), tokens.as_bytes([end_id]), SumOfSquares(window), partition_id()

        def sequences() -> Iterator[list[Piece]]:
            for batch in parts:
                for doc_id, text in rows_of(batch):
                    ids = tokens.encode(text, ids_of) + end
                    total, start = len(ids) // 4, 0
                    while total - start >= window:
                        yield [(doc_id, start, ids[4 * start : 4 * (start + window)], total)]
                        start += window
                    if start < total:
                        full = packer.place((doc_id, start, ids[4 * start :], total))
                        if full:
                            yield full
            yield from packer.rest()

        def rows() -> Iterator[tuple]:
            for number, sequence in enumerate(sequences()):
                offset = 0
                for doc_id, start, ids, total in sequence:
                    n = len(ids) // 4
                    yield doc_id, start, n, zlib.crc32(ids), total, (task << 40) | number, offset, ids if with_ids else None
                    offset += n

        longs = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        yield from batches(rows(), pa.schema([*((c, pa.int64()) for c in longs), ("ids", pa.binary())]), 512 if with_ids else 8192)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    out = rows.mapInArrow(run, PIECES)
    return out if with_ids else out.drop("ids")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)

"""Token counts that follow edits: segment trees over pre-tokens.

A document's text is cut before white space into segments of about ``SEGMENT``
characters, the leaves of a segment tree whose nodes hold the token ids and the
characters below them. The tokenizer never merges across white space, so a
document's count is the sum at the root. An edit walks down to the segments it
touches, takes the segment before as well where the new text no longer starts with
white space (the boundary context), encodes those segments alone and updates the
sums above them.

Positions and lengths of edits are in characters (code points) of the text as the
edits before left it; edits that reach past the end stop there.

Defined results: a null or empty text has no tokens and one empty segment; null or
no edits leave the count as it is; a null doc_id stays null; repeated rows are
handled one by one; an empty table gives no rows; other columns are ignored. A
document's edits apply one after another, so they stay together in one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import batches, rows_of, text_or_empty

SEGMENT = 256
EDITS = "array<struct<position: long, deleted: long, inserted: string>>"
TREES = f"doc_id long, text string, segment_chars array<int>, segment_tokens array<int>, edits {EDITS}"
COUNTS = "doc_id long, n_tokens long, n_edits int, n_tokens_after long, n_chars_after long, encoded_chars long"


def cut(text: str) -> list[str]:
    """Segments that, but for the first, start with white space."""
    out, at = [], 0
    while at < len(text):
        gap = tokens.SPACE.search(text, at + SEGMENT)
        end = gap.start() if gap else len(text)
        out.append(text[at:end])
        at = end
    return out or [""]


def count(text: str, ids: tokens.ChunkEncoder) -> int:
    return sum(len(ids[c]) for c in tokens.chunks(text)) // 4


class SegmentTree:
    """Node i has children 2i and 2i + 1; leaves begin at ``size``."""

    def __init__(self, segments: list[str], counts: list[int], ids: tokens.ChunkEncoder):
        self.ids, self.encoded = ids, 0
        self.plant(segments, counts)

    def plant(self, segments: list[str], counts: list[int]) -> None:
        self.segments = segments
        self.size = 1 << max(0, (len(segments) - 1).bit_length())
        pad = [0] * (self.size - len(segments))
        self.tokens = [0] * self.size + counts + pad
        self.chars = [0] * self.size + [len(s) for s in segments] + pad
        for node in range(self.size - 1, 0, -1):
            self.add_up(node)

    def add_up(self, node: int) -> None:
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]

    def locate(self, position: int) -> tuple[int, int]:
        """The segment that holds the character, and the place in it."""
        node = 1
        while node < self.size:
            node *= 2
            if position >= self.chars[node] and self.chars[node + 1]:
                position -= self.chars[node]
                node += 1
        return node - self.size, position

    def edit(self, position: int, deleted: int, inserted: str) -> None:
        position = max(0, min(position, self.chars[1]))
        deleted = max(0, min(deleted, self.chars[1] - position))
        first, offset = self.locate(position)
        last, held = first, len(self.segments[first])
        while held < offset + deleted:
            last += 1
            held += len(self.segments[last])
        old = "".join(self.segments[first : last + 1])
        new = old[:offset] + inserted + old[offset + deleted :]
        if new and not tokens.SPACE.match(new):  # may go on what stands before
            before = first - 1
            while before >= 0 and not self.segments[before]:
                before -= 1
            if before >= 0:
                first, new = before, self.segments[before] + new
        self.encoded += len(new)
        if len(new) > 4 * SEGMENT * (last - first + 1):  # too much for these leaves: more of them
            parts = cut(new)
            counts = self.tokens[self.size : self.size + len(self.segments)]
            self.plant(self.segments[:first] + parts + self.segments[last + 1 :], counts[:first] + [count(p, self.ids) for p in parts] + counts[last + 1 :])
            return
        for i in range(first, last + 1):
            self.segments[i] = new if i == first else ""
            self.tokens[self.size + i] = count(new, self.ids) if i == first else 0
            self.chars[self.size + i] = len(self.segments[i])
        low, high = (self.size + first) // 2, (self.size + last) // 2
        while low:
            for node in range(low, high + 1):
                self.add_up(node)
            low, high = low // 2, high // 2


def plant_trees(docs: DataFrame, edits: Column, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """The leaves of every document's tree, with its text and ``edits``: a table that
    may be stored and edited later."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = tokens.encoder(vocabulary)
        for batch in parts:
            chars, counts = [], []
            for text in batch.column(1).to_pylist():
                segments = cut(text)
                chars.append([len(s) for s in segments])
                counts.append([count(s, ids) for s in segments])
            arrays = [*batch.columns[:2], pa.array(chars, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())), batch.column(2)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text", "segment_chars", "segment_tokens", "edits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), edits.cast(EDITS).alias("edits"))
    return rows.mapInArrow(run, TREES)


def edited_counts(trees: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """Counts before and after each document's edits; ``encoded_chars``: the
    characters that the edits had encoded again."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = tokens.encoder(vocabulary)
        longs = [("n_tokens", pa.int64()), ("n_edits", pa.int32()), ("n_tokens_after", pa.int64()), ("n_chars_after", pa.int64()), ("encoded_chars", pa.int64())]

        def rows() -> Iterator[tuple]:
            for batch in parts:
                for doc_id, text, chars, counts, edits in rows_of(batch):
                    segments, at = [], 0
                    for n in chars:
                        segments.append(text[at : at + n])
                        at += n
                    tree = SegmentTree(segments, counts, ids)
                    for e in edits or []:
                        tree.edit(e["position"], e["deleted"], e["inserted"] or "")
                    yield doc_id, sum(counts), len(edits or []), tree.tokens[1], tree.chars[1], tree.encoded

        yield from batches(rows(), pa.schema([("doc_id", pa.int64()), *longs]))

    return trees.mapInArrow(run, COUNTS)


def revision() -> Column:
    """Three edits of a document, from its own text: a replacement, an insertion of
    its first words and a deletion. A null text has none."""
    n = F.length("text")
    edits = [
        (F.floor(n / 4), F.lit(20), F.lit("Revised wording, ")),
        (F.floor(n / 2), F.lit(0), F.substring("text", 1, 12)),
        (F.floor(n * 3 / 4), F.lit(9), F.lit("")),
    ]
    return F.when(n.isNotNull(), F.array(*(F.struct(p.cast("long").alias("position"), d.cast("long").alias("deleted"), i.alias("inserted")) for p, d, i in edits)))


def op10_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return edited_counts(plant_trees(docs, revision()))

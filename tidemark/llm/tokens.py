"""Token ids of whole texts with a public word-level BPE tokenizer.

The tokenizer drops white space and never merges across it, so a text's ids are
the ids of its white-space-separated chunks in order. Each distinct chunk goes
through the library once per cache life; the cache is bounded.
"""

from __future__ import annotations

import re
import struct
from itertools import islice

import public_tokenizers
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
CACHE_CHUNKS = 300_000
LONGEST_CACHED = 64

#: White space of the tokenizer's pattern; str.split() also splits at four
#: control characters, which the tokenizer keeps.
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: Letters and a run of punctuation are two pre-tokens, whatever surrounds them.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?&%$#*|()-]*)")

_encoders: dict[str, ChunkEncoder] = {}


class ChunkEncoder(dict):
    """chunk -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        # The characters that stand for the bytes of a non-ASCII letter, from the library's own steps.
        self.letters = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c != "÷"}

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():  # lower-casing is all the normalising, and it is one pre-token
            lower = chunk.lower()
            ids = self[lower] if lower != chunk and lower in self else as_bytes([t.id for t in self.model.tokenize(lower)])
        elif (plain := PLAIN.fullmatch(chunk)) is None:
            ids = as_bytes(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        elif plain[2]:
            ids = self[plain[1]] + self.punctuation(plain[2])
        else:
            ids = as_bytes([t.id for t in self.model.tokenize(chunk.lower().translate(self.letters))])
        return self.keep(chunk, ids)

    def keep(self, chunk: str, ids: bytes) -> bytes:
        """Cache short chunks; a full cache keeps its older half, where the frequent ones are."""
        if len(chunk) <= LONGEST_CACHED:
            if len(self) >= CACHE_CHUNKS:
                older = list(islice(self.items(), CACHE_CHUNKS // 2))
                self.clear()
                self.update(older)
            self[chunk] = ids
        return ids

    def punctuation(self, chunk: str) -> bytes:
        ids = self.get(chunk)
        if ids is None:
            ids = self.keep(chunk, as_bytes(self.tokenizer.encode(chunk, add_special_tokens=False).ids))
        return ids


def as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encoder(vocabulary: str = VOCABULARY) -> ChunkEncoder:
    """One encoder per Python worker and vocabulary."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = ChunkEncoder(vocabulary)
    return _encoders[vocabulary]


def chunks(text: str) -> list[str]:
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return [c for c in SPACE.split(text) if c]
    return text.split()


def encode(text: str, ids: ChunkEncoder) -> bytes:
    """Ids of a whole text without the end id, as little-endian uint32 bytes."""
    return b"".join([ids[c] for c in chunks(text)])

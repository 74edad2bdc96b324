"""Benchmark decontamination: counted word-pair seeds and Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased. Smith-Waterman over words scores
a passage against a test item, which allows for replaced, dropped and added words.
The seeds lose no passage that reaches the score asked for: of two words that an
alignment matches one after the other, those with at most one word replaced,
dropped or added between them are one or two places apart on either side. Each step
that is wider costs a match at least, so an alignment of score T holds
``T / 2 - 1`` such pairs or more, each from another place of the item.

Every pair of words one or two places apart in an item is looked for in all
documents through a Bloom filter of fixed size, and what passes is joined with the
items' pairs, so the document frequency of each is known over the whole corpus. As
many of an item's rarest places are seeds as are sure to hold half of the pairs
that the score guarantees, whatever the frequencies are; passages that hold that
many of them are aligned, unless all their pairs with the item are too few for it.

A passage reaches as far around the document's hits as the longest item is long.
A document leaks an item if the score is at least ``LEAST`` of the item's score
against itself, or, however long the item is, that of ``PASSAGE`` matched words. Of
items of less than ``2 * FEW`` words ``FEW`` matched words are asked, or ``SHORT_LEAST``
of the score where that is less: three common words in a row are no leak.

Nothing of the corpus is collected or broadcast; the Bloom filter is a bit map of
``BLOOM_BITS`` bits whatever the number of items, and more items only let more
pairs pass it to the join. The words of a passage are shuffled only if a filter of the
same size over the passages to align lets it pass.

Defined results: null and empty texts have no words and leak nothing; an item of
fewer words than ``GRAM`` leaks where it stands word for word; a null doc_id or
item_id takes no part; repeated rows, also those that repeat an id with another
text, are judged one by one and the best score of the pair is returned; an empty table on either
side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, materialize, rows_of, text_or_empty

GRAM = 3
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST, SHORT_LEAST = 0.5, 0.8
PASSAGE, FEW = 13, 5
BLOOM_BITS = 1 << 24
CACHED_WORDS, CACHED_ITEMS = 200_000, 1_000
#: words of documents that are looked up at a time; a longer text is taken whole
TOGETHER = 1 << 16
WORD = re.compile(r"[^\W_]+")
#: what ``WORD`` leaves out of ASCII text, as blanks
BLANKS = "".join(c if WORD.match(c) else " " for c in map(chr, range(128)))

#: an item row: its id and a hash of its words
ITEM = ["item_id", "item_key"]
#: places of the words of a seed, from its first one on
ONE, PAIRS = (0,), ((0, 1), (0, 2))

GRAMS = "item_id long, item_key long, place int, gram long, n_words int, words string"
HITS = "doc_id long, passage int, words string, grams array<long>"
SEEDS = "item_id long, item_key long, place int, least int"


class WordHashes(dict):
    """word -> 63-bit hash, bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word) >> 1
        return value


_hashes = WordHashes()


def words_of(text: str) -> list[str]:
    text = text.lower()
    return text.translate(BLANKS).split() if text.isascii() else WORD.findall(text)


def word_hashes(words: Iterator[str] | list[str]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64)


def gram_hashes(ids: np.ndarray, at: tuple[int, ...]) -> np.ndarray:
    """A hash of the words ``at`` each place; how far apart they stand is not in it."""
    n = max(len(ids) - at[-1], 0)
    h = np.full(n, len(at), dtype=np.uint64)
    for j in at:
        h = (h ^ ids[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def needed_score(n_words: int, least: float) -> float:
    """The score from which on a passage leaks an item of so many words."""
    if n_words < GRAM:
        return MATCH * n_words
    short = MATCH * min(n_words * max(SHORT_LEAST, least), FEW)
    return min(max(MATCH * n_words * least, short), MATCH * PASSAGE)


def seed_counts(n_words: int, least: float) -> tuple[int, int]:
    """How many of an item's rarest places are seeds, and how many of them every
    passage that reaches the score holds."""
    places = max(n_words - 1, 1)
    sure = max(1, math.ceil(math.ceil(needed_score(n_words, least)) / MATCH - 1))
    asked = (sure + 1) // 2
    return min(places, places - sure + asked), asked


def item_grams(items: DataFrame) -> DataFrame:
    """Every pair of every item: item_id, item_key (of its words), place, gram,
    n_words, and words on one row."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("item_id", pa.int64()), ("item_key", pa.int64()), ("place", pa.int32()), ("gram", pa.int64()), ("n_words", pa.int32()), ("words", pa.string())])

        def rows() -> Iterator[tuple]:
            for batch in parts:
                for item_id, text in rows_of(batch):
                    words = words_of(text)
                    ids, whole = word_hashes(words), " ".join(words)
                    key = xxhash.xxh64_intdigest(whole) >> 1
                    for at in PAIRS if len(words) > 1 else [ONE]:
                        for place, gram in enumerate(gram_hashes(ids, at)):
                            yield item_id, key, place, int(gram), len(words), whole if place == 0 and at in (ONE, PAIRS[0]) else None

        yield from batches(rows(), schema)

    rows = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text"))
    return materialize(rows.mapInArrow(run, GRAMS), "leak-grams")


def bloom(grams: DataFrame) -> np.ndarray:
    """A bit map of the pairs' hashes: BLOOM_BITS bits, so at most BLOOM_BITS / 64
    numbers reach the driver."""
    bits = grams.select(F.explode(F.array(*(F.pmod(F.shiftright("gram", s), F.lit(BLOOM_BITS)) for s in (0, 24)))).alias("bit")).distinct()
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    out = np.zeros(BLOOM_BITS // 64, dtype=np.int64)
    for word, value in words.collect():
        out[word] = value
    return out


def passes(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    ok = np.ones(len(grams), dtype=bool)
    for shift in (0, 24):
        at = (grams >> shift) & (BLOOM_BITS - 1)
        ok &= (bits[at >> 6] >> (at & 63)) & 1 == 1
    return ok


def known_pairs(texts: list[list[str]], known: np.ndarray, kinds: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' pairs that pass the filter: number of the text, place in it (rising) and gram."""
    starts = np.cumsum([0, *map(len, texts)])
    ids = word_hashes(chain.from_iterable(texts))
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    places, grams = [], []
    for kind in kinds:
        h = gram_hashes(ids, kind)
        at = np.flatnonzero(passes(known, h))
        at = at[owner[at] == owner[at + kind[-1]]]  # no pair reaches into the next text
        places.append(at)
        grams.append(h[at])
    places, grams = np.concatenate(places), np.concatenate(grams)
    order = np.argsort(places, kind="stable")
    places, grams = places[order], grams[order]
    return owner[places], places - starts[owner[places]], grams


def passages(docs: DataFrame, bits: np.ndarray, kinds: list[tuple[int, ...]], reach: int) -> DataFrame:
    """Pairs of the documents that pass the filter, each once for every passage; a
    passage reaches ``reach`` words around them. No best alignment spans ``3 * reach``
    words without a pair: that costs more than the lesser side of it scores."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    schema = pa.schema([("doc_id", pa.int64()), ("passage", pa.int32()), ("words", pa.string()), ("grams", pa.list_(pa.int64()))])

    def cut(doc_ids: list[int], texts: list[list[str]]) -> pa.RecordBatch:
        owner, places, grams = known_pairs(texts, shared.value, kinds)
        first = np.ones(len(owner), dtype=bool)  # pairs that begin a passage
        first[1:] = (np.diff(owner) > 0) | (np.diff(places) > 3 * reach + 2)
        begin = np.flatnonzero(first)
        docs_of = owner[begin]
        number = np.arange(len(begin)) - np.searchsorted(docs_of, docs_of)
        last = np.append(begin[1:], len(owner))[: len(begin)] - 1
        words = [" ".join(texts[d][max(0, p - reach) : q + reach + 2]) for d, p, q in zip(docs_of.tolist(), places[begin].tolist(), places[last].tolist(), strict=True)]
        passage = np.cumsum(first) - 1
        order = np.lexsort((grams, passage))
        grams, passage = grams[order], passage[order]
        once = np.ones(len(grams), dtype=bool)
        once[1:] = (np.diff(passage) > 0) | (grams[1:] != grams[:-1])
        grams, passage = grams[once], passage[once]
        held = pa.ListArray.from_arrays(pa.array(np.searchsorted(passage, np.arange(len(begin) + 1)), pa.int32()), pa.array(grams, pa.int64()))
        ids = pa.array(np.array(doc_ids, dtype=np.int64)[docs_of])
        return pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(words, pa.string()), held], schema=schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, texts, total = [], [], 0
        for batch in parts:
            for doc_id, text in rows_of(batch):
                words = words_of(text)
                doc_ids.append(doc_id)
                texts.append(words)
                total += len(words)
                if total >= TOGETHER:
                    yield cut(doc_ids, texts)
                    doc_ids, texts, total = [], [], 0
        if texts:
            yield cut(doc_ids, texts)

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return materialize(rows.mapInArrow(run, HITS), "leak-passages")


def among(passages: DataFrame, pairs: DataFrame) -> DataFrame:
    """The passages that ``pairs`` may name: those that it names pass a filter of fixed
    size, so the words of few others are shuffled."""
    place = F.xxhash64("doc_id", "passage")
    shared = passages.sparkSession.sparkContext.broadcast(bloom(pairs.select(place.alias("gram"))))

    @F.arrow_udf("boolean")
    def named(places: pa.Array) -> pa.Array:
        return pa.array(passes(shared.value, places.to_numpy()))

    return passages.where(named(place))


def chosen_seeds(grams: DataFrame, frequency: DataFrame, least: float) -> DataFrame:
    """item_id, item_key, gram, place, least (places that a passage must hold) of the seeds."""
    counted = grams.select(*ITEM, "place", "gram", "n_words").join(frequency, "gram", "left")
    counted = materialize(counted, "leak-counted")
    places = counted.groupBy(*ITEM, "place").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"), F.max("n_words").alias("n_words"))
    rank = F.row_number().over(Window.partitionBy(*ITEM).orderBy("n", "place"))
    places = places.withColumn("rank", rank)  # places that no document holds count among the rarest

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in parts:
                for item_id, key, place, n_words, at in rows_of(batch):
                    taken, asked = seed_counts(n_words, least)
                    if at <= taken:
                        yield item_id, key, place, asked

        yield from batches(rows(), pa.schema([("item_id", pa.int64()), ("item_key", pa.int64()), ("place", pa.int32()), ("least", pa.int32())]))

    taken = materialize(places.select(*ITEM, "place", "n_words", "rank").mapInArrow(run, SEEDS), "leak-places")
    found = counted.where("n is not null").select(*ITEM, "place", "gram").distinct()
    return materialize(found.join(taken, [*ITEM, "place"]), "leak-seeds")


def align(passage: list[str], item: list[str]) -> int:
    """Smith-Waterman score of the best local alignment of two word lists."""
    number = {w: i for i, w in enumerate(dict.fromkeys(item))}
    x = np.array([number.get(w, -1) for w in passage])
    slope = -GAP * np.arange(len(x) + 1)
    above, best = np.zeros(len(x) + 1, dtype=np.int64), 0
    for w in item:
        row = np.zeros(len(x) + 1, dtype=np.int64)
        row[1:] = np.maximum(0, above[:-1] + np.where(x == number[w], MATCH, MISMATCH))
        row = np.maximum(row, above + GAP)
        row = np.maximum.accumulate(row + slope) - slope  # gaps along the passage
        above = np.maximum(row, 0)
        best = max(best, int(above.max()))
    return best


class Pairs(NamedTuple):
    words: np.ndarray  # sorted distinct hashes of the item's words
    near: np.ndarray  # sorted numbers of its pairs of neighbours
    wide: np.ndarray  # and of its words two places apart


def pairs_of(item: np.ndarray) -> Pairs:
    words, at = np.unique(item, return_inverse=True)
    return Pairs(words, np.unique(at[:-1] * len(words) + at[1:]), np.unique(at[:-2] * len(words) + at[2:]))


def within(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values a sorted array holds."""
    if not len(among):
        return np.zeros(len(values), dtype=bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def may_score(passage: np.ndarray, item: Pairs, n_words: int, needed: float) -> bool:
    """Whether some alignment may reach the score: after its first match it gains two
    points by a pair of neighbours on both sides, one by another pair and none by a
    wider step, all within ``3 * n_words`` words."""
    at = np.searchsorted(item.words, passage)
    at[at == len(item.words)] = 0
    held = np.flatnonzero(item.words[at] == passage)
    known = np.zeros(len(passage) + 2, dtype=bool)
    known[held] = True
    gains = np.zeros(len(passage) + 1, dtype=np.int64)
    starts = held[known[held + 2]]
    pair = at[starts] * len(item.words) + at[starts + 2]
    gains[starts] = within(pair, item.near) | within(pair, item.wide)
    starts = held[known[held + 1]]
    pair = at[starts] * len(item.words) + at[starts + 1]
    gains[starts] = np.maximum(gains[starts], np.where(within(pair, item.near), 2, within(pair, item.wide)))
    total = np.concatenate([[0], np.cumsum(gains)])
    span = min(3 * n_words, len(total) - 1)
    return int((total[span:] - total[: len(total) - span]).max()) >= needed - MATCH


def leaks(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, item_id, score, ratio (to the item's own score) of every leak."""
    grams = item_grams(items)
    size = grams.agg(F.max("n_words").alias("longest"), F.min("n_words").alias("shortest")).first()
    if size.longest is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score int, ratio double")
    kinds = [*([ONE] if size.shortest == 1 else []), *PAIRS]
    found = passages(docs, bloom(grams), kinds, int(size.longest))

    hits = found.select("doc_id", "passage", F.explode("grams").alias("gram"))
    frequency = materialize(hits.groupBy("gram").agg(F.count("*").alias("n")), "leak-frequencies")
    seeds = chosen_seeds(grams, frequency, least)

    met = hits.join(seeds, "gram").groupBy("doc_id", "passage", *ITEM)
    pairs = met.agg(F.size(F.collect_set("place")).alias("held"), F.min("least").alias("least")).where("held >= least")
    texts = grams.where("words is not null").select(*ITEM, F.col("words").alias("item")).distinct()
    pairs = materialize(pairs.select("doc_id", "passage", *ITEM), "leak-pairs")
    wanted = among(found.select("doc_id", "passage", "words"), pairs)
    pairs = pairs.join(materialize(texts, "leak-items"), ITEM).join(wanted, ["doc_id", "passage"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            seen, passage, ids = None, [], None
            tables: dict[str, tuple[list[str], Pairs]] = {}
            for batch in parts:
                for doc_id, item_id, words, text in rows_of(batch, 64):
                    if words != seen:  # rows of a passage often follow each other
                        seen, passage = words, words.split(" ")
                        ids = word_hashes(passage)
                    if text not in tables:
                        if len(tables) >= CACHED_ITEMS:
                            tables.clear()
                        tables[text] = text.split(" "), pairs_of(word_hashes(text.split(" ")))
                    item, pairs_held = tables[text]
                    needed = needed_score(len(item), least)
                    if not may_score(ids, pairs_held, len(item), needed):
                        continue
                    score = align(passage, item)
                    if score >= needed:
                        yield doc_id, item_id, score, score / (MATCH * len(item))

        yield from batches(rows(), pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.int32()), ("ratio", pa.float64())]))

    scored = pairs.select("doc_id", "item_id", "words", "item").mapInArrow(run, "doc_id long, item_id long, score int, ratio double")
    return scored.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), F.max("ratio").alias("ratio"))


def op6_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

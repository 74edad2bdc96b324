"""Token ids, token files, packing and edit-aware counts against the tokenizer itself."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest
from tests.llm.helpers import docs, empty, prose
from tidemark.llm import edit_counts, packing, seekable, token_files, tokens
from tidemark.llm.common import open_uri, scratch_path

ODD = [
    "", " ", "a\x1cb c", "x\x85y\xa0z w　v", "it's John's don't 'S", "<|endoftext|> a<|startoftext|>b", "İstanbul ΣΑΣ ς", "é x ́y é",
    "A.B,c!! 12ab ab12 a1", "hello​world", "ﬁ ſt K Ångström ÄÖÜß", "a-b (c) it. 's", "foo|bar| <| |>", "THE!! Éaux### ÉAUX", "Stra­ße x ", "a᠎b", "ͅa x̀ͅ",
    "ab\x0bcd\x0cef", "日本語 テキスト", "🙂🙂 a🙂b", "x" * 5000, "é" * 3000, "ª º µ",
]
TEXTS = [*ODD, *(prose(n, n) for n in (1, 5, 40, 900, 6000)), "the "]
ROWS = [(7 * i % 101, t) for i, t in enumerate(TEXTS)] + [(500, None), (None, "no id"), (3000, "again"), (3000, "again"), (3000, "another")]


@pytest.fixture(scope="module")
def library():
    ids = tokens.encoder()
    return lambda text: tokens.as_bytes(ids.tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_chunks_encode_as_the_whole_text(library):
    ids = tokens.ChunkEncoder(tokens.VOCABULARY)
    for text in TEXTS:
        assert tokens.encode(text, ids) == library(text), text[:40]


def test_full_cache_gives_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 20)
    ids = tokens.ChunkEncoder(tokens.VOCABULARY)
    assert all(tokens.encode(t, ids) == library(t) for t in TEXTS * 2)
    assert len(ids) <= 20


def test_files_round_trip(spark, library):
    files = token_files.write_token_files(docs(spark, ROWS, "n_tokens long, ids binary, start long"), scratch_path(spark, "t"))
    files.cache()
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in token_files.read_token_files(files).collect()]
    want, start = [], 0
    for doc_id, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = library(text) + tokens.as_bytes([2])
        want.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), ids))
        start += len(ids) // 4
    assert sorted(got, key=lambda r: r[1]) == want
    some = token_files.read_token_files(files, wanted=[14, 500])
    assert sorted((r.doc_id, bytes(r.ids)) for r in some.collect()) == sorted((i, library(t) + tokens.as_bytes([2])) for i, t in ROWS if i in (14, 500))


def test_damage_is_seen(spark, tmp_path):
    files = token_files.write_token_files(docs(spark, [(1, "one"), (2, "two")]), scratch_path(spark, "t"))
    uri = files.first().uri
    path = uri.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[10] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception), open_uri(uri) as handle:  # noqa: B017
        frames, _ = seekable.read_tables(handle)
        for f in frames:
            seekable.read_frame(handle, f)


def test_packing_holds_every_id_once(spark, library):
    pieces = packing.pack(docs(spark, ROWS, "length long, offset long, sequence_id long"), window=256).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length and zlib.crc32(p.ids) == p.ids_crc32
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    full = defaultdict(list)
    for doc_id, text in ROWS:
        full[doc_id].append(library(text) + tokens.as_bytes([2]))
    for doc_id, texts in full.items():
        if len(texts) == 1:
            some = sorted(by_doc.pop(doc_id), key=lambda p: p.start)
            assert b"".join(p.ids for p in some) == texts[0]
            assert [p.start for p in some] == [sum(q.length for q in some[:i]) for i in range(len(some))]
            assert {p.doc_tokens for p in some} == {len(texts[0]) // 4}
    assert sum(p.length for p in pieces) == sum(len(t) // 4 for texts in full.values() for t in texts)
    for some in by_sequence.values():
        some.sort(key=lambda p: p.offset)
        assert [p.offset for p in some] == [sum(q.length for q in some[:i]) for i in range(len(some))]
        total = sum(p.length for p in some)
        assert total == 256 or total & (total - 1) == 0


def test_packing_chooses_the_least_sum_of_squares():
    rng = random.Random(2)
    packer, size = packing.SumOfSquares(20), 20
    for _ in range(500):
        s, level = rng.randint(1, 19), list(packer.level)
        costs = {}
        for h in range(0, size - s + 1):
            if h and not level[h]:
                continue
            after = level.copy()
            after[h] -= h > 0
            if h + s < size:
                after[h + s] += 1
            costs[h] = sum(x * x for x in after[1:size])
        h = packer.best_level(s)
        assert costs[h] == min(costs.values()) and h == max(k for k, c in costs.items() if c == costs[h])
        packer.place((1, 0, bytes(4 * s), s))


def test_edit_counts_equal_encoding_anew(spark, library):
    rng, rows = random.Random(4), []
    for doc_id, text in [*ROWS, *((200 + i, prose(rng.randint(1, 700), i)) for i in range(30))]:
        edits = [(rng.randint(0, 5000), rng.choice([0, 1, 3, 50, 400]), rng.choice(["", " ", "x", "new words", " É!", prose(600, 3), None, "\x1c"])) for _ in range(rng.randint(0, 6))]
        rows.append((doc_id, text, edits if rng.random() < 0.9 else None))
    table = spark.createDataFrame(rows, f"doc_id long, text string, edits {edit_counts.EDITS}")
    from pyspark.sql import functions as F

    out = edit_counts.edited_counts(edit_counts.plant_trees(table, F.col("edits"))).collect()
    want = []
    for doc_id, text, edits in rows:
        now = text or ""
        for position, deleted, inserted in edits or []:
            p = min(position, len(now))
            now = now[:p] + (inserted or "") + now[p + deleted :]
        want.append((doc_id, len(library(text)) // 4, len(edits or []), len(library(now)) // 4, len(now)))
    assert sorted((tuple(r)[:5] for r in out), key=str) == sorted(want, key=str)


def test_small_edits_encode_little(spark):
    text = prose(20_000, 1)
    table = spark.createDataFrame([(1, text, [(len(text) // 2, 5, "x")])], f"doc_id long, text string, edits {edit_counts.EDITS}")
    from pyspark.sql import functions as F

    assert edit_counts.edited_counts(edit_counts.plant_trees(table, F.col("edits"))).first().encoded_chars < 4 * edit_counts.SEGMENT


def test_empty_tables(spark):
    none = empty(spark, "doc_id long, text string")
    assert token_files.read_token_files(token_files.write_token_files(none, scratch_path(spark, "t"))).count() == 0
    assert packing.pack(none).count() == 0
    assert edit_counts.edited_counts(edit_counts.plant_trees(none, edit_counts.revision())).count() == 0

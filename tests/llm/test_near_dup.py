from __future__ import annotations

import random

from tests.llm.helpers import components, docs, edited, empty, prose, shingle_set
from tidemark.llm import near_dup


def judged(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()}


def expected(rows):
    return {i: (len(shingle_set(t)), c, c == i) for (i, t), c in zip(sorted(rows), components(rows).values(), strict=True)}


def test_groups_of_copies_equal_brute_force(spark):
    rng, rows = random.Random(3), []
    for g in range(8):
        base = prose(rng.choice([30, 80, 150, 200]), g)
        rows += [edited(base, rng.randint(0, 6), 100 * g + i) for i in range(25)]
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    assert judged(docs(spark, rows, "n_shingles long, component_id long, node string, band long")) == expected(rows)


def test_chains_and_centres(spark):
    """Copies that are linked through each other only."""
    words = prose(300, 9).split(" ")
    rows = [(i, " ".join(words[4 * i : 4 * i + 120])) for i in range(40)]
    assert judged(docs(spark, rows)) == expected(rows)


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two\n"), (6, "one two three four five"), (7, "İ É one two"), (8, "i é one two"), (9, "a b c"), (10, "x " * 5000), (11, "x x x x x"), (12, None)]
    assert judged(docs(spark, rows)) == expected(rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (2, "a b c d e f"), (2, "g h i j k l m"), (5, "g h i j k l m"), (7, "a b c d e f"), (2, "a b c d e f")]
    out = sorted(map(tuple, near_dup.near_duplicates(docs(spark, rows)).collect()), key=str)
    assert out == sorted([(None, 2, None, True), (2, 2, 2, True), (2, 3, 2, True), (5, 3, 2, False), (7, 2, 2, False), (2, 2, 2, True)], key=str)


def test_empty_table(spark):
    assert near_dup.near_duplicates(empty(spark, "doc_id long, text string")).count() == 0


def test_signature_is_circular():
    s = near_dup.shingles(b"a b c d e f g h")
    runs, _ = near_dup.circle()
    place = (s >> 44).astype(int)
    order = runs[:, 0]
    coordinates = near_dup.signature(s)
    for k in (0, 1, 57, near_dup.BANDS * near_dup.ROWS - 1):
        assert coordinates[k] == min(order[(p + k) % near_dup.CIRCLE] for p in place)


def family(base: str, n: int, seed: int) -> list[str]:
    """Copies about 0.8 similar to ``base`` with edits of their own: hardly any two are linked."""
    return [edited(base, 4, seed + i) for i in range(n)]


def test_families_around_one_text_equal_brute_force(spark):
    """Copies that fall apart around their centre, and families of copies of its copies."""
    base = prose(160, 77)
    rows = [base, *family(base, 60, 1000)]
    for g in range(3):
        rows += [edited(edited(base, 4, 50 + g), 1, 2000 + 100 * g + i) for i in range(30)]
    rows = list(enumerate(rows))
    random.Random(4).shuffle(rows)
    assert judged(docs(spark, rows)) == expected(rows)


def test_rows_around_a_centre_grow_with_the_input(spark, monkeypatch):
    """Pairs to be decided one by one, and the joins' rows, for 5 times the copies of one text."""
    made = []
    monkeypatch.setattr(near_dup, "across", lambda shared, percent, f=near_dup.across: made.append((shared.count(), f(shared, percent).count())) or f(shared, percent))
    for n in (60, 300):
        near_dup.near_duplicates(docs(spark, list(enumerate([prose(160, 78), *family(prose(160, 78), n, 10_000)])))).count()
    assert len(made) == 2
    (shared, pairs), (shared_5, pairs_5) = made
    assert pairs_5 <= max(6 * pairs, n) and shared_5 <= 30 * shared, made


def test_kept_differences_lose_no_link():
    """Every linked pair around a centre, one side not linked with it, shares a kept difference."""
    rng = random.Random(8)
    for _ in range(3000):
        percent = rng.choice([80, 85, 90])
        centre = set(range(rng.randint(5, 40)))

        def some(start, size):
            s = {e for e in start if rng.random() > 0.15} | {rng.randint(100, 130) for _ in range(rng.randint(0, size))}
            return s or {1}

        x = some(centre, 8)
        y = some(x, 3) if rng.random() < 0.7 else some(centre, 8)
        link = lambda a, b: 100 * len(a & b) >= percent * len(a | b)
        if not link(x, y) or link(x, centre):
            continue
        kept = []
        least = min(len(s ^ centre) for s in (x, y) if not link(s, centre))
        for s, partner in ((x, y), (y, x)):
            order = sorted(s ^ centre, key=lambda e: (e * 7919) % 131)
            first, strict = near_dup.kept_differences(len(s), len(centre), len(order), link(s, centre), least, max(len(x), len(y)), percent)
            kept.append(order[: strict if not link(s, centre) and not link(partner, centre) else first])
        assert set(kept[0]) & set(kept[1]), (x, y, centre)

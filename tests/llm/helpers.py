"""Small tables and brute-force versions for the operators' tests."""

from __future__ import annotations

import random
import re

from pyspark.sql.types import StructType

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra: str = ""):
    """(doc_id, text) rows as a documents table; ``extra``: clashing columns."""
    names = [x.split()[0] for x in extra.split(",") if x]
    schema = DOCS + ("," + extra if extra else "")
    full = [(i, t, "en", "src0", None if t is None else len(t), *([None] * len(names))) for i, t in rows]
    return spark.createDataFrame(full, schema)


def empty(spark, schema: str | StructType):
    return spark.createDataFrame([], schema)


def vocabulary(n: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def prose(n: int, seed: int) -> str:
    rng, words = random.Random(seed), vocabulary(800)
    return " ".join(rng.choice(words) for _ in range(n))


def edited(text: str, changes: int, seed: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(changes):
        i = rng.randrange(len(words))
        words[i : i + rng.randint(0, 1)] = [f"edit{rng.randrange(10**6)}"]
    return " ".join(words)


def shingle_set(text: str | None, n: int = 5) -> frozenset:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def components(rows: list[tuple[int, str | None]], percent: int = 85) -> dict[int, int]:
    """Brute force: doc_id to the smallest doc_id reachable."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in ids}

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tests.llm.helpers import empty
from tidemark.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, 7) for i, v in rows], SCHEMA)


def brute(rows, is_query, k=10):
    good = []
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out = set()
    for n, (i, q) in enumerate(good):
        if is_query(i):
            found = sorted((-sum(a * b for a, b in zip(q, p, strict=True)), j) for m, (j, p) in enumerate(good) if j != i and len(p) == len(q))
            out |= {(i, r, j, -s) for r, (s, j) in enumerate(found[:k], 1)}
    return out


def result(df):
    return {(r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "BUCKET_ROWS", 32)
    monkeypatch.setattr(topk, "BUCKETS_PER_TASK", 2)
    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(400, 8)) * np.exp(spread * rng.normal(size=(400, 1)))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[3][1]) for i in range(15)]  # ties
    assert result(topk.top_k(table(spark, rows), "vec_id % 50 = 0")) == brute(rows, lambda i: i % 50 == 0)


def test_invalid_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (6, []), (None, [9.0, 9.0]), (7, [1.0, 2.0, 3.0]), (8, [-1.0, -1.0]), (9, [0.0, 0.0])]
    assert result(topk.top_k(table(spark, rows), "vec_id in (0, 2, 4, 7, 9)")) == brute(rows, lambda i: i in (0, 2, 4, 7, 9))


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [3e5, 1.5, 2.0]), (1, [3e5, 1.0, 0.0]), (2, [3e5, 1.0, 2.0 ** -10]), (3, [2.9e5, 0.0, 0.0])]
    assert result(topk.top_k(table(spark, rows), "vec_id = 0")) == brute(rows, lambda i: i == 0)


def test_empty_table(spark):
    assert topk.top_k(empty(spark, SCHEMA), "vec_id % 100 = 0").count() == 0


def test_pruning_keeps_everything_that_reaches_the_floor():
    rng = np.random.default_rng(1)
    for _ in range(200):
        vectors = rng.normal(size=(50, 6)) * rng.exponential(size=(50, 1))
        lengths = np.sqrt((vectors**2).sum(axis=1))
        order = np.argsort(-lengths)
        vectors, lengths = vectors[order], lengths[order]
        q = rng.normal(size=6)
        scores = vectors @ q
        floor = float(np.quantile(scores, random.Random(_).random()))
        rows = topk.candidates(vectors, lengths, vectors / lengths[:, None], q, float(np.sqrt(q @ q)), float(lengths[0]), floor)
        assert set(np.flatnonzero(scores >= floor)) <= set(np.arange(50)[rows])

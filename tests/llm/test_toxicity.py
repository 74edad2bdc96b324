from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tests.llm.helpers import docs, prose
from tidemark.llm import toxicity
from tidemark.llm.queries import QUERIES
from tidemark.llm.quality import held_out

SF = "/root/testdata/sf0.1"
INSULTS = ["zorg", "blat", "fnurk"]


def labelled(n, seed=1, wrong=0.0):
    """(doc_id, text, toxic): toxic texts hold an insult among their words."""
    rng, out = random.Random(seed), []
    for i in range(n):
        words, toxic = prose(rng.randint(20, 200), 1000 + i).split(), int(i % 5 == 0)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(INSULTS)
        out.append((i, " ".join(words), 1 - toxic if rng.random() < wrong else toxic))
    return out


def label_table(spark, rows):
    return spark.createDataFrame([(i, 1, y) for i, y in rows], "doc_id long, quality int, toxic int")


def test_finds_toxic_documents(spark):
    out = QUERIES["op12_toxicity"](spark, SF).toPandas().set_index("doc_id")
    known = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")
    assert out.index.is_unique and out.score.between(0, 1).all() and len(out) == 10_000
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in out.held_out.items())
    both = out.join(known, how="inner")
    both = both[both.held_out]
    assert both[both.toxic == 0].predicted.mean() < 0.01
    assert both[both.toxic == 1].predicted.mean() > 0.75  # a tenth of the labels are wrong
    assert (out.predicted == (out.score >= 0.3)).all()


def test_one_insult_in_a_very_long_text(spark):
    rows = labelled(600)
    model = toxicity.learn(docs(spark, [r[:2] for r in rows]), label_table(spark, [(i, y) for i, _, y in rows]))
    assert 0 < len(model.places) < 2000
    other = [f"q{w}" for w in prose(10_000, 5).split()]  # a vocabulary of its own
    long = " ".join([*other, INSULTS[0], *other])
    tests = [(1, f"{prose(40, 9)} {INSULTS[1]} {prose(50, 10)}"), (2, prose(90, 11)), (3, long), (4, long.replace(INSULTS[0], "")), (5, None), (6, ""), (None, INSULTS[2]), (1, prose(30, 12))]
    out = toxicity.score(docs(spark, tests, "score double, toxic int, __text string"), model, "s").collect()
    assert [r.s >= 0.3 for r in out] == [True, False, True, False, False, False, True, False]
    assert out[4].s == out[5].s


def test_weights_are_those_of_plain_ftrl():
    """Brute force: one coordinate after the other, in plain numbers."""
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 30, 8)).astype(np.int32) for _ in range(120)]
    labels, share = rng.integers(0, 2, 120), rng.random(120)
    z, n, state = {}, {}, lambda d, k: d.get(k, 0.0)

    def weight(k):
        l1 = 0 if k == "intercept" else toxicity.L1
        return 0.0 if abs(state(z, k)) <= l1 else -np.sign(z[k]) * (abs(z[k]) - l1) / ((toxicity.BETA + state(n, k) ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.PASSES):
        for row, y, s in zip(rows, labels, share, strict=True):
            keys = [*row.tolist(), "intercept"]
            g = (toxicity.logistic(sum(weight(k) for k in keys)) - y) * s
            new = {k: (state(z, k) + g - ((state(n, k) + g * g) ** 0.5 - state(n, k) ** 0.5) / toxicity.ALPHA * weight(k), state(n, k) + g * g) for k in keys}
            for k, (a, b) in new.items():
                z[k], n[k] = a, b
    model = toxicity.learnt([np.append(r, 30).astype(np.int32) for r in rows], labels, share, np.arange(30, dtype=np.int32))
    want = {k: weight(k) for k in range(30) if weight(k)}
    assert dict(zip(model.places.tolist(), model.weights.tolist(), strict=True)).keys() == want.keys()
    assert all(abs(w - want[k]) < 1e-6 for k, w in zip(model.places.tolist(), model.weights.tolist(), strict=True))
    assert abs(model.intercept - weight("intercept")) < 1e-9


def test_defined_cases(spark):
    rows = labelled(200)
    table = docs(spark, [r[:2] for r in rows])
    labels = label_table(spark, [*((i, y) for i, _, y in rows), (None, 1), (9999, 1), (3, None), (0, 0)])
    model = toxicity.learn(table, labels)
    again = toxicity.learn(table.repartition(3), labels.repartition(2))
    assert (model.places == again.places).all() and (model.weights == again.weights).all()
    none = toxicity.learn(table, labels.limit(0))
    assert {r.s for r in toxicity.score(table, none, "s").collect()} == {0.0}
    one = toxicity.learn(table, labels.where("toxic = 0"))
    assert all(r.s < 0.3 for r in toxicity.score(table, one, "s").collect())
    assert toxicity.score(table.limit(0), model, "s").count() == 0
    assert toxicity.learn(table.limit(0), labels).intercept == -np.inf
    small = toxicity.learn(table, labels, sample=40)
    assert 0 <= len(small.places) <= len(model.places) * 40


def test_learns_nothing_from_held_out_labels(spark):
    rows = docs(spark, [(i, INSULTS[0] if zlib.crc32(str(i).encode()) % 4 == 2 else "calm") for i in range(120)])
    labels = label_table(spark, [(i, int(zlib.crc32(str(i).encode()) % 4 == 2)) for i in range(120)])
    model = toxicity.learn(rows, labels)
    out = toxicity.score(rows, model, "s").where(held_out(F.col("doc_id"))).collect()
    assert out and all(r.s < 0.3 for r in out)

"""Rounds of the toxicity learner: what reaches the driver, and the mean of the tasks' states."""

from __future__ import annotations

import random

import numpy as np

from plantlens.llm import toxicity

BITS = 15


def test_a_round_tells_each_coordinate_once(spark, monkeypatch):
    pick = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    texts = [(i, " ".join(pick.choices(words, k=400))) for i in range(600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 3 = 0 as int) AS toxic")
    told = []

    def noting(take):
        def call(df):
            taken = take(df)
            if df.columns[-3:] == ["at", "z", "n"]:
                rows = taken if isinstance(taken, list) else taken.to_pylist()
                told.append([(row["at"], row["z"], row["n"]) for row in rows])
            return taken

        return call

    for name in ("collect", "toArrow"):
        monkeypatch.setattr(type(docs), name, noting(getattr(type(docs), name)))
    at, weights = toxicity.train(docs, labels, bits=BITS)
    assert len(at) == len(weights) > 0
    assert len(told) == toxicity.ROUNDS
    for rows in told:
        met = np.concatenate([np.frombuffer(row[0], np.int32) for row in rows])
        assert len(met) == len(np.unique(met)) > 1 << (BITS - 1)
        assert sum(len(blob) for row in rows for blob in row) == 12 * len(met)
        assert max(len(blob) for row in rows for blob in row) <= 4 << toxicity.BLOCK_BITS


def test_mean_over_the_tasks_that_met_a_coordinate():
    rng = np.random.default_rng(3)
    told, sums = [], {}
    for _ in range(4):
        at = np.flatnonzero(rng.random(500) < 0.4)
        z, n = rng.normal(size=(2, len(at))).astype(np.float32)
        told.append(toxicity.packed(at, z, n))
        for key, *state in zip(at.tolist(), z.tolist(), n.tolist(), strict=True):
            sums.setdefault(key, []).append(state)
    at, z, n = toxicity.unpacked(toxicity.average(told))
    assert at.tolist() == sorted(sums)
    for got, key in zip(zip(z, n, strict=True), at.tolist(), strict=True):
        assert np.allclose(got, np.mean(sums[key], axis=0), atol=1e-6)

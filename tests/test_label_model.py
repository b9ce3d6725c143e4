"""The trainer against a plain loop over steps and labels, its stop rule, and training in parts."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daypanel.operators import label_model as L

N_DRUGS, N_FEATURES = 4, 3
RULE = L.Rule()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for hadm_id in range(40):
        for step in range(1, rng.randint(2, 6)):
            drugs = sorted(rng.sample(range(N_DRUGS), rng.randint(0, 3)))
            features = [rng.choice([0.0, 1.0]), rng.uniform(-80, 120), 0.0]
            label = sorted({d for d in drugs if rng.random() < 0.8} | ({3} if features[1] > 60 else set()))
            out.append((hadm_id, step, drugs, features, label))
    return out


@pytest.fixture(scope="module")
def vectors(spark, rows):
    steps = spark.createDataFrame(
        rows, "hadm_id bigint, step int, drugs array<int>, features array<double>, label array<int>"
    )
    return L.step_vectors(steps.repartition(5), N_DRUGS)


def plain(rows, test_ids, passes):
    """Weights, losses and monitor values by loops over steps and labels."""
    width = 1 + N_DRUGS + N_FEATURES
    train = [r for r in rows if r[0] not in test_ids]
    scale = [math.sqrt(sum(r[3][j] ** 2 for r in train) / len(train)) for j in range(N_FEATURES)]

    def vector(r):
        return [1.0] + [float(d in r[2]) for d in range(N_DRUGS)] + [v / s if s else 0.0 for v, s in zip(r[3], scale)]

    w, m, v = ([[0.0] * width for _ in range(N_DRUGS)] for _ in range(3))
    history = []
    for t in range(passes + 1):
        gradient = [[RULE.pull * w[k][p] if p else 0.0 for p in range(width)] for k in range(N_DRUGS)]
        loss = both = union = 0.0
        for r in rows:
            x = vector(r)
            for k in range(N_DRUGS):
                s = sum(a * b for a, b in zip(w[k], x))
                p, y = 1 / (1 + math.exp(-s)), float(k in r[4])
                if r[0] in test_ids:
                    both += y * (p >= 0.5)
                    union += max(y, float(p >= 0.5))
                else:
                    loss -= y * math.log(p) + (1 - y) * math.log(1 - p)
                    for place in range(width):
                        gradient[k][place] += (p - y) * x[place] / len(train)
        if t:
            history.append((t, loss / len(train), both / union))
        if t < passes:
            for k in range(N_DRUGS):
                for p in range(width):
                    g = gradient[k][p]
                    m[k][p] = RULE.fade * m[k][p] + (1 - RULE.fade) * g
                    v[k][p] = RULE.fade_square * v[k][p] + (1 - RULE.fade_square) * g * g
                    up = m[k][p] / (1 - RULE.fade ** (t + 1))
                    w[k][p] -= RULE.rate * up / (math.sqrt(v[k][p] / (1 - RULE.fade_square ** (t + 1))) + RULE.floor)
    return w, history, vector


def weights_of(learned):
    rows = learned.weights.collect()
    assert len(rows) == N_DRUGS * (1 + N_DRUGS + N_FEATURES)
    out = np.zeros((N_DRUGS, 1 + N_DRUGS + N_FEATURES))
    for r in rows:
        out[r.label, r.place] = r.weight
    return out


def train(vectors, **options):
    return L.train(vectors, N_DRUGS, N_DRUGS, N_FEATURES, **options)


def test_vectors(vectors, rows):
    got = {(r.hadm_id, r.step): dict(zip(r.places, r["values"])) for r in vectors.collect()}
    for hadm_id, step, drugs, features, _ in rows:
        want = {0: 1.0, **{1 + d: 1.0 for d in drugs}, **{1 + N_DRUGS + j: v for j, v in enumerate(features) if v}}
        assert got[hadm_id, step] == want


def test_training_against_plain_loops(vectors, rows):
    test_ids = {r.hadm_id for r in vectors.filter("split = 'test'").collect()}
    assert test_ids and len(test_ids) < 40
    want, history, vector = plain(rows, test_ids, 6)
    learned = train(vectors, passes=6, patience=None)
    assert np.allclose(weights_of(learned), want, atol=1e-9)
    assert learned.kept == 6
    assert np.allclose(np.array(learned.history), np.array(history), atol=1e-9)
    scored = L.score(vectors, learned, N_DRUGS, N_DRUGS, N_FEATURES).collect()
    by_key = {(r[0], r[1]): r for r in rows}
    for r in scored:
        x = vector(by_key[r.hadm_id, r.step])
        assert np.allclose(r.score, [1 / (1 + math.exp(-float(np.dot(want[k], x)))) for k in range(N_DRUGS)], atol=1e-9)
        assert r.truth == [int(k in by_key[r.hadm_id, r.step][4]) for k in range(N_DRUGS)]
    assert len(scored) == len(rows)


def test_it_learns(vectors):
    learned = train(vectors, passes=40, patience=None)
    first, last = learned.history[0], learned.history[-1]
    assert last[1] < first[1] and last[2] > 0.6


def test_labels_in_parts(vectors, monkeypatch):
    """More labels than one pass holds give the same weights and scores."""
    whole = train(vectors, passes=3, patience=None)
    monkeypatch.setattr(L, "_WEIGHTS", 2 * (1 + N_DRUGS + N_FEATURES) + 1)
    monkeypatch.setattr(L, "_CELLS", 30)
    parts = train(vectors, passes=3, patience=None)
    assert np.allclose(weights_of(parts), weights_of(whole), atol=1e-12)
    assert np.allclose(np.array(parts.history), np.array(whole.history), atol=1e-12)
    monkeypatch.setattr(L, "_WEIGHTS", 1)  # one label a pass
    got = {(r.hadm_id, r.step): r.score for r in L.score(vectors, parts, N_DRUGS, N_DRUGS, N_FEATURES).collect()}
    want = {(r.hadm_id, r.step): r.score for r in L.score(vectors, whole, N_DRUGS, N_DRUGS, N_FEATURES).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)


def test_early_stop_keeps_the_best(vectors):
    long = train(vectors, passes=14, patience=None)
    values = [j for _, _, j in long.history]
    for patience in (1, 3):
        best, at = -1.0, 0
        for t, value in enumerate(values, 1):
            if value > best:
                best, at = value, t
            end = t
            if t - at >= patience:
                break
        learned = train(vectors, passes=14, patience=patience)
        assert learned.kept == at and len(learned.history) == end
        kept = train(vectors, passes=at, patience=None)
        assert np.allclose(weights_of(learned), weights_of(kept), atol=1e-12)


def test_no_steps(spark, vectors):
    learned = train(vectors.filter(F.lit(False)), passes=2, patience=None)
    assert not weights_of(learned).any() and [h[1:] for h in learned.history] == [(0.0, 0.0)] * 2
    assert L.score(vectors.filter(F.lit(False)), learned, N_DRUGS, N_DRUGS, N_FEATURES).collect() == []

from __future__ import annotations

import numpy as np
import pytest

from daypanel.operators import label_model, metrics, scoring

N_DRUGS, N_FEATURES, STEPS = 7, 5, 6


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def softmax(x):
    e = np.exp(x)
    return e / e.sum()


def plain_scores(cell, x1, x2, w, tau=0.2):
    """One admission, one step after the other, gate by gate."""
    units = w["recurrent"].shape[0]
    h, c, hist, out = np.zeros(units), np.zeros(units), 0.0, []
    gate = lambda m, k: m[..., k * units : (k + 1) * units]
    for a, b in zip(x1, x2):
        e1, e2 = a @ w["drugs"], b @ w["others"]
        a12 = softmax(np.tanh(e1 @ w["to_1_w"] + e2 @ w["to_1_u"]) * (e2 @ w["to_1_v"]))
        a21 = softmax(np.tanh(e2 @ w["to_2_w"] + e1 @ w["to_2_u"]) * (e1 @ w["to_2_v"]))
        inp = np.concatenate([e1 * a12, e2 * a21])
        pre = [inp @ gate(w["kernel"], k) + gate(w["bias"], k) for k in range(scoring.GATES[cell])]
        rec = lambda k, v=None: (h if v is None else v) @ gate(w["recurrent"], k)  # noqa: E731, B023
        if cell == "rnn":
            new = np.tanh(pre[0] + rec(0))
        elif cell == "lstm":
            i, f, o = (sigmoid(pre[k] + rec(k)) for k in (0, 1, 3))
            c = f * c + i * np.tanh(pre[2] + rec(2))
            new = o * np.tanh(c)
        else:
            z, r = sigmoid(pre[0] + rec(0)), sigmoid(pre[1] + rec(1))
            new = z * h + (1 - z) * np.tanh(pre[2] + rec(2, r * h))
        gamma = sigmoid(inp @ w["decay"] + w["decay_bias"])
        hist = np.concatenate([a12, a21]) + hist * (1 - gamma)
        h = (1 - tau) * new + tau * np.tanh(hist @ w["recall"] + w["recall_bias"])
        y = np.maximum(h @ w["dense_1"] + w["dense_1_bias"], 0)
        y = np.maximum(y @ w["dense_2"] + w["dense_2_bias"], 0)
        out.append(sigmoid(y @ w["head"] + w["head_bias"]))
    return np.array(out)


@pytest.mark.parametrize("cell", ["rnn", "lstm", "gru"])
def test_against_the_plain_loop(spark, cell):
    rng = np.random.default_rng(3)
    weights = scoring.random_weights(cell, N_DRUGS, N_FEATURES, embedding=4, units=3, dense=5)
    weights = {name: w + rng.normal(scale=0.3, size=w.shape) for name, w in weights.items()}
    drugs = [[sorted(rng.choice(N_DRUGS, rng.integers(0, 4), replace=False).tolist()) for _ in range(STEPS)] for _ in range(600)]
    features = rng.normal(size=(600, STEPS, N_FEATURES))
    rows = [(k, drugs[k], features[k].tolist(), drugs[k]) for k in range(600)]
    padded = spark.createDataFrame(
        rows, "hadm_id bigint, drugs array<array<int>>, features array<array<double>>, labels array<array<int>>"
    ).repartition(2)
    got = scoring.score_sequences(padded, cell, weights).collect()
    assert len(got) == 600 * STEPS
    table = {(r.hadm_id, r.step): r for r in got}
    for k in (0, 1, 299, 599):
        hot = np.array([[float(d in day) for d in range(N_DRUGS)] for day in drugs[k]])
        wanted = plain_scores(cell, hot, features[k], weights)
        for t in range(STEPS):
            np.testing.assert_allclose(table[k, t + 1].score, wanted[t], rtol=1e-9)
            assert table[k, t + 1].label == drugs[k][t]


def test_shapes_of_the_full_size():
    w = scoring.random_weights("lstm", 400, 70)
    assert w["kernel"].shape == (256, 1024) and w["recurrent"].shape == (256, 1024) and w["head"].shape == (256, 400)
    assert w["bias"][256:512].tolist() == [1.0] * 256


def test_label_model_learns_a_plain_rule(spark):
    """Drug 0 today means label 1 tomorrow."""
    rows = [(h, s, [0] if (h + s) % 2 else [1], [float(s)], [1] if (h + s) % 2 else [0]) for h in range(80) for s in range(1, 5)]
    steps = spark.createDataFrame(rows, "hadm_id bigint, step int, drugs array<int>, features array<double>, label array<int>")
    vectors = label_model.step_vectors(steps, 2)
    learned = label_model.train(vectors, 2, 2, 1, passes=30, patience=None)
    scored = label_model.score(vectors.filter("split = 'test'"), learned, 2, 2, 1)
    assert 0 < scored.select("hadm_id").distinct().count() < 80
    assert metrics.jaccard(scored).first()[0] == 1.0

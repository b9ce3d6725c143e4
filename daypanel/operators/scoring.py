"""Distributed scoring with a recurrent cross-attention network.

The sequences are the unit of work: Spark hands batches of admissions to the workers, each batch advances all of its
admissions one step at a time with one matrix product per gate group, and the weights are broadcast once per executor.
Their size is fixed by the network's shape. Drugs arrive as positions, so their embedding is a sum of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

GATES = {"rnn": 1, "lstm": 4, "gru": 3}
TAU = 0.2
_ADMISSIONS = 256  # scored together


def random_weights(
    cell: str,
    n_drugs: int,
    n_features: int,
    embedding: int = 128,
    units: int = 256,
    dense: int = 256,
    seed: int = 2020,
) -> dict[str, np.ndarray]:
    """Untrained weights of the right shapes, scaled by fan-in and fan-out; the forget gate starts open."""
    rng = np.random.default_rng(seed)
    both, width = 2 * embedding, GATES[cell] * units

    def matrix(rows: int, columns: int) -> np.ndarray:
        reach = np.sqrt(6.0 / (rows + columns))
        return rng.uniform(-reach, reach, (rows, columns))

    weights = {"drugs": matrix(n_drugs, embedding), "others": matrix(n_features, embedding)}
    weights |= {f"{side}_{part}": matrix(embedding, embedding) for side in ("to_1", "to_2") for part in "wuv"}
    weights |= {"kernel": matrix(both, width), "recurrent": matrix(units, width), "bias": np.zeros(width)}
    if cell == "lstm":
        weights["bias"][units : 2 * units] = 1.0
    weights |= {"decay": matrix(both, both), "decay_bias": np.zeros(both)}
    weights |= {"recall": matrix(both, units), "recall_bias": np.zeros(units)}
    for name, rows, columns in (("dense_1", units, dense), ("dense_2", dense, dense), ("head", dense, n_drugs)):
        weights |= {name: matrix(rows, columns), f"{name}_bias": np.zeros(columns)}
    return weights


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


def _attention(own, other, w, side):
    """Attention of one sequence given the other, over the embedding axis."""
    logits = np.tanh(own @ w[f"{side}_w"] + other @ w[f"{side}_u"]) * (other @ w[f"{side}_v"])
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def _cell(cell, seen, h, c, w):
    """One step of the plain, LSTM or GRU cell from projected input ``seen``; returns output and carry."""
    n = h.shape[1]
    if cell == "rnn":
        return np.tanh(seen + h @ w["recurrent"]), c
    if cell == "lstm":
        i, f, g, o = np.split(seen + h @ w["recurrent"], 4, axis=1)
        c = _sigmoid(f) * c + _sigmoid(i) * np.tanh(g)
        return _sigmoid(o) * np.tanh(c), c
    gates = _sigmoid(seen[:, : 2 * n] + h @ w["recurrent"][:, : 2 * n])
    update, reset = gates[:, :n], gates[:, n:]
    new = np.tanh(seen[:, 2 * n :] + (reset * h) @ w["recurrent"][:, 2 * n :])
    return update * h + (1 - update) * new, c


def forward(cell: str, e1: np.ndarray, e2: np.ndarray, w: dict[str, np.ndarray], tau: float = TAU) -> np.ndarray:
    """Scores (admissions, steps, labels) from the embedded sequences (admissions, steps, embedding)."""
    a1, a2 = _attention(e1, e2, w, "to_1"), _attention(e2, e1, w, "to_2")
    attention = np.concatenate([a1, a2], axis=-1)
    weighted = np.concatenate([e1 * a1, e2 * a2], axis=-1)
    projected = weighted @ w["kernel"] + w["bias"]
    keep = 1.0 - _sigmoid(weighted @ w["decay"] + w["decay_bias"])
    h = np.zeros((len(e1), w["recurrent"].shape[0]))
    c, history, outputs = np.zeros_like(h), np.zeros_like(attention[:, 0]), []
    for t in range(e1.shape[1]):
        out, c = _cell(cell, projected[:, t], h, c, w)
        history = attention[:, t] + history * keep[:, t]
        h = (1 - tau) * out + tau * np.tanh(history @ w["recall"] + w["recall_bias"])
        outputs.append(h)
    x = np.stack(outputs, axis=1)
    for layer in ("dense_1", "dense_2"):
        x = np.maximum(x @ w[layer] + w[f"{layer}_bias"], 0.0)
    return _sigmoid(x @ w["head"] + w["head_bias"])


def _embed_drugs(drugs: pa.ListArray, table: np.ndarray) -> np.ndarray:
    """Sum of embedding rows per step, for a (admission, step, positions) array."""
    steps = drugs.flatten()
    summed = np.zeros((len(steps), table.shape[1]))
    owner = np.repeat(np.arange(len(steps)), steps.value_lengths().to_numpy(zero_copy_only=False))
    np.add.at(summed, owner, table[steps.flatten().to_numpy(zero_copy_only=False)])
    return summed


def score_sequences(padded: DataFrame, cell: str, weights: dict[str, np.ndarray], tau: float = TAU) -> DataFrame:
    """Score every step of padded sequences; one output row per (admission, step) with ``label`` and ``score``.

    ``step`` counts from 1 and the padding is scored too, as the pooled metric asks for it.
    """
    shared = padded.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, _ADMISSIONS):
                part = batch.slice(start, _ADMISSIONS)
                n, features = part.num_rows, part["features"].flatten()
                length = len(features) // n
                others = features.flatten().to_numpy(zero_copy_only=False).reshape(n, length, -1) @ w["others"]
                drugs = _embed_drugs(part["drugs"], w["drugs"]).reshape(n, length, -1)
                scores = forward(cell, drugs, others, w, tau).reshape(n * length, -1)
                ends = np.arange(len(scores) + 1, dtype=np.int32) * scores.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(part["hadm_id"].to_numpy(), length)),
                        pa.array(np.tile(np.arange(1, length + 1, dtype=np.int32), n)),
                        part["labels"].flatten(),
                        pa.ListArray.from_arrays(ends, scores.ravel()),
                    ],
                    names=["hadm_id", "step", "label", "score"],
                )

    wanted = padded.select("hadm_id", "drugs", "features", "labels")
    return wanted.mapInArrow(score, "hadm_id bigint, step int, label array<int>, score array<double>")

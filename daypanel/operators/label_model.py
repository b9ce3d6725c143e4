"""Next-day label model: logistic regressions for all labels at once, trained by whole passes over the steps.

Each pass multiplies the steps of a partition with the weights of all labels, adds up the gradients of its training steps
and, for the test steps, what the monitor needs. The sums leave the partition as (label, place, value) and are added up
by one aggregate; the new weights are a stored table, so a lost executor costs one pass. No loop runs over labels or rows.

A step is a vector: place 0 is 1 for all, then one place per drug, then the features, each divided by the root of its mean
square over the training steps. Weights move by adaptive moments, the rule the recurrent networks are trained with. The
monitor is the pooled Jaccard of the test steps at a threshold of one half; training ends when it has not risen for some
passes, and the weights of its highest value are kept.

The results are not comparable with those of a recurrent network.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.operators.sequences import split_of
from daypanel.session import staged

MONITOR = -1  # the label of sums that belong to none: loss, cells true and predicted, cells true, cells predicted
PASSES = 200
PATIENCE = 10

_CELLS = 1 << 21  # of the dense matrix of steps that is held at once
_WEIGHTS = 1 << 23  # weights of one pass; more labels than fit are trained in several passes side by side


@dataclass(frozen=True)
class Rule:
    """How far weights move: the rate, how fast the two moments fade, the floor of the divisor, the pull to zero."""

    rate: float = 0.3
    fade: float = 0.5
    fade_square: float = 0.9
    floor: float = 1e-8
    pull: float = 1e-4


@dataclass(frozen=True)
class Learned:
    """``weights``: label, place, weight. ``history``: step, loss and jaccard after that many passes. ``kept``: a step."""

    weights: DataFrame
    scales: DataFrame
    history: list[tuple[int, float, float]]
    kept: int


def step_vectors(steps: DataFrame, n_drugs: int) -> DataFrame:
    """hadm_id, step, split, label, and the cells of the vector that are not zero as ``places`` and ``values``.

    Stored, since every pass reads it.
    """
    shown = F.transform("features", lambda v, place: F.struct((place + 1 + n_drugs).alias("place"), v.alias("value")))
    cells = F.filter(shown, lambda cell: cell["value"] != 0)
    return staged(
        steps.select("hadm_id", "step", split_of(F.col("hadm_id")).alias("split"), "label", "drugs", cells.alias("cells")).select(
            "hadm_id",
            "step",
            "split",
            "label",
            F.concat(F.array(F.lit(0)), F.transform("drugs", lambda d: d + 1), F.col("cells.place")).alias("places"),
            F.concat(F.array_repeat(F.lit(1.0), F.size("drugs") + 1), F.col("cells.value")).alias("values"),
        ),
        "label-steps",
    )


def scales_of(vectors: DataFrame, n_drugs: int) -> DataFrame:
    """place, scale: the root mean square of each feature over the training steps; no row for one that is always 0."""
    train = vectors.filter("split = 'train'")
    n = train.count()
    cells = train.select(F.explode(F.arrays_zip("places", "values")).alias("cell")).filter(F.col("cell.places") > n_drugs)
    mean = cells.groupBy(F.col("cell.places").alias("place")).agg(F.sum(F.col("cell.values") * F.col("cell.values")).alias("sum"))
    return staged(mean.select("place", F.sqrt(F.col("sum") / F.lit(n)).alias("scale")), "label-scales")


def _factors(scales: DataFrame, n_drugs: int, width: int) -> np.ndarray:
    """What each place is multiplied with; as many numbers as the vector has places."""
    out = np.zeros(width)
    out[: 1 + n_drugs] = 1.0
    for row in scales.collect():
        out[row.place] = 1.0 / row.scale
    return out


def _matrix(weights: DataFrame, low: int, high: int, width: int) -> np.ndarray:
    """The weights of some labels, at most ``_WEIGHTS`` numbers."""
    rows = weights.filter(F.col("label").between(low, high - 1)).select("label", "place", "weight").toPandas()
    out = np.zeros((high - low, width))
    out[rows["label"].to_numpy() - low, rows["place"].to_numpy()] = rows["weight"].to_numpy()
    return out


def _dense(batch: pa.RecordBatch, at: int, to: int, factors: np.ndarray) -> np.ndarray:
    places = batch.column("places").slice(at, to - at)
    lengths = places.value_lengths().to_numpy(zero_copy_only=False)
    x = np.zeros((to - at, len(factors)))
    columns = places.flatten().to_numpy(zero_copy_only=False)
    values = batch.column("values").slice(at, to - at).flatten().to_numpy(zero_copy_only=False)
    x[np.repeat(np.arange(to - at), lengths), columns] = values * factors[columns]
    return x


def _chunks(batches: Iterator[pa.RecordBatch], factors: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    rows = max(1, _CELLS // len(factors))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            to = min(at + rows, batch.num_rows)
            yield batch.slice(at, to - at), _dense(batch, at, to, factors)


def _truth(batch: pa.RecordBatch, low: int, high: int) -> np.ndarray:
    labels = batch.column("label")
    rows = np.repeat(np.arange(len(labels)), labels.value_lengths().to_numpy(zero_copy_only=False))
    columns = labels.flatten().to_numpy(zero_copy_only=False)
    inside = (columns >= low) & (columns < high)
    y = np.zeros((len(labels), high - low))
    y[rows[inside], columns[inside] - low] = 1.0
    return y


def _pass_sums(vectors: DataFrame, weights: np.ndarray, factors: np.ndarray, low: int) -> DataFrame:
    """label, place, value of each partition: its gradients and its part of the monitor."""
    high = low + len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient, monitor = np.zeros(weights.shape), np.zeros(4)
        for batch, x in _chunks(batches, factors):
            score, y = x @ weights.T, _truth(batch, low, high)
            p = 1.0 / (1.0 + np.exp(-score))
            train = batch.column("split").to_numpy(zero_copy_only=False) == "train"
            gradient += (p - y)[train].T @ x[train]
            loss = np.logaddexp(0.0, score[train]) - y[train] * score[train]
            hit, true = p[~train] >= 0.5, y[~train] > 0
            monitor += [loss.sum(), (hit & true).sum(), true.sum(), hit.sum()]
        label, place = np.nonzero(gradient)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([label + low, np.full(4, MONITOR)]).astype(np.int32)),
                pa.array(np.concatenate([place, np.arange(4)]).astype(np.int32)),
                pa.array(np.concatenate([gradient[label, place], monitor])),
            ],
            ["label", "place", "value"],
        )

    return vectors.select("split", "label", "places", "values").mapInArrow(run, "label int, place int, value double")


def _moved(weights: DataFrame, sums: DataFrame, n: int, t: int, rule: Rule) -> DataFrame:
    """The weights after pass ``t``, counted from 1."""
    pull = F.when(F.col("place") > 0, F.col("weight") * rule.pull).otherwise(0.0)
    gradient = F.coalesce(F.col("total"), F.lit(0.0)) / n + pull
    first = F.col("first") * rule.fade + F.col("_g") * (1 - rule.fade)
    second = F.col("second") * rule.fade_square + F.col("_g") * F.col("_g") * (1 - rule.fade_square)
    step = (F.col("_m") / (1 - rule.fade**t)) / (F.sqrt(F.col("_v") / (1 - rule.fade_square**t)) + rule.floor)
    return (
        weights.join(sums.filter(F.col("label") != MONITOR), ["label", "place"], "left")
        .withColumn("_g", gradient)
        .withColumns({"_m": first, "_v": second})
        .select("label", "place", (F.col("weight") - step * rule.rate).alias("weight"), F.col("_m").alias("first"), F.col("_v").alias("second"))
    )


def train(
    vectors: DataFrame,
    n_labels: int,
    n_drugs: int,
    n_features: int,
    passes: int = PASSES,
    patience: int | None = PATIENCE,
    rule: Rule | None = None,
) -> Learned:
    """Train from zero weights on the training steps; one job a pass reads the steps, one writes the weights.

    With ``patience`` training stops after so many passes in a row without a higher monitor value, and the weights of the
    highest one, the first of equals, are kept; without it the last weights are. The driver holds the weights of a pass:
    the number of labels times that of places, whatever the number of steps.
    """
    spark, rule = vectors.sparkSession, rule or Rule()
    width = 1 + n_drugs + n_features
    n = vectors.filter("split = 'train'").count()
    scales = scales_of(vectors, n_drugs)
    factors = _factors(scales, n_drugs, width)
    pair = F.col("id")
    weights = spark.range(n_labels * width).select(
        F.call_function("div", pair, F.lit(width)).cast("int").alias("label"),
        (pair % width).cast("int").alias("place"),
        *(F.lit(0.0).alias(name) for name in ("weight", "first", "second")),
    )
    weights = best = staged(weights, "label-weights")
    per_pass = max(1, _WEIGHTS // width)
    history: list[tuple[int, float, float]] = []
    kept, highest = 0, -1.0
    for t in range(passes + 1):
        parts = [
            _pass_sums(vectors, _matrix(weights, low, min(low + per_pass, n_labels), width), factors, low)
            for low in range(0, n_labels, per_pass)
        ]
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        sums = staged(found.groupBy("label", "place").agg(F.sum("value").alias("total")), "label-sums")
        monitor = {row.place: row.total for row in sums.filter(F.col("label") == MONITOR).collect()}
        loss, both, true, hit = (monitor.get(k, 0.0) for k in range(4))
        if t:
            history.append((t, loss / max(n, 1), both / (true + hit - both) if true + hit > 0 else 0.0))
            if patience is None or history[-1][2] > highest:
                kept, highest, best = t, history[-1][2], weights
        if t == passes or (patience is not None and t - kept >= patience and t > 0):
            break
        weights = staged(_moved(weights, sums, max(n, 1), t + 1, rule), "label-weights")
    return Learned(best.select("label", "place", "weight"), scales, history, kept)


def score(vectors: DataFrame, learned: Learned, n_labels: int, n_drugs: int, n_features: int) -> DataFrame:
    """hadm_id, step, ``truth`` and ``score``, arrays over all labels, for each step."""
    width = 1 + n_drugs + n_features
    factors = _factors(learned.scales, n_drugs, width)
    per_pass = max(1, _WEIGHTS // width)
    out = vectors.select("hadm_id", "step", "label", "places", "values").withColumn("score", F.array().cast("array<double>"))
    for low in range(0, n_labels, per_pass):
        out = _scored(out, _matrix(learned.weights, low, min(low + per_pass, n_labels), width), factors)
    places = F.sequence(F.lit(0), F.lit(n_labels - 1))
    truth = F.transform(places, lambda place: F.array_contains("label", place).cast("int"))
    return out.select("hadm_id", "step", truth.alias("truth"), "score")


def _scored(rows: DataFrame, weights: np.ndarray, factors: np.ndarray) -> DataFrame:
    """``rows`` with the scores of some labels put behind those that are there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _chunks(batches, factors):
            p = 1.0 / (1.0 + np.exp(-(x @ weights.T)))
            before = batch.column("score")
            have = before.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            both = np.hstack([have, p]) if have.size else p
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * both.shape[1]
            done = pa.ListArray.from_arrays(ends, np.ascontiguousarray(both).ravel())
            yield batch.set_column(batch.schema.get_field_index("score"), "score", done)

    return rows.mapInArrow(run, rows.schema)

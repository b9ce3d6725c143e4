"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams, trained by FTRL-proximal.

Features are the n-grams of 1 to 3 characters of the lower-cased text, hashed to ``BUCKETS``, as relative frequencies
times the inverse document frequency. Document frequencies and the number of documents of each language come from all
documents that may be learned from; the weights from a sample of them of about ``SAMPLE_ROWS`` rows, bounded for each
language and chosen by hash. Follow-the-regularised-leader keeps for each weight a sum of gradients and of their
squares; the elastic net sets weak weights to zero (L1) and shrinks the others (L2). A quarter of the sample is held
back to fit the temperature that calibrates the probabilities.

The fit runs in one task over the bounded sample; the model has a fixed size for each language. Prediction is one pass
with no shuffle.

A document is held out of learning if crc32 of its id as text is 2 modulo 4; a null id is never learned from and not
held out. A text without a letter, or null, is ``und`` with score 0, and so is every text if nothing can be learned.
Repeated rows each get their row. Extra columns are ignored.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import Rolling, batch_of, mix

BUCKETS = 1 << 15
SIZES = (1, 2, 3)
SAMPLE_ROWS = 6000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
SCALE = 20.0
UNKNOWN = "und"
HELD_OUT = 2
BLOCK_CHARACTERS = 1 << 20
LETTER = re.compile(r"[^\W\d_]")


def _blocks(texts: list[str | None]):
    """(first row, last row, bucket of every n-gram, row of every n-gram) of some texts at a time."""
    at = 0
    while at < len(texts):
        some, size = [], 0
        while at + len(some) < len(texts) and (size < BLOCK_CHARACTERS or not some):
            some.append((texts[at + len(some)] or "").lower())
            size += len(some[-1])
        codes = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        offsets = np.cumsum([0, *map(len, some)])
        rolling = Rolling(mix(codes + np.uint64(1)))
        rows = np.repeat(np.arange(len(some)), np.diff(offsets))
        buckets, owners = [], []
        for n in SIZES:
            grams = rolling.grams(n)
            inside = rows[: len(grams)] == rows[n - 1 :][: len(grams)]
            buckets.append((grams[inside] >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
            owners.append(rows[: len(grams)][inside])
        yield at, at + len(some), np.concatenate(buckets), np.concatenate(owners)
        at += len(some)


def _counts(bucket: np.ndarray, owner: np.ndarray, n: int):
    """For each row, its buckets and their relative frequencies."""
    code, count = np.unique(owner * BUCKETS + bucket, return_counts=True)
    row, column = code // BUCKETS, code % BUCKETS
    total = np.bincount(row, count, n)
    cuts = np.searchsorted(row, np.arange(n + 1))
    share = count / np.maximum(total[row], 1)
    return [(column[a:b], share[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def labelled(documents: DataFrame) -> DataFrame:
    """The rows that may be learned from: lang, text and a number to sample by."""
    part = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    return documents.filter("lang is not null and text is not null").filter(part != HELD_OUT).select(
        "lang", "text", F.abs(F.xxhash64("doc_id", "text") % (1 << 40)).alias("draw")
    )


def statistics(rows: DataFrame) -> tuple[dict[str, int], np.ndarray, int]:
    """Documents of each language, documents with each bucket, and all documents."""

    def count(batches):
        frequency = np.zeros(BUCKETS, np.int64)
        seen = 0
        for batch in batches:
            seen += batch.num_rows
            for first, last, bucket, owner in _blocks(batch.column("text").to_pylist()):
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(last - first + 1))
                bucket = bucket[order]
                for a, b in zip(cuts[:-1], cuts[1:]):
                    frequency += np.bincount(bucket[a:b], minlength=BUCKETS) > 0
        if seen:
            at = np.flatnonzero(frequency)
            yield batch_of(bucket=np.append(at, -1), n=np.append(frequency[at], seen))

    languages = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, frequency = 0, np.zeros(BUCKETS, np.int64)
    counted = rows.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in counted.collect():  # BUCKETS + 1 rows at most
        if bucket < 0:
            total = n
        else:
            frequency[bucket] = n
    return languages, frequency, total


class Ftrl:
    """FTRL-proximal for multinomial logistic regression with an elastic net."""

    def __init__(self, features: int, classes: int):
        self.z = np.zeros((features + 1, classes))
        self.n = np.zeros((features + 1, classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = softmax(x @ w)
        gradient[label] -= 1
        gradient = x[:, None] * gradient
        square = gradient**2
        self.z[at] += gradient - (np.sqrt(self.n[at] + square) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] += square


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The one that makes the labels most likely, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t):
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1)
        return float((np.log(np.exp(scaled - top[:, None]).sum(axis=1)) + top - scaled[np.arange(len(labels)), labels]).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


class Model(NamedTuple):
    languages: list[str]
    table: np.ndarray  # a row for each bucket, a column for each language
    bias: np.ndarray


def fit(documents: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Train on the labelled rows; None if there are none."""
    rows = labelled(documents)
    languages, frequency, total = statistics(rows)
    if not languages:
        return None
    names = sorted(languages)
    idf = np.log((1 + total) / (1 + frequency)) + 1
    each = max(1, sample_rows // len(names))
    limits = F.create_map(*(x for n in names for x in (F.lit(n), F.lit(int(min(1.0, each / languages[n]) * (1 << 40))))))
    sample = rows.filter(F.col("draw") < F.element_at(limits, F.col("lang")))

    def train(batches):
        draws, labels, x = [], [], []
        for batch in batches:
            draws += batch.column("draw").to_pylist()
            labels += [names.index(n) for n in batch.column("lang").to_pylist()]
            for first, last, bucket, owner in _blocks(batch.column("text").to_pylist()):
                x += [
                    (np.append(at, BUCKETS), np.append(share * idf[at] * SCALE, 1.0))
                    for at, share in _counts(bucket, owner, last - first)
                ]
        order = sorted(range(len(x)), key=lambda i: (draws[i], labels[i], len(x[i][0])))
        held, used = order[::4], [i for p, i in enumerate(order) if p % 4] or order
        model = Ftrl(BUCKETS, len(names))
        for _ in range(EPOCHS):
            for i in used:
                model.learn(*x[i], labels[i])
        w = model.weights(slice(None))
        logits = np.array([x[i][1] @ w[x[i][0]] for i in held]).reshape(len(held), len(names))
        w = w / temperature(logits, np.array([labels[i] for i in held], int))
        yield batch_of(weights=pa.array([w.astype(np.float64).tobytes()], pa.binary()))

    [trained] = sample.repartition(1).mapInArrow(train, "weights binary").collect()
    w = np.frombuffer(trained.weights).reshape(BUCKETS + 1, len(names))
    return Model(names, (w[:-1] * (idf * SCALE)[:, None]).astype(np.float32), w[-1])


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    shipped = documents.sparkSession.sparkContext.broadcast(tuple(model) if model else ([], None, None))

    def label(batches):
        languages, table, bias = shipped.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names = np.full(len(texts), UNKNOWN, object)
            scores = np.zeros(len(texts))
            for first, last, bucket, owner in _blocks(texts) if languages else ():
                logits = np.zeros((last - first, len(languages)))
                total = np.maximum(np.bincount(owner, minlength=last - first), 1)[:, None]
                for c in range(len(languages)):
                    logits[:, c] = np.bincount(owner, table[:, c][bucket], last - first)
                chance = softmax(logits / total + bias)
                names[first:last] = np.array(languages, object)[chance.argmax(axis=1)]
                scores[first:last] = chance.max(axis=1)
            for i, text in enumerate(texts):
                if not text or not LETTER.search(text):
                    names[i], scores[i] = UNKNOWN, 0.0
            yield batch_of(
                doc_id=batch.column("doc_id"), held_out=batch.column("held_out"),
                lang_pred=pa.array(names.tolist(), pa.string()), score=scores,
            )

    part = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    rows = documents.select("doc_id", F.coalesce(part == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(label, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def digest(documents: DataFrame) -> DataFrame:
    return predict(documents, fit(documents))

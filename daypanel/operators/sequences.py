"""Next-day labels, per-admission sequences, split and padding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.functions.numbers import bucket_hash
from daypanel.operators.encode import multi_hot

SEQUENCE_STEPS = 35
TEST_PERCENT = 25


def next_day_labels(days: DataFrame, stays: DataFrame) -> DataFrame:
    """Each recorded day with the drugs of the next recorded day as label; the last day has none and is left out.

    ``days`` has one row per (admission, day). ``stays`` lists admissions with a bounded number of days, which also
    bounds the window partitions; the restriction comes before the window. Adds ``step``, from 1.
    """
    stay = Window.partitionBy("hadm_id").orderBy("startdate")
    return (
        days.join(stays.select("hadm_id"), "hadm_id", "left_semi")
        .withColumns({"step": F.row_number().over(stay), "label": F.lead("drugs").over(stay)})
        .filter(F.col("label").isNotNull())
    )


def sequences(steps: DataFrame) -> DataFrame:
    """One row per admission with its steps in order. A stay is bounded in days, so its array is too."""
    fields = [name for name in steps.columns if name not in ("hadm_id", "step")]
    return steps.groupBy("hadm_id").agg(F.sort_array(F.collect_list(F.struct("step", *fields))).alias("steps"))


def split_of(hadm_id: Column, test_percent: int = TEST_PERCENT) -> Column:
    """``train`` or ``test`` by a hash of the admission: the same on every run and machine, without any shuffle."""
    return F.when(F.pmod(bucket_hash(hadm_id), F.lit(100)) < test_percent, "test").otherwise("train")


def pad_truncate(seqs: DataFrame, n_features: int, length: int = SEQUENCE_STEPS, as_int: bool = False) -> DataFrame:
    """Exactly ``length`` steps per admission: longer ones keep their last steps, shorter ones get zeros behind.

    A step of zeros has no drugs, no labels and all features 0. ``as_int`` cuts features to whole numbers. Gives the
    parallel arrays ``drugs``, ``features`` and ``labels``, and ``n_steps``, the number of real steps.
    """
    size = F.size("steps")
    kept = F.slice("steps", F.greatest(size - length, F.lit(0)) + 1, F.least(size, F.lit(length)))
    missing = F.lit(length) - F.size("kept")
    none = F.array().cast("array<int>")
    zeros = F.array_repeat(F.lit(0.0), n_features)

    def whole(vector: Column) -> Column:
        return F.transform(vector, lambda v: v.cast("bigint").cast("double"))

    features = F.transform("kept", lambda s: whole(s["features"]) if as_int else s["features"])
    return seqs.withColumn("kept", kept).select(
        "hadm_id",
        F.size("kept").alias("n_steps"),
        F.concat(F.transform("kept", lambda s: s["drugs"]), F.array_repeat(none, missing)).alias("drugs"),
        F.concat(features, F.array_repeat(zeros, missing)).alias("features"),
        F.concat(F.transform("kept", lambda s: s["label"]), F.array_repeat(none, missing)).alias("labels"),
    )


def dual_sequence(padded: DataFrame, n_drugs: int) -> DataFrame:
    """The two input sequences of the models: drugs as 0/1 vectors, and everything else."""
    return padded.select(
        "hadm_id",
        "n_steps",
        F.transform("drugs", lambda positions: multi_hot(positions, n_drugs)).alias("seqx1"),
        F.col("features").alias("seqx2"),
        F.transform("labels", lambda positions: multi_hot(positions, n_drugs)).alias("y"),
    )


def sequence_counts() -> dict[str, Column]:
    """The aggregates of ``sequence_stats``."""

    def empty(part: str) -> Column:
        return F.sum(F.size(F.filter("steps", lambda s: F.size(s[part]) == 0))).cast("bigint")

    return {
        "n_sequences": F.count(F.lit(1)),
        "n_steps": F.sum(F.size("steps")).cast("bigint"),
        "n_empty_drugs": empty("drugs"),
        "n_empty_labels": empty("label"),
    }


def sequence_stats(seqs: DataFrame) -> DataFrame:
    """One row: sequences, label steps, and days whose drugs or labels are all zero."""
    return seqs.agg(*[n.alias(name) for name, n in sequence_counts().items()])

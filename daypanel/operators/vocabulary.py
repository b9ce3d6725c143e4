"""Drug vocabulary, daily drug use and the spine of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypanel.sources.schemas import KEYS

VOCABULARY_SIZES = (1000, 800, 600, 400, 200)


def icu_prescriptions(prescriptions: DataFrame) -> DataFrame:
    """Prescriptions written during an ICU stay, with the start as a calendar day."""
    return prescriptions.filter(F.col("icustay_id").isNotNull()).withColumn("startdate", F.to_date("startdate"))


def top_drugs(icu: DataFrame, n: int) -> DataFrame:
    """The ``n`` most prescribed drugs with their counts; equal counts are ordered by name."""
    return (
        icu.groupBy("drug")
        .agg(F.count(F.lit(1)).alias("num"))
        .orderBy(F.desc("num"), F.asc_nulls_last("drug"))
        .limit(n)
    )


def vocabulary_sizes(icu: DataFrame, sizes: Sequence[int] = VOCABULARY_SIZES) -> DataFrame:
    """The vocabularies of several sizes, told apart by ``size``, from one count of the drugs.

    Ranks are given after the cut to the largest size, so the window sees at most ``max(sizes)`` rows.
    """
    order = Window.orderBy(F.desc("num"), F.asc_nulls_last("drug"))
    ranked = top_drugs(icu, max(sizes)).withColumn("_rank", F.row_number().over(order))
    fitting = F.filter(F.array(*[F.lit(n) for n in sizes]), lambda size: size >= F.col("_rank"))
    return ranked.select(F.explode(fitting).alias("size"), "drug", "num")


def in_vocabulary(icu: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Rows whose drug belongs to the vocabulary; how the two meet is left to size-based planning."""
    return icu.join(vocabulary.select("drug"), "drug", "left_semi")


def daily_drug_use(icu: DataFrame) -> DataFrame:
    """Distinct (admission, day, drug)."""
    return icu.select(*KEYS, "drug").distinct()


def spine(use: DataFrame) -> DataFrame:
    """Distinct (admission, day) with at least one drug; days that are not known cannot be matched and are left out."""
    return use.filter(F.col("startdate").isNotNull() & F.col("hadm_id").isNotNull()).select(*KEYS).distinct()

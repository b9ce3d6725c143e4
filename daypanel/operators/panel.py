"""Wide panel and the modelling table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.operators import registry as R
from daypanel.operators.signals import spine_means
from daypanel.sources.schemas import CATEGORIES, KEYS, SIGNAL_ORDER, STATIC_ORDER

STAY_DAYS = (2, 100)


def wide_panel(cleaned: DataFrame, spine: DataFrame) -> DataFrame:
    """The spine with the daily mean of all signals, null where there was no reading.

    Readings are tallied in long form first, which is cheap per reading and shrinks them to one row per (admission,
    day, signal). After the one exchange by admission inside ``spine_means``, laying the signals side by side and
    joining static attributes move nothing more; days without readings are kept by the spine's own rows.
    """
    return (
        spine_means(cleaned, spine)
        .groupBy(*KEYS)
        .agg(*[F.expr(f"max(case when signal = {R.CODE_OF[name]} then mean end) as {name}") for name in SIGNAL_ORDER])
    )


def cohort_panel(panel: DataFrame, cohort: DataFrame) -> DataFrame:
    """Panel rows of cohort admissions with their static attributes."""
    return panel.join(cohort.select("hadm_id", *STATIC_ORDER), "hadm_id")


def aligned_keys(spine: DataFrame, cohort: DataFrame) -> DataFrame:
    """Spine days that survive the cohort."""
    return spine.join(cohort.select("hadm_id"), "hadm_id", "left_semi")


def modelling_table(panel: DataFrame, cohort: DataFrame) -> DataFrame:
    """Keys, 30 signals and 9 static attributes in the fixed order, category texts normalised.

    The panel has one row per spine day, so joining the cohort already leaves exactly the aligned keys; no second join
    of keys to rows is needed.
    """
    rows = cohort_panel(panel, cohort)
    tidy = {name: F.replace(F.lower(name), F.lit(" "), F.lit("")) for name in CATEGORIES}
    return rows.withColumns(tidy).select(*KEYS, *SIGNAL_ORDER, *STATIC_ORDER)


def admission_days(keys: DataFrame, bounds: tuple[int, int] = STAY_DAYS) -> DataFrame:
    """Recorded days per admission, for admissions with a number of days within ``bounds``, both included."""
    return keys.groupBy("hadm_id").agg(F.count(F.lit(1)).alias("num")).filter(F.col("num").between(*bounds))

"""Multi-label metrics over scored steps.

Input rows are steps with ``truth``, an array of 0 and 1, and ``score``, an array of the same length. Everything up to
the final sums happens inside a row, so nothing is exploded into cells and the only exchange is that of a global
aggregate with partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.5
DIGITS = 8


def _total(cells: Column, zero: Column) -> Column:
    return F.aggregate(cells, zero, lambda total, cell: total + cell)


def _whole(cells: Column) -> Column:
    return _total(cells, F.lit(0).cast("bigint"))


def labelled_steps(scored: DataFrame) -> DataFrame:
    """Steps with at least one true label; padding has none."""
    return scored.filter(F.exists("truth", lambda t: t > 0))


def _precision_of_step() -> Column:
    """Over the true labels of a step, the mean share of true labels among those scored at least as high.

    The scores are sorted once, with their truth. Walking them from the top, ``seen`` and ``true`` are what stands above
    the current score, and a group of equal scores, ``tie`` of them with ``hit`` true, is settled when the next score
    begins: each of its true labels has the share (true + hit) / (seen + tie). So a step costs one sort of its labels.
    """
    return F.expr(
        """
        transform(array(aggregate(
          reverse(array_sort(arrays_zip(score, truth))),
          named_struct('at', cast(null as double), 'seen', 0L, 'true', 0L, 'tie', 0L, 'hit', 0L, 'sum', 0D),
          (s, c) -> if(s.at is not null and c.score = s.at,
            named_struct('at', s.at, 'seen', s.seen, 'true', s.true, 'tie', s.tie + 1, 'hit', s.hit + c.truth, 'sum', s.sum),
            named_struct('at', c.score, 'seen', s.seen + s.tie, 'true', s.true + s.hit, 'tie', 1L, 'hit', bigint(c.truth),
              'sum', s.sum + if(s.hit = 0, 0D, s.hit * ((s.true + s.hit) / (s.seen + s.tie))))))),
          s -> (s.sum + if(s.hit = 0, 0D, s.hit * ((s.true + s.hit) / (s.seen + s.tie)))) / nullif(s.true + s.hit, 0L))[0]
        """
    )


def step_counts(scored: DataFrame) -> DataFrame:
    """Per step: cells both true and predicted, cells true, cells predicted, and the ranking precision.

    Columns that the metric at hand does not ask for are pruned. In the ranking equal scores share the larger rank.
    """
    predicted = F.transform("score", lambda s: (s >= THRESHOLD).cast("int"))
    doubles = {"_predicted": predicted, "score": F.col("score").cast("array<double>")}
    return scored.withColumns(doubles).select(
        _whole(F.zip_with("truth", "_predicted", lambda t, p: t * p)).alias("both"),
        _whole(F.col("truth")).alias("is_true"),
        _whole(F.col("_predicted")).alias("is_predicted"),
        _precision_of_step().alias("precision"),
    )


def _jaccard() -> Column:
    union = F.col("is_true") + F.col("is_predicted") - F.col("both")
    return F.round(F.avg(F.col("both") / union), DIGITS).alias("jaccard")


def _precision() -> Column:
    return F.round(F.avg("precision"), DIGITS).alias("lrap")


def _micro_f1() -> Column:
    return F.round(F.sum("both") * 2 / (F.sum("is_true") + F.sum("is_predicted")), DIGITS).alias("micro_f1")


def jaccard(scored: DataFrame) -> DataFrame:
    """Mean over labelled steps of |true and predicted| / |true or predicted|."""
    return step_counts(labelled_steps(scored)).agg(_jaccard())


def ranking_precision(scored: DataFrame) -> DataFrame:
    """Label-ranking average precision over labelled steps."""
    return step_counts(labelled_steps(scored)).agg(_precision())


def micro_f1(scored: DataFrame) -> DataFrame:
    """2 TP / (2 TP + FP + FN) over all cells of labelled steps."""
    return step_counts(labelled_steps(scored)).agg(_micro_f1())


def pooled_jaccard(scored: DataFrame) -> DataFrame:
    """Jaccard over all cells at once, padding included."""
    union = F.sum("is_true") + F.sum("is_predicted") - F.sum("both")
    return step_counts(scored).agg(F.round(F.sum("both") / union, DIGITS).alias("pooled_jaccard"))


def soft_jaccard(scored: DataFrame) -> DataFrame:
    """1 - sum(t s) / (sum t + sum (1 - t) s) over all cells, scores taken as they are."""
    per_step = scored.select(
        _total(F.zip_with("truth", "score", lambda t, s: t * s), F.lit(0.0)).alias("overlap"),
        _whole(F.col("truth")).alias("is_true"),
        _total(F.zip_with("truth", "score", lambda t, s: (1 - t) * s), F.lit(0.0)).alias("outside"),
    )
    loss = 1 - F.sum("overlap") / (F.sum("is_true") + F.sum("outside"))
    return per_step.agg(F.round(loss, DIGITS).alias("soft_jaccard_loss"))


def run_report(scored: DataFrame, model: str, seconds: float) -> DataFrame:
    """One row with the model's name, its seconds and the three metrics, from a single pass over the steps."""
    figures = step_counts(labelled_steps(scored)).agg(_jaccard(), _precision(), _micro_f1())
    return figures.select(F.lit(model).alias("model"), F.lit(float(seconds)).alias("seconds"), *figures.columns)

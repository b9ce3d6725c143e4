from __future__ import annotations

import numpy as np
import pytest

from daypanel.operators import metrics


def scored(spark, rows):
    return spark.createDataFrame(rows, "truth array<int>, score array<double>")


def value(metric, df):
    return metric(df).first()[0]


def test_worked_cases(spark):
    one = scored(spark, [([1, 0, 1], [0.9, 0.8, 0.3])])
    assert value(metrics.jaccard, one) == pytest.approx(1 / 3, abs=1e-8)
    assert value(metrics.ranking_precision, one) == pytest.approx(5 / 6, abs=1e-8)
    assert value(metrics.micro_f1, one) == pytest.approx(1 / 2, abs=1e-8)
    assert value(metrics.pooled_jaccard, one) == pytest.approx(1 / 3, abs=1e-8)
    assert value(metrics.soft_jaccard, one) == pytest.approx(4 / 7, abs=1e-8)
    tie = scored(spark, [([1, 0], [0.5, 0.5])])
    assert value(metrics.ranking_precision, tie) == 0.5 and value(metrics.jaccard, tie) == 0.5


def test_padding_counts_only_in_the_pooled_form(spark):
    rows = [([1, 0, 1], [0.9, 0.8, 0.3]), ([0, 0, 0], [0.6, 0.1, 0.7])]
    df = scored(spark, rows)
    assert metrics.labelled_steps(df).count() == 1
    assert value(metrics.jaccard, df) == pytest.approx(1 / 3, abs=1e-8)
    assert value(metrics.micro_f1, df) == pytest.approx(1 / 2, abs=1e-8)
    assert value(metrics.pooled_jaccard, df) == pytest.approx(1 / 5, abs=1e-8)


def test_against_plain_loops(spark):
    rng = np.random.default_rng(1)
    truth = (rng.random((60, 9)) < 0.3).astype(int)
    score = rng.integers(0, 8, (60, 9)) / 8
    df = scored(spark, [(t.tolist(), s.tolist()) for t, s in zip(truth, score)])
    live = truth.sum(axis=1) > 0
    t, p, s = truth[live], (score[live] >= 0.5).astype(int), score[live]
    both = (t * p).sum(axis=1)
    precision = [
        np.mean([(tt[ss >= ss[j]]).sum() / (ss >= ss[j]).sum() for j in np.flatnonzero(tt)]) for tt, ss in zip(t, s)
    ]
    expected = {
        metrics.jaccard: np.mean(both / (t.sum(axis=1) + p.sum(axis=1) - both)),
        metrics.ranking_precision: np.mean(precision),
        metrics.micro_f1: 2 * both.sum() / (t.sum() + p.sum()),
        metrics.soft_jaccard: 1 - (truth * score).sum() / (truth.sum() + ((1 - truth) * score).sum()),
    }
    for metric, wanted in expected.items():
        got = value(metric, df)
        assert got == pytest.approx(wanted, abs=1e-8) and 0 <= got <= 1


def test_report(spark):
    row = metrics.run_report(scored(spark, [([1, 0, 1], [0.9, 0.8, 0.3])]), "gru", 2.5).first()
    assert (row.model, row.seconds, row.jaccard, row.micro_f1) == ("gru", 2.5, 0.33333333, 0.5)
    assert row.lrap == 0.83333333

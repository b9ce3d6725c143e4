from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from daypanel.operators import impute


def plain_fill(x, k):
    """Row by row, as the definition reads."""
    out, n = x.copy(), len(x)
    gaps = (x[:, None, :] - x[None, :, :]) ** 2
    shared = (~np.isnan(gaps)).sum(axis=2)
    d = np.where(shared > 0, np.nansum(gaps, axis=2) / np.maximum(shared, 1), np.inf)
    d = np.clip(d, impute.NEAREST, impute.FARTHEST * max(1.0, d[np.isfinite(d)].max()))
    for i in range(n):
        for j in np.flatnonzero(np.isnan(x[i])):
            have = [m for m in np.argsort(d[i], kind="stable") if m != i and not np.isnan(x[m, j])][:k]
            w = 1 / d[i, have]
            out[i, j] = (w * x[have, j]).sum() / w.sum() if have else 0.0
    return out


def test_worked_case():
    x = np.array([[0, np.nan], [1, 10], [2, 20]])
    assert impute.fill_block(x, 2)[0, 1] == pytest.approx(12)


@pytest.mark.parametrize("seed", range(4))
def test_against_the_definition(seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(300, 8)), 1)
    x[:, 6:] = x[:, 6:] > 0
    x[rng.random(x.shape) < (0.3, 0.6)[seed % 2]] = np.nan
    if seed < 2:
        x[:, 6:] = np.nan_to_num(x[:, 6:])  # complete 0/1 features
    x[:, 5] = np.nan  # never measured
    x[200:, 4] = np.nan  # measured in some rows only
    np.testing.assert_allclose(impute.fill_block(x, 10), plain_fill(x, 10), rtol=1e-9)


def test_few_rows_with_the_feature_far_down_the_order():
    x = np.column_stack([np.arange(500.0), np.full(500, np.nan)])
    x[[490, 499], 1] = [1.0, 3.0]
    np.testing.assert_allclose(impute.fill_block(x, 10), plain_fill(x, 10), rtol=1e-9)


def matrix(spark, n_stays, n_days):
    days = spark.range(n_stays * n_days).select(
        (F.col("id") / n_days).cast("bigint").alias("hadm_id"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % n_days).cast("int")).alias("startdate"),
        F.array(
            F.when(F.col("id") % 3 > 0, (F.col("id") % 17).cast("double")), (F.col("id") % 5).cast("double")
        ).alias("features"),
    )
    return days


def test_blocks_keep_stays_together_and_fill_everything(spark):
    rows = matrix(spark, 100, 10)
    blocked = impute.assign_blocks(rows, 1000, 100)
    per_stay = blocked.groupBy("hadm_id").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0]
    assert per_stay == 1 and blocked.select("block").distinct().count() > 5
    done = impute.knn_impute(blocked)
    assert done.count() == 1000
    assert done.filter(F.exists("features", lambda v: v.isNull() | F.isnan(v))).count() == 0
    kept = done.join(rows.withColumnRenamed("features", "raw"), ["hadm_id", "startdate"])
    assert kept.filter("raw[0] is not null and raw[0] <> features[0]").count() == 0


def test_one_block_below_the_block_size(spark):
    rows = matrix(spark, 3, 4)
    assert impute.assign_blocks(rows, 12).select("block").distinct().collect()[0].block == 0
    lazy = rows.agg(F.count(F.lit(1))).scalar()
    assert impute.assign_blocks(rows, lazy).select("block").distinct().count() == 1


def test_a_huge_stay_is_cut(spark):
    blocked = impute.assign_blocks(matrix(spark, 1, 2000), 2000, 50)
    assert blocked.groupBy("block").count().agg(F.max("count")).first()[0] <= 400


def test_key_as_feature_changes_the_neighbours(spark):
    day = dt.date(2024, 1, 1)
    rows = [(1, day, 0, [None, 1.0]), (2, day, 0, [5.0, 9.0]), (900, day, 0, [7.0, 1.0])]
    blocked = spark.createDataFrame(rows, "hadm_id bigint, startdate date, block bigint, features array<double>")
    by_value = impute.knn_impute(blocked, k=1).filter("hadm_id = 1").first().features
    by_key = impute.knn_impute(blocked, k=1, key_as_feature=True).filter("hadm_id = 1").first().features
    assert by_value == [7.0, 1.0] and by_key == [5.0, 1.0]

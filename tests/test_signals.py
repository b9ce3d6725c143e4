from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daypanel.operators import panel, signals
from daypanel.operators.registry import CODE_OF
from daypanel.sources.schemas import KEYS, SIGNAL_ORDER

DAY = [dt.date(2024, 1, d) for d in range(1, 10)]


def readings(spark, rows):
    """(admission, item, day, text) -> tagged and cleaned readings."""
    data = [(h, i, dt.datetime.combine(d, dt.time(9)), v) for h, i, d, v in rows]
    df = spark.createDataFrame(data, "hadm_id bigint, itemid int, charttime timestamp_ntz, value string")
    return signals.clean_units(signals.tag_signals(df))


def days(spark, pairs):
    return spark.createDataFrame(pairs, "hadm_id bigint, startdate date")


@pytest.fixture(scope="module")
def small(spark):
    rows = [
        (1, 211, DAY[0], "80"), (1, 211, DAY[0], None), (1, 211, DAY[1], "91"), (1, 211, DAY[2], "999"),
        (2, 211, DAY[0], None), (2, 50971, DAY[0], "4.11"), (2, 50971, DAY[0], "4.12"), (2, 50971, DAY[0], "bad e"),
        (2, 807, DAY[0], "fs 1"), (2, 807, DAY[1], "120"),
    ]
    return readings(spark, rows), days(spark, [(1, DAY[0]), (1, DAY[1]), (2, DAY[0]), (2, DAY[1]), (3, DAY[0])])


def test_fill_then_mean(small):
    means = {
        (r.hadm_id, r.startdate.day, r.signal): r["mean"] for r in signals.daily_signal_mean(*small).collect()
    }
    hr, k, glucose = CODE_OF["heart_rate"], CODE_OF["pota"], CODE_OF["blood_glucose"]
    assert means[1, 1, hr] == 83 and means[1, 2, hr] == 91  # fill 85.5 -> 86; day 3 is not on the spine
    assert means[2, 1, hr] is None  # no value in the whole stay
    assert means[2, 1, k] == pytest.approx((4.11 + 4.12 + 4.12) / 3)  # 4.115 is rounded up before it fills
    assert (2, 1, glucose) not in means and means[2, 2, glucose] == 120  # dropped, not filled


def test_filled_readings_agree_with_daily_means(small):
    filled = signals.filled_readings(*small)
    size = signals.unit_size(F.col("signal"))
    from_readings = filled.groupBy(*KEYS, "signal").agg((F.sum("units").cast("double") / F.count("units") / F.first(size)).alias("m"))
    both = from_readings.join(signals.daily_signal_mean(*small), [*KEYS, "signal"]).collect()
    assert len(both) == 5
    assert all(r.m == pytest.approx(r["mean"]) for r in both)


def test_fill_keeps_known_readings(small):
    cleaned, spine = small
    known = cleaned.filter("units is not null").join(spine, KEYS, "left_semi")
    kept = signals.filled_readings(cleaned, spine).select(known.columns)
    assert known.exceptAll(kept).count() == 0


def test_panel_has_the_rows_of_the_spine(small):
    wide = panel.wide_panel(*small)
    assert wide.columns == [*KEYS, *SIGNAL_ORDER]
    assert wide.select(*KEYS).exceptAll(small[1]).count() == 0 and wide.count() == 5
    row = wide.filter("hadm_id = 1").orderBy("startdate").first()
    assert row.heart_rate == 83 and row.pota is None


def test_negative_values_round_away_from_zero(spark):
    cleaned = readings(spark, [(1, 211, DAY[0], "-2"), (1, 211, DAY[0], "-3"), (1, 211, DAY[1], None)])
    means = signals.daily_signal_mean(cleaned, days(spark, [(1, DAY[0]), (1, DAY[1])])).collect()
    assert sorted(r["mean"] for r in means) == [-3.0, -2.5]


def test_quotients_round_away_from_zero(spark):
    from daypanel.functions.numbers import rounded_quotient

    cases = [(5, 2), (-5, 2), (7, 3), (-7, 3), (0, 4), (4 * 10**18, 10), (-(10**18) - 5, 10), (8, 0), (None, 1)]
    rows = spark.createDataFrame(cases, "t bigint, n bigint")
    got = rows.select(rounded_quotient(F.col("t"), F.col("n")).alias("q")).collect()
    want = [None if t is None or not n else (1 if t >= 0 else -1) * ((2 * abs(t) + n) // (2 * n)) for t, n in cases]
    assert [r.q for r in got] == want


def test_on_spine_keeps_each_reading_once(small):
    cleaned, spine = small
    assert signals.on_spine(cleaned, spine).count() == cleaned.join(spine, KEYS, "left_semi").count()


def test_one_admission_with_a_third_of_the_rows(spark):
    """The panel of a skewed table against pandas."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(5)
    n = 6000
    raw = pd.DataFrame(
        {
            "hadm_id": np.where(np.arange(n) % 3 == 0, 1, rng.integers(2, 60, n)),
            "itemid": rng.choice([211, 220045, 646], n),
            "day": rng.integers(0, 6, n),
            "value": np.where(rng.random(n) < 0.2, None, rng.integers(50, 99, n).astype(str)),
        }
    )
    rows = [(int(r.hadm_id), int(r.itemid), DAY[r.day], r.value) for r in raw.itertuples()]
    listed = raw[["hadm_id", "day"]].drop_duplicates().query("day != 3 or hadm_id % 2 == 0")
    spine = days(spark, [(int(r.hadm_id), DAY[r.day]) for r in listed.itertuples()])
    got = panel.wide_panel(readings(spark, rows), spine).select(*KEYS, "heart_rate", "spo2").toPandas()

    kept = raw.merge(listed, on=["hadm_id", "day"])
    kept["signal"] = np.where(kept.itemid == 646, "spo2", "heart_rate")
    kept["value"] = kept.value.astype(float)
    mean = kept.groupby(["hadm_id", "signal"]).value.transform("mean")
    kept["value"] = kept.value.fillna(np.floor(mean + 0.5))
    wanted = kept.pivot_table(index=["hadm_id", "day"], columns="signal", values="value", aggfunc="mean")
    got["day"] = got.startdate.map(lambda d: d.day - 1)
    both = got.set_index(["hadm_id", "day"]).sort_index()[["heart_rate", "spo2"]]
    wanted = wanted.reindex(both.index)
    np.testing.assert_allclose(both.to_numpy(float), wanted[["heart_rate", "spo2"]].to_numpy(float), rtol=1e-12)
    assert len(both) == len(listed)


@pytest.mark.parametrize("bits", (64, 1 << 12, signals.SPINE_BITS))
def test_days_off_the_spine_are_not_cleaned(spark, bits):
    tagged = spark.range(20_000).select(
        (F.col("id") % 200).alias("hadm_id"),
        F.date_add(F.lit(DAY[0]), (F.col("id") % 97).cast("int")).alias("startdate"),
        F.col("id").alias("n"),
    )
    spine = tagged.filter("hadm_id < 5 and day(startdate) < 10").select(*KEYS).distinct()
    near, on = signals.near_spine(tagged, spine, bits), signals.on_spine(tagged, spine)
    assert near.columns == tagged.columns and on.exceptAll(near).count() == 0 < on.count()
    n, days_of = near.count(), spine.count()
    if bits == 64:  # full: all pass
        assert n > 15_000
    else:  # a share of days over bits of the others, and some more by chance
        assert n <= on.count() + 20_000 * days_of / bits * 1.5 + 20


def test_the_filter_stands_before_the_cleaning(spark):
    rows = [(1, 211, DAY[0], "80"), (1, 211, DAY[3], "81"), (9, 211, DAY[0], "82")]
    data = [(h, i, dt.datetime.combine(d, dt.time(9)), v) for h, i, d, v in rows]
    tagged = signals.tag_signals(spark.createDataFrame(data, "hadm_id bigint, itemid int, charttime timestamp_ntz, value string"))
    cleaned = signals.clean_units(signals.near_spine(tagged, days(spark, [(1, DAY[0])])))
    assert [(r.hadm_id, r.units) for r in cleaned.collect()] == [(1, 80)]
    text = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("units") < text.index("_set")  # the plan is read from its end

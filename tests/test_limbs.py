"""Arithmetic on numbers of any length against Python's own."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from daypanel.functions import limbs
from daypanel.operators import registry as R
from daypanel.operators import signals, statics

NUMBER = re.compile(r"^[\x00-\x20]*[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]{1,3})?[\x00-\x20]*\Z")


def number(rng, longest=120, behind=True):
    whole = "".join(rng.choice("0123456789" if rng.random() < 0.8 else "9") for _ in range(rng.randint(0, longest)))
    places = rng.randint(0, 5 if rng.random() < 0.7 else 60)
    rest = "." + "".join(rng.choice("0459") for _ in range(places)) if behind and rng.random() < 0.6 else ""
    return rng.choice(["", "", "", "-", "+"]) + ((whole or "0") + rest)


@pytest.fixture(autouse=True)
def exact():
    with localcontext() as context:
        context.prec = 3000
        yield


def test_units(spark):
    rng = random.Random(1)
    texts = [number(rng) for _ in range(300)]
    texts += ["1e3", "-2.5E2", "9.995", "0.005", ".5", "5.", " 7 ", "99.995", "999999999999999.995", "1e-3", "5e-3", "1e-200"]
    texts += ["4e200", "12abc", "", "-", ".", "e5", "1e", "--1", "٣", "0", "-0", "-0.001", "0.999", "1e1000", None, "9" * 250 + ".995"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r for r in rows.select("i", *(F.expr(limbs.rounded_units("t", str(k))).alias(f"at_{k}") for k in (0, 2))).collect()}
    for i, text in enumerate(texts):
        for k in (0, 2):
            want = None
            if text is not None and NUMBER.match(text):
                want = str(int((Decimal(text.strip()) * 10**k).quantize(Decimal(1), ROUND_HALF_UP)))
            assert got[i][f"at_{k}"] == want, text


def cut(spark, groups):
    rows = [(g, t) for g, texts in enumerate(groups) for t in texts]
    return spark.createDataFrame(rows, "g int, t string").select("g", F.explode(F.expr(limbs.pieces("t"))).alias("x"))


def test_sums(spark):
    rng = random.Random(2)
    groups = [[number(rng) for _ in range(rng.randint(1, 12))] for _ in range(100)]
    groups += [["-5", "3"], ["1", "-1"], ["0"], ["-" + "9" * 40, "9" * 40], ["-1" + "0" * 45, "1"], ["5" * 250] * 9]
    added = cut(spark, groups).groupBy("g", F.col("x.limb").alias("limb")).agg(F.sum("x.piece").cast("decimal(38,0)").alias("piece"))
    lists = added.groupBy("g").agg(F.collect_list(F.struct("limb", "piece")).alias("l"))
    got = {r.g: Decimal(r.x) for r in lists.select("g", F.expr(limbs.total_text("l")).alias("x")).collect()}
    assert got == {g: sum(map(Decimal, texts)) for g, texts in enumerate(groups)}


@pytest.mark.parametrize("n", [1, 2, 7, 1_000_003, 10**12 + 1])
def test_quotients(spark, n):
    rng = random.Random(n)
    groups = [[number(rng, 60, False) for _ in range(rng.randint(1, 9))] for _ in range(60)]
    groups += [["5"], ["-5"], ["1", "-1"], ["-" + "9" * 40]]
    lists = cut(spark, groups).groupBy("g").agg(F.collect_list("x").alias("l"))
    got = {r.g: r.x for r in lists.select("g", F.expr(limbs.rounded_quotient_text("l", str(n))).alias("x")).collect()}
    for g, texts in enumerate(groups):
        total = sum(map(int, texts))
        assert got[g] == str((1 if total >= 0 else -1) * ((2 * abs(total) + n) // (2 * n)))


def cleaned(spark, rows):
    data = [(h, i, dt.datetime.combine(d, dt.time(9)), v) for h, i, d, v in rows]
    schema = "hadm_id bigint, itemid int, charttime timestamp_ntz, value string"
    return signals.clean_units(signals.tag_signals(spark.createDataFrame(data, schema)))


DAYS = [dt.date(2024, 1, d) for d in range(1, 4)]


def test_long_readings_are_kept_and_added_exactly(spark):
    texts = ["9" * 13, "8" * 15 + ".25", "7" * 30, "6" * 30 + ".99", "5" * 31, "4" * 100 + ".5", "3" * 250]
    rows = [(1, 50971, DAYS[0], text) for text in texts * 500]
    tally = signals.tally_digits(signals.reading_tally(cleaned(spark, rows))).first()
    total = 500 * sum(int(Decimal(t) * 100) for t in texts)
    n = 500 * len(texts)
    assert (tally.digits, tally.n_valued, tally.n_missing) == (str(total), n, 0)
    assert tally.rounded_mean == str((2 * total + n) // (2 * n))


def test_long_readings_of_every_signal(spark):
    """None is rejected or dropped, whatever its length."""
    rows = [(code, spec.items[0], DAYS[0], "1" * length) for code, spec in enumerate(R.SIGNALS) for length in (31, 100, 250)]
    got = {(r.hadm_id, len(r.value)): r for r in cleaned(spark, rows).collect()}
    assert len(got) == 90
    for (code, length), r in got.items():
        units = int("1" * length) * 10 ** R.SIGNALS[code].scale
        if R.SIGNALS[code].items[0] in R.CELSIUS_ITEMS:
            units = (units * 18 + 320 + 5) // 10
        assert r.units is None and r.long_units == str(units)
    report = signals.reject_report(cleaned(spark, rows).drop("units", "long_units")).collect()
    assert all(r.n_rejected == 0 and r.n_readings == 3 for r in report)


def test_long_celsius(spark):
    item = R.CELSIUS_ITEMS[0]
    rows = [(1, item, DAYS[0], "123456789012345678901234567890")]
    want = (123456789012345678901234567890 * 18 + 320 + 5) // 10
    assert cleaned(spark, rows).first().long_units == str(want)


def test_long_fill_and_means(spark):
    big = 10**40 + 7
    rows = [(1, 211, DAYS[0], str(big)), (1, 211, DAYS[1], "80"), (1, 211, DAYS[1], None), (2, 211, DAYS[0], "80")]
    spine = spark.createDataFrame([(1, DAYS[0]), (1, DAYS[1]), (2, DAYS[0])], "hadm_id bigint, startdate date")
    readings = cleaned(spark, rows)
    fill = (2 * (big + 80) + 2) // 4
    filled = signals.filled_readings(readings, spine).filter("value is null").first()
    assert filled.units is None and filled.long_units == str(fill)
    means = {(r.hadm_id, r.startdate): r["mean"] for r in signals.daily_signal_mean(readings, spine).collect()}
    assert means == {(1, DAYS[0]): float(big), (1, DAYS[1]): float(80 + fill) / 2, (2, DAYS[0]): 80.0}


def test_body_means_of_any_length(spark):
    values = {
        1: ["170.5", "171"],
        2: ["1" * 31, "2" * 100, "3" * 250],
        3: ["1.123456789012345678", "2.000000000000000002"],
        4: ["1.5e2", "25E-1", "1e-20"],
        5: ["tall", None],
        6: ["-3", "+4", " 5 "],
        7: ["12345678.5", "3"],
    }
    rows = [(h, item, v) for h, texts in values.items() for item in (R.HEIGHT_ITEM, R.WEIGHT_ITEM) for v in texts]
    rows += [(8, R.WEIGHT_ITEM, "80")]
    got = {r.hadm_id: r for r in statics.body_measures(spark.createDataFrame(rows, "hadm_id bigint, itemid int, value string")).collect()}
    for h, texts in values.items():
        numbers = [Decimal(t.strip()) for t in texts if t is not None and NUMBER.match(t)]
        want = float(sum(numbers)) / len(numbers) if numbers else None
        assert (got[h].height, got[h].weight) == (want, want)
    assert (got[8].height, got[8].weight) == (None, 80.0)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        statics.body_measures(spark.createDataFrame(rows, "hadm_id bigint, itemid int, value string"), strict=True).collect()

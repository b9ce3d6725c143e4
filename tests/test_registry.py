"""Raw text -> number, worked by hand for every signal."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from daypanel.operators import registry as R
from daypanel.operators.signals import clean_units, reject_report, tag_signals, unit_size

GONE = "gone"  # the reading itself is dropped

CASES = {
    "respiratory_rate": {">60/min": 60, "18.5": 19, "12.4": 12, None: None},
    "blood_glucose": {
        "\\109": 109, "110CS": 110, "'174": 174, "99.5": 100, "fs 120": GONE, "1,20": GONE, "": GONE, None: GONE,
    },
    "fio2": {".5": 50, "0.5": 100, "0.6": 100, "0.4": 0, "1": 100, "40": 40, ".995": 99, ".25": 25, "high": None},
    "blood_oxygen_saturation": {"DISREGARD": None, "97.5": 98, "97.4": 97},
    "ph": {"7.405": 7.41, "GREATER THAN 7.8": 7.8, "CLOTTED": None, ">7.8": None},
    "po": {"QNS": None, "GREATER THAN 500": 500, "greater than 500": None},
    "pco": {"GREATER THAN 150": None, "41": 41},
    "co": {"-5": None, "25": 25, "GREATER THAN 50": 50, "-": None},
    "agap": {"-5": None, "25": 25, "GREATER THAN 50": 50},
    "albu": {"LESS THAN 1.0": 1, "<1.0": 1, "add-on": None, "3.25": 3.25},
    "bica": {"LESS THAN 5": 5, "GREATER THAN 50": 50, ">50": 50, "GREATER THAN 40": 40, "UNABLE": None},
    "sodi": {"GREATER THAN 180": 180, ">180": 180, "LESS THAN 10": 10, "DISREGARD": None},
    "pota": {"GREATER THAN 10": None, "<1.0": 1},
    "chlor": {">140": 140, "LESS THAN 10": None},
    "lacta": {"GREATER THAN 30": 30, "GREATER THAN 20.5": 20.5, "UNABLE TO REPORT": None, ">30": 30},
    "creatin": {"LESS THAN 0.6": 0.6, "<0.5": 0.5, "GREATER THAN 25": 25, "VOID": None},
    "ureanit": {"UNABLE": None, "GREATER THAN 180": 180, "<0.5": 0.5},
    "partialt": {"26..": 26, ">150": None, "GREATER THAN 150": None},
    "interrat": {">23.7": 23.7, ">20": None, "GREATER THAN 15.7": None},
    "bilirut": {"LESS THAN 2.0": None, "1.25": 1.25},
    "hemogt": {"10.25": 10.25, "LESS THAN 2.0": None},
    "hematt": {"10.25": 10.25, "LESS THAN 2.0": None},
    "wbcet": {"<0.1": 0.1, "TEST": None},
    "calc": {"<5": None, "-5": None, "8.4": 8.4},
    "heart_rate": {"80.5": 81, "-3.5": -4, "abc": None},
    "diastolic_blood_pressure": {"70": 70},
    "systolic_blood_pressure": {"120.4": 120},
    "spo2": {"98": 98},
    "glascow_coma_scale": {"15": 15},
}
BY_ITEM = {("body_temperature", 676): {"36.6": 99}, ("body_temperature", 223762): {"36.4": 97}}
BY_ITEM |= {("body_temperature", 678): {"98.6": 99}, ("body_temperature", 223761): {None: None}}
for spec in R.SIGNALS:
    if spec.numeric_only:
        half = 1 if spec.scale == 0 else 0.5
        odd = GONE if spec.drop_missing else None
        CASES[spec.name] |= {"5.": 5, ".5": half, "1e3": odd, " 5": odd, "+5": odd, "5\n": odd}


def rows():
    for spec in R.SIGNALS:
        for text, expected in CASES.get(spec.name, {}).items():
            for item in spec.items:
                yield spec.name, item, text, expected
    for (name, item), cases in BY_ITEM.items():
        for text, expected in cases.items():
            yield name, item, text, expected


@pytest.fixture(scope="module")
def readings(spark):
    data = [(k, item, text) for k, (_, item, text, _) in enumerate(rows())]
    df = spark.createDataFrame(data, "hadm_id bigint, itemid int, value string")
    return df.withColumn("charttime", F.lit("2024-01-01 08:00:00").cast("timestamp_ntz"))


def test_every_signal_has_cases():
    assert {name for name, *_ in rows()} == {spec.name for spec in R.SIGNALS}


def test_goldens(readings):
    value = F.col("units") / unit_size(F.col("signal"))
    cleaned = clean_units(tag_signals(readings)).select("hadm_id", "signal", value.alias("value")).collect()
    got = {row.hadm_id: (R.NAME_OF[row.signal], row.value) for row in cleaned}
    wrong = []
    for k, (name, item, text, expected) in enumerate(rows()):
        seen = got.get(k, (name, GONE))
        if seen != (name, expected):
            wrong.append((name, item, text, expected, seen))
    assert not wrong


def test_items_belong_to_one_signal():
    items = [item for spec in R.SIGNALS for item in spec.items]
    assert len(items) == len(set(items)) and len(R.SIGNALS) == 30


@pytest.mark.parametrize("spec", R.SIGNALS, ids=lambda s: s.name)
def test_plain_digits_match_no_rule(spec):
    """What lets plain digits pass before the rules: no needle can be found in, or at the start of, such a text."""
    plain = re.compile(R.PLAIN_TEXT.replace(r"\z", r"\Z"))
    shape = re.compile(R.NUMERIC_TEXT.replace(r"\z", r"\Z"))
    for kind, pattern, outcome in spec.rules:
        if kind == R.HAS:
            assert re.search(r"[^0-9.]|[.].*[.]", pattern)
        else:
            assert not plain.match(pattern) and (kind == R.IS or not pattern[0].isdigit())
        if outcome not in (R.MISSING, R.STRIP, R.PERCENT):
            assert shape.match(outcome)


def test_strict_raises_on_bad_text(spark, readings):
    bad = readings.filter(F.col("value") == "abc")
    assert clean_units(tag_signals(bad)).filter("units is null").count() > 0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean_units(tag_signals(bad), strict=True).collect()


def test_reject_report_counts(readings):
    report = {row.signal: row for row in reject_report(tag_signals(readings)).collect()}
    assert report["respiratory_rate"].n_blank == 4 and report["respiratory_rate"].n_rejected == 0
    assert report["wbcet"].n_rejected == 5  # TEST, 1e3, " 5", +5 and a digit before a line end


def test_unlisted_items_are_left_out(spark, readings):
    listed = spark.createDataFrame([(211, "Heart Rate"), (999, "x")], "itemid int, label string")
    kept = tag_signals(readings, dictionary=listed).select("itemid").distinct().collect()
    assert [row.itemid for row in kept] == [211]
    assert tag_signals(readings, "lab").filter("itemid = 211").count() == 0

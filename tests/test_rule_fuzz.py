"""Random texts: the broadcast rules against the rules applied one after another in plain Python."""

from __future__ import annotations

import random
import re
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from daypanel.operators import registry as R
from daypanel.operators.signals import clean_units, tag_signals

PIECES = [
    "GREATER THAN ", "greater than ", "LESS THAN ", "less than ", "<", ">", "-", ".", "..", "0", "1", "5", "10", "2.0",
    "45", "50", "60", "180", "23.", "26", "0.5", "0.6", "1.0", "e", "UNABLE", "disre", "add", "Q", "V", "cs", "FS",
    "\\", ",", "``", "'174", " ", "", "9999999",
]
SHAPE = re.compile(R.NUMERIC_TEXT.replace(r"\z", r"\Z"))


def expected(spec, item, text):
    """Units, or None; ``gone`` for a dropped reading."""
    for mark in spec.marks:
        text = text.lower().replace(mark, "")
    for kind, pattern, outcome in spec.rules:
        if text is None:
            break
        low = text.lower()
        hit = {R.IS: low == pattern, R.HAS: pattern in low, R.LEADS: text.startswith(pattern)}[kind]
        if hit and outcome == R.STRIP:
            text = text.replace(R.UPPER_BOUND, "")
        elif hit and outcome == R.PERCENT:
            digits = re.match(r"[.][0-9]{1,2}", text)
            text = str(Decimal(digits.group()) * 100) if digits else None
        elif hit:
            text = outcome
    if spec.numeric_only and text is not None and not SHAPE.match(text):
        text = None
    try:
        number = Decimal(text.strip()) if text is not None else None
    except ArithmeticError:
        number = None
    if number is not None and not number.is_finite():
        number = None
    if number is None:
        return "gone" if spec.drop_missing else None
    units = int((number * 10**spec.scale).quantize(Decimal(1), ROUND_HALF_UP))
    if item in R.CELSIUS_ITEMS:
        units = int((units * Decimal("1.8") + 32).quantize(Decimal(1), ROUND_HALF_UP))
    return 100 if spec.name == "fio2" and units == 1 else units


def test_random_texts(spark):
    rng = random.Random(11)
    texts = sorted({"".join(rng.choices(PIECES, k=rng.randint(1, 4))) for _ in range(1500)})
    cases = [(spec, spec.items[k % len(spec.items)], text) for spec in R.SIGNALS for k, text in enumerate(texts)]
    rows = [(k, item, text) for k, (_, item, text) in enumerate(cases)]
    df = spark.createDataFrame(rows, "hadm_id bigint, itemid int, value string").withColumn(
        "charttime", F.lit("2024-01-01").cast("timestamp_ntz")
    )
    rows = clean_units(tag_signals(df)).select("hadm_id", "units", "long_units").collect()
    got = {r.hadm_id: int(r.long_units) if r.units is None and r.long_units else r.units for r in rows}
    wrong = []
    for k, (spec, item, text) in enumerate(cases):
        wanted, seen = expected(spec, item, text), got.get(k, "gone")
        if wanted != seen:
            wrong.append((spec.name, item, text, wanted, seen))
    assert not wrong, wrong[:10]
    assert sum(v is not None for v in got.values()) > 2000

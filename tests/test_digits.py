"""Sums of long numbers as texts in the workers, and the tally built on them."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pyarrow as pa
import pytest

from daypanel.functions import digits
from daypanel.operators import registry as R
from daypanel.operators import signals

DAY = dt.date(2024, 1, 1)


def cleaned(spark, rows):
    data = [(h, i, dt.datetime.combine(DAY, dt.time(9)), v) for h, i, v in rows]
    schema = "hadm_id bigint, itemid int, charttime timestamp_ntz, value string"
    return signals.clean_units(signals.tag_signals(spark.createDataFrame(data, schema)))


def test_sums_and_means_of_lists():
    rng = random.Random(4)
    lists = [[str(rng.randint(-(10**k), 10**k)) for _ in range(rng.randint(0, 5))] for k in (1, 15, 40, 250) for _ in range(50)]
    lists += [["-" + "9" * 30, "9" * 30], ["-1"], ["-5", "2"]]
    more = [rng.choice([None, 0, -7, 10**18]) for _ in lists]
    counts = [rng.choice([0, 1, 2, 7, 10**9]) for _ in lists]
    column = pa.array(lists, pa.list_(pa.string()))
    totals, means = digits.totals_and_means(column, pa.array(more, pa.int64()), pa.array(counts, pa.int64()))
    for texts, other, n, total, mean in zip(lists, more, counts, totals, means):
        want = sum(map(int, texts)) + (other or 0)
        sign = -1 if want < 0 else 1
        assert total == str(want)
        assert mean == (str(sign * ((2 * abs(want) + n) // (2 * n))) if n else None)
    assert digits.added(column).to_pylist() == [str(sum(map(int, texts))) if texts else None for texts in lists]


def test_no_limit_of_digits():
    long = "8" * 20_000
    column = pa.array([[long, "1" * 20_000, "1"]])
    assert digits.added(column).to_pylist() == ["1" + "0" * 20_000]
    assert digits.totals_and_means(column, pa.array([-1], pa.int64()), pa.array([3]))[1] == ["3" * 20_000]


def test_chunks_are_bounded(monkeypatch):
    monkeypatch.setattr(digits, "CHUNK_BYTES", 100)
    batches = [pa.record_batch([pa.array(range(10))], names=["n"]) for _ in range(5)]  # 80 bytes each
    assert [chunk.num_rows for chunk in digits.chunks(iter(batches))] == [20, 20, 10]


def test_tally_cuts_no_reading_into_limbs(spark, capsys):
    """A long reading stays one row, and its sum one text."""
    signals.tally_digits(signals.reading_tally(cleaned(spark, [(1, 211, "7" * 250)]))).explain()
    plan = capsys.readouterr().out
    assert "MapInArrow" in plan and not any(step in plan for step in ("Generate", "Window"))


@pytest.mark.parametrize("chunk", [1, 1 << 24])
def test_tally_by_chunks(spark, monkeypatch, chunk):
    """Keys with short, long, missing and no values, added up in many chunks or one."""
    monkeypatch.setattr(digits, "CHUNK_BYTES", chunk)
    texts = {
        1: ["80", "91", None],
        2: ["7" * 30, "-" + "7" * 30, "-3"],
        3: [None, "no number"],
        4: ["9" * 250] * 40 + ["1"] * 40 + [None],
        5: ["1" * 9 + "2"],
        6: ["007" + "0" * 12, "0" * 20 + "5", "12345678901.5"],
    }
    rows = [(h, 211, text) for h, values in texts.items() for text in values]
    readings = cleaned(spark, rows).repartition(3)
    got = {r.hadm_id: r for r in signals.tally_digits(signals.reading_tally(readings)).collect()}
    assert set(got) == set(texts) and got[1].signal == R.CODE_OF["heart_rate"]
    for h, values in texts.items():
        numbers = [int(Decimal(t).to_integral_value("ROUND_HALF_UP")) for t in values if t and t != "no number"]
        total, n = sum(numbers), len(numbers)
        sign = -1 if total < 0 else 1
        assert (got[h].n_valued, got[h].n_missing) == (n, len(values) - n)
        assert got[h].digits == (str(total) if n else None)
        assert got[h].rounded_mean == (str(sign * ((2 * abs(total) + n) // (2 * n))) if n else None)

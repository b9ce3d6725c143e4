"""The exchange by admission has partitions for the stored size of its inputs."""

from __future__ import annotations

import re

import pytest

from daypanel import session
from daypanel.operators import panel, signals
from daypanel.plans.queries import line_spine_of, line_tagged


def dealt(frame, capsys):
    """(partitions, kind) of the exchanges that were asked for."""
    frame.explain()
    return re.findall(r"Exchange hashpartitioning\(\w+#\w+, (\d+)\), (REPARTITION\w+)", capsys.readouterr().out)


@pytest.fixture()
def stored(spark, tmp_path):
    path = str(tmp_path / "stored")
    spark.range(0, 20_000, 1, 1).selectExpr("id as hadm_id").write.parquet(path)
    return spark.read.parquet(path), sum(f.stat().st_size for f in (tmp_path / "stored").glob("*.parquet"))


def test_partitions_follow_the_stored_size(spark, stored, monkeypatch, capsys):
    rows, size = stored
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(session, "TASK_BYTES", size // 20)
    [(once, kind)] = dealt(session.spread(rows, "hadm_id", rows), capsys)
    assert (int(once), kind) == (-(-size // (size // 20)), "REPARTITION_BY_NUM")
    [(twice, _)] = dealt(session.spread(rows, "hadm_id", rows, rows.filter("hadm_id > 5")), capsys)
    assert int(twice) == -(-2 * size // (size // 20))
    monkeypatch.setattr(session, "TASK_BYTES", size)
    assert dealt(session.spread(rows, "hadm_id", rows), capsys) == [(str(now), "REPARTITION_BY_COL")]


def test_no_fewer_than_the_session_has(spark, stored, monkeypatch, capsys):
    rows, size = stored
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(session, "TASK_BYTES", size // 20)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        assert dealt(session.spread(rows, "hadm_id", rows), capsys) == [("64", "REPARTITION_BY_NUM")]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rows_of_unknown_size_count_nothing(spark, capsys):
    rows = spark.createDataFrame([(1,), (2,)], "hadm_id bigint")
    assert [kind for _, kind in dealt(session.spread(rows, "hadm_id", rows), capsys)] == ["REPARTITION_BY_COL"]


def test_panel_is_dealt_by_size(spark, sf_dir, monkeypatch, capsys):
    """More partitions than the session has, and the same rows."""

    def wide():
        cleaned = signals.clean_units(line_tagged(spark, sf_dir))
        return panel.wide_panel(cleaned, line_spine_of(spark, sf_dir)[1])

    plain = wide().collect()
    monkeypatch.setattr(session, "TASK_BYTES", 40_000)
    [(n, kind)] = dealt(wide(), capsys)
    assert kind == "REPARTITION_BY_NUM" and int(n) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = lambda r: (r.hadm_id, r.startdate)
    assert sorted(wide().collect(), key=key) == sorted(plain, key=key)

"""Every registered query against DuckDB, and the shape of its plan."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

QUERIES = {k: f for k, f in contract.queries().items() if k not in contract.TEXT_QUERIES}  # tests/llm has those
ORACLE = {k: q for k, q in contract.oracle_sql().items() if k not in contract.TEXT_QUERIES}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "part", "orders", "lineitem", "events"):
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def test_what_has_no_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal_rows(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    wanted = Counter(cursor.fetchall())
    rows = Counter(tuple(r) for r in got.select(*names).collect())
    assert rows == wanted and sum(rows.values()) > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "SinglePartition" not in text or name.startswith(("metric_", "sequence_stats", "null_audit")) or (
        "collect_list" in text or "count(1)" in text  # the vocabulary in one row, the row count of a block plan
    )


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and len(df.columns) == 41


def test_spine_reads_only_what_it_needs(spark, sf_dir):
    text = plan(QUERIES["line_top_drugs"](spark, sf_dir))
    assert "l_extendedprice" not in text and "o_totalprice" not in text and "p_brand" not in text
    assert "TakeOrderedAndProject" in text


def test_panel_moves_readings_once(spark, sf_dir):
    """Exchanges of the panel without any broadcast by size.

    Vocabulary count, both sides of the vocabulary join, distinct spine, item dictionary, tally, one by admission.
    """
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["wide_panel"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 7
    assert text.count("REPARTITION_BY_COL") == 1 and text.count("SortMergeJoin") == 1  # of the vocabulary
    assert text.count("FileScan parquet") == 4  # vocabulary, spine, readings, dictionary


def test_static_side_joins_without_moving_the_panel(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["dataset"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = text[: text.index("REPARTITION_BY_COL")]
    assert "SortMergeJoin [hadm_id" in joined and joined.count("Exchange") == 1  # the repartition itself

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daypanel.operators import encode, panel, sequences

D = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(60)]
A, B, C = 0, 1, 2


def table(spark, rows):
    return spark.createDataFrame(rows, "hadm_id bigint, startdate date, drugs array<int>, features array<double>")


def labelled(spark, rows, bounds=(2, 100)):
    days = table(spark, rows)
    return sequences.next_day_labels(days, panel.admission_days(days, bounds))


def test_label_is_the_next_recorded_day(spark):
    rows = [(1, D[4], [C], [3.0]), (1, D[0], [A], [1.0]), (1, D[1], [A, B], [2.0]), (2, D[0], [A], [1.0])]
    got = labelled(spark, rows).orderBy("step").collect()
    assert [(r.hadm_id, r.startdate, r.step, r.label) for r in got] == [(1, D[0], 1, [A, B]), (1, D[1], 2, [C])]


def test_day_bounds(spark):
    rows = [(h, D[k], [A], [0.0]) for h, n in ((1, 1), (2, 2), (3, 5), (4, 6)) for k in range(n)]
    assert {r.hadm_id for r in labelled(spark, rows, (2, 5)).collect()} == {2, 3}


@pytest.mark.parametrize("n_days", [3, 35, 36, 41])
def test_padding_and_truncation(spark, n_days):
    rows = [(1, D[k], [k], [k + 0.9]) for k in range(n_days)]
    seqs = sequences.sequences(labelled(spark, rows))
    got = sequences.pad_truncate(seqs, 1).first()
    steps = n_days - 1
    kept = list(range(steps))[-35:]
    assert got.n_steps == len(kept)
    assert got.drugs == [[k] for k in kept] + [[]] * (35 - len(kept))
    assert got.labels == [[k + 1] for k in kept] + [[]] * (35 - len(kept))
    assert [f[0] for f in got.features] == [k + 0.9 for k in kept] + [0.0] * (35 - len(kept))
    whole = sequences.pad_truncate(seqs, 1, as_int=True).first()
    assert [f[0] for f in whole.features] == [float(k) for k in kept] + [0.0] * (35 - len(kept))
    dual = sequences.dual_sequence(sequences.pad_truncate(seqs, 1), 60).first()
    assert len(dual.seqx1) == 35 and all(len(step) == 60 for step in dual.seqx1)
    assert [i for i, v in enumerate(dual.y[0]) if v] == got.labels[0]


def test_split_is_by_admission_and_repeats(spark):
    ids = spark.range(20_000).select("id", sequences.split_of(F.col("id")).alias("split"))
    share = ids.filter("split = 'test'").count() / 20_000
    assert 0.23 < share < 0.27
    assert ids.repartition(7).exceptAll(ids).count() == 0


def test_stats(spark):
    rows = [(1, D[k], [A], [0.0]) for k in range(4)] + [(2, D[0], [], [0.0]), (2, D[1], [B], [0.0])]
    got = sequences.sequence_stats(sequences.sequences(labelled(spark, rows))).first()
    assert (got.n_sequences, got.n_steps, got.n_empty_drugs, got.n_empty_labels) == (2, 4, 1, 0)


def test_one_hot_and_layout(spark):
    df = spark.createDataFrame([("m", "x"), ("f", None), (None, "y"), ("f", "é"), ("f", "é")], "gender string, religion string")
    columns = ["gender", "religion"]
    dictionary = encode.category_dictionary(df, columns)
    values = [(0, "f", 0), (0, "m", 1), (1, "x", 2), (1, "y", 3), (1, "é", 4)]
    assert sorted(map(tuple, dictionary.collect())) == values
    unknown = spark.createDataFrame([("z", "x")], "gender string, religion string")
    rows = encode.with_places(df.unionByName(unknown), dictionary, columns)
    bits = [b.alias(c) for b, c in zip(encode.one_hot_bits(dictionary, columns), ("g", "r"))]
    got = {(r.gender, r.religion): (r.g, r.r) for r in rows.select(*columns, *bits).collect()}
    assert got == {
        ("m", "x"): ("01", "100"), ("f", None): ("10", "000"), (None, "y"): ("00", "010"),
        ("f", "é"): ("10", "001"), ("z", "x"): ("00", "100"),
    }
    layout = encode.FeatureLayout(dictionary, columns=columns)
    dummies = ["gender_f", "gender_m", "religion_x", "religion_y", "religion_é"]
    assert layout.names[30:] == ["age", "weight", "height", "hospital_expire_flag", *dummies]
    assert layout.n_features == len(layout.names)
    assert layout.without("statics").names == layout.names[:30] and layout.without("statics").n_features == 30
    assert layout.without("signals").names == layout.names[30:]
    assert "hospital_expire_flag" not in layout.without("outcome").names


def test_vectors_of_categories(spark):
    df = spark.createDataFrame([(1, "m", None, 2.0), (2, None, "x", None), (3, "f", "y", 0.0)], "i int, a string, b string, n double")
    dictionary = encode.category_dictionary(df, ["a", "b"])
    layout = encode.FeatureLayout(dictionary, signals=(), numbers=("n",), columns=("a", "b"))
    rows = {r.i: r for r in layout.placed(df).select("i", layout.vector().alias("v"), layout.n_set().alias("k")).collect()}
    assert {i: r.v for i, r in rows.items()} == {1: [2.0, 0, 1, 0, 0], 2: [None, 0, 0, 1, 0], 3: [0.0, 1, 0, 0, 1]}
    assert {i: r.k for i, r in rows.items()} == {1: 2, 2: 1, 3: 2}
    none = encode.category_dictionary(df.filter("false"), ["a", "b"])
    empty = encode.FeatureLayout(none, signals=(), numbers=("n",), columns=("a", "b"))
    assert empty.n_features == 1 and empty.placed(df).select(empty.vector().alias("v")).filter("size(v) = 1").count() == 3
    bits = encode.one_hot_bits(none, ["a", "b"])
    assert [r.x for r in encode.with_places(df, none, ["a", "b"]).select(bits[0].alias("x")).collect()] == [""] * 3


def test_many_categories(spark, monkeypatch):
    """More values than one range holds, most of them with a common prefix: places are those of the sorted texts."""
    n = 5000
    df = spark.range(n).selectExpr("concat('https://', lpad(string((id * 7919) % 5000), 5, '0')) as a", "string(id % 3) as b")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = encode.category_dictionary(df, ["a", "b"]).orderBy("place").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = [(0, f"https://{k:05d}") for k in range(n)] + [(1, str(k)) for k in range(3)]
    assert [(r.attribute, r.category) for r in got] == want and [r.place for r in got] == list(range(n + 3))


def test_multi_hot(spark):
    use = spark.createDataFrame([(1, D[0], "b"), (1, D[0], "b"), (1, D[0], "a"), (1, D[1], "c"), (1, None, "c")], "hadm_id bigint, startdate date, drug string")
    vocabulary = spark.createDataFrame([("c",), ("a",)], "drug string")
    sets = encode.drug_sets(use, encode.drug_positions(vocabulary))
    got = {r.startdate: r.v for r in sets.select("startdate", encode.multi_hot(F.col("drugs"), 3).alias("v")).collect()}
    assert got == {D[0]: [1, 0, 0], D[1]: [0, 1, 0]}

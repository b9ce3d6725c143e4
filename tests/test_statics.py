from __future__ import annotations

import datetime as dt

import pytest

from daypanel.operators import statics, vocabulary

NAMES = (
    "subject_id bigint, hadm_id bigint, gender string, age double, weight double, height double, religion string, "
    "language string, marital_status string, ethnicity string"
)


def impute(spark, rows):
    data = [(k, k, g, float(a) if a is not None else None, w, h, None, None, m, None) for k, (g, a, h, w, m) in enumerate(rows)]
    return statics.impute_static(spark.createDataFrame(data, NAMES)).orderBy("hadm_id").collect()


def test_height_and_weight(spark):
    got = impute(
        spark,
        [("M", 40, None, None, "X"), ("F", 30, None, None, "X"), ("M", 16, None, None, "X"),
         ("M", 40, 180.0, 70.0, "X"), (None, 40, None, 61.0, "X"), ("F", None, None, None, "X")],
    )
    heights, weights = [r.height for r in got], [r.weight for r in got]
    assert heights == [177, 169.2, 0, 180, 0, 0]
    assert weights == pytest.approx([88.66107, 75.2933232, 0, 91.692, 61, 0])
    assert {(r.religion, r.language, r.ethnicity) for r in got} == {("CATHOLIC", "ENGL", "WHITE")}


def test_marital_status(spark):
    people = [("M", 30), ("M", 31), ("F", 27), ("F", 28), ("F", 80), ("M", None), (None, 20)]
    got = impute(spark, [(g, a, 1.0, 1.0, None) for g, a in people])
    assert [r.marital_status for r in got] == ["SINGLE", "MARRIED", "SINGLE", "MARRIED", "SINGLE", None, "MARRIED"]


def test_normalise_and_cohort(spark):
    df = spark.createDataFrame([(1, 18.0, "BLACK CARIBBEAN"), (2, 17.99, "A"), (3, 89.0, None), (4, None, "B")],
                               "hadm_id bigint, age double, ethnicity string")
    kept = statics.adult_cohort(statics.normalise_categories(df)).orderBy("hadm_id").collect()
    assert [(r.hadm_id, r.ethnicity) for r in kept] == [(1, "blackcaribbean"), (3, None)]


def test_age_counts_whole_days(spark):
    admissions = spark.createDataFrame([(1, 1, dt.datetime(2020, 3, 1, 5)), (2, 2, dt.datetime(2020, 3, 1, 5))],
                                       "subject_id bigint, hadm_id bigint, admittime timestamp_ntz")
    patients = spark.createDataFrame([(1, "F", dt.datetime(2020, 1, 1, 10))], "subject_id bigint, gender string, dob timestamp_ntz")
    ages = {r.hadm_id: r.age for r in statics.patient_age(admissions, patients).collect()}
    assert ages == {1: 59 / 365.28, 2: None}


def test_outcome_flag_defaults_to_zero(spark):
    cohort = spark.createDataFrame([(1,), (2,), (3,)], "hadm_id bigint")
    admissions = spark.createDataFrame([(1, 1), (2, None)], "hadm_id bigint, hospital_expire_flag int")
    got = {r.hadm_id: r.hospital_expire_flag for r in statics.with_outcome(cohort, admissions).collect()}
    assert got == {1: 1.0, 2: None, 3: 0.0}  # the default counts only where the admission is not listed


def test_ties_and_nulls_in_the_vocabulary(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(1, 1, day, d) for d in ("b", "a", "c", "c", None, None, None)] + [(1, None, day, "z")] * 9
    rows += [(1, 1, None, "c"), (2, 1, day, "b")]
    icu = vocabulary.icu_prescriptions(
        spark.createDataFrame(rows, "hadm_id bigint, icustay_id bigint, startdate timestamp_ntz, drug string")
    )
    top = vocabulary.top_drugs(icu, 4)
    assert [(r.drug, r.num) for r in top.collect()] == [("c", 3), (None, 3), ("b", 2), ("a", 1)]
    days = vocabulary.spine(vocabulary.in_vocabulary(icu, vocabulary.top_drugs(icu, 3)))
    assert sorted(r.hadm_id for r in days.collect()) == [1, 2]

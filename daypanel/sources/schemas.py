"""Explicit schemas; nothing is inferred from file contents."""

from __future__ import annotations

from pyspark.sql import types as T

from daypanel.operators.registry import SIGNALS


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_EVENTS = _schema(
    hadm_id=T.LongType(), itemid=T.IntegerType(), charttime=T.TimestampNTZType(), value=T.StringType()
)
_DICTIONARY = _schema(itemid=T.IntegerType(), label=T.StringType())

BASE = {
    "admissions": _schema(
        subject_id=T.LongType(),
        hadm_id=T.LongType(),
        admittime=T.TimestampNTZType(),
        religion=T.StringType(),
        language=T.StringType(),
        marital_status=T.StringType(),
        ethnicity=T.StringType(),
        hospital_expire_flag=T.IntegerType(),
    ),
    "patients": _schema(subject_id=T.LongType(), gender=T.StringType(), dob=T.TimestampNTZType()),
    "prescriptions": _schema(
        hadm_id=T.LongType(), icustay_id=T.LongType(), startdate=T.TimestampNTZType(), drug=T.StringType()
    ),
    "chartevents": _EVENTS,
    "labevents": _EVENTS,
    "d_items": _DICTIONARY,
    "d_labitems": _DICTIONARY,
}

# The given tables behind the stand-ins.
_L, _I, _S, _D, _TS = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampNTZType()
GIVEN = {
    "region": _schema(r_regionkey=_I, r_name=_S),
    "nation": _schema(n_nationkey=_I, n_name=_S, n_regionkey=_I),
    "customer": _schema(c_custkey=_L, c_name=_S, c_nationkey=_I, c_acctbal=_D, c_mktsegment=_S),
    "part": _schema(p_partkey=_L, p_name=_S, p_brand=_S, p_type=_S, p_size=_I, p_retailprice=_D),
    "orders": _schema(
        o_orderkey=_L, o_custkey=_L, o_orderstatus=_S, o_totalprice=_D, o_orderdate=_TS, o_orderpriority=_S
    ),
    "lineitem": _schema(
        l_orderkey=_L, l_partkey=_L, l_suppkey=_L, l_linenumber=_I, l_quantity=_D, l_extendedprice=_D, l_discount=_D,
        l_tax=_D, l_returnflag=_S, l_linestatus=_S, l_shipdate=_TS,
    ),
    "events": _schema(event_id=_L, ts=_TS, user_id=_L, event_type=_S, value=_D, props=_S),
}

# Column order of the exported modelling table: keys, signals, static attributes.
SIGNAL_ORDER = [
    "agap", "albu", "blood_glucose", "bica", "bilirut", "blood_oxygen_saturation", "body_temperature", "calc", "chlor",
    "co", "creatin", "diastolic_blood_pressure", "fio2", "glascow_coma_scale", "heart_rate", "hematt", "hemogt",
    "interrat", "lacta", "partialt", "pco", "po", "pota", "ph", "respiratory_rate", "sodi", "spo2",
    "systolic_blood_pressure", "ureanit", "wbcet",
]
CATEGORIES = ["gender", "religion", "language", "marital_status", "ethnicity"]
STATIC_NUMBERS = ["age", "weight", "height", "hospital_expire_flag"]
STATIC_ORDER = [
    "gender", "age", "weight", "height", "religion", "language", "marital_status", "ethnicity", "hospital_expire_flag",
]
KEYS = ["hadm_id", "startdate"]

if sorted(SIGNAL_ORDER) != sorted(s.name for s in SIGNALS):
    raise AssertionError("the column order and the signal registry name different signals")

DRUG_USE = _schema(hadm_id=T.LongType(), startdate=T.DateType(), drug=T.StringType())
ADMISSION_DAYS = _schema(hadm_id=T.LongType(), num=T.LongType())
DATASET = T.StructType(
    [T.StructField("hadm_id", T.LongType()), T.StructField("startdate", T.DateType())]
    + [T.StructField(name, T.DoubleType()) for name in SIGNAL_ORDER]
    + [T.StructField(n, T.StringType() if n in CATEGORIES else T.DoubleType()) for n in STATIC_ORDER]
)
EXPORTS = {"drug_use": DRUG_USE, "admission_days": ADMISSION_DAYS, "dataset": DATASET}

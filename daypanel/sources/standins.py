"""Stand-ins for the base relations, derived from the given tables.

The clinical inputs are licensed, so every registered query reads relations of the same shape that Spark derives from
``events``, ``customer`` and, for the larger set, ``lineitem``, ``orders`` and ``part``. Each text below is valid both
in Spark SQL and in DuckDB, which lets the oracle queries start from the very same rows. Dirty texts and nulls come
from fixed expressions on the row number of an event or an order line.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from daypanel.operators.registry import SIGNALS
from daypanel.sources.schemas import GIVEN

_ITEMS = [item for spec in SIGNALS for item in spec.items]
_ITEM_ROWS = ", ".join(f"({k}, {item})" for k, item in enumerate(_ITEMS))

# Odd texts that the rules of some signal name, dealt over the readings of the larger set.
ODD_TEXTS = [
    ">60/min", "GREATER THAN 10", "greater than 20", "GREATER THAN 50", "GREATER THAN 180", "LESS THAN 2.0",
    "LESS THAN 5", "less than 0.6", "<1.0", "<0.1", ">140", ">23.7", "26..", "-", "-5", "UNABLE TO REPORT",
    "DISREGARD", "QNS", "CLOTTED", "VOID", "110CS", "fs 120", "1,20", ".5", ".995", "1", "36.65", "5.", "add-on",
]
_ODD_ROWS = ", ".join(f"({k}, '{text}')" for k, text in enumerate(ODD_TEXTS))

VIEWS = {
    "fx_prescriptions": """
select user_id as hadm_id, cast(ts as date) as startdate,
  concat(event_type, '_', cast(cast(regexp_extract(props, '([0-9]+)', 1) as int) % 20 as string)) as drug,
  case when event_id % 10 = 0 or event_id % 3 = 0 then null else event_id end as icustay_id
from events""",
    "fx_readings": """
select user_id as hadm_id,
  case event_type when 'click' then 211 when 'view' then 618 when 'error' then
    case when event_id % 2 = 0 then 676 else 678 end
    when 'purchase' then 50971 else 50813 end as itemid,
  ts as charttime,
  case when event_id % 11 = 0 then null
    when event_type = 'view' and event_id % 13 = 0 then '>60/min'
    when event_type = 'purchase' and event_id % 13 = 0 then '<1.0'
    when event_type = 'purchase' and event_id % 17 = 0 then 'GREATER THAN 10'
    when event_type = 'signup' and event_id % 13 = 0 then 'GREATER THAN 30'
    when event_type = 'signup' and event_id % 17 = 0 then 'GREATER THAN 20.5'
    when event_type = 'signup' and event_id % 19 = 0 then 'UNABLE TO REPORT'
    when event_type in ('purchase', 'signup') and event_id % 23 = 0 then '-'
    else cast(cast(value as decimal(18,2)) as string) end as value
from events""",
    "fx_items": """
select distinct case event_type when 'click' then 211 when 'view' then 618 when 'error' then
    case when event_id % 2 = 0 then 676 else 678 end
    when 'purchase' then 50971 else 50813 end as itemid, event_type as label
from events""",
    "fx_admissions": """
select c.c_custkey as subject_id, c.c_custkey as hadm_id, a.admittime,
  case when c.c_custkey % 7 = 0 then null else c.c_mktsegment end as religion,
  case when c.c_custkey % 5 = 0 then null else n.n_name end as language,
  case c.c_custkey % 4 when 0 then null when 1 then 'MARRIED' when 2 then 'SINGLE' else 'WIDOWED' end
    as marital_status,
  case when c.c_custkey % 6 = 0 then null else concat(r.r_name, ' ', c.c_mktsegment) end as ethnicity,
  case when c.c_custkey % 13 = 0 then null when c.c_custkey % 9 = 0 then 1 else 0 end as hospital_expire_flag
from customer c
join (select user_id, min(ts) as admittime from events group by user_id) a on c.c_custkey = a.user_id
join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey""",
    "fx_patients": """
select c_custkey as subject_id, case when c_nationkey % 2 = 0 then 'M' else 'F' end as gender,
  cast(date '1930-01-01' + cast((c_custkey * 211) % 29000 as int) as timestamp) as dob
from customer""",
    "fx_body": """
select c_custkey as hadm_id, case when c_custkey % 2 = 0 then 226730 else 3693 end as itemid,
  case when c_custkey % 3 <> 0 then cast(cast(150 + c_custkey % 40 as decimal(18,2)) as string) end as value
from customer""",
    "fx_line_prescriptions": """
select o.o_custkey as hadm_id, cast(l.l_shipdate as date) as startdate, p.p_name as drug,
  case when (l.l_orderkey + l.l_linenumber) % 10 = 0 then null else l.l_orderkey end as icustay_id
from lineitem l join orders o on l.l_orderkey = o.o_orderkey join part p on l.l_partkey = p.p_partkey""",
    "fx_long_readings": """
select case when l.l_orderkey % 3 = 0 then 1 else o.o_custkey end as hadm_id,
  case l.l_linenumber % 3 when 0 then 211 when 1 then 50971 else 50813 end as itemid,
  case when l.l_orderkey % 3 = 0 then cast('1995-01-01' as timestamp) else cast(l.l_shipdate as timestamp) end as charttime,
  case l.l_orderkey % 5 when 0 then concat('9', lpad(cast(l.l_orderkey * 7 as string), 12, '0'))
    when 1 then concat('8', lpad(cast(l.l_partkey * 13 as string), 14, '3'), '.25')
    when 2 then concat('7', lpad(cast(l.l_orderkey + l.l_linenumber as string),
      cast(case l.l_linenumber when 1 then 29 when 2 then 30 when 3 then 99 else 249 end as int), '5'))
    when 3 then null else cast(l.l_partkey % 100 as string) end as value
from lineitem l join orders o on l.l_orderkey = o.o_orderkey""",
    "fx_long_body": """
select case when l_orderkey % 3 = 0 then 1 else l_suppkey end as hadm_id,
  case when l_linenumber % 2 = 0 then 226730 else 3693 end as itemid,
  case l_orderkey % 5 when 0 then concat('1', lpad(cast(l_orderkey * 3 as string),
      cast(case l_linenumber when 1 then 30 when 2 then 99 else 249 end as int), '4'))
    when 1 then concat(cast(l_partkey as string), '.', lpad(cast(l_orderkey as string), 12, '0'))
    when 2 then concat(cast(l_partkey % 100 as string), '.5') when 3 then null else 'tall' end as value
from lineitem""",
    "fx_csv_lines": """
select user_id as hadm_id, cast(ts as date) as startdate, event_type as drug,
  case when event_id % 13 = 0 then 'columns' when event_id % 17 = 0 then 'value of startdate'
    when event_id % 19 = 0 then 'columns' when event_id % 23 = 0 then 'value of hadm_id' end as reason,
  case when event_id % 13 = 0 then concat(cast(user_id as string), ',', cast(cast(ts as date) as string))
    when event_id % 17 = 0 then concat(cast(user_id as string), ',31/12/2024,', event_type)
    when event_id % 19 = 0 then concat(cast(user_id as string), ',', cast(cast(ts as date) as string), ',', event_type, ',x')
    when event_id % 23 = 0 then concat('n', cast(user_id as string), ',', cast(cast(ts as date) as string), ',', event_type)
    else concat(cast(user_id as string), ',', cast(cast(ts as date) as string), ',', event_type) end as line
from events""",
    "fx_line_readings": f"""
select o.o_custkey as hadm_id, m.itemid, l.l_shipdate as charttime,
  case when (l.l_orderkey * 3 + l.l_linenumber) % 11 = 0 then null
    else coalesce(w.word, concat(cast(l.l_orderkey * 7 % 200 as string), '.', cast(l.l_partkey % 100 as string)))
    end as value
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
join (values {_ITEM_ROWS}) as m(k, itemid) on (l.l_partkey * 7 + l.l_linenumber) % {len(_ITEMS)} = m.k
left join (values {_ODD_ROWS}) as w(k, word) on (l.l_orderkey * 13 + l.l_linenumber * 5) % {10 * len(ODD_TEXTS)} = w.k""",
}

_FROM = re.compile(rf"\b(from|join) ({'|'.join(GIVEN)})\b")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stand-in relation over the parquet tables in ``sf_dir``."""
    names = {found.group(2) for found in _FROM.finditer(VIEWS[name])}
    tables = {table: spark.read.schema(GIVEN[table]).parquet(f"{sf_dir}/{table}.parquet") for table in names}
    return spark.sql(_FROM.sub(r"\1 {\2}", VIEWS[name]), **tables)

"""DuckDB texts for the registered queries.

Written apart from the operators: rules are applied one after another as updates would, fills are joined back to the
readings, encodings are built cell by cell. Only the fixed values of the registry are shared.
"""

from __future__ import annotations

import re

from daypanel.operators import registry as R
from daypanel.operators.impute import NEIGHBOURS
from daypanel.plans.oracle_learning import learning_parts, learning_queries, vector_parts, vector_queries
from daypanel.plans.oracle_network import network_query
from daypanel.plans.settings import BLOCK_ROWS, LINE_DRUGS, N_DRUGS, PAD_STEPS, SCORED_STEPS
from daypanel.sources.schemas import CATEGORIES, SIGNAL_ORDER, STATIC_ORDER
from daypanel.sources.standins import VIEWS

LIVE = ["body_temperature", "heart_rate", "lacta", "pota", "respiratory_rate"]  # signals the event stand-in has

_ITEM_ROWS = ", ".join(
    f"({item}, {code}, '{spec.name}', {10**spec.scale})" for code, spec in enumerate(R.SIGNALS) for item in spec.items
)


def _hash(key: str) -> str:
    return f"cast(concat('0x', substr(md5({key}), 1, 8)) as bigint)"


def _rounded(total: str, n: str) -> str:
    return f"cast(sign({total}) * ((2 * abs({total}) + {n}) // (2 * {n})) as hugeint)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _ruled(source: str) -> str:
    """The readings with every rule position applied to the text left by the one before, as ``t``."""
    glucose = R.CODE_OF["blood_glucose"]
    stripped = "lower(value)"
    for mark in R.GLUCOSE_MARKS:
        stripped = f"replace({stripped}, {_text(mark)}, '')"
    sql = f"select *, case when signal = {glucose} then {stripped} else value end as t from {source}"
    for k in range(max(len(spec.rules) for spec in R.SIGNALS)):
        branches = []
        for code, spec in enumerate(R.SIGNALS):
            if k < len(spec.rules):
                kind, pattern, outcome = spec.rules[k]
                test = {
                    R.IS: f"lower(t) = {_text(pattern)}",
                    R.HAS: f"contains(lower(t), {_text(pattern)})",
                    R.LEADS: f"starts_with(t, {_text(pattern)})",
                }[kind]
                if outcome is None:
                    result = "null"
                elif outcome == R.STRIP:
                    result = f"replace(t, {_text(R.UPPER_BOUND)}, '')"
                elif outcome == R.PERCENT:
                    result = "cast(try_cast(regexp_extract(t, '^[.][0-9]{1,2}') as decimal(4,2)) * 100 as varchar)"
                else:
                    result = _text(outcome)
                branches.append(f"when signal = {code} and {test} then {result}")
        sql = f"select * replace (case {' '.join(branches)} else t end as t) from ({sql})"
    digits = ", ".join(str(code) for code, spec in enumerate(R.SIGNALS) if spec.numeric_only)
    shape = R.NUMERIC_TEXT.replace(r"\z", "$")
    return f"""select * replace (case when signal in ({digits}) and not regexp_matches(t, '{shape}') then null
        else t end as t) from ({sql})"""


def _rule_steps(source: str) -> str:
    """``units`` of readings whose numbers are short."""
    sql = _ruled(source)
    celsius = ", ".join(map(str, R.CELSIUS_ITEMS))
    return f"""
select * exclude (t, number),
  case when itemid in ({celsius}) then {_rounded("(number * 18 + 320)", "10")}
    when signal = {R.CODE_OF["fio2"]} and number = 1 then 100 else number end as units
from (select *, case when size = 1 then cast(try_cast(t as decimal(30,0)) as hugeint)
  else cast(try_cast(t as decimal(32,2)) * 100 as hugeint) end as number from ({sql}))"""


def _chain(p: str) -> dict[str, str]:
    """Readings to wide panel over the stand-ins with prefix ``p``."""
    n = N_DRUGS if p == "" else LINE_DRUGS
    keys = "hadm_id, startdate"
    wide = ", ".join(
        f"max(case when signal = {R.CODE_OF[name]} then mean end) as {name}" for name in SIGNAL_ORDER
    )
    glucose = R.CODE_OF["blood_glucose"]
    return {
        f"{p}icu": f"select * from fx_{p}prescriptions where icustay_id is not null",
        f"{p}vocab": f"select drug, count(*) as num from {p}icu group by drug order by num desc, drug limit {n}",
        f"{p}used": f"""select distinct hadm_id, startdate, drug from {p}icu
            where drug in (select drug from {p}vocab)""",
        f"{p}days": f"select distinct {keys} from {p}used",
        f"{p}tagged": f"""select r.hadm_id, cast(r.charttime as date) as startdate, r.itemid, r.charttime, r.value,
            m.signal, m.name, m.size
            from fx_{p}readings r join (values {_ITEM_ROWS}) as m(item, signal, name, size) on r.itemid = m.item""",
        f"{p}valued": _rule_steps(f"{p}tagged"),
        f"{p}kept": f"select * from {p}valued where signal <> {glucose} or units is not null",
        f"{p}on_days": f"select k.* from {p}kept k join {p}days d using ({keys})",
        f"{p}stay_mean": f"""select hadm_id, signal, {_rounded("sum(units)", "count(units)")} as fill
            from {p}on_days where units is not null group by hadm_id, signal""",
        f"{p}filled": f"""select o.* replace (coalesce(o.units, s.fill) as units)
            from {p}on_days o left join {p}stay_mean s using (hadm_id, signal)""",
        f"{p}daily": f"""select {keys}, signal, name,
            cast(sum(units) as double) / cast(count(units) * any_value(size) as double) as mean
            from {p}filled group by {keys}, signal, name""",
        f"{p}wide": f"""select d.hadm_id, d.startdate, {', '.join(SIGNAL_ORDER)} from {p}days d
            left join (select {keys}, {wide} from {p}daily group by {keys}) w using ({keys})""",
    }


def _age(a: str = "a", b: str = "b") -> str:
    return f"cast(extract(day from ({a}.admittime - cast({b}.dob as timestamp))) as double) / cast(365.28 as double)"


def _mean_item(item: int) -> str:
    number = f"case when itemid = {item} then try_cast(value as decimal(32,6)) end"
    return f"cast(sum({number}) as double) / count({number})"


_SQUARE = "(height / 100) * (height / 100)"
_TIDY = ", ".join(f"replace(lower({name}), ' ', '') as {name}" for name in CATEGORIES)
_SHARED = [f"(case when a.{s} is null or b.{s} is null then 0 else 1 end)" for s in LIVE]
_GAPS = [f"coalesce(pow(a.{s} - b.{s}, 2), 0)" for s in LIVE]
_GAPS += [f"pow(a.{n} - b.{n}, 2)" for n in ("age", "weight", "height")]
_SHARED += ["(case when a.hospital_expire_flag is null or b.hospital_expire_flag is null then 0 else 1 end)"]
_GAPS += ["coalesce(pow(a.hospital_expire_flag - b.hospital_expire_flag, 2), 0)"]
# Two one-hot vectors differ in one place per value that is set on one side only.
_GAPS += [
    f"(case when a.{c} is not distinct from b.{c} then 0 else (a.{c} is not null)::int + (b.{c} is not null)::int end)"
    for c in CATEGORIES
]

CTES = {
    **VIEWS,
    **_chain(""),
    **_chain("line_"),
    "long_ruled": _ruled(
        f"""(select r.hadm_id, cast(r.charttime as date) as startdate, r.itemid, r.value, m.signal, m.name, m.size
        from fx_long_readings r join (values {_ITEM_ROWS}) as m(item, signal, name, size) on r.itemid = m.item)"""
    ),
    # Digits of any length: those of the whole part, two more for hundredths, and one for the rounding.
    "long_digits": """select *, split_part(t, '.', 1) as whole, split_part(t, '.', 2) as behind,
        case when size = 1 then 0 else 2 end as scale from long_ruled""",
    "long_valued": """select *, case when t is not null then concat(whole, substr(rpad(behind, 3, '0'), 1, scale))::bignum
          + (substr(rpad(behind, 3, '0'), scale + 1, 1) >= '5')::int::bignum end as units
        from long_digits""",
    "long_sums": """select hadm_id, startdate, name, sum(units) as total, count(units) as n_valued,
        count(*) filter (units is null) as n_missing from long_valued group by hadm_id, startdate, name""",
    # Twice the total and the count, over twice the count, 15 digits at a time from the left.
    "long_twice": """select hadm_id, startdate, name, n_valued as n, d, length(d) // 15 as parts
        from (select *, lpad(raw, cast(15 * ceil(length(raw) / 15.0) as int), '0') as d
          from (select *, (total + total + n_valued::bignum)::varchar as raw from long_sums where n_valued > 0))""",
    "long_division": """select hadm_id, startdate, name, n, d, parts, 0 as part, 0::hugeint as rest, '' as q from long_twice
        union all
        select hadm_id, startdate, name, n, d, parts, part + 1,
          (rest * 1000000000000000 + substr(d, 15 * part + 1, 15)::hugeint) % (2 * n),
          q || lpad(((rest * 1000000000000000 + substr(d, 15 * part + 1, 15)::hugeint) // (2 * n))::varchar, 15, '0')
        from long_division where part < parts""",
    # Body readings with at most 12 places behind the point, as whole numbers of the last of them.
    "long_heights": """select hadm_id, itemid,
        concat(split_part(value, '.', 1), rpad(split_part(value, '.', 2), 12, '0'))::bignum as units
        from fx_long_body where regexp_matches(value, '^[0-9]+([.][0-9]+)?$')""",
    "long_height_sums": """select hadm_id, itemid, count(*) as n, lpad(sum(units)::varchar, cast(greatest(13, length(sum(units)::varchar)) as int), '0') as total
        from long_heights group by hadm_id, itemid""",
    "body": f"""select hadm_id, {_mean_item(R.HEIGHT_ITEM)} as height, {_mean_item(R.WEIGHT_ITEM)} as weight
        from fx_body group by hadm_id""",
    "static": f"""select a.subject_id, a.hadm_id, b.gender, {_age()} as age, c.weight, c.height,
        a.religion, a.language, a.marital_status, a.ethnicity
        from fx_admissions a left join fx_patients b using (subject_id) left join body c using (hadm_id)""",
    "height_set": """select * replace (case when height is not null then height
        when gender = 'M' and age between 18 and 89 then cast(177 as double)
        when gender = 'F' and age between 18 and 89 then cast(169.2 as double) else 0 end as height) from static""",
    "static_set": f"""select * replace (
        case gender when 'M' then cast(28.3 as double) * {_SQUARE} when 'F' then cast(26.3 as double) * {_SQUARE}
          else weight end as weight,
        coalesce(religion, 'CATHOLIC') as religion, coalesce(language, 'ENGL') as language,
        coalesce(ethnicity, 'WHITE') as ethnicity,
        case when marital_status is not null then marital_status
          when (gender = 'M' and age < 31) or (gender = 'F' and age < 28) then 'SINGLE'
          when age < 80 then 'MARRIED' when age >= 80 then 'SINGLE' end as marital_status) from height_set""",
    "adults": "select * from static_set where age between 18 and 89",
    "flagged": """select c.*, cast(case when a.hadm_id is null then 0 else a.hospital_expire_flag end as double)
          as hospital_expire_flag
        from adults c left join fx_admissions a using (hadm_id)""",
    "tidy": f"select * replace ({_TIDY}) from flagged",
    "aligned": "select d.* from days d where d.hadm_id in (select hadm_id from adults)",
    "modelling": f"""select w.*, {', '.join('t.' + name for name in STATIC_ORDER)}
        from wide w join tidy t using (hadm_id)""",
    "stays": """select hadm_id, count(*) as num from aligned group by hadm_id
        having count(*) between 2 and 100""",
    "places": "select drug, cast(row_number() over (order by drug) as int) - 1 as place from vocab",
    "cells": f"""select d.hadm_id, d.startdate, p.place, (u.drug is not null)::int as hot
        from days d cross join places p left join used u
        on u.hadm_id = d.hadm_id and u.startdate = d.startdate and u.drug = p.drug""",
    "hot": """select hadm_id, startdate, string_agg(cast(hot as varchar), '' order by place) as hot,
        string_agg(case when hot = 1 then cast(place as varchar) end, ',' order by place) as drugs
        from cells group by hadm_id, startdate""",
    "labelled": """select * from (
        select h.hadm_id, h.startdate, h.drugs, h.hot,
          cast(row_number() over w as int) as step, lead(h.drugs) over w as label, lead(h.hot) over w as label_hot
        from hot h join aligned using (hadm_id, startdate) where h.hadm_id in (select hadm_id from stays)
        window w as (partition by h.hadm_id order by h.startdate)) where label is not null""",
    "blocks": f"""select hadm_id, startdate,
        {_hash(f"concat(hadm_id, ':', cast(floor((startdate - date '1970-01-01') / {BLOCK_ROWS}.0) as bigint))")}
        % greatest(1, cast(ceil((select count(*) from aligned) / {BLOCK_ROWS}.0) as bigint)) as block from aligned""",
    "knn_rows": "select * from modelling join blocks using (hadm_id, startdate)",
    "listed": "select * from tidy where hadm_id in (select hadm_id from aligned)",
    "n_dummies": " union all ".join(f"select count(distinct {c}) as n from listed" for c in CATEGORIES),
    "pairs": f"""select a.hadm_id, a.startdate, b.hadm_id as other, b.startdate as other_day,
        {', '.join(f'a.{s} as own_{s}, b.{s} as {s}' for s in [*LIVE, "hospital_expire_flag"])},
        greatest(1e-6, ({' + '.join(_GAPS)})
          / ({' + '.join(_SHARED)} + 3 + (select sum(n) from n_dummies))) as distance
        from knn_rows a join knn_rows b on a.block = b.block
          and (a.hadm_id <> b.hadm_id or a.startdate <> b.startdate)""",
    **{
        f"near_{s}": f"""select hadm_id, startdate, sum({s} / distance) / sum(1 / distance) as mean from (
            select * from pairs where own_{s} is null and {s} is not null
            qualify row_number() over (partition by hadm_id, startdate order by distance, other, other_day)
              <= {NEIGHBOURS}) group by hadm_id, startdate"""
        for s in [*LIVE, "hospital_expire_flag"]
    },
    "imputed": f"""select k.hadm_id, k.startdate,
        {', '.join(f'round(coalesce(k.{s}, n_{s}.mean, 0), 6) as {s}' for s in LIVE)}
        from knn_rows k {' '.join(f'left join near_{s} n_{s} using (hadm_id, startdate)' for s in LIVE)}""",
    "step_count": "select hadm_id, max(step) as n from labelled group by hadm_id",
    "numbered": """select l.*, coalesce(w.heart_rate, 0) as heart_rate, coalesce(w.lacta, 0) as lacta, c.n
        from labelled l join wide w using (hadm_id, startdate) join step_count c using (hadm_id)""",
    "slots": f"""select hadm_id, n, cast(position as int) as position from step_count
        cross join range(1, {PAD_STEPS} + 1) as r(position)""",
    "padded": f"""select s.hadm_id, s.position, coalesce(x.drugs, '') as drugs, coalesce(x.label, '') as labels,
        coalesce(x.heart_rate, 0) as heart_rate, coalesce(x.lacta, 0) as lacta
        from slots s left join numbered x
        on x.hadm_id = s.hadm_id and x.step = s.position + greatest(s.n - {PAD_STEPS}, 0)""",
    "scored_slots": f"""select hadm_id, n, cast(position as int) as position from step_count
        cross join range(1, {SCORED_STEPS} + 1) as r(position)""",
    "scored": f"""select s.hadm_id, s.position, cast(place as int) as place,
        coalesce(cast(substr(x.label_hot, cast(place as int) + 1, 1) as int), 0) as truth,
        (({_hash("concat(s.hadm_id, ':', s.position)")} * (2 * place + 1) + place * place) % 101)
          / cast(100 as double) as score
        from scored_slots s cross join range({N_DRUGS}) as r(place)
        left join labelled x on x.hadm_id = s.hadm_id
          and x.step = s.position + greatest(s.n - {SCORED_STEPS}, 0)""",
    "hits": """select hadm_id, position, sum(truth * (score >= 0.5)::int) as n_both, sum(truth) as is_true,
        sum((score >= 0.5)::int) as is_predicted from scored group by hadm_id, position""",
    "ranked": """select hadm_id, position, truth,
        sum(truth) over w as true_above, count(*) over w as above
        from scored window w as (partition by hadm_id, position order by score desc
          range between unbounded preceding and current row)""",
}

_ONE_HOT = ", ".join(
    f"""(select string_agg(case when v = t.{c} then '1' else '0' end, '' order by v)
        from (select distinct {c} as v from listed where {c} is not null)) as {c}_hot"""
    for c in CATEGORIES
)
_PRESENT = {
    "signals": " + ".join(f"(coalesce(m.{s}, 0) <> 0)::int" for s in SIGNAL_ORDER),
    "statics": " + ".join(
        [f"coalesce(m.{s} <> 0, false)::int" for s in ("age", "weight", "height", "hospital_expire_flag")]
        + [f"(m.{c} is not null)::int" for c in CATEGORIES]
    ),
    "drugs": "(length(h.drugs) - length(replace(h.drugs, ',', '')) + 1)",
}

QUERIES = {
    "icu_prescriptions": "select hadm_id, startdate, drug, icustay_id from icu",
    "top_drugs": "select drug, num from vocab",
    "vocabulary_sizes": """select cast(size as int) as size, drug, num
        from (select drug, count(*) as num, row_number() over (order by count(*) desc, drug) as place from icu
          group by drug) as c
        join (values (60), (40), (20), (10)) as s(size) on c.place <= s.size""",
    "daily_drug_use": "select distinct hadm_id, startdate, drug from icu",
    "vocabulary_filter": "select * from used",
    "spine": "select * from days",
    "line_top_drugs": "select drug, num from line_vocab",
    "line_spine": "select * from line_days",
    "admission_height": """select a.subject_id, a.hadm_id, c.height, c.weight
        from fx_admissions a left join body c using (hadm_id)""",
    "patient_age": f"select a.subject_id, a.hadm_id, {_age()} as age from fx_admissions a left join fx_patients b using (subject_id)",
    "patient_static": "select * from static",
    "static_imputation": "select * from static_set",
    "normalise_categories": f"select hadm_id, {_TIDY} from static_set",
    "signal_readings": """select t.hadm_id, t.startdate, t.itemid, t.charttime, t.value, t.name as signal
        from tagged t join days d using (hadm_id, startdate)
        where t.itemid in (select itemid from fx_items)""",
    "clean_values": """select hadm_id, startdate, itemid, name as signal,
        cast(units as double) / cast(size as double) as value from kept""",
    "line_clean_values": """select hadm_id, startdate, itemid, name as signal,
        cast(units as double) / cast(size as double) as value from line_kept""",
    "clean_temperature": f"""select hadm_id, startdate, itemid, value as raw, cast(units as bigint) as value from line_kept
        where signal = {R.CODE_OF["body_temperature"]}""",
    "clean_fraction": f"""select hadm_id, startdate, itemid, value as raw, cast(units as bigint) as value from line_kept
        where signal = {R.CODE_OF["fio2"]}""",
    "clean_long_numbers": """select s.hadm_id, s.startdate, s.name as signal, total::varchar as total, n_valued, n_missing,
        coalesce(nullif(ltrim(q, '0'), ''), case when q is not null then '0' end) as rounded_mean
        from long_sums s left join (select * from long_division where part = parts) d using (hadm_id, startdate, name)""",
    "long_body_means": f"""select hadm_id,
        max(case when itemid = {R.HEIGHT_ITEM} then mean end) as height,
        max(case when itemid = {R.WEIGHT_ITEM} then mean end) as weight
        from (select distinct hadm_id from fx_long_body) left join (
          select hadm_id, itemid, cast(concat(left(total, length(total) - 12), '.', right(total, 12)) as double) / n as mean
          from long_height_sums) using (hadm_id) group by hadm_id""",
    "reject_report": """select name as signal, count(*) as n_readings,
        count(*) filter (value is null) as n_blank,
        count(*) filter (value is not null and units is null) as n_rejected from line_valued group by name""",
    "group_mean_fill": """select hadm_id, startdate, itemid, charttime, name as signal,
        cast(units as double) / cast(size as double) as value from filled""",
    "line_group_mean_fill": """select hadm_id, startdate, itemid, name as signal,
        cast(units as double) / cast(size as double) as value from line_filled""",
    "daily_signal_mean": "select hadm_id, startdate, name as signal, mean from daily",
    "wide_panel": "select * from wide",
    "line_wide_panel": "select * from line_wide",
    "adult_cohort": "select * from adults",
    "cohort_flag": "select hadm_id, age, hospital_expire_flag from flagged",
    "aligned_keys": "select hadm_id, startdate from aligned",
    "dataset": "select * from modelling",
    "admission_days": "select hadm_id, num from stays",
    "line_admission_days": """select hadm_id, count(*) as num from line_days group by hadm_id
        having count(*) between 2 and 100""",
    "csv_quarantine": """select case when reason is null then hadm_id end as hadm_id,
        case when reason is null then startdate end as startdate, case when reason is null then drug end as drug,
        case when reason is not null then line end as record, reason from fx_csv_lines""",
    "drug_multihot": "select hadm_id, startdate, hot from hot",
    "drug_multihot_join": """select m.hadm_id, m.startdate, m.heart_rate, h.hot
        from modelling m join hot h using (hadm_id, startdate)""",
    "onehot_static": f"select t.hadm_id, {_ONE_HOT} from tidy t",
    "feature_groups": f"""select m.hadm_id, m.startdate, cast({_PRESENT["drugs"]} as bigint) as n_drugs,
        cast({_PRESENT["signals"]} as bigint) as n_signals, cast({_PRESENT["statics"]} as bigint) as n_statics,
        cast({_PRESENT["statics"]} - coalesce(m.hospital_expire_flag <> 0, false)::int as bigint) as n_without_outcome
        from modelling m join hot h using (hadm_id, startdate)""",
    "null_audit": " union all ".join(
        f"select '{c}' as column_name, count(*) filter ({c} is null) as n_null from modelling"
        for c in [*SIGNAL_ORDER, *STATIC_ORDER]
    ),
    "sequence_stats": """select count(distinct hadm_id) as n_sequences, count(*) as n_steps,
        count(*) filter (drugs = '') as n_empty_drugs, count(*) filter (label = '') as n_empty_labels from labelled""",
    "impute_blocks": "select hadm_id, startdate, block from blocks",
    "knn_impute": "select * from imputed",
    "model_matrix": "select i.*, h.hot from imputed i join hot h using (hadm_id, startdate)",
    "next_day_labels": "select hadm_id, startdate, step, drugs, label from labelled",
    "sequences": """select hadm_id, cast(count(*) as int) as n_steps,
        string_agg(strftime(startdate, '%Y-%m-%d'), '|' order by step) as days,
        string_agg(drugs, '|' order by step) as drugs, string_agg(label, '|' order by step) as labels
        from labelled group by hadm_id""",
    "split_admissions": f"""select hadm_id, case when {_hash("cast(hadm_id as varchar)")} % 100 < 25 then 'test'
        else 'train' end as split from stays""",
    "pad_truncate": "select * from padded",
    "pad_truncate_whole": """select * replace (trunc(heart_rate) as heart_rate, trunc(lacta) as lacta) from padded""",
    "dual_sequence": f"""select s.hadm_id, s.position, coalesce(x.hot, repeat('0', {N_DRUGS})) as seqx1,
        coalesce(x.heart_rate, 0) as heart_rate, coalesce(x.lacta, 0) as lacta,
        coalesce(x.label_hot, repeat('0', {N_DRUGS})) as y
        from scored_slots s left join numbered x
        on x.hadm_id = s.hadm_id and x.step = s.position + greatest(s.n - {SCORED_STEPS}, 0)""",
    "metric_steps": "select hadm_id, position, cast(is_true as bigint) as n_true from hits where is_true > 0",
    "metric_jaccard": """select round(avg(n_both / (is_true + is_predicted - n_both)), 8) as jaccard
        from hits where is_true > 0""",
    "metric_lrap": """select round(avg(precision), 8) as lrap from (
        select avg(true_above / above) as precision from ranked where truth = 1 group by hadm_id, position)""",
    "metric_micro_f1": """select round(sum(n_both) * 2 / (sum(is_true) + sum(is_predicted)), 8) as micro_f1
        from hits where is_true > 0""",
    "run_report": """select 'hash' as model, cast(0 as double) as seconds, jaccard, lrap, micro_f1 from
        (select round(avg(n_both / (is_true + is_predicted - n_both)), 8) as jaccard,
          round(sum(n_both) * 2 / (sum(is_true) + sum(is_predicted)), 8) as micro_f1 from hits where is_true > 0) as a
        cross join (select round(avg(precision), 8) as lrap from (select avg(true_above / above) as precision
          from ranked where truth = 1 group by hadm_id, position) as r) as b""",
    "metric_pooled_jaccard": """select round(sum(n_both) / (sum(is_true) + sum(is_predicted) - sum(n_both)), 8)
        as pooled_jaccard from hits""",
    "metric_soft_jaccard": """select round(1 - sum(truth * score) / (sum(truth) + sum((1 - truth) * score)), 8)
        as soft_jaccard_loss from scored""",
}

_TEST = f"{_hash('cast(hadm_id as varchar)')} % 100 < 25"
CTES |= vector_parts(LIVE) | learning_parts(_TEST)
QUERIES |= vector_queries() | learning_queries()

for _cell in ("rnn", "lstm", "gru"):
    _parts, QUERIES[f"score_{_cell}"] = network_query(_cell)
    CTES |= _parts


def _needed(sql: str) -> list[str]:
    found: set[str] = set()
    todo = [sql]
    while todo:
        for name in set(re.findall(r"\b(?:from|join)\s+([a-z_]+)\b", todo.pop())) & set(CTES):
            if name not in found:
                found.add(name)
                todo.append(CTES[name])
    return [name for name in CTES if name in found]

#: The same rows by another way.
for kept, same in {
    "wide_panel_near_spine": "wide_panel",
    "null_audit_of_write": "null_audit",
    "sequence_stats_of_write": "sequence_stats",
    "stored_sequences": "sequences",
}.items():
    QUERIES[kept] = QUERIES[same]


def oracle(name: str) -> str:
    """The query with the parts it needs in front, in an order in which each comes after what it reads."""
    sql = QUERIES[name]
    ordered: list[str] = []

    def place(cte: str) -> None:
        for inner in _needed(CTES[cte]):
            if inner not in ordered and inner != cte:
                place(inner)
        if cte not in ordered:
            ordered.append(cte)

    for cte in _needed(sql):
        place(cte)
    recursive = {cte for cte in ordered if re.search(rf"\b(from|join) {cte}\b", CTES[cte])}
    parts = ",\n".join(
        f"{cte} as {'' if cte in recursive else 'materialized '}({CTES[cte]})" for cte in ordered
    )
    return f"with {'recursive ' if recursive else ''}{parts}\n{sql}" if parts else sql


def oracle_sql() -> dict[str, str]:
    return {name: oracle(name) for name in QUERIES}

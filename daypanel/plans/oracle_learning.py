"""DuckDB texts for whole feature vectors and for the label model, every pass written out.

The stand-ins measure five of the signals; the others are never read, so imputation leaves them at 0.
"""

from __future__ import annotations

from daypanel.operators.label_model import Rule
from daypanel.plans.settings import LEARN_PASSES, LEARN_PATIENCE, N_DRUGS, PAD_STEPS, SCORED_STEPS, STOP_PASSES
from daypanel.sources.schemas import CATEGORIES, SIGNAL_ORDER, STATIC_NUMBERS

_FLAG = "hospital_expire_flag"


def _cells(live: list[str]) -> str:
    """One select for each column that can hold something else than 0."""
    parts = []
    for place, name in enumerate([*SIGNAL_ORDER, *STATIC_NUMBERS]):
        if name in live or name in STATIC_NUMBERS:
            parts.append(f"select hadm_id, startdate, {place} as place, {name} as value from whole_rows where {name} <> 0")
    for k, name in enumerate(CATEGORIES):
        parts.append(
            f"select f.hadm_id, f.startdate, d.place, 1.0 as value from whole_rows f join dummies d on d.k = {k} and d.v = f.{name}"
        )
    return " union all ".join(parts)


def vector_parts(live: list[str]) -> dict[str, str]:
    """``whole_rows``: the imputed rows; ``whole_cells``: their cells beside 0; ``whole_vectors``: the same as text."""
    gaps = [*live, _FLAG]
    found = " union all ".join(
        f"select distinct {k} as k, {name} as v from listed where {name} is not null" for k, name in enumerate(CATEGORIES)
    )
    first = len(SIGNAL_ORDER) + len(STATIC_NUMBERS)
    shown = "cast(round(value * 1000000) as bigint)"
    return {
        "whole_rows": f"""select k.* replace ({', '.join(f'cast(coalesce(k.{s}, n_{s}.mean, 0) as double) as {s}' for s in gaps)})
            from knn_rows k {' '.join(f'left join near_{s} n_{s} using (hadm_id, startdate)' for s in gaps)}""",
        "dummies": f"select k, v, cast({first} + row_number() over (order by k, v) - 1 as int) as place from ({found})",
        "whole_cells": _cells(live),
        "whole_vectors": f"""select f.hadm_id, f.startdate, coalesce(features, '') as features from whole_rows f left join (
            select hadm_id, startdate, string_agg(concat(place, ':', {shown}), ',' order by place) as features
            from whole_cells where {shown} <> 0 group by hadm_id, startdate) using (hadm_id, startdate)""",
        "cut_vectors": """select f.hadm_id, f.startdate, coalesce(features, '') as features from whole_rows f left join (
            select hadm_id, startdate, string_agg(concat(place, ':', cast(trunc(value) as bigint) * 1000000), ',' order by place)
              as features
            from whole_cells where trunc(value) <> 0 group by hadm_id, startdate) using (hadm_id, startdate)""",
    }


def vector_queries() -> dict[str, str]:
    def padded(slots: str, length: int, vectors: str, drugs: str, label: str, out: str) -> str:
        return f"""select s.hadm_id, s.position, {out}, coalesce(v.features, '') as features
            from {slots} s left join labelled x
            on x.hadm_id = s.hadm_id and x.step = s.position + greatest(s.n - {length}, 0)
            left join {vectors} v on v.hadm_id = x.hadm_id and v.startdate = x.startdate"""

    sets = "coalesce(x.drugs, '') as drugs, coalesce(x.label, '') as labels"
    zeros = f"repeat('0', {N_DRUGS})"
    dual = f"coalesce(x.hot, {zeros}) as seqx1, coalesce(x.label_hot, {zeros}) as y"
    return {
        "imputed_features": "select hadm_id, startdate, features from whole_vectors",
        "matrix_features": "select v.hadm_id, v.startdate, v.features, h.drugs from whole_vectors v join hot h using (hadm_id, startdate)",
        "sequence_features": """select hadm_id, cast(count(*) as int) as n_steps,
            string_agg(drugs, '|' order by step) as drugs, string_agg(label, '|' order by step) as labels,
            string_agg(features, '|' order by step) as features
            from labelled join whole_vectors using (hadm_id, startdate) group by hadm_id""",
        "padded_features": padded("slots", PAD_STEPS, "whole_vectors", "drugs", "label", sets),
        "padded_features_whole": padded("slots", PAD_STEPS, "cut_vectors", "drugs", "label", sets),
        "dual_features": padded("scored_slots", SCORED_STEPS, "whole_vectors", "hot", "label_hot", dual),
    }


def _name(part: str, t: int) -> str:
    return f"{part}_{chr(ord('a') + t // 26)}{chr(ord('a') + t % 26)}"


def learning_parts(split: str) -> dict[str, str]:
    """The steps as cells, and for each pass scores, errors, gradients and the new weights. ``split`` tells test steps."""
    rule, keys = Rule(), "hadm_id, step"
    parts = {
        "learn_steps": f"select *, case when {split} then 'test' else 'train' end as split from labelled",
        "learn_scales": f"""select 1 + {N_DRUGS} + place as place,
            sqrt(sum(value * value) / (select count(*) from learn_steps where split = 'train')) as scale
            from learn_steps join whole_cells using (hadm_id, startdate) where split = 'train' group by 1""",
        "learn_cells": f"""select {keys}, split, 0 as place, cast(1 as double) as value from learn_steps
            union all select {keys}, split, 1 + c.place, 1 from learn_steps join cells c using (hadm_id, startdate) where c.hot = 1
            union all select {keys}, split, s.place, v.value / s.scale
            from learn_steps join whole_cells v using (hadm_id, startdate)
            join learn_scales s on s.place = 1 + {N_DRUGS} + v.place""",
        "learn_truth": f"""select {keys}, split, cast(label_place as int) as label,
            cast(substr(label_hot, cast(label_place as int) + 1, 1) as int) as y
            from learn_steps cross join range({N_DRUGS}) as r(label_place)""",
        _name("weights", 0): f"""select cast(l.label as int) as label, cast(p.place as int) as place,
            cast(0 as double) as w, cast(0 as double) as m, cast(0 as double) as v
            from range({N_DRUGS}) as l(label)
            cross join range(1 + {N_DRUGS} + {len(SIGNAL_ORDER) + len(STATIC_NUMBERS)} + (select count(*) from dummies)) as p(place)""",
    }
    for t in range(STOP_PASSES + 1):
        parts[_name("scores", t)] = f"""select {keys}, label, sum(w * value) as s
            from learn_cells join {_name('weights', t)} using (place) group by {keys}, label"""
        parts[_name("chances", t)] = f"""select t.*, c.s, 1 / (1 + exp(-c.s)) as p
            from learn_truth t join {_name('scores', t)} c using ({keys}, label)"""
        parts[_name("slopes", t)] = f"""select c.label, x.place,
            sum((c.p - c.y) * x.value) / (select count(*) from learn_steps where split = 'train') as g
            from {_name('chances', t)} c join learn_cells x using ({keys}) where c.split = 'train' group by c.label, x.place"""
        k = t + 1
        parts[_name("weights", k)] = f"""select label, place,
            w - {rule.rate} * ((m2 / {1 - rule.fade**k!r}) / (sqrt(v2 / {1 - rule.fade_square**k!r}) + {rule.floor})) as w,
            m2 as m, v2 as v
            from (select label, place, w, m * {rule.fade} + g2 * {1 - rule.fade!r} as m2,
                v * {rule.fade_square} + g2 * g2 * {1 - rule.fade_square!r} as v2
              from (select w.*, coalesce(g.g, 0) + case when w.place > 0 then w.w * {rule.pull} else 0 end as g2
                from {_name('weights', t)} w left join {_name('slopes', t)} g using (label, place)))"""
    monitored = " union all ".join(
        f"""select {t} as step,
          sum(case when split = 'train' then greatest(s, 0) + ln(1 + exp(-abs(s))) - y * s end)
            / (select count(*) from learn_steps where split = 'train') as loss,
          cast(coalesce(sum(case when split = 'test' and p >= 0.5 then y end), 0) as double)
            / nullif(sum(case when split = 'test' then greatest(y, (p >= 0.5)::int) end), 0) as jaccard
          from {_name('chances', t)}"""
        for t in range(1, STOP_PASSES + 1)
    )
    parts["monitored"] = f"select step, loss, coalesce(jaccard, 0) as jaccard from ({monitored})"
    # A pass is better if it is above all before it; training ends after so many passes since the last better one.
    parts["bettered"] = """select *, jaccard > coalesce(max(jaccard) over (order by step
        rows between unbounded preceding and 1 preceding), -1) as better from monitored"""
    parts["waited"] = f"""select *, step - max(case when better then step end) over (order by step) >= {LEARN_PATIENCE} as over
        from bettered"""
    parts["walked"] = "select * from waited where step <= coalesce((select min(step) from waited where over), 1000)"
    return parts


def learning_queries() -> dict[str, str]:
    return {
        "label_model_scores": f"""select hadm_id, step, label as place, y as truth, round(p, 4) as score
            from {_name('chances', LEARN_PASSES)} where split = 'test'""",
        "early_stopping": """select step, round(loss, 6) as loss, round(jaccard, 8) as jaccard, better,
            step = (select max(step) from walked where better) as kept from walked""",
    }

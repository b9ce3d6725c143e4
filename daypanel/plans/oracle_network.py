"""DuckDB text of the recurrent scoring: every unit is a column, every step a round of a recursive query.

Meant for the very small networks of the registered queries.
"""

from __future__ import annotations

import numpy as np

from daypanel.operators.scoring import GATES, TAU, random_weights
from daypanel.plans.settings import N_DRUGS, SCORED_STEPS, SMALL_MODEL

FEATURES = ["heart_rate", "lacta"]


def _number(x: float) -> str:
    return format(float(x), ".17e")


def _product(names: list[str], matrix: np.ndarray, bias: np.ndarray | None = None) -> list[str]:
    out = []
    for k in range(matrix.shape[1]):
        terms = [f"{name} * ({_number(matrix[i, k])})" for i, name in enumerate(names)]
        out.append(" + ".join(terms + ([] if bias is None else [f"({_number(bias[k])})"])))
    return out


def _names(stem: str, n: int) -> list[str]:
    return [f"{stem}_{k}" for k in range(n)]


def _sigmoid(x: str) -> str:
    return f"(1 / (1 + exp(-({x}))))"


def _layer(stem: str, expressions: list[str], source: str) -> str:
    """One more set of columns over a sub-query."""
    return f"select *, {', '.join(f'{e} as {stem}_{k}' for k, e in enumerate(expressions))} from ({source})"


def _inputs(w: dict[str, np.ndarray]) -> str:
    """Per step all that does not depend on the step before: attention ``a``, gate inputs ``p`` and memory ``k``."""
    n = w["drugs"].shape[1]
    rows = f"""select s.hadm_id, s.position, string_split(coalesce(x.drugs, ''), ',') as places,
        coalesce(x.label, '') as label, {', '.join(f'coalesce(x.{f}, 0) as {f}' for f in FEATURES)}
        from scored_slots s left join numbered x
        on x.hadm_id = s.hadm_id and x.step = s.position + greatest(s.n - {SCORED_STEPS}, 0)"""
    embedded = []
    for column in w["drugs"].T:
        table = ", ".join(map(_number, column))
        embedded.append(
            f"coalesce(list_sum([([{table}])[cast(place as int) + 1] for place in places if place <> '']), 0)"
        )
    e, a = {"1": _names("e1", n), "2": _names("e2", n)}, {"1": _names("a1", n), "2": _names("a2", n)}
    sql = _layer("e2", _product(FEATURES, w["others"]), _layer("e1", embedded, rows))
    for own, other in (("1", "2"), ("2", "1")):
        query, key = _product(e[own], w[f"to_{own}_w"]), _product(e[other], w[f"to_{own}_u"])
        value = _product(e[other], w[f"to_{own}_v"])
        raised = [f"exp(tanh({q} + {k}) * ({v}))" for q, k, v in zip(query, key, value)]
        sql = _layer(f"r{own}", raised, sql)
        total = " + ".join(_names(f"r{own}", n))
        sql = _layer(f"a{own}", [f"{name} / ({total})" for name in _names(f"r{own}", n)], sql)
    weighted = [f"({x} * {y})" for side in "12" for x, y in zip(e[side], a[side])]
    sql = _layer("w", weighted, sql)
    sql = _layer("p", _product(_names("w", 2 * n), w["kernel"], w["bias"]), sql)
    decay = _product(_names("w", 2 * n), w["decay"], w["decay_bias"])
    sql = _layer("k", [f"1 - {_sigmoid(d)}" for d in decay], sql)
    return f"select *, {', '.join(f'{x} as m_{k}' for k, x in enumerate(a['1'] + a['2']))} from ({sql})"


def _step(cell: str, w: dict[str, np.ndarray], source: str) -> str:
    """From a row with the step's inputs and the state before (``h``, ``c``, ``t``) to the state after."""
    units, both = w["recurrent"].shape[0], w["decay"].shape[0]
    h, c = _names("h", units), _names("c", units)
    gate = [w["recurrent"][:, g * units : (g + 1) * units] for g in range(GATES[cell])]

    def pre(g: int, names: list[str] = h) -> list[str]:
        return [f"p_{g * units + k} + {x}" for k, x in enumerate(_product(names, gate[g]))]

    if cell == "rnn":
        sql, new_c = _layer("o", [f"tanh({x})" for x in pre(0)], source), c
    elif cell == "lstm":
        parts = [[_sigmoid(x) for x in pre(g)] for g in (0, 1, 3)]
        cells = [f"{f} * {old} + {i} * tanh({x})" for i, f, old, x in zip(parts[0], parts[1], c, pre(2))]
        sql = _layer("n", cells, source)
        sql, new_c = _layer("o", [f"{o} * tanh(n_{k})" for k, o in enumerate(parts[2])], sql), _names("n", units)
    else:
        sql = _layer("z", [_sigmoid(x) for x in pre(0)], source)
        sql = _layer("q", [f"{_sigmoid(x)} * h_{k}" for k, x in enumerate(pre(1))], sql)
        fresh = [f"tanh({x})" for x in pre(2, _names("q", units))]
        sql, new_c = _layer("o", [f"z_{k} * h_{k} + (1 - z_{k}) * {x}" for k, x in enumerate(fresh)], sql), c
    sql = _layer("y", [f"m_{k} + t_{k} * k_{k}" for k in range(both)], sql)
    recall = _product(_names("y", both), w["recall"], w["recall_bias"])
    state = [f"{1 - TAU} * o_{k} + {TAU} * tanh({x})" for k, x in enumerate(recall)]
    columns = [f"{x} as s_{k}" for k, x in enumerate(state)]
    columns += [f"{x} as d_{k}" for k, x in enumerate(new_c)] + [f"y_{k} as v_{k}" for k in range(both)]
    return f"select hadm_id, position, label, {', '.join(columns)} from ({sql})"


def network_query(cell: str) -> tuple[dict[str, str], str]:
    """The parts and the final text for one cell."""
    w = random_weights(cell, N_DRUGS, len(FEATURES), **SMALL_MODEL)
    units, both, dense = w["recurrent"].shape[0], w["decay"].shape[0], w["head"].shape[0]
    before = [f"{s}_{k}" for s, n in (("h", units), ("c", units), ("t", both)) for k in range(n)]
    after = [f"{s}_{k}" for s, n in (("s", units), ("d", units), ("v", both)) for k in range(n)]
    first = f"select *, {', '.join(f'cast(0 as double) as {x}' for x in before)} from {cell}_inputs where position = 1"
    nxt = f"""select i.*, {', '.join(f'r.{x} as {y}' for x, y in zip(after, before))}
        from {cell}_states r join {cell}_inputs i on i.hadm_id = r.hadm_id and i.position = r.position + 1"""
    parts = {
        f"{cell}_inputs": _inputs(w),
        f"{cell}_states": f"{_step(cell, w, first)} union all {_step(cell, w, nxt)}",
    }
    sql = f"select * from {cell}_states"
    sql = _layer("f", [f"greatest({x}, 0)" for x in _product(_names("s", units), w["dense_1"], w["dense_1_bias"])], sql)
    sql = _layer("g", [f"greatest({x}, 0)" for x in _product(_names("f", dense), w["dense_2"], w["dense_2_bias"])], sql)
    scores = [_sigmoid(x) for x in _product(_names("g", dense), w["head"], w["head_bias"])]
    final = f"""select hadm_id, cast(position as int) as step, label,
        cast(list_position(scores, list_max(scores)) - 1 as bigint) as best_place,
        round(list_max(scores), 6) as best_score, round(list_sum(scores), 6) as total_score
        from (select *, [{', '.join(scores)}] as scores from ({sql}))"""
    return parts, final

"""Chat formatting against a version of its own, odd JSON, schemas word by word, and long chains."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from daypanel.llm import chat_format, json_schema

TYPE = "conv_id long, turn long, role string, text string"
COUNTS = (
    "n_calls", "n_results", "n_linked", "n_orphans", "n_duplicates", "n_invalid", "n_unknown", "n_circular", "n_broken",
    "order_turn", "order_level",
)


def got_of(spark, rows, **options):
    got = chat_format.format_chat(spark.createDataFrame(rows, TYPE), **options).collect()
    return {(r.conv_id, r.turn): r for r in got}


def marked(kind, value):
    return f"<{kind}>{json.dumps(value)}</{kind}>"


def made_up(seed, n_conv=25):
    """Calls of a tool f that wants a whole number, and of an unknown one; some name others, some JSON is cut short."""
    rng, rows = random.Random(seed), []
    tools = [{"name": "f", "parameters": {"type": "object", "properties": {"a": {"type": "integer"}}, "required": ["a"]}}]
    for conv in range(n_conv):
        rows.append((conv, 0, "system", marked("tools", tools)))
        for turn in range(1, 14):
            text = ""
            for _ in range(rng.randint(0, 2)):
                i, other = (f"c{rng.randint(0, 9)}" for _ in range(2))
                text += rng.choice([
                    lambda: marked("tool_call", {"id": i, "name": rng.choice("fg"), "arguments": {"a": rng.choice([1, "x", True])}}),
                    lambda: marked("tool_call", {"id": i, "name": "f", "arguments": {"a": 2}, "depends_on": [other]}),
                    lambda: marked("tool_call", {"id": i, "name": "f", "arguments": {"b": {"deep": ["$" + other]}}}),
                    lambda: marked("tool_result", {"id": i, "content": turn}),
                    lambda: marked("tool_result", {"id": i})[:-16] + "</tool_result>",
                ])() + " and "
            rows.append((conv, turn, "assistant", text))
    return rows


def plain(rows):
    """Scans for marks by position, follows links by recursion; shares nothing with the operator."""
    out = {}
    for conv in {r[0] for r in rows}:
        calls, results, named, broken = {}, {}, set(), {}
        seen = {"tool_call": [], "tool_result": []}
        for _, turn, _, text in sorted(r for r in rows if r[0] == conv):
            at, broken[turn] = 0, 0
            while (start := text.find("<", at)) >= 0:
                at = start + 1
                kind = next((k for k in ("tools", "tool_call", "tool_result") if text.startswith(f"<{k}>", start)), None)
                if kind is None:
                    continue
                end = text.find(f"</{kind}>", start)
                inner, at = text[start + len(kind) + 2 : end], end
                try:
                    value = json.loads(inner)
                except ValueError:
                    broken[turn] += 1
                    continue
                if kind == "tools":
                    named |= {t["name"] for t in value}
                else:
                    first = calls if kind == "tool_call" else results
                    seen[kind].append((turn, value, value["id"] in first))
                    first.setdefault(value["id"], turn)

        def needs(value):
            text = json.dumps(value["arguments"])
            return set(value.get("depends_on", ())) | {f"c{n}" for n in range(10) if f'"$c{n}"' in text}

        waits = {r[1]: set() for r in rows if r[0] == conv}
        inner = {}
        for turn, value, _ in seen["tool_call"]:
            for i in needs(value) & calls.keys():
                waits[turn].add(results.get(i, calls[i]))
            inner.setdefault(turn, []).append(value)
        for turn, value, _ in seen["tool_result"]:
            if value["id"] in calls:
                waits[turn].add(calls[value["id"]])

        def way(turn, above=()):
            """(level, at), or None on a circle."""
            if turn in above:
                return None
            before = [way(t, (*above, turn)) for t in waits[turn] - {turn}]
            if None in before:
                return None
            return max((n + 1 for n, _ in before), default=0), max([turn, *(a for _, a in before)])

        def stuck(turn):
            """Calls of a turn that can never be made."""
            left = list(inner.get(turn, ()))
            here, have = {x["id"] for x in left}, set()
            while free := [x for x in left if needs(x) & here <= have]:
                have.add(free[0]["id"])
                left.remove(free[0])
            return {x["id"] for x in left}

        for turn in waits:
            c, r = ([x for x in seen[k] if x[0] == turn] for k in ("tool_call", "tool_result"))
            place, bad = way(turn), stuck(turn)
            wrong = [x for _, x, _ in c if x["name"] == "f" and "f" in named and type(x["arguments"].get("a")) is not int]
            linked = sum(x["id"] in results for _, x, _ in c) + sum(x["id"] in calls for _, x, _ in r)
            out[conv, turn] = (
                len(c), len(r), linked, len(c) + len(r) - linked, sum(d for *_, d in c + r), len(wrong),
                sum(x["name"] != "f" for _, x, _ in c), sum(place is None or x["id"] in bad for _, x, _ in c), broken[turn],
                place[1] if place else turn, place[0] if place else 0,
            )
    return out


@pytest.mark.parametrize("whole", (20_000, 0))
def test_against_a_version_of_its_own(spark, whole):
    rows = made_up(5, 25 if whole else 12)
    want = plain(rows)
    got = {k: tuple(r[n] for n in COUNTS) for k, r in got_of(spark, rows, whole_edges=whole).items()}
    assert got == want
    total = [sum(x[i] for x in want.values()) for i in range(len(COUNTS))]
    assert all(total), dict(zip(COUNTS, total))  # every case occurs


def test_rounds_and_whole_conversations_agree(spark):
    rows = made_up(8, 20)
    whole, rounds = got_of(spark, rows), got_of(spark, rows, whole_edges=9)  # some conversations are above, some below
    assert whole == rounds


def test_a_chain_of_two_thousand_calls(spark):
    rows = []
    for n in range(2000):
        rows.append((1, 2 * n, "assistant", marked("tool_call", {"id": n, "name": "f", "arguments": {}, "depends_on": [n - 1]})))
        rows.append((1, 2 * n + 1, "tool", json.dumps({"id": n, "content": n})))
    got = got_of(spark, rows)
    assert [got[1, t].order_level for t in range(4000)] == list(range(4000))
    assert sum(r.n_circular for r in got.values()) == 0 and sum(r.n_linked for r in got.values()) == 4000


def test_many_calls_in_one_turn():
    calls = [{"id": str(n), "needs": [str(n + 1)]} for n in range(30_000)] + [{"id": "x", "needs": ["x"]}]
    order, circle = chat_format._in_order(calls)
    assert circle == {"x"}
    assert [x["id"] for x in order[:2]] == ["29999", "29998"] and order[-1]["id"] == "x"


ODD = [
    '<tool_call>{"id":null,"name":"f","arguments":{}}</tool_call>',
    '<tool_call>{"id":true,"name":"f","arguments":{}}</tool_call>',
    '<tool_call>{"id":["a"],"name":"f","arguments":{}}</tool_call>',
    '<tool_call>{"id":"a","name":null,"arguments":{}}</tool_call>',
    '<tool_call>{"id":"a","name":"f","arguments":{"v":NaN}}</tool_call>',
    '<tool_call>{"id":"a","name":"f","arguments":{"v":1e999}}</tool_call>',
    '<tool_call>{"id":"a","name":"f","arguments":{"v":"\\ud800"}}</tool_call>',
    '<tool_call>{"id":"\\ud800","name":"f","arguments":{}}</tool_call>',
    '<tool_call>{"id":"a","name":"f","arguments":{},"depends_on":"b"}</tool_call>',
    '<tool_call>{"id":"a","name":"f","arguments":{},"depends_on":[null]}</tool_call>',
    '<tool_call>{"id":"a","name":"f","arguments":' + "[" * 50_000 + "]" * 50_000 + "}</tool_call>",
    '<tool_call>{"id":"a","name":"f","arguments":' + "[" * 101 + "]" * 101 + "}</tool_call>",
    '<tool_call>{"id":"a","name":"f","arguments":' + "9" * 5000 + "}</tool_call>",
    '<tool_call>[1]</tool_call>', "<tool_call>7</tool_call>", "<tools>7</tools>", '<tools>["f"]</tools>', "<tool_result>null</tool_result>",
]


def test_odd_json_is_text_that_is_counted(spark):
    got = got_of(spark, [(1, n, "user", text) for n, text in enumerate(ODD)])
    for n, text in enumerate(ODD):
        row = got[1, n]
        assert (row.n_broken, row.n_calls, row.n_results) == (1, 0, 0), text[:80]
        assert json.loads(row.message) == {"role": "user", "content": text}


SCHEMAS = [
    {"pattern": "("}, {"minimum": "2"}, {"properties": None}, {"required": 5}, {"type": {}}, {"type": "whole"}, {"enum": 3},
    {"anyOf": []}, {"items": 4}, {"multipleOf": 0}, {"minLength": -1}, {"$ref": "#/nowhere"}, {"$ref": "#"}, {"$ref": "http://x"},
    {"not": 1}, {"unheard": 1}, {"patternProperties": {"(": {}}}, 5, None, "object",
]


def test_malformed_schemas_are_counted(spark):
    rows = []
    for n, schema in enumerate(SCHEMAS):
        rows.append((n, 0, "system", marked("tools", [{"name": "f", "parameters": schema}])))
        rows.append((n, 1, "assistant", marked("tool_call", {"id": 1, "name": "f", "arguments": {"a": 1}})))
    got = got_of(spark, rows)
    assert [(got[n, 1].n_unchecked, got[n, 1].n_invalid) for n in range(len(SCHEMAS))] == [(1, 0)] * len(SCHEMAS)


@pytest.mark.parametrize(
    "schema, good, bad",
    [
        ({"exclusiveMinimum": 2}, [3, 2.5, "x"], [2, 1]),
        ({"exclusiveMaximum": 2}, [1, None], [2, 2.0]),
        ({"multipleOf": 0.1}, [0.3, 7, "x", 10**300], [0.35]),
        ({"multipleOf": 3}, [9, 0, 9.0], [10]),
        ({"uniqueItems": True}, [[1, True, "1"], []], [[1, 1.0], [{"a": 1, "b": 2}, {"b": 2, "a": 1}]]),
        ({"enum": [1, "a", None]}, [1, 1.0, "a", None], [True, 0, "b"]),
        ({"const": {"a": [1]}}, [{"a": [1.0]}], [{"a": [True]}, {}]),
        ({"type": ["integer", "null"]}, [2, 2.0, None], [2.5, True, "2"]),
        ({"minItems": 1, "maxItems": 2}, [[0]], [[], [1, 2, 3]]),
        ({"minProperties": 1, "maxProperties": 1}, [{"a": 1}], [{}, {"a": 1, "b": 1}]),
        ({"minLength": 1, "maxLength": 2.0, "pattern": "a"}, ["a", "ba"], ["", "b", "aaa"]),
        ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, ["x", 7], [3]),
        ({"oneOf": [{"minimum": 5}, {"multipleOf": 2}]}, [7, 4], [8, 3]),
        ({"allOf": [{"minimum": 5}, {"maximum": 6}]}, [5], [4, 7]),
        ({"not": {"type": "null"}}, [0], [None]),
        ({"patternProperties": {"^n_": {"type": "integer"}}, "additionalProperties": {"type": "string"}},
         [{"n_a": 1, "b": "x"}], [{"n_a": "x"}, {"b": 1}]),
        ({"properties": {"a": False}}, [{}, {"b": 1}], [{"a": 1}]),
        ({"$ref": "#/$defs/tree", "$defs": {"tree": {"properties": {"kids": {"items": {"$ref": "#/$defs/tree"}}}, "required": ["v"]}}},
         [{"v": 1, "kids": [{"v": 2, "kids": []}]}], [{"v": 1, "kids": [{"kids": []}]}, {}]),
        (True, [1], []), (False, [], [1, None]), ({"title": "x", "format": "date", "default": 3}, [1], []),
    ],
)
def test_words_of_a_schema(schema, good, bad):
    for value in good:
        assert json_schema.check(value, schema) == ([], []), value
    for value in bad:
        wrong, unchecked = json_schema.check(value, schema)
        assert wrong and not unchecked, value


def test_a_schema_that_doubles_at_every_step_ends():
    defs = {str(n): {"allOf": [{"$ref": f"#/$defs/{n + 1}"}] * 2} for n in range(60)} | {"60": {}}
    assert json_schema.check(1, {"$ref": "#/$defs/0", "$defs": defs}) == ([], ["size"])
    chain = {str(n): {"$ref": f"#/$defs/{n + 1}"} for n in range(5000)}
    assert json_schema.check(1, {"$ref": "#/$defs/0", "$defs": chain}) == ([], ["size"])
    assert json_schema.check(list(range(200_000)), {"items": {"type": "integer"}}) == ([], [])


def test_circles_and_null_conversations(spark):
    a = marked("tool_call", {"id": "a", "name": "f", "arguments": {}, "depends_on": ["b"]})
    b = marked("tool_call", {"id": "b", "name": "f", "arguments": {}, "depends_on": ["a"]})
    behind = marked("tool_call", {"id": "c", "name": "f", "arguments": {"x": "$a"}})
    rows = [(c, t, "assistant", text) for c in (1, None) for t, text in enumerate((a, b, behind))]
    frame = spark.createDataFrame(rows, TYPE)
    for whole in (20_000, 1):
        got = chat_format.format_chat(frame, whole).groupBy("conv_id").agg(F.sum("n_circular").alias("n")).collect()
        assert {r.conv_id: r.n for r in got} == {1: 3, None: 0}

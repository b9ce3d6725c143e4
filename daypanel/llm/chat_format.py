"""Conversations with tool calls as canonical JSON messages in an order that respects what depends on what.

What a turn says beside its text stands in marked JSON:

    <tools>[{"name": ..., "parameters": {JSON schema}}]</tools>             what may be called
    <tool_call>{"id": ..., "name": ..., "arguments": {...}}</tool_call>     a call; "depends_on": [ids] is possible
    <tool_result>{"id": ..., "content": ...}</tool_result>                  a result; so is a turn of role "tool"
                                                                            that is such an object

Each turn is parsed on its own. Calls and results then meet in a hash join by conversation and identifier, calls and
schemas by conversation and tool name. A call needs the calls that it names in ``depends_on`` or whose identifier is
the whole of a string argument ``$id``. So a turn waits for others: one with a result for the call, one with a call for
the results of what that needs. Turns are put in levels by the longest way, inside a conversation where its links are few
(``WHOLE_EDGES``), by a join for each level otherwise; what hangs on a circle has no level. Inside a turn calls stand
behind those of the turn that they need.

The result has a row for each turn, so no conversation is gathered in one task. Sorting a conversation by
(``order_turn``, ``order_level``, ``turn``) is a topological order, and leaves turns as they are where they are in one.

Of several calls with one identifier the first counts, by turn and place; so does the first of several results and of
several schemas of a name. The others are marked duplicate. JSON that is not strict (see ``json_schema``) stays text and is
counted as broken; so does a call or result whose identifier is not a text or a number, and one whose name is not a text.
A schema with words that are malformed or not known is checked as far as it goes, and its calls are counted apart.
Canonical JSON has sorted keys, no blanks, and characters as they are. A null text is an
empty message, a null role the role "none"; a null conversation is one without links. Rows that repeat all four
columns count once. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .json_schema import canonical, check, read
from .textscan import batch_of

MARK = re.compile(r"<(tools|tool_call|tool_result)>(.*?)</\1>", re.S)
WHOLE_EDGES = 20_000  # of a conversation that is followed in one piece, some 2 MB
_ROUNDS_A_PLAN = 16
_ITEM = "place: int, kind: string, id: string, name: string, value: string, needs: array<string>"


def references(value) -> set[str]:
    """Identifiers that stand in an argument as the string ``$id``."""
    if isinstance(value, dict):
        return set().union(*map(references, value.values()))
    if isinstance(value, list):
        return set().union(*map(references, value))
    return {value[1:]} if isinstance(value, str) and len(value) > 1 and value[0] == "$" else set()


def _identifier(value) -> str:
    """A text as it is, a number as it is written. Nothing else names a call."""
    if isinstance(value, bool) or not isinstance(value, (str, int, float)):
        raise ValueError("no identifier")
    return value if isinstance(value, str) else canonical(value)


def _name(value) -> str:
    if not isinstance(value, str):
        raise ValueError("no name")
    return value


def parse(role: str | None, text: str | None) -> tuple[str, list[dict], int]:
    """The text of a turn without its marks, its items, and the number of marks that could not be read."""
    items, broken = [], 0

    def item(kind, raw):
        value = read(raw)
        if kind == "tools":
            return [
                {"kind": "schema", "id": None, "name": _name(t["name"]), "value": canonical(t.get("parameters", {})), "needs": []}
                for t in value
            ]
        if kind == "tool_call":
            arguments = value.get("arguments", {})
            arguments = read(arguments) if isinstance(arguments, str) else arguments
            listed = value.get("depends_on", [])
            if not isinstance(listed, list):
                raise ValueError("no list")
            needs = {_identifier(x) for x in listed} | references(arguments)
            return [
                {"kind": "call", "id": _identifier(value["id"]), "name": _name(value.get("name", "")),
                 "value": canonical(arguments), "needs": sorted(needs)}
            ]
        return [
            {"kind": "result", "id": _identifier(value["id"]), "name": None, "value": canonical(value.get("content")), "needs": []}
        ]

    def replace(m):
        nonlocal broken
        try:
            items.extend(item(m[1], m[2]))
            return ""
        except (ValueError, KeyError, TypeError, AttributeError):
            broken += 1
            return m[0]

    text = MARK.sub(replace, text or "")
    if role == "tool" and not items and text.lstrip()[:1] == "{":
        try:
            items += item("tool_result", text)
            text = ""
        except (ValueError, KeyError, TypeError, AttributeError):
            broken += 1
    return text, [{"place": i, **x} for i, x in enumerate(items)], broken


def _turns(conversations: DataFrame) -> DataFrame:
    """A row for each turn: conv_id, turn, role, k (which turn it is), said, items, broken."""
    item_type = pa.list_(
        pa.struct(
            [("place", pa.int32()), ("kind", pa.string()), ("id", pa.string()), ("name", pa.string()),
             ("value", pa.string()), ("needs", pa.list_(pa.string()))]
        )
    )

    def read(batches):
        for batch in batches:
            rows = [parse(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            yield batch_of(
                conv_id=batch.column("conv_id"), turn=batch.column("turn"), role=batch.column("role"), k=batch.column("k"),
                said=pa.array([r[0] for r in rows], pa.string()), items=pa.array([r[1] for r in rows], item_type),
                broken=pa.array([r[2] for r in rows], pa.int64()),
            )

    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("none")).alias("role"), "text").distinct()
    rows = rows.withColumn("k", F.xxhash64("conv_id", "turn", "role", "text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, k long, said string, "
    return staged(rows.mapInArrow(read, schema + f"items array<struct<{_ITEM}>>, broken long"), "chat-turns")


def _first(rows: DataFrame, *by: str) -> DataFrame:
    """``duplicate``: whether a row of the same conversation and key came before. Null turns come first."""
    place = Window.partitionBy("conv_id", *by).orderBy("turn", "k", "place")
    return rows.withColumn("duplicate", F.row_number().over(place) > 1)


def _longest_ways(turns: dict[int, object], before: dict[int, set[int]]) -> dict[int, tuple[int, object]]:
    """level and at of each turn of one conversation that hangs on no circle."""
    users: dict[int, list[int]] = {}
    for k, needed in before.items():
        for b in needed:
            users.setdefault(b, []).append(k)
    open_ = {k: len(before.get(k, ())) for k in turns}
    level, at = dict.fromkeys(turns, 0), dict(turns)
    ready, out = [k for k, n in open_.items() if not n], {}
    while ready:
        b = ready.pop()
        out[b] = (level[b], at[b])
        for k in users.get(b, ()):
            level[k] = max(level[k], level[b] + 1)
            at[k] = max((x for x in (at[k], at[b]) if x is not None), default=None)
            open_[k] -= 1
            if not open_[k]:
                ready.append(k)
    return out


def _levels_inside(edges: DataFrame) -> DataFrame:
    """(k, level, at) for all turns of ``edges``, level null on a circle; each conversation is one bounded group."""
    kind = edges.schema["turn"].dataType.simpleString()

    def follow(group: pa.Table) -> pa.Table:
        turns, before = {}, {}
        for k, turn, b, turn_before in zip(*(group[n].to_pylist() for n in ("k", "turn", "before", "turn_before"))):
            turns[k], turns[b] = turn, turn_before
            before.setdefault(k, set()).add(b)
        ways = _longest_ways(turns, before)
        level, at = zip(*(ways.get(k, (None, None)) for k in turns))
        columns = [pa.array(list(turns), pa.int64()), pa.array(level, pa.int32()), pa.array(at, group["turn"].type)]
        return pa.table(columns, names=["k", "level", "at"])

    return edges.groupBy("conv_id").applyInArrow(follow, f"k long, level int, at {kind}")


def _levels_in_rounds(edges: DataFrame) -> DataFrame:
    """The same for conversations of any size: a join for each level, until no turn is free any more."""
    nodes = edges.select("k", "turn").union(edges.select("before", "turn_before")).distinct()
    edges = edges.select("k", "before")
    waits = edges.select("k").distinct()
    free = nodes.join(waits, "k", "left_anti").select("k", F.lit(0).alias("level"), F.col("turn").alias("at"))
    out = level = staged(free, "chat-level")
    waiting = staged(nodes.join(waits, "k", "left_semi"), "chat-waiting")
    n = 0
    while not level.isEmpty() and not waiting.isEmpty():
        n += 1
        met = edges.join(out.select(F.col("k").alias("before"), "level", "at"), "before", "left")
        state = met.groupBy("k").agg(F.count_if(F.col("level").isNull()).alias("open"), F.max("at").alias("last"))
        level = waiting.join(state.filter("open = 0"), "k").select(
            "k", F.lit(n).alias("level"), F.greatest("turn", "last").alias("at")
        )
        level = staged(level, "chat-level")
        out = out.unionByName(level)
        if n % _ROUNDS_A_PLAN == 0:
            out = staged(out, "chat-levels")
        waiting = staged(waiting.join(level, "k", "left_anti"), "chat-waiting")
    return out.unionByName(waiting.select("k", F.lit(None).cast("int").alias("level"), F.lit(None).cast(out.schema["at"].dataType).alias("at")))


def _levels(nodes: DataFrame, edges: DataFrame, whole_edges: int) -> DataFrame:
    """(k, level, at) of each turn: behind all turns that it waits for; level is null for one that hangs on a circle.

    ``nodes`` has k and turn, ``edges`` has conv_id, k, turn, and ``before``, ``turn_before`` of the turn it waits for. The
    level is the longest way to a turn that waits for none; ``at`` is the latest turn number on the way, its own included.
    Conversations of up to ``whole_edges`` edges are followed in one piece, larger ones in rounds over all of them.
    """
    edges = staged(edges.distinct(), "chat-edges")
    sizes = edges.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    large = staged(sizes.filter(F.col("n") > whole_edges).select("conv_id"), "chat-large")
    placed = _levels_inside(edges.join(large, "conv_id", "left_anti"))
    if not large.isEmpty():
        placed = placed.unionByName(_levels_in_rounds(staged(edges.join(large, "conv_id", "left_semi"), "chat-edges")))
    placed = placed.withColumn("placed", F.lit(True))
    first = F.col("placed").isNull()
    return nodes.join(placed, "k", "left").select(
        "k", F.when(first, 0).otherwise(F.col("level")).alias("level"), F.when(first, F.col("turn")).otherwise(F.col("at")).alias("at")
    )


def format_chat(conversations: DataFrame, whole_edges: int = WHOLE_EDGES) -> DataFrame:
    """A row for each turn: conv_id, turn, role, counts of its calls and results, where it goes, and ``message``.

    n_calls, n_results; n_linked (with a partner), n_orphans (without), n_duplicates, n_invalid (calls whose arguments
    break the schema), n_unchecked (calls whose schema has parts that were not checked), n_unknown (calls of a tool without
    a schema), n_circular, n_broken; order_turn, order_level.
    """
    turns = _turns(conversations)
    items = turns.select("conv_id", "turn", "k", F.explode("items").alias("item")).select("conv_id", "turn", "k", "item.*")
    calls = staged(_first(items.filter("kind = 'call'"), "id"), "chat-calls")
    results = staged(_first(items.filter("kind = 'result'"), "id"), "chat-results")
    schemas = _first(items.filter("kind = 'schema'"), "name").filter("not duplicate")
    schemas = schemas.select("conv_id", "name", F.col("value").alias("schema"))

    key = ["conv_id", "id"]
    done = results.filter("not duplicate").select("conv_id", "id", F.struct("k", "turn").alias("answer"))
    called = calls.filter("not duplicate").select("conv_id", "id", F.struct("k", "turn").alias("origin"))
    calls = calls.join(done, key, "left").join(schemas, ["conv_id", "name"], "left")
    results = results.join(called, key, "left")
    # A result waits for its call, a call for the results of what it needs, or for the call if that has none.
    needed = calls.filter("not duplicate").select("conv_id", "id", F.coalesce("answer", F.struct("k", "turn")).alias("to"))
    needs = calls.select("conv_id", "k", "turn", F.explode("needs").alias("id")).join(needed, key)
    waits = needs.select("conv_id", "k", "turn", "to").unionByName(
        results.filter("origin is not null").select("conv_id", "k", "turn", F.col("origin").alias("to"))
    )
    edges = waits.select("conv_id", "k", "turn", F.col("to.k").alias("before"), F.col("to.turn").alias("turn_before"))
    level = _levels(items.select("k", "turn").distinct(), edges.filter("k <> before"), whole_edges)

    columns = ["k", "place", "kind", "id", "name", "value", "needs", "duplicate"]
    both = calls.select(*columns, "schema", F.col("answer").isNotNull().alias("met")).unionByName(
        results.select(*columns, F.lit(None).cast("string").alias("schema"), F.col("origin").isNotNull().alias("met"))
    )
    listed = both.groupBy("k").agg(F.array_sort(F.collect_list(F.struct(*columns[1:], "schema", "met"))).alias("items"))
    whole = turns.select("conv_id", "turn", "role", "k", "said", "broken").join(listed, "k", "left").join(level, "k", "left")

    def write(batches):
        for batch in batches:
            names = ("role", "turn", "said", "broken", "items", "level", "at")
            rows = [_message(*r) for r in zip(*(batch.column(n).to_pylist() for n in names))]
            yield batch_of(
                conv_id=batch.column("conv_id"), turn=batch.column("turn"), role=batch.column("role"),
                **{n: pa.array([r[n] for r in rows], pa.string() if n == "message" else pa.int64()) for n in _COLUMNS},
            )

    kinds = {f.name: f.dataType.simpleString() for f in whole.schema}
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, "
    return whole.mapInArrow(write, schema + ", ".join(f"{n} {'string' if n == 'message' else 'long'}" for n in _COLUMNS))


_COLUMNS = (
    "n_calls", "n_results", "n_linked", "n_orphans", "n_duplicates", "n_invalid", "n_unchecked", "n_unknown", "n_circular", "n_broken",
    "order_turn", "order_level", "message",
)


def _in_order(calls: list[dict]) -> tuple[list[dict], set[str]]:
    """The calls of one turn, each behind those of the turn that it needs, and the identifiers on a circle.

    Of those that may come next the one that was written first does. Calls with one identifier count as one that is made
    when the first of them is.
    """
    here = {x["id"] for x in calls}
    open_, users = [], {}
    for i, x in enumerate(calls):
        needs = set(x["needs"]) & here
        open_.append(len(needs))
        for n in needs:
            users.setdefault(n, []).append(i)
    ready = [i for i, n in enumerate(open_) if not n]  # a heap, since it ascends
    out, have, made = [], set(), set()
    while ready:
        i = heapq.heappop(ready)
        out.append(calls[i])
        made.add(i)
        if calls[i]["id"] not in have:
            have.add(calls[i]["id"])
            for j in users.get(calls[i]["id"], ()):
                open_[j] -= 1
                if not open_[j]:
                    heapq.heappush(ready, j)
    left = [x for i, x in enumerate(calls) if i not in made]
    return out + left, {x["id"] for x in left}


def _message(
    role: str, turn: int | None, said: str, broken: int, items: list[dict] | None, level: int | None, at: int | None
) -> dict:
    out = dict.fromkeys(_COLUMNS, 0) | {"n_broken": broken}
    message: dict = {"role": role, "content": said}
    items = items or []
    calls, circle = _in_order([x for x in items if x["kind"] == "call"])
    for x in calls:
        value = json.loads(x["value"])
        wrong, unchecked = check(value, json.loads(x["schema"])) if x["schema"] else ([], [])
        out["n_invalid"] += bool(wrong)
        out["n_unchecked"] += bool(unchecked)
        out["n_unknown"] += x["schema"] is None
        out["n_circular"] += level is None or x["id"] in circle
        entry = {"id": x["id"], "name": x["name"], "arguments": value}
        message.setdefault("tool_calls", []).append(entry | ({"errors": wrong} if wrong else {}))
    results = [x for x in items if x["kind"] == "result"]
    for x in results:
        message.setdefault("tool_results", []).append({"id": x["id"], "content": json.loads(x["value"])})
    out |= {"n_calls": len(calls), "n_results": len(results)}
    for x in (*calls, *results):
        out["n_duplicates"] += x["duplicate"]
        out["n_linked" if x["met"] else "n_orphans"] += 1
    out["order_turn"] = turn if at is None else at
    out["order_level"] = level or 0
    out["message"] = canonical(message)
    return out


def digest(conversations: DataFrame) -> DataFrame:
    return format_chat(conversations)


def brute_force(rows: list[tuple]) -> dict[tuple, dict]:
    """The message of each (conv_id, turn) by plain loops, for tests; one row for each turn."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = {r[1]: (r[2] or "none", *parse(r[2], r[3])) for r in rows if r[0] == conv}
        first: dict[str, dict] = {"call": {}, "result": {}, "schema": {}}
        for turn in sorted(turns):
            for x in turns[turn][2]:
                first[x["kind"]].setdefault(x["name"] if x["kind"] == "schema" else x["id"], (turn, x))
        calls, results, schemas = first.values()
        before: dict[int, set[int]] = {t: set() for t in turns}
        for turn in turns:
            for x in turns[turn][2]:
                if x["kind"] == "result" and x["id"] in calls:
                    before[turn].add(calls[x["id"]][0])
                for n in x["needs"] if x["kind"] == "call" else ():
                    if n in calls:
                        before[turn].add((results if n in results else calls)[n][0])
            before[turn].discard(turn)
        level: dict[int, int] = {}
        at: dict[int, int] = {}
        for _ in turns:
            for t in turns:
                if t not in level and all(b in level for b in before[t]):
                    level[t] = max((level[b] + 1 for b in before[t]), default=0)
                    at[t] = max([t, *(at[b] for b in before[t])])
        for turn, (role, said, items, broken) in turns.items():
            listed = []
            for x in items:
                if x["kind"] != "schema":
                    call = x["kind"] == "call"
                    own, other = (calls, results) if call else (results, calls)
                    schema = schemas[x["name"]][1]["value"] if call and x["name"] in schemas else None
                    listed.append(x | {"duplicate": own[x["id"]] != (turn, x), "schema": schema, "met": x["id"] in other})
            out[conv, turn] = _message(role, turn, said, broken, listed, level.get(turn), at.get(turn))
    return out

"""Language, chat, mixing, the DuckDB texts, and the pipeline as a whole."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest_llm import SCHEMA, by_id, prose, rows_of

import __spark_entry__ as contract
import corpus_pipeline
from daypanel.llm import chat_format, decontaminate, jaccard_join, json_schema, language_id, quality_ledger, secret_scan, source_mix
from daypanel.llm.components import components
from daypanel.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_duckdb_agrees(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    rows = Counter(tuple(r) for r in got.select(*names).collect())
    assert rows == Counter(cursor.fetchall()) and rows


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


def test_language_is_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 200 < len(held) < 300
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_documents(spark, odd_documents, odd_texts, empty_documents):
    got = by_id(language_id.digest(odd_documents).collect())
    for i, text in odd_texts.items():
        letters = any(c.isalpha() for c in text or "")
        assert (got[i].lang_pred in ("en", "de")) == letters and (got[i].lang_pred == "und") != letters
    assert language_id.digest(empty_documents).collect() == []
    none = odd_documents.drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r.lang_pred for r in language_id.digest(none).collect()} == {"und"}


def test_temperature():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(4000, 3))
    chance = language_id.softmax(logits)
    labels = np.array([rng.choice(3, p=p) for p in chance])
    assert abs(language_id.temperature(logits * 4, labels) - 4) < 0.5


def test_l1_makes_weights_zero():
    """Feature 0 goes with class 1, the others go with neither."""
    model = language_id.Ftrl(50, 2)
    rng = np.random.default_rng(0)
    for _ in range(400):
        at = rng.choice(50, 5, replace=False)
        model.learn(at, np.full(5, 0.005), int(0 in at or rng.random() < 0.5))
    weights = model.weights(slice(None))
    assert (weights[1:] == 0).mean() > 0.5 and weights[0, 1] > 0 > weights[0, 0]


TOOLS = '<tools>[{"name":"f","parameters":{"type":"object","properties":{"a":{"type":"integer"}},"required":["a"]}}]</tools>'


def call(i, name="f", arguments='{"a":1}', more=""):
    return f'<tool_call>{{"id":"{i}","name":"{name}","arguments":{arguments}{more}}}</tool_call>'


def result(i, content="1"):
    return f'<tool_result>{{"id":"{i}","content":{content}}}</tool_result>'


def conversations():
    rng = random.Random(3)
    rows = [(1, 0, "system", TOOLS), (1, 1, "assistant", call("x") + call("y", arguments='{"a":"$x"}')), (1, 2, "tool", result("y")),
            (1, 3, "tool", '{"id":"x","content":{"z":[1,2],"b":"é"}}'), (2, 0, None, None), (2, 1, "user", "<tool_call>{</tool_call>"),
            (3, 0, "assistant", call("late", more=',"depends_on":["early"]')), (3, 1, "tool", result("late")),
            (3, 2, "assistant", call("early")), (3, 5, "tool", result("early"))]
    for conv in range(10, 30):
        ids = [f"c{n}" for n in range(8)]
        rows.append((conv, 0, "system", TOOLS))
        for turn in range(1, 12):
            parts = []
            for _ in range(rng.randint(0, 3)):
                n = rng.randint(0, 7)
                if rng.random() < 0.5:
                    need = f'"${ids[rng.randint(0, n)]}"' if rng.random() < 0.5 else "2"
                    parts.append(call(ids[n], rng.choice("fg"), f'{{"a":{need}}}'))
                else:
                    parts.append(result(ids[n], rng.choice(['"q"', "[1]", '{"b":1,"a":null}'])))
            rows.append((conv, turn, rng.choice(["assistant", "tool"]), "t " + "".join(parts)))
    return rows


def test_chat(spark):
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    more = frame.unionByName(frame.limit(4)).selectExpr("*", "1 as k", "'x' as items", "2 as place", "3 as level")
    got = {(r.conv_id, r.turn): r.asDict() for r in chat_format.digest(more).collect()}
    want = chat_format.brute_force(rows)
    assert got.keys() == want.keys()
    assert [k for k in want if any(got[k][n] != x for n, x in want[k].items())] == []
    # A call stands before its result, wherever both have their places.
    order = sorted((r["order_turn"], r["order_level"], r["turn"]) for k, r in got.items() if k[0] == 3)
    assert [t for _, _, t in order] == [2, 5, 0, 1]


def test_chat_of_nothing(spark):
    assert chat_format.digest(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
    frame = spark.createDataFrame([(None, None, None, None), (None, None, "user", call("a"))], "conv_id long, turn long, role string, text string")
    assert len(chat_format.digest(frame).collect()) == 2


def test_schemas():
    schema = {"type": "object", "properties": {"a": {"type": "integer", "minimum": 2}, "b": {"type": "array", "items": {"enum": ["x"]}}},
              "required": ["a"], "additionalProperties": False}
    assert json_schema.problems({"a": 2, "b": ["x"]}, schema) == []
    assert json_schema.problems({"a": True}, schema) == ["$.a: type"]
    assert json_schema.problems({"a": 1, "b": ["x", "y"], "c": 0}, schema) == ["$.a: bounds", "$.b[1]: enum", "$.c: unknown"]
    assert json_schema.problems([], schema) == ["$: type"] and json_schema.problems({}, schema) == ["$.a: missing"]


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    shares = {"lang": {"en": 0.4, "de": 0.3, "fr": 0.2, "es": 0.1}}
    rows = source_mix.weighted(docs, shares=shares, budget=0.3).collect()
    total = sum(r.n_tokens * r.weight for r in rows)
    for lang, share in shares["lang"].items():
        assert abs(sum(r.n_tokens * r.weight for r in rows if r.lang == lang) / total - share) < 0.01
    assert abs(sum(r.n_tokens * r.probability for r in rows) / sum(r.n_tokens for r in rows) - 0.3) < 0.001
    assert abs(np.mean([r.kept for r in rows]) - np.mean([r.probability for r in rows])) < 0.05


def test_mix_of_odd_documents(odd_documents, empty_documents):
    rows = source_mix.digest(odd_documents).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.probability <= 1 for r in rows)
    assert {r.lang for r in rows} == {"en", "de", "(none)"}
    mixed = source_mix.mix(odd_documents)
    assert mixed.columns == [*odd_documents.columns, "mix_topic", "mix_weight"]
    assert mixed.count() == sum(r.kept for r in rows)
    assert source_mix.digest(empty_documents).collect() == [] and source_mix.mix(empty_documents).collect() == []


def test_mix_twice(spark, odd_documents, tmp_path):
    """Columns of the first mix are replaced by those of the second, also in other letters."""
    again = source_mix.mix(source_mix.mix(odd_documents, budget=1.0).withColumnRenamed("mix_topic", "Mix_Topic"), budget=1.0)
    assert again.columns == [*odd_documents.columns, "mix_topic", "mix_weight"]
    again.write.parquet(str(tmp_path / "twice"))


def test_targets_that_cannot_be_met_are_named(spark):
    """Sources and languages are the same split, so their targets contradict each other: the later marginal wins."""
    rows = [(n, "prose " * 20, *(("a", "en") if n % 2 else ("b", "de"))) for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    shares = {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.2, "de": 0.7, "fr": 0.1}}
    got = {(r.margin, r.value): r for r in source_mix.fit_report(docs, shares).collect()}
    assert {k: r.met for k, r in got.items()} == {
        ("source", "a"): False, ("source", "b"): False, ("lang", "en"): False, ("lang", "de"): False, ("lang", "fr"): False,
        ("topic", "prose"): True,
    }
    assert got["lang", "fr"].share == 0 and got["source", "a"].share == pytest.approx(2 / 9)
    assert got["source", "a"].target == pytest.approx(0.9)
    possible = {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.9, "de": 0.1}}
    assert all(r.met for r in source_mix.fit_report(docs, possible).collect())
    assert source_mix.fit_report(docs.limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    root = {x: x for pair in links for x in pair}
    for _ in range(200):
        for u, v in links:
            root[u] = root[v] = min(root[u], root[v])
    assert got == {x: r for x, r in root.items() if any(x in p and p[0] != p[1] for p in links)}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_pipeline(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in quality_ledger.digest(docs).collect() if r.kept}
    frames, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, "/root/testdata/sf0.01").cache()
        frames[name] = now
        assert now.columns[: len(docs.columns)] == docs.columns
    after = {name: {r.doc_id: r.text for r in f.collect()} for name, f in frames.items()}
    assert after["quality"] == {i: texts[i] for i in kept}
    groups = jaccard_join.brute_force(after["quality"])
    assert after["near_duplicates"] == {i: texts[i] for i in kept if groups[i][1] == i or not groups[i][0]}
    phrases = [(str(r.item_id), r.text) for r in items.collect()]
    found = dict(zip(after["near_duplicates"], decontaminate.brute_force(list(after["near_duplicates"].values()), phrases)))
    passages = after["benchmark_passages"]
    assert all(passages[i] == texts[i] for i, (_, n, _) in found.items() if not n) and any(n for _, n, _ in found.values())
    assert not any(n for _, n, _ in decontaminate.brute_force(list(passages.values()), phrases))
    secret = after["secrets"]
    for i, text in passages.items():
        spans = secret_scan.brute_force(text)
        assert secret[i] == text if not spans else "[SECRET]" in secret[i] and not secret_scan.brute_force(secret[i])
    drawn = after["source_weights"]
    assert all(secret[i] == t for i, t in drawn.items()) and 0.3 < len(drawn) / len(secret) < 0.7
    whole = contract.queries()["pipeline"](spark, "/root/testdata/sf0.01")
    assert {r.doc_id: r.text for r in whole.collect()} == drawn


def test_stages_on_odd_documents(spark, odd_texts, empty_documents):
    usual = SCHEMA.split(", d long")[0]
    rows = [r[:5] for r in rows_of(odd_texts | {500 + i: prose(500 + i, 70) + "\npassword=abcdefgh12" for i in range(5)})]
    now, none = spark.createDataFrame(rows + rows[::5], usual), empty_documents.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        now, none = stage(spark, now, SF), stage(spark, none, SF)
        assert now.columns[:5] == none.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
        assert none.count() == 0 and now.count() > 0

"""Responses, request bodies and safe views."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from scrollwork.functions.text import group_id, json_string
from scrollwork.operators import messages as M
from scrollwork.plans.check_queries import ODD


def answers(spark, rows):
    frame = spark.createDataFrame(rows, "k int, style string, raw string")
    got = frame.select("k", M.response_text(F.col("style"), F.col("raw")).alias("r")).collect()
    return {r["k"]: (r["r"]["text"], r["r"]["problem"]) for r in got}


def test_odd_responses_of_each_style(spark):
    rows = [(style, raw, problem) for style, texts in ODD.items() for raw, problem in texts.items()]
    got = answers(spark, [(k, style, raw) for k, (style, raw, _) in enumerate(rows)])
    assert got == {k: (None, problem) for k, (_, _, problem) in enumerate(rows)}


def test_responses(spark):
    part = lambda *texts: [{"type": "output_text", "text": t} for t in texts]
    rows = {
        ("responses", json.dumps({"output": [{"type": "reasoning", "content": 3}, {"type": "message", "content": part("a", "b")}, {"type": "message", "content": [{"type": "refusal", "text": 1}, *part("c")]}]})): ("abc", None),
        ("responses", '{"status": "completed", "output": [{"type": "message"}]}'): (None, "no_text"),
        ("responses", '{"output": [{"type": "message", "content": [{"type": "output_text"}]}]}'): (None, "no_text"),
        ("responses", '{"output": null}'): (None, "malformed"),
        ("responses", '{"output": 5}'): (None, "malformed"),
        ("responses", '{"output": ""}'): (None, "no_text"),
        ("responses", '{"output": [null]}'): (None, "malformed"),
        ("responses", '{"status": "failed", "output": 5}'): (None, "incomplete"),
        ("responses", '{"usage": null, "output": []}'): (None, "malformed"),
        ("responses", '{"usage": {}, "output": [{"type": "message", "content": [{"type": "output_text", "text": "x"}]}]}'): ("x", None),
        ("chat_completions", '{"choices": [{"finish_reason": "stop", "message": {"content": "hi"}}]}'): ("hi", None),
        ("chat_completions", '{"choices": [{"finish_reason": "stop"}]}'): (None, "no_text"),
        ("chat_completions", '{"choices": [{"finish_reason": "length", "message": 1}]}'): (None, "incomplete"),
        ("chat_completions", '{"choices": [{"finish_reason": "stop", "message": "hi"}]}'): (None, "malformed"),
        ("chat_completions", '{"choices": {"a": 1}}'): (None, "malformed"),
        ("chat_completions", '{"choices": "x"}'): (None, "malformed"),
        ("chat_completions", '{"choices": null}'): (None, "incomplete"),
        ("chat_completions", "{}"): (None, "incomplete"),
        ("messages", '{"stop_reason": "end_turn", "content": [{"type": "thinking", "text": 1}, {"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}'): ("ab", None),
        ("messages", '{"stop_reason": "end_turn", "content": ["x"]}'): (None, "malformed"),
        ("messages", '{"content": []}'): (None, "incomplete"),
        ("messages", "[]"): (None, "malformed"),
        ("messages", "{oops"): (None, "malformed"),
        ("messages", None): (None, "malformed"),
        ("telegram", '{"stop_reason": "end_turn", "content": []}'): (None, "unknown_style"),
        (None, "{}"): (None, "unknown_style"),
    }
    assert answers(spark, [(k, style, raw) for k, (style, raw) in enumerate(rows)]) == dict(enumerate(rows.values()))


def test_requests_of_unknown_styles_and_efforts(spark):
    rows = [("responses", "low"), ("messages", "low"), ("chat_completions", "most"), ("telegram", "low"), (None, "low")]
    frame = spark.createDataFrame(rows, "style string, effort string")
    got = frame.select(M.effort_problem(F.col("style"), F.col("effort")).alias("p"), M.request_body(F.col("style"), F.lit("m"), F.lit("s"), F.lit("c"), F.col("effort"), 9).alias("b")).collect()
    assert [r["p"] for r in got] == [None, "effort_not_in_style", "unknown_effort", "unknown_style", "unknown_style"]
    assert [r["b"] is None for r in got] == [r["p"] is not None for r in got]


VALUES = [
    {"b": 1, "a": [True, None, "x\n\"é"], "c": {}, "d": []},
    {"type": "message", "content": [{"type": "thinking", "thinking": "hm", "signature": "s"}, {"type": "text", "text": "t", "reasoning_details": [1]}]},
    {"Api-Key": {"deep": [1]}, "list": [{"PASS_WORD": "x", "token_count": 3}, [[{"Authorization": None}]]]},
    ["plain", 2, {"type": "redacted_thinking", "data": "d"}],
    "text",
    {"type": 5, "thinking": {"a": 1}},
]


def without_thoughts(v):
    if isinstance(v, list):
        return [without_thoughts(x) for x in v]
    if not isinstance(v, dict):
        return v
    if v.get("type") in M.THOUGHT_BLOCKS:
        return {"omitted": True, "type": v["type"]}
    return {k: without_thoughts(x) for k, x in v.items() if k not in M.THOUGHT_FIELDS}


def without_secrets(v):
    if isinstance(v, list):
        return [without_secrets(x) for x in v]
    secret = lambda k: "".join(c for c in k.lower() if "a" <= c <= "z") in M.SECRET_KEYS
    return {k: "[REDACTED]" if secret(k) else without_secrets(x) for k, x in v.items()} if isinstance(v, dict) else v


def test_views(spark):
    frame = spark.createDataFrame([(k, json.dumps(v)) for k, v in enumerate(VALUES)], "k int, raw string").withColumn("v", F.try_parse_json("raw"))
    got = {r["k"]: r for r in frame.select("k", *[f(F.col("v")).alias(n) for n, f in (("seen", M.visible_response), ("safe", M.redacted_json), ("one", M.canonical_json), ("sha", M.canonical_hash))]).collect()}
    form = lambda v: json.dumps(v, sort_keys=True, ensure_ascii=False)
    for k, v in enumerate(VALUES):
        assert got[k]["seen"] == form(without_thoughts(v)) and got[k]["safe"] == form(without_secrets(v)) and got[k]["one"] == form(v)
        assert got[k]["sha"] == hashlib.sha256(form(v).encode()).hexdigest()


def test_views_of_deep_and_broken_values(spark):
    nested = lambda n: "[" * n + "1" + "]" * n
    rows = [(nested(M.DEPTH),), (nested(M.DEPTH + 1),), ("{oops",), (None,), ('{"b": 1, "a": {"z": 1, "y": 2}}',), ('{"a": {"y": 2, "z": 1}, "b": 1}',)]
    frame = spark.createDataFrame(rows, "raw string").select(F.try_parse_json("raw").alias("v"))
    got = [tuple(r) for r in frame.select(M.canonical_json(F.col("v")), M.canonical_hash(F.col("v"))).collect()]
    assert got[0][0] == nested(M.DEPTH) and got[1][0] is None  # deeper than stated: no view rather than part of one
    assert got[2] == got[3] == (None, None)
    assert got[4] == got[5] and got[4][0] == '{"a": {"y": 2, "z": 1}, "b": 1}'


def test_views_interpret_no_lambdas(spark):
    frame = spark.createDataFrame([("{}",)], "raw string").select(*[f(F.try_parse_json("raw")) for f in (M.visible_response, M.redacted_json, M.canonical_hash)])
    assert "lambda" not in frame._jdf.queryExecution().optimizedPlan().toString()


ODD_VALUES = [
    {"thinking": 1}, {"a": 1, "signature": [1, {"b": "}"}], "thinking": "x"}, {"reasoning_content": 1, "reasoning_details": 2, "z": {"thinking": 3}},
    {"a": '", "thinking": 1, "type": "reasoning"', "b": ', "token": {', "c": "\\", "{": "}", "d": '{"type": "thinking"}'},
    [{"type": "reasoning", "a": {"type": "x"}, "z": [{}]}, {"a": {"type": "thinking", "b": [[]]}, "type": "text"}, {"type": ["thinking"]}],
    {'to"k\\e\nn': 1, "\u212aAP\u0130 Key": 2, "AP\u0130 \u212aey": {"x": [1]}, "tokens": {"SECRET!": None}, "\u0001token\u00e9": [], "to": "token"},
    {"deep": json.loads("[" * 20 + '{"token": 1, "thinking": 2}' + "]" * 20)},
]


@pytest.mark.parametrize("value", ODD_VALUES)
def test_views_of_odd_values(spark, value):
    v = F.try_parse_json(F.lit(json.dumps(value)))
    got = spark.range(1).select(M.visible_response(v), M.redacted_json(v), M.canonical_json(v)).first()
    assert [json.loads(x) for x in got] == [without_thoughts(value), without_secrets(value), value]
    assert list(got) == [json.dumps(json.loads(x), ensure_ascii=False) for x in got]


def test_views_of_long_values(spark):
    long = {"text": '\\"' * 100_000, "list": [{"token": k, "type": "text"} for k in range(20_000)]}
    row = spark.createDataFrame([(json.dumps(long),)], "raw string").select(F.try_parse_json("raw").alias("v")).select(M.visible_response(F.col("v")), M.redacted_json(F.col("v"))).first()
    assert [json.loads(x) for x in row] == [long, without_secrets(long)]


def test_no_python_in_the_views(spark):
    frame = spark.createDataFrame([("{}",)], "raw string").select(M.visible_response(F.try_parse_json("raw")))
    assert "Python" not in frame._jdf.queryExecution().toString()


@pytest.mark.parametrize("text", ["", "plain", 'say "hi"', "back\\slash", "tab\t\n\r\b\f", "\x01\x1f\x7f", "é ß 日本", "😀 mixed é", "]["])
def test_json_strings(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(json_string(F.col("t"))).first()[0] == json.dumps(text)


def test_group_ids_tell_quoted_ids_apart(spark):
    made = lambda evidence, context: spark.range(1).select(group_id(F.lit("s"), F.lit("v"), F.lit("t"), F.array(*map(F.lit, evidence)).cast("array<string>"), F.array(*map(F.lit, context)).cast("array<string>"))).first()[0]
    assert made(['a", "b'], []) != made(["a", "b"], [])
    want = hashlib.sha256(json.dumps(["s", "v", "t", ["é", 'q"'], []]).encode()).hexdigest()
    assert made(["é", 'q"'], []) == f"passage-{want}"

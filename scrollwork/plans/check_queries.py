"""Queries over chunk documents and messages, with faults put in on purpose, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import documents, messages
from .adapters import ITEMS, LOG, items, log, table


#: Responses of each style that parse and yet are not what the style has, and what is wrong with them.
ODD = {
    "responses": {
        '{"output": ["x"]}': "malformed",
        '{"output": [{"type": "message", "content": "hello"}]}': "malformed",
        '{"output": [], "usage": 3}': "malformed",
        '{"status": null, "output": {}}': "no_text",
        '{"output": [{"type": "message", "content": [{"type": "output_text", "text": 7}]}]}': "malformed",
    },
    "chat_completions": {
        '{"choices": [{"finish_reason": "stop", "message": {"content": [{"type": "text"}]}}]}': "no_text",
        '{"choices": [{"finish_reason": "stop", "message": {"content": 7}}]}': "no_text",
        '{"choices": []}': "incomplete",
        '{"choices": ["x"]}': "malformed",
        '{"choices": [{"finish_reason": "stop", "message": null}]}': "malformed",
    },
    "messages": {
        '{"stop_reason": "end_turn", "content": "hello"}': "malformed",
        '{"stop_reason": "end_turn", "content": [{"type": "text", "text": null}]}': "malformed",
        '{"stop_reason": "end_turn"}': "no_text",
        '{"stop_reason": "end_turn", "content": [], "usage": []}': "malformed",
        '{"stop_reason": 1, "content": []}': "incomplete",
    },
}


def _styled(spark: SparkSession, d: str) -> DataFrame:
    """event_id, k, style and a raw response of each event: some incomplete, some empty, some no JSON, some odd, some of no
    known style."""
    k = F.col("k")
    style = F.when(k % 17 == 0, "other").otherwise(F.element_at(F.array(*map(F.lit, ODD)), k % 3 + 1))
    own = log(spark, d).select("event_id", "k", style.alias("style"))
    odd = F.get(F.element_at(F.array(*[F.array(*map(F.lit, texts)) for texts in ODD.values()]), k % 3 + 1), F.floor(k / 39).cast("int") % 5)
    said = F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("said "), k.cast("string")))
    done = k % 5 != 0
    responses = F.concat(F.lit('{"status": "'), F.when(done, "completed").otherwise("failed"), F.lit('", "output": [{"type": "reasoning"}, {"type": "message", "content": [{"type": "output_text", "text": "'), said, F.lit('"}, {"type": "refusal", "text": "no"}]}]}'))
    chat = F.concat(F.lit('{"choices": [{"finish_reason": "'), F.when(done, "stop").otherwise("length"), F.lit('", "message": {"content": "'), said, F.lit('"}}]}'))
    message = F.concat(F.lit('{"stop_reason": "'), F.when(done, "end_turn").otherwise("max_tokens"), F.lit('", "content": [{"type": "thinking", "thinking": "hm"}, {"type": "text", "text": "'), said, F.lit('"}]}'))
    raw = F.when(k % 13 == 0, odd).when(k % 11 == 0, "[oops").when(F.col("style") == "responses", responses).when(F.col("style") == "chat_completions", chat).otherwise(message)
    return own.withColumn("raw", raw)


def response_texts(spark: SparkSession, d: str) -> DataFrame:
    return _styled(spark, d).select("event_id", messages.response_text(F.col("style"), F.col("raw")).alias("r")).select("event_id", "r.*")


def request_bodies(spark: SparkSession, d: str) -> DataFrame:
    own = _styled(spark, d)
    effort = F.element_at(F.array(*map(F.lit, ("none", "high", "low", "most"))), F.col("k") % 4 + 1)
    body = messages.request_body(F.col("style"), F.lit("m"), F.lit("be brief"), F.col("k").cast("string"), effort, 900)
    return own.select("event_id", messages.effort_problem(F.col("style"), effort).alias("problem"), body.alias("body"))


def _secretive(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k").cast("string")
    raw = F.concat(F.lit('{"id": '), k, F.lit(', "Api-Key": {"a": 1}, "thinking": "x", "parts": [{"type": "reasoning", "text": "t"}, {"type": "text", "text": "é'), k, F.lit('", "signature": "s", "Headers": ["h"]}], "token_count": 2}'))
    return log(spark, d).select("event_id", "k", raw.alias("raw"))


def safe_views(spark: SparkSession, d: str) -> DataFrame:
    """Responses without thoughts, without secrets, and the hash of their one form."""
    own = _secretive(spark, d).select("event_id", messages.canonical_json(F.try_parse_json("raw")).alias("form"))  # once for all three
    return own.select("event_id", messages.without_thoughts(F.col("form")).alias("visible"), messages.without_secrets(F.col("form")).alias("redacted"), F.sha2(F.col("form").cast("binary"), 256).alias("sha"))


def envelope_violations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    sha = F.sha2(F.col("text").cast("binary"), 256)
    own = table(spark, d, "documents").select("doc_id", F.when(k % 40 == 3, 2).otherwise(1).alias("schema_version"), F.when(k % 40 == 5, "failed").otherwise("completed").alias("status"), F.when(k % 40 == 7, F.upper(sha)).when(k % 40 == 8, None).otherwise(sha).alias("source_sha"), (k % 40 == 9).alias("is_annotation"))
    return documents.envelope_violations(own)


def _chunk_items(spark: SparkSession, d: str) -> DataFrame:
    """Items in chunks of eight; some are left out, repeated, swapped, or in chunks of one name."""
    k, pos = F.col("doc_id") % 20, F.col("pos")
    own = items(spark, d).select("doc_id", F.floor(pos / 8).cast("int").alias("chunk_no"), F.when((k == 4) & (pos < 2), 1 - pos).otherwise(pos).alias("ord"), "item_id", "pos")
    own = own.where(~((F.col("doc_id") % 20 == 2) & (pos == 1)))
    own = own.unionByName(own.where((k == 3) & (pos == 0)))
    return own.withColumn("chunk_id", F.when(F.col("doc_id") % 20 == 5, "chunk").otherwise(F.col("chunk_no").cast("string")))


def chunk_coverage_breaches(spark: SparkSession, d: str) -> DataFrame:
    return documents.coverage_breaches(_chunk_items(spark, d), items(spark, d).select("doc_id", F.col("pos").alias("ord"), "item_id"))


def reading_order_violations(spark: SparkSession, d: str) -> DataFrame:
    own = items(spark, d)
    k, pos = F.col("doc_id") % 20, F.col("pos")
    index = own.select("doc_id", "item_id", (F.col("label") == "list_item").alias("is_container"), F.lit("s").alias("source_sha")).where(~((k == 1) & F.col("item_id").endswith("/2")))
    order = own.where((F.col("label") != "list_item") | (k == 6)).select("doc_id", pos.alias("ord"), "item_id", F.when((k == 7) & (pos % 3 == 0), "t").otherwise("s").alias("source_sha"))
    return documents.reading_order_violations(order.unionByName(order.where((k == 8) & (F.col("ord") == 0))), index)


def item_violations(spark: SparkSession, d: str) -> DataFrame:
    k, pos = F.col("doc_id") % 20, F.col("pos")
    own = items(spark, d)
    made = own.select(
        "doc_id", "item_id", "label", F.when((k == 1) & (pos % 2 == 0), 0).otherwise(F.col("level")).alias("level"),
        F.when(k == 2, F.array(pos)).otherwise(F.array(F.lit(1))).alias("pages"),
        F.when((k == 3) & (pos == 0), "#/groups/none").when(pos > 0, F.lit("#/texts/0")).alias("parent_id"),
        F.when(k == 4, F.array(F.concat(F.lit("#/texts/"), pos), F.lit("#/texts/none"))).otherwise(F.array().cast("array<string>")).alias("heading_ids"),
    )
    return documents.item_violations(made)


def answer_differences(spark: SparkSession, d: str) -> DataFrame:
    saved = table(spark, d, "labels").select("doc_id", "quality")
    again = saved.select("doc_id", F.when(F.col("doc_id") % 9 == 0, 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality")).where("doc_id % 14 <> 0")
    return documents.answer_differences(saved, again)


def registration_violations(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    drafts = o.select(F.col("o_custkey").alias("doc_id"), (F.col("o_orderkey") % 50).alias("fact_id"), F.when(F.col("o_orderkey") % 13 == 0, "x").otherwise("s").alias("source_sha"))
    return documents.registration_violations(drafts, table(spark, d, "customer").where("c_custkey % 6 <> 0").select(F.col("c_custkey").alias("doc_id"), F.lit("s").alias("sha")))


def model_substitutions(spark: SparkSession, d: str) -> DataFrame:
    calls = log(spark, d).where("event = 'llm_attempt'").select(F.col("event_id").alias("key"), F.col("model").alias("asked_model"), F.when(F.col("k") % 8 == 0, "model-9").otherwise(F.col("model")).alias("model"), F.lit("chat").alias("asked_style"), F.when(F.col("k") % 15 == 0, "messages").otherwise("chat").alias("style"))
    return documents.model_substitutions(calls).select("key", "asked_model", "model", "style")


QUERIES = {f.__name__: f for f in (response_texts, request_bodies, safe_views, envelope_violations, chunk_coverage_breaches, reading_order_violations, item_violations, answer_differences, registration_violations, model_substitutions)}

_SAID = "CASE WHEN k % 7 = 0 THEN '' ELSE 'said ' || k END"
ORACLES = {
    "response_texts": f"""WITH {LOG}, p AS (SELECT event_id, k, CASE WHEN k % 17 = 0 THEN 'unknown_style'
          WHEN k % 13 = 0 THEN {[list(x.values()) for x in ODD.values()]}[k % 3 + 1][k // 39 % 5 + 1] WHEN k % 11 = 0 THEN 'malformed' WHEN k % 5 = 0 THEN 'incomplete' WHEN k % 7 = 0 THEN 'no_text' END AS problem FROM log)
        SELECT event_id, CASE WHEN problem IS NULL THEN 'said ' || k END AS text, problem FROM p""",
    "request_bodies": f"""WITH {LOG}, e AS (SELECT event_id, k, ['none', 'high', 'low', 'most'][k % 4 + 1] AS effort FROM log),
        p AS (SELECT *, CASE WHEN k % 17 = 0 THEN 'unknown_style' WHEN effort = 'most' THEN 'unknown_effort' WHEN k % 3 = 2 AND effort = 'low' THEN 'effort_not_in_style' END AS problem FROM e)
        SELECT event_id, problem, CASE WHEN problem IS NULL THEN CASE k % 3
          WHEN 0 THEN '{{"model":"m","instructions":"be brief","input":"' || k || '","store":false,"reasoning":{{"effort":"' || effort || '"}},"max_output_tokens":900}}'
          WHEN 1 THEN '{{"model":"m","messages":[{{"role":"system","content":"be brief"}},{{"role":"user","content":"' || k || '"}}],"max_tokens":900,"response_format":{{"type":"json_object"}}' || CASE WHEN effort <> 'none' THEN ',"reasoning_effort":"' || effort || '"' ELSE '' END || '}}'
          ELSE '{{"model":"m","system":"be brief","messages":[{{"role":"user","content":"' || k || '"}}],"max_tokens":' || CASE WHEN effort = 'high' THEN '32768,"thinking":{{"type":"enabled","budget_tokens":16000}}}}' ELSE '8192,"thinking":{{"type":"disabled"}}}}' END END END AS body FROM p""",
    "safe_views": f"""WITH {LOG} SELECT event_id,
        '{{"Api-Key": {{"a": 1}}, "id": ' || k || ', "parts": [{{"omitted": true, "type": "reasoning"}}, {{"Headers": ["h"], "text": "é' || k || '", "type": "text"}}], "token_count": 2}}' AS visible,
        '{{"Api-Key": "[REDACTED]", "id": ' || k || ', "parts": [{{"text": "t", "type": "reasoning"}}, {{"Headers": "[REDACTED]", "signature": "s", "text": "é' || k || '", "type": "text"}}], "thinking": "x", "token_count": 2}}' AS redacted,
        sha256('{{"Api-Key": {{"a": 1}}, "id": ' || k || ', "parts": [{{"text": "t", "type": "reasoning"}}, {{"Headers": ["h"], "signature": "s", "text": "é' || k || '", "type": "text"}}], "thinking": "x", "token_count": 2}}') AS sha FROM log""",
    "envelope_violations": """SELECT CASE doc_id % 40 WHEN 3 THEN 'not_completed' WHEN 5 THEN 'not_completed' WHEN 9 THEN 'annotation_file' ELSE 'bad_source' END AS rule, doc_id FROM documents
        WHERE doc_id % 40 IN (3, 5, 8, 9) OR doc_id % 40 = 7 AND regexp_matches(sha256(text), '[a-f]')""",
    "chunk_coverage_breaches": f"""WITH {ITEMS}, n AS (SELECT doc_id, max(pos) AS z FROM items GROUP BY doc_id)
        SELECT 'coverage' AS rule, doc_id FROM n WHERE doc_id % 20 = 3 OR doc_id % 20 IN (2, 4) AND z >= 1
        UNION ALL SELECT 'repeated_item', doc_id FROM n WHERE doc_id % 20 = 3 UNION ALL SELECT 'repeated_chunk', doc_id FROM n WHERE doc_id % 20 = 5 AND z >= 8""",
    "reading_order_violations": f"""WITH {ITEMS}, o AS (SELECT * FROM items WHERE label <> 'list_item' OR doc_id % 20 = 6)
        SELECT 'repeated' AS rule, doc_id, item_id FROM o WHERE doc_id % 20 = 8 AND pos = 0
        UNION ALL SELECT 'unknown', doc_id, item_id FROM o WHERE doc_id % 20 = 1 AND suffix(item_id, '/2')
        UNION ALL SELECT 'not_a_leaf', doc_id, item_id FROM o WHERE label = 'list_item'
        UNION ALL SELECT 'other_source', doc_id, item_id FROM o WHERE doc_id % 20 = 7 AND pos % 3 = 0""",
    "item_violations": f"""WITH {ITEMS}
        SELECT 'bad_level' AS rule, doc_id, item_id FROM items WHERE level IS NOT NULL AND doc_id % 20 = 1 AND pos % 2 = 0
        UNION ALL SELECT 'bad_page', doc_id, item_id FROM items WHERE doc_id % 20 = 2 AND pos = 0
        UNION ALL SELECT 'unknown_parent', doc_id, item_id FROM items WHERE doc_id % 20 = 3 AND pos = 0
        UNION ALL SELECT 'unknown_heading', doc_id, item_id FROM items WHERE doc_id % 20 = 4
        UNION ALL SELECT 'not_a_heading', doc_id, item_id FROM items WHERE doc_id % 20 = 4 AND level IS NULL""",
    "answer_differences": """WITH r AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 1 - quality ELSE quality END AS quality FROM labels WHERE doc_id % 14 <> 0)
        SELECT *, 'saved' AS side FROM (SELECT doc_id, quality FROM labels EXCEPT ALL SELECT doc_id, quality FROM r) UNION ALL SELECT *, 'recomputed' FROM (SELECT doc_id, quality FROM r EXCEPT ALL SELECT doc_id, quality FROM labels)""",
    "registration_violations": """WITH d AS (SELECT o_custkey AS doc_id, o_orderkey % 50 AS fact_id, o_orderkey % 13 = 0 AS other, doc_id || '/' || fact_id AS key, o_custkey % 6 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer) AS known FROM orders)
        SELECT 'repeated_fact' AS rule, key FROM d GROUP BY key HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'unknown_document', key FROM d WHERE NOT known UNION ALL SELECT DISTINCT 'other_source', key FROM d WHERE known AND other""",
    "model_substitutions": f"WITH {LOG} SELECT event_id AS key, model AS asked_model, CASE WHEN k % 8 = 0 THEN 'model-9' ELSE model END AS model, CASE WHEN k % 15 = 0 THEN 'messages' ELSE 'chat' END AS style FROM log WHERE event = 'llm_attempt' AND (k % 8 = 0 OR k % 15 = 0)",
}

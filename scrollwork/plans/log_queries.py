"""Queries over logs, reviews and the corpus, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import money as M
from ..functions import text as T
from ..operators import audit, boundaries, reviews, stages, telemetry
from ..operators.topics import TOPICS
from ..sources import files, html
from .adapters import LOG, log, table


def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.run_summary(log(spark, d)).where("dimension = 'all'")


def run_summary_by_key(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.run_summary(log(spark, d)).where("dimension <> 'all'")


def run_costs(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.run_costs(log(spark, d))


def model_exchanges(spark: SparkSession, d: str) -> DataFrame:
    """Calls, ends of stages and failed batches stand for requests, responses and validation errors; two in five carry an
    attempt_id, and the log's stages stand for those that ask, validate and ask for themselves."""
    role = F.when(F.col("event") == "llm_attempt", "request").when(F.col("event") == "stage_finished", "response").when(F.col("event") == "batch_failed", "error")
    stage = F.element_at(F.create_map(*map(F.lit, ("A", "D2", "B2", "D3", "C", "B2"))), F.col("stage"))
    k = F.col("k")
    own = log(spark, d).select("run_id", F.col("event_id").alias("seq"), stage.alias("stage"), role.alias("role"), F.when(k % 5 < 2, F.concat(F.lit("a"), (k % 40).cast("string"))).alias("attempt_id"), "batch_id", "attempt")
    return telemetry.model_exchanges(own.where("role IS NOT NULL"))


def batch_status(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.batch_status(log(spark, d))


def staged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The log with skipped and cached stages and with events that have no span, and the jobs of four runs in five."""
    event, k = F.col("event"), F.col("k")
    other = F.when((event == "batch_failed") & (k % 4 == 1), "stage_skipped").when((event == "llm_attempt") & (k % 9 == 1), "cache_hit").otherwise(event)
    own = log(spark, d).withColumn("event", other).withColumn("span_id", F.when(k % 6 != 0, F.col("span_id")))
    states = F.array(*map(F.lit, ("running", "failed", "historical", "interrupted")))
    return own, own.select("run_id").distinct().where("run_id % 5 < 4").withColumn("status", F.get(states, (F.col("run_id") % 5).cast("int")))


def stage_status(spark: SparkSession, d: str) -> DataFrame:
    return stages.stage_status(*staged(spark, d))


def latest_boundary(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.latest_boundary(log(spark, d))


def _snapshots(spark: SparkSession, d: str) -> DataFrame:
    """An event is a snapshot of a stage's boundary: kind, fields and values by its number."""
    k, at = F.col("k"), F.col("event_id")
    kind = F.get(F.array(*map(F.lit, (*boundaries.KINDS, "request"))), (at % 5).cast("int"))
    field = F.get(F.array(*map(F.lit, ("signals", "chunks", "topic_signals_json_path"))), (k % 3).cast("int"))
    data = F.create_map(F.lit("k"), k.cast("string"), field, at.cast("string"), F.lit("_trace"), F.lit("t"))
    return log(spark, d).where("stage IS NOT NULL").select("run_id", at.alias("seq"), F.concat_ws("-", "stage", kind, F.lit("x.json")).alias("filename"), F.when(k % 6 != 0, F.col("span_id")).alias("span_id"), data.alias("data"))


def stage_boundaries(spark: SparkSession, d: str) -> DataFrame:
    """Two runs in three are of the present layout."""
    current = log(spark, d).where("run_id % 3 > 0").select("run_id")
    found = boundaries.stage_boundaries(_snapshots(spark, d), log(spark, d), current)
    return found.select("run_id", "stage", *[boundaries.shown(F.col(c)).alias(c) for c in ("input", "input_artifacts", "output", "return_value")], "n_events")


def run_layout(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.run_layout(log(spark, d))


def exchange_pairs(spark: SparkSession, d: str) -> DataFrame:
    role = F.when(F.col("role") == "user", "request").when(F.col("role") == "assistant", "response").otherwise("other")
    pairs = telemetry.exchange_pairs(table(spark, d, "conversations").select(F.col("conv_id").alias("key"), F.col("turn").alias("seq"), role.alias("role")))
    return pairs.select(F.col("key").alias("conv_id"), "request_seq", "response_seq")


def cost_estimate(spark: SparkSession, d: str) -> DataFrame:
    calls = log(spark, d).where("event = 'llm_attempt'")
    price = lambda a, b: F.when(F.col("model") == "model-0", F.lit(a)).when(F.col("model").isNotNull(), F.lit(b)).cast("decimal(9,4)")
    cost = M.estimated_cost(F.col("input_tokens"), F.col("k"), F.col("k") * 2, F.col("output_tokens"), {"input": price(0.25, 1.25), "cached": price(0.025, 0.125), "written": price(0.3, 1.5), "output": price(2, 10)}, 900)
    reported = F.when(F.col("cost_kind") == "reported", F.col("cents"))
    return calls.select("event_id", (cost * 1_000_000_000).cast("long").alias("billionths"), M.cost_choice(reported, F.col("currency"), F.lit(-1)).cast("long").alias("chosen"))


def usage_totals(spark: SparkSession, d: str) -> DataFrame:
    calls = log(spark, d).where("event = 'llm_attempt'")
    style = F.when(F.col("k") % 2 == 0, "messages").otherwise("chat")
    return calls.select("event_id", M.usage_totals(style, F.col("input_tokens"), F.col("output_tokens"), F.col("k"), F.when(F.col("k") % 7 == 0, -5).otherwise(3)).alias("u")).select("event_id", "u.*")


def retryable(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    return log(spark, d).select("event_id", M.is_retryable(F.when(k % 3 == 0, 400 + k), F.when(k % 5 == 0, "connection").when(k % 5 == 1, "refused")).alias("again"))


def decisions(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    word = F.when(F.col("o_orderstatus") == "O", "approved").when(F.col("o_orderstatus") == "F", "edited").when(F.col("o_orderkey") % 2 == 0, "rejected").otherwise("skipped")
    return o.select(F.col("o_custkey").alias("fact_id"), rank.alias("revision"), word.alias("decision"), F.col("o_orderkey").alias("note"))


def latest_decision(spark: SparkSession, d: str) -> DataFrame:
    return reviews.latest(decisions(spark, d)).select("fact_id", "revision", "decision", "note")


def decision_history(spark: SparkSession, d: str) -> DataFrame:
    return reviews.history(decisions(spark, d))


def decision_flags(spark: SparkSession, d: str) -> DataFrame:
    return reviews.flags(decisions(spark, d))


def _incoming(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, d, "customer").select(c.alias("fact_id"), (c % 16).alias("expected"), F.when(c % 9 == 0, "guessed").otherwise("approved").alias("decision"))


def cas_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return reviews.compare_and_set(decisions(spark, d), _incoming(spark, d)).select("fact_id", "expected", "current", "accepted")


def cas_applied(spark: SparkSession, d: str) -> DataFrame:
    return reviews.applied(decisions(spark, d), _incoming(spark, d)).groupBy("fact_id").agg(F.max("revision").alias("revision"))


def review_progress(spark: SparkSession, d: str) -> DataFrame:
    return reviews.progress(decisions(spark, d), table(spark, d, "customer").select(F.col("c_custkey").alias("fact_id")))


def annotation_upgrade(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("reviewed"), (F.col("doc_id") % 2 == 0).alias("legacy"), F.array(F.lit("covenants"), F.lit("contract_definitions"), F.when(F.col("toxic") == 1, "covenants").otherwise("default_and_remedies")).alias("topics"))
    up = reviews.upgraded(own, TOPICS, ("repayment_and_prepayment.call_protection",))
    return up.select("doc_id", F.array_join("reviewed_topics", ",").alias("reviewed_topics"), F.array_join(reviews.ordered_topics(F.col("topics"), TOPICS), ",").alias("topics"))


_TOXIC = "scum|worthless|pathetic|threat"


def label_scores(spark: SparkSession, d: str) -> DataFrame:
    labels, docs = table(spark, d, "labels"), table(spark, d, "documents")
    names = lambda bad, good: F.array_compact(F.array(F.when(bad, "toxic"), F.when(good, "good")))
    predicted = docs.select("doc_id", F.explode(names(F.col("text").rlike(_TOXIC), F.col("n_chars") > 400)).alias("label"))
    reference = labels.select("doc_id", F.explode_outer(names(F.col("toxic") == 1, F.col("quality") == 1)).alias("label"))
    return audit.agreement(predicted, reference)


def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return audit.exact_copies(table(spark, d, "documents"))


def keyword_screen(spark: SparkSession, d: str) -> DataFrame:
    return audit.keyword_screen(table(spark, d, "documents"), "(?i)licen[sc]e|password", "the|die|los|les")


def vintages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(audit.vintage(F.year("o_orderdate"), (1993, 1995, 1997)).alias("bucket")).agg(F.count("*").alias("n"))


def redact_fields(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    fields = F.create_map(F.lit("k"), k, F.lit("Api-Key"), F.concat(F.lit("x"), k), F.lit("note"), F.col("event_type"))
    return table(spark, d, "events").select("event_id", audit.redacted(fields).alias("f")).select("event_id", *[F.element_at("f", n).alias(a) for n, a in (("k", "k"), ("Api-Key", "api_key"), ("note", "note"))])


def pending_inputs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    manifest = docs.select("sha", F.when(F.col("doc_id") % 3 == 0, "completed").otherwise("running").alias("status"), F.when(F.col("doc_id") % 2 == 0, "plain").otherwise("deep").alias("profile"))
    return audit.not_completed(docs, manifest, "plain").select("doc_id")


def log_lines(spark: SparkSession, d: str) -> DataFrame:
    """Events as log files with a corrupt line here and an unfinished last line there."""
    texts = table(spark, d, "events").select((F.col("user_id")).cast("string").alias("path"), "event_id", "props")
    bad = F.when(F.col("event_id") % 40 == 0, F.lit("{oops")).when(F.col("event_id") % 31 == 0, F.lit("[1]")).when(F.col("event_id") % 17 == 0, F.lit("  ")).otherwise(F.col("props"))
    whole = texts.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", bad.alias("line")))), lambda s: s["line"]), "\n").alias("value"))
    return files.json_lines(whole).groupBy("path").agg(F.count("*").alias("n_lines"), F.sum(F.col("is_valid").cast("int")).alias("n_valid"), F.sum(F.col("is_tail").cast("int")).alias("n_tails"))


def snapshot_stages(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    name = F.concat(F.element_at(F.array(*map(F.lit, ("A", "B2", "A3.1", "E"))), (k % 4).cast("int") + 1), F.lit("-"), F.col("event_type"), F.lit("-"), F.lower(F.hex("event_id")), F.when(k % 5 == 0, ".txt").otherwise(".json"))
    return files.snapshot_names(table(spark, d, "events").select(name.alias("filename"), F.col("ts").alias("modificationTime"))).select("filename", "stage", "kind", "id")


def html_title(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", html.page_title(F.col("html")).alias("title"))


def html_items(spark: SparkSession, d: str) -> DataFrame:
    return html.convert(table(spark, d, "pages"), "page_id", "html")


def embedded_json(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.sha2(T.html_safe_json(F.col("html")).cast("binary"), 256).alias("sha"))


_SUMS = """count(*) AS request_count, CAST(sum(CASE WHEN is_failed THEN 1 ELSE 0 END) AS BIGINT) AS failed_count, CAST(sum(CASE WHEN attempt > 1 THEN 1 ELSE 0 END) AS BIGINT) AS retry_count,
  CAST(coalesce(sum(CASE WHEN input_tokens >= 0 THEN input_tokens END), 0) AS BIGINT) AS input_tokens, CAST(coalesce(sum(CASE WHEN output_tokens >= 0 THEN output_tokens END), 0) AS BIGINT) AS output_tokens,
  CAST(sum(CASE WHEN input_tokens >= 0 AND output_tokens >= 0 THEN 0 ELSE 1 END) AS BIGINT) AS unknown_usage, CAST(sum(CASE WHEN paid THEN 0 ELSE 1 END) AS BIGINT) AS unknown_cost,
  sum(CASE WHEN paid THEN 0 ELSE 1 END) = 0 AS cost_complete, CAST(sum(CASE WHEN cost_kind = 'estimated' THEN 1 ELSE 0 END) AS BIGINT) AS estimated_count,
  CAST(coalesce(sum(latency_ms), 0) AS BIGINT) AS latency_ms"""
_CALLS = f"""WITH {LOG}, calls AS (
  SELECT *, cost_kind IN ('estimated', 'reported') AND cents IS NOT NULL AND currency <> '' AS paid,
    status = 'failed' OR EXISTS (SELECT 1 FROM log f WHERE f.event = 'stage_finished' AND f.status = 'failed' AND f.stage = 'C' AND f.run_id = l.run_id AND f.span_id = l.span_id)
    OR EXISTS (SELECT 1 FROM log f WHERE f.event = 'batch_failed' AND f.run_id = l.run_id AND f.source IS NOT DISTINCT FROM l.source AND f.batch_id IS NOT DISTINCT FROM l.batch_id AND f.attempt = l.attempt) AS is_failed
  FROM log l WHERE event = 'llm_attempt')"""
_BY = " UNION ALL ".join(f"SELECT run_id, '{c}' AS dimension, coalesce({c}, 'unknown') AS value, {_SUMS} FROM calls GROUP BY run_id, coalesce({c}, 'unknown')" for c in ("model", "stage", "source"))
_DECISIONS = """WITH decisions AS (SELECT o_custkey AS fact_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS revision, o_orderkey AS note,
  CASE WHEN o_orderstatus = 'O' THEN 'approved' WHEN o_orderstatus = 'F' THEN 'edited' WHEN o_orderkey % 2 = 0 THEN 'rejected' ELSE 'skipped' END AS decision FROM orders),
  current AS (SELECT fact_id, max(revision) AS current FROM decisions GROUP BY fact_id)"""
_VOCABULARY = ", ".join(f"'{t}'" for t in TOPICS)
_OLD = ",".join(t for t in TOPICS if t != "repayment_and_prepayment.call_protection")

QUERIES = {f.__name__: f for f in (run_summary, run_summary_by_key, run_costs, model_exchanges, batch_status, stage_status, latest_boundary, stage_boundaries, run_layout, exchange_pairs, cost_estimate, usage_totals, retryable, latest_decision, decision_history, decision_flags, cas_conflicts, cas_applied, review_progress, annotation_upgrade, label_scores, exact_duplicates, keyword_screen, vintages, redact_fields, pending_inputs, log_lines, snapshot_stages, html_title, html_items, embedded_json)}

ORACLES = {
    "run_summary": f"{_CALLS} SELECT run_id, 'all' AS dimension, 'all' AS value, {_SUMS} FROM calls GROUP BY run_id",
    "run_summary_by_key": f"{_CALLS} {_BY}",
    "run_costs": f"{_CALLS} SELECT run_id, 'all' AS dimension, 'all' AS value, currency, CAST(sum(cents) AS BIGINT) AS cents FROM calls WHERE paid GROUP BY ALL" + "".join(f" UNION ALL SELECT run_id, '{c}', coalesce({c}, 'unknown'), currency, CAST(sum(cents) AS BIGINT) FROM calls WHERE paid GROUP BY ALL" for c in ("model", "stage", "source")),
    "model_exchanges": f"""WITH {LOG}, m AS (SELECT run_id, event_id AS seq, event, batch_id, attempt, CASE WHEN k % 5 < 2 THEN 'a' || (k % 40) END AS attempt_id,
            CASE stage WHEN 'A' THEN 'D2' WHEN 'C' THEN 'B2' WHEN 'B2' THEN CASE WHEN event = 'batch_failed' THEN 'D2' END END AS stage FROM log WHERE event IN ('llm_attempt', 'stage_finished', 'batch_failed')),
        r AS (SELECT *, lead(seq) OVER (PARTITION BY run_id, stage, batch_id, attempt ORDER BY seq) AS same FROM m WHERE event = 'llm_attempt' AND stage IS NOT NULL),
        named AS (SELECT r.run_id, r.seq, min(m.seq) FILTER (WHERE m.event = 'stage_finished') AS response_seq, min(m.seq) FILTER (WHERE m.event = 'batch_failed') AS error_seq
          FROM r LEFT JOIN m ON m.run_id = r.run_id AND m.stage = r.stage AND m.seq > r.seq AND m.attempt_id = r.attempt_id WHERE r.attempt_id IS NOT NULL GROUP BY ALL),
        plain AS (SELECT r.run_id, r.seq, min(m.seq) FILTER (WHERE m.event = 'stage_finished') AS response_seq, min(m.seq) FILTER (WHERE m.event = 'batch_failed') AS error_seq
          FROM r LEFT JOIN m ON m.run_id = r.run_id AND m.stage = r.stage AND m.seq > r.seq AND m.seq < coalesce(r.same, 9223372036854775807) AND m.batch_id IS NOT DISTINCT FROM r.batch_id AND m.attempt = r.attempt WHERE r.attempt_id IS NULL GROUP BY ALL)
        SELECT run_id, seq AS request_seq, response_seq, error_seq FROM named UNION ALL SELECT run_id, seq, response_seq, error_seq FROM plain""",
    "stage_status": f"""WITH {LOG}, own AS (SELECT run_id, stage, event_id, CASE WHEN event = 'batch_failed' AND k % 4 = 1 THEN 'stage_skipped' WHEN event = 'llm_attempt' AND k % 9 = 1 THEN 'cache_hit' ELSE event END AS event,
            CASE WHEN k % 6 <> 0 THEN span_id END AS span, status FROM log WHERE stage IS NOT NULL),
        kept AS (SELECT *, event = 'stage_finished' AS ends FROM own WHERE event IN ('stage_started', 'stage_finished', 'stage_skipped', 'cache_hit')),
        last AS (SELECT run_id, stage, arg_max(event, event_id) AS event, arg_max(status, event_id) AS said FROM kept GROUP BY ALL),
        bad AS (SELECT DISTINCT run_id, stage FROM kept f WHERE ends AND status = 'failed' AND NOT EXISTS (SELECT 1 FROM kept x WHERE x.run_id = f.run_id AND x.stage = f.stage AND NOT x.ends AND x.event_id > f.event_id)),
        active AS (SELECT run_id, stage, count(*) AS n FROM (SELECT run_id, stage, span, arg_max(event, event_id) AS event FROM kept WHERE span IS NOT NULL AND event LIKE 'stage_%ed' AND event <> 'stage_skipped' GROUP BY ALL) WHERE event = 'stage_started' GROUP BY ALL),
        counts AS (SELECT run_id, stage, count(*) AS n FROM own GROUP BY ALL),
        runs AS (SELECT DISTINCT run_id, CASE run_id % 5 WHEN 0 THEN 'running' WHEN 1 THEN 'failed' WHEN 2 THEN 'historical' WHEN 3 THEN 'interrupted' END AS job FROM log),
        s AS (SELECT run_id, stage, job, coalesce(c.n, 0) AS n_events, coalesce(a.n, 0) AS n_active,
            CASE l.event WHEN 'stage_started' THEN 'running' WHEN 'stage_skipped' THEN 'skipped' WHEN 'cache_hit' THEN 'cached'
              WHEN 'stage_finished' THEN CASE WHEN b.run_id IS NOT NULL THEN 'failed' WHEN a.n > 0 THEN 'running' ELSE l.said END
              ELSE CASE WHEN job IS NULL OR job = 'historical' THEN 'unrecorded' ELSE 'waiting' END END AS status
          FROM runs CROSS JOIN (SELECT unnest({list(stages.STAGES)}) AS stage) LEFT JOIN last l USING (run_id, stage) LEFT JOIN bad b USING (run_id, stage) LEFT JOIN active a USING (run_id, stage) LEFT JOIN counts c USING (run_id, stage))
        SELECT run_id, stage, CASE WHEN status = 'running' AND job IN ('failed', 'interrupted') THEN 'interrupted' WHEN status = 'running' AND job = 'historical' THEN 'unrecorded' ELSE status END AS status, n_events, n_active FROM s""",
    "batch_status": f"""WITH {LOG}, last AS (SELECT run_id, batch_id, arg_max(event, event_id) AS event FROM log WHERE batch_id IS NOT NULL AND stage = 'B2' AND event LIKE 'batch_%' GROUP BY ALL)
        SELECT run_id, {", ".join(f"count(*) FILTER (WHERE event = '{e}') AS n_{n}" for e, n in telemetry.BATCH_STATES.items())} FROM last GROUP BY run_id""",
    "stage_boundaries": f"""WITH {LOG}, snap AS (SELECT run_id, stage, event_id AS seq, k, event_id % 5 AS kind, ['signals', 'chunks', 'topic_signals_json_path'][k % 3 + 1] AS field,
            CASE WHEN k % 6 <> 0 THEN span_id END AS span, run_id % 3 > 0 AND stage = 'B2' AS late FROM log WHERE stage IS NOT NULL),
        lastspan AS (SELECT run_id, arg_max(coalesce(span, ''), seq) AS span FROM snap WHERE stage = 'C' AND kind IN (2, 3) GROUP BY run_id),
        fit AS (SELECT s.* FROM snap s LEFT JOIN lastspan l USING (run_id) WHERE stage <> 'C' OR coalesce(l.span, '') = '' OR s.span = l.span),
        inputs AS (SELECT run_id, stage, list_aggregate([x.field || '=' || x.value FOR x IN list(struct_pack(field := field, value := value) ORDER BY field)], 'string_agg', ',') AS v FROM (
          SELECT run_id, stage, field, arg_max(value, seq) AS value FROM (
            SELECT run_id, stage, seq, 'k' AS field, CAST(k AS VARCHAR) AS value, late FROM snap WHERE kind = 0 UNION ALL SELECT run_id, stage, seq, field, CAST(seq AS VARCHAR), late FROM snap WHERE kind = 0)
          WHERE NOT (late AND field IN ('signals', 'topic_signals_json_path')) GROUP BY ALL) GROUP BY ALL),
        whole AS (SELECT *, CASE WHEN field < 'k' THEN '_trace=t,' || field || '=' || seq || ',k=' || k ELSE '_trace=t,k=' || k || ',' || field || '=' || seq END AS v FROM fit),
        ins AS (SELECT run_id, stage, arg_max(v, seq) AS v FROM whole WHERE kind = 2 GROUP BY ALL),
        outs AS (SELECT run_id, stage, arg_max(v, seq) AS v FROM whole WHERE kind = 3 GROUP BY ALL),
        arts AS (SELECT run_id, stage, arg_max(CASE WHEN late AND field = 'topic_signals_json_path' THEN 'k=' || k WHEN field < 'k' THEN field || '=' || seq || ',k=' || k ELSE 'k=' || k || ',' || field || '=' || seq END, seq) AS v FROM snap WHERE kind = 1 GROUP BY ALL),
        n AS (SELECT run_id, stage, count(*) AS n FROM log WHERE stage IS NOT NULL GROUP BY ALL)
        SELECT r.run_id, r.stage, ins.v AS input, coalesce(inputs.v, '') AS input_artifacts, arts.v AS output, outs.v AS return_value, coalesce(n.n, 0) AS n_events
        FROM (SELECT DISTINCT run_id, s.stage FROM snap, (SELECT unnest({list(boundaries.REVIEWED)}) AS stage) s) r LEFT JOIN ins USING (run_id, stage) LEFT JOIN inputs USING (run_id, stage) LEFT JOIN arts USING (run_id, stage) LEFT JOIN outs USING (run_id, stage) LEFT JOIN n USING (run_id, stage)""",
    "latest_boundary": f"""WITH {LOG}, last AS (SELECT run_id, arg_max(span_id, event_id) AS span_id FROM log WHERE event = 'llm_attempt' GROUP BY run_id)
        SELECT run_id, span_id, max(event_id) FILTER (WHERE event = 'stage_started') AS last_input, max(event_id) FILTER (WHERE event = 'stage_finished') AS last_output FROM log JOIN last USING (run_id, span_id) GROUP BY ALL""",
    "run_layout": f"WITH {LOG} SELECT run_id, bool_or(event LIKE 'batch_%') AS has_batches, bool_or(event LIKE 'stage_%') AS has_stages FROM log GROUP BY run_id",
    "exchange_pairs": """WITH r AS (SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations WHERE role = 'user')
        SELECT r.conv_id, r.turn AS request_seq, min(a.turn) AS response_seq FROM r LEFT JOIN conversations a ON a.conv_id = r.conv_id AND a.role = 'assistant' AND a.turn > r.turn AND (r.next IS NULL OR a.turn < r.next) GROUP BY ALL""",
    "cost_estimate": f"""WITH {LOG}, p AS (SELECT *, CASE WHEN model = 'model-0' THEN 1 WHEN model IS NOT NULL THEN 5 END AS scale FROM log WHERE event = 'llm_attempt')
        SELECT event_id, CASE WHEN input_tokens >= 0 AND output_tokens >= 0 AND 3 * k <= input_tokens AND input_tokens <= 900
          THEN CAST(scale * ((input_tokens - 3 * k) * 250 + k * 25 + k * 600 + output_tokens * 2000) AS BIGINT) END AS billionths,
          CASE WHEN cost_kind = 'reported' AND cents >= 0 AND currency <> '' THEN cents ELSE -1 END AS chosen FROM p""",
    "usage_totals": f"WITH {LOG} SELECT event_id, CASE WHEN k % 2 = 0 THEN CASE WHEN k % 7 <> 0 THEN input_tokens + k + 3 END ELSE input_tokens END AS input_tokens, CASE WHEN output_tokens >= 0 THEN output_tokens END AS output_tokens FROM log WHERE event = 'llm_attempt'",
    "retryable": f"WITH {LOG} SELECT event_id, (k % 3 = 0 AND (400 + k = 429 OR 400 + k >= 500)) OR k % 5 = 0 AS again FROM log",
    "latest_decision": f"{_DECISIONS} SELECT fact_id, revision, decision, note FROM decisions d WHERE revision = (SELECT max(revision) FROM decisions e WHERE e.fact_id = d.fact_id)",
    "decision_history": f"{_DECISIONS} SELECT fact_id, revision, decision, lag(decision) OVER (PARTITION BY fact_id ORDER BY revision) AS previous FROM decisions",
    "decision_flags": f"{_DECISIONS} SELECT fact_id, revision, decision IN ('approved', 'edited') AS approved_for_reference, CASE decision WHEN 'approved' THEN 'supported' WHEN 'skipped' THEN 'unreviewed' ELSE decision END AS value_status FROM decisions",
    "cas_conflicts": f"{_DECISIONS} SELECT c_custkey AS fact_id, c_custkey % 16 AS expected, coalesce(current, 0) AS current, c_custkey % 16 = coalesce(current, 0) AND c_custkey % 9 <> 0 AS accepted FROM customer LEFT JOIN current ON fact_id = c_custkey",
    "cas_applied": f"{_DECISIONS}, new AS (SELECT c_custkey AS fact_id, coalesce(current, 0) + 1 AS revision FROM customer LEFT JOIN current ON fact_id = c_custkey WHERE c_custkey % 16 = coalesce(current, 0) AND c_custkey % 9 <> 0) SELECT fact_id, max(revision) AS revision FROM (SELECT * FROM new UNION ALL SELECT fact_id, revision FROM decisions) GROUP BY fact_id",
    "review_progress": f"""{_DECISIONS}, last AS (SELECT d.* FROM decisions d JOIN current c ON c.fact_id = d.fact_id AND c.current = d.revision)
        SELECT count(*) AS n_facts, count(*) FILTER (WHERE decision IN ('approved', 'edited', 'rejected')) AS n_reviewed, count(*) FILTER (WHERE decision IN ('approved', 'edited')) AS n_approved, count(*) FILTER (WHERE decision = 'skipped') AS n_skipped,
          100 * count(*) FILTER (WHERE decision IN ('approved', 'edited', 'rejected')) // count(*) AS percent FROM customer LEFT JOIN last ON fact_id = c_custkey""",
    "annotation_upgrade": f"""SELECT doc_id, CASE WHEN quality <> 1 THEN '' WHEN doc_id % 2 = 0 THEN '{_OLD}' ELSE '{",".join(TOPICS)}' END AS reviewed_topics,
        CASE WHEN toxic = 1 THEN 'contract_definitions,covenants' ELSE 'contract_definitions,covenants,default_and_remedies' END AS topics FROM labels""",
    "label_scores": f"""WITH p AS (SELECT doc_id, 'toxic' AS label FROM documents WHERE regexp_matches(text, '{_TOXIC}') UNION ALL SELECT doc_id, 'good' FROM documents WHERE n_chars > 400),
        r AS (SELECT doc_id, 'toxic' AS label FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, 'good' FROM labels WHERE quality = 1),
        j AS (SELECT coalesce(p.doc_id, r.doc_id) AS doc_id, p.label IS NOT NULL AS p, r.label IS NOT NULL AS r FROM (SELECT * FROM p WHERE doc_id IN (SELECT doc_id FROM labels)) p FULL JOIN r ON p.doc_id = r.doc_id AND p.label = r.label),
        s AS (SELECT count(*) FILTER (WHERE p AND r) AS tp, count(*) FILTER (WHERE p AND NOT r) AS fp, count(*) FILTER (WHERE r AND NOT p) AS fn FROM j)
        SELECT (SELECT count(DISTINCT doc_id) FROM labels) AS n_docs, tp, fp, fn, (SELECT count(DISTINCT doc_id) FROM labels) - (SELECT count(DISTINCT doc_id) FROM j WHERE p <> r) AS n_exact,
          10000 * tp // (tp + fp) AS precision, 10000 * tp // (tp + fn) AS recall, 20000 * tp // (2 * tp + fp + fn) AS f1 FROM s""",
    "exact_duplicates": "SELECT sha256(text) AS sha, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY sha256(text) HAVING count(*) > 1",
    "keyword_screen": "SELECT doc_id, source FROM documents WHERE regexp_matches(text, '(?i)licen[sc]e|password') AND regexp_matches(text, 'the|die|los|les')",
    "vintages": "SELECT CASE WHEN y < 1993 THEN 'before 1993' WHEN y < 1995 THEN '1993-1994' WHEN y < 1997 THEN '1995-1996' ELSE 'from 1997' END AS bucket, count(*) AS n FROM (SELECT year(o_orderdate) AS y FROM orders) GROUP BY 1",
    "redact_fields": "SELECT event_id, json_extract_string(props, '$.k') AS k, '[REDACTED]' AS api_key, event_type AS note FROM events",
    "pending_inputs": "SELECT doc_id FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 6 = 0)",
    "log_lines": """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS path, event_id, CASE WHEN event_id % 40 = 0 THEN 'bad' WHEN event_id % 31 = 0 THEN 'bad' WHEN event_id % 17 = 0 THEN 'blank' ELSE 'good' END AS kind,
          event_id = max(event_id) OVER (PARTITION BY user_id) AS last FROM events)
        SELECT path, count(*) AS n_lines, count(*) FILTER (WHERE kind = 'good') AS n_valid, count(*) FILTER (WHERE kind = 'bad' AND last) AS n_tails FROM e WHERE kind <> 'blank' GROUP BY path""",
    "snapshot_stages": """SELECT ['A', 'B2', 'A3.1', 'E'][event_id % 4 + 1] || '-' || event_type || '-' || lower(to_hex(event_id)) || '.json' AS filename, ['A', 'B2', 'A3.1', 'E'][event_id % 4 + 1] AS stage, event_type AS kind, lower(to_hex(event_id)) AS id
        FROM events WHERE event_id % 5 <> 0 AND event_id % 4 <> 3""",
    "html_title": "SELECT page_id, nullif(trim(replace(replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')), '') AS title FROM pages",
    "embedded_json": "SELECT page_id, sha256(replace(replace(replace(html, '&', '\\u0026'), '<', '\\u003c'), '>', '\\u003e')) AS sha FROM pages",
}

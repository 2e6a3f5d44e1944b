"""Analytics of a pipeline's append-only log: runs, batches, stages, request and response pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.money import valid_tokens

#: The stages that ask a model, and the stage whose validation errors are another's.
EXCHANGES, VALIDATION = ("B2", "D2"), ("D3", "D2")
#: The stages that classify in batches and that extract, and what the events of a batch make of it.
CLASSIFICATION, EXTRACTION = "B2", "C"
BATCH_STATES = {"batch_attempt": "active", "batch_validated": "completed", "batch_reused": "reused", "batch_failed": "failed"}


def calls_with_failures(log: DataFrame) -> DataFrame:
    """Model calls with is_failed: they failed themselves, or the extraction stage's span did, or their batch attempt did. Missing parts
    of a batch attempt's key are equal to missing parts."""
    calls = log.where("event = 'llm_attempt'")
    spans = log.where(f"event = 'stage_finished' AND status = 'failed' AND stage = '{EXTRACTION}'").select("run_id", "span_id", F.lit(True).alias("span_failed")).distinct()
    key = ["run_id", "source", "batch_id", "attempt"]
    batches = log.where("event = 'batch_failed'").select(*[F.col(c).alias(f"f_{c}") for c in key], F.lit(True).alias("batch_failed")).distinct()
    same = F.lit(True)
    for c in key:
        same = same & calls[c].eqNullSafe(F.col(f"f_{c}"))
    joined = calls.join(spans, ["run_id", "span_id"], "left").join(batches, (calls["run_id"] == F.col("f_run_id")) & same, "left")
    return joined.withColumn("is_failed", (F.col("status") == "failed") | F.coalesce("span_failed", F.lit(False)) | F.coalesce("batch_failed", F.lit(False)))


def _by_dimension(log: DataFrame, more: list[str], sums: list[Column]) -> DataFrame:
    """Sums over each run's calls, in all and by model, by stage and by source, in one aggregation."""
    calls = calls_with_failures(log)
    named = calls.select("*", *[F.coalesce(c, F.lit("unknown")).alias(f"by_{c}") for c in ("model", "stage", "source")])
    sets = [[F.col(c) for c in ("run_id", *more, *by)] for by in ((), ("by_model",), ("by_stage",), ("by_source",))]
    grouped = named.groupingSets(sets, "run_id", *more, "by_model", "by_stage", "by_source").agg(F.grouping("by_model").alias("g0"), F.grouping("by_stage").alias("g1"), F.grouping("by_source").alias("g2"), *sums)
    dimension = F.when(F.col("g0") == 0, "model").when(F.col("g1") == 0, "stage").when(F.col("g2") == 0, "source").otherwise("all")
    return grouped.withColumn("dimension", dimension).withColumn("value", F.coalesce("by_model", "by_stage", "by_source", F.lit("all")))


_PAID = "cost_kind IN ('estimated', 'reported') AND cents IS NOT NULL AND currency <> ''"


def run_summary(log: DataFrame) -> DataFrame:
    """Counts, tokens and latency of each run's calls, in all and by model, by stage and by source."""
    paid = F.coalesce(F.expr(_PAID), F.lit(False))
    known = valid_tokens(F.col("input_tokens")).isNotNull() & valid_tokens(F.col("output_tokens")).isNotNull()
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = [
        F.count("*").alias("request_count"),
        count(F.col("is_failed")).alias("failed_count"),
        count(F.col("attempt") > 1).alias("retry_count"),
        total(valid_tokens(F.col("input_tokens"))).alias("input_tokens"),
        total(valid_tokens(F.col("output_tokens"))).alias("output_tokens"),
        count(~known).alias("unknown_usage"),
        count(~paid).alias("unknown_cost"),
        count(F.col("cost_kind") == "estimated").alias("estimated_count"),
        total(F.col("latency_ms")).alias("latency_ms"),
    ]
    names = ["request_count", "failed_count", "retry_count", "input_tokens", "output_tokens", "unknown_usage", "unknown_cost"]
    return _by_dimension(log, [], sums).select("run_id", "dimension", "value", *names, (F.col("unknown_cost") == 0).alias("cost_complete"), "estimated_count", "latency_ms")


def run_costs(log: DataFrame) -> DataFrame:
    """Known costs of each run's calls in every currency they have, in all and by model, by stage and by source."""
    return _by_dimension(log, ["currency"], [F.sum(F.when(F.expr(_PAID), F.col("cents"))).alias("cents")]).where("cents IS NOT NULL").select("run_id", "dimension", "value", "currency", "cents")


def batch_status(log: DataFrame) -> DataFrame:
    """The classification's batches of each run by their last event: active, completed, reused, failed."""
    own = log.where(F.col("event").isin(*BATCH_STATES) & (F.col("stage") == CLASSIFICATION) & F.col("batch_id").isNotNull())
    last = own.groupBy("run_id", "batch_id").agg(F.max_by("event", "event_id").alias("event"))
    return last.groupBy("run_id").agg(*[F.sum(F.when(F.col("event") == e, 1).otherwise(0)).alias(f"n_{state}") for e, state in BATCH_STATES.items()])


def _later(*key: str) -> WindowSpec:
    """The messages of a key that come after one. From the last one back, as Spark carries an aggregate on only where its
    rows grow from the start; towards the end it begins anew at every row."""
    return Window.partitionBy(*key).orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)


def exchange_pairs(messages: DataFrame) -> DataFrame:
    """Each request with the first response after it and before the next request: key, request_seq, response_seq.

    `messages`: key, seq, role (request, response, or other). One window over the key, no join.
    """
    after = _later("key")
    next_of = lambda r: F.min(F.when(F.col("role") == r, F.col("seq"))).over(after)
    looked = messages.where("role IN ('request', 'response')").select("key", "seq", "role", next_of("request").alias("next_request"), next_of("response").alias("next_response"))
    answered = F.when(F.col("next_response") < F.coalesce("next_request", F.lit(2**62)), F.col("next_response"))
    return looked.where("role = 'request'").select("key", F.col("seq").alias("request_seq"), answered.alias("response_seq"))


def model_exchanges(messages: DataFrame, stages: tuple[str, ...] = EXCHANGES) -> DataFrame:
    """Each request of these stages with the first response and the first validation error that belong to it: run_id,
    request_seq, response_seq, error_seq.

    `messages`: run_id, seq, stage, role (request, response, error), attempt_id, batch_id, attempt. A request with an
    attempt_id has what comes later with the same one, however far. One without has what comes later with the same batch and
    attempt, missing ones alike, up to the next request with these. Either way only of its own stage; the errors of the
    stage that validates the last one are that one's. Answers may interleave. One window each, no join.
    """
    owner = F.when((F.col("role") == "error") & (F.col("stage") == VALIDATION[0]), VALIDATION[1]).otherwise(F.col("stage"))
    messages = messages.withColumn("stage", owner).where(F.col("stage").isin(*stages))

    def looked(rows: DataFrame, key: list[str]) -> DataFrame:
        after = _later("run_id", "stage", *key)
        first = lambda r: F.min(F.when(F.col("role") == r, F.col("seq"))).over(after).alias(f"{r}_next")
        return rows.select("run_id", "seq", "role", "attempt_id", *map(first, ("request", "response", "error"))).where("role = 'request'")

    seen = lambda r, end: F.when(F.col(f"{r}_next") < end, F.col(f"{r}_next")).alias(f"{r}_seq")
    far = F.lit(1 << 62)
    named = looked(messages.where("attempt_id <> ''"), ["attempt_id"])
    plain = looked(messages, ["batch_id", "attempt"]).where("attempt_id IS NULL OR attempt_id = ''")
    out = [f.select("run_id", F.col("seq").alias("request_seq"), seen("response", end), seen("error", end)) for f, end in ((named, far), (plain, F.coalesce("request_next", far)))]
    return out[0].unionByName(out[1])


def latest_boundary(log: DataFrame) -> DataFrame:
    """Of each run's last span that took a call: its last start and its last end (null if it has none)."""
    last = log.where("event = 'llm_attempt'").groupBy("run_id").agg(F.max_by("span_id", "event_id").alias("span_id"))
    own = log.join(last, ["run_id", "span_id"])
    at = lambda e: F.max(F.when(F.col("event") == e, F.col("event_id")))
    return own.groupBy("run_id", "span_id").agg(at("stage_started").alias("last_input"), at("stage_finished").alias("last_output"))


def run_layout(log: DataFrame) -> DataFrame:
    """Whether a run has batches, and whether it has stages."""
    has = lambda p: F.bool_or(F.col("event").startswith(p))
    return log.groupBy("run_id").agg(has("batch_").alias("has_batches"), has("stage_").alias("has_stages"))

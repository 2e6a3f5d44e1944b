"""Which API a model is asked by and what it costs, which settings a run may have, and which document a past run was about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import estimated_cost
from .messages import effort_problem

#: The API style of each model.
ROUTES = {
    "gpt-5.6-luna": "responses",
    "gpt-5.6-sol": "responses",
    "gpt-5.6-terra": "responses",
    "gpt-6-luna": "responses",
    "qwen3.8-max": "chat_completions",
    "qwen3.8-flash": "messages",
    "deepseek-v4.1-flash": "chat_completions",
    "deepseek-v4-pro": "chat_completions",
    "deepseek-v4-flash": "chat_completions",
}
#: List prices of a million tokens, and the most input tokens they hold for.
PRICES = (("gpt-5.6-luna", "2026-10-01", "USD", "0.20", "0.02", "0.25", "1.20", 272_000),)
#: What a model may be called.
MODEL_NAME = "^[A-Za-z0-9_.-]{1,100}$"
_MONEY = "decimal(12,6)"


def routes(spark: SparkSession, table: dict[str, str] | None = None) -> DataFrame:
    """model, style."""
    return spark.createDataFrame(list((ROUTES if table is None else table).items()), "model string, style string")


def prices(spark: SparkSession, rows=PRICES) -> DataFrame:
    """model, priced_on, currency, input, cached, written, output (of a million tokens), most_input. No rows: no estimates."""
    frame = spark.createDataFrame(list(rows), "model string, priced_on string, currency string, input string, cached string, written string, output string, most_input long")
    return frame.withColumns({c: F.col(c).cast(_MONEY) for c in ("input", "cached", "written", "output")})


def routed(requests: DataFrame, table: DataFrame) -> DataFrame:
    """Requests (model, style or null, and more) with style: the one asked for, else the model's; null if neither is known."""
    own = table.select("model", F.col("style").alias("model_style"))
    return requests.join(own, "model", "left").withColumn("style", F.coalesce("style", "model_style")).drop("model_style")


def priced(calls: DataFrame, table: DataFrame) -> DataFrame:
    """Calls (model, input_tokens, cached_tokens, written_tokens, output_tokens, and more) with estimate and currency by their
    model's prices; null for models without a price, and where the tokens do not add up or are more than prices hold for."""
    joined = calls.join(table, "model", "left")
    cost = estimated_cost(F.col("input_tokens"), F.col("cached_tokens"), F.col("written_tokens"), F.col("output_tokens"), {c: F.col(c) for c in ("input", "cached", "written", "output")}, F.col("most_input"))
    return joined.select(*calls.columns, cost.alias("estimate"), F.when(cost.isNotNull(), F.col("currency")).alias("currency"))


#: Names of settings and their defaults' kinds: flags, models with the setting of their effort.
FLAGS, MODELS = ("use_hierarchy", "debug"), {"model": "reasoning_effort", "classification_model": "classification_reasoning_effort"}


def settings_problems(settings: DataFrame, table: DataFrame, documents: DataFrame) -> DataFrame:
    """`settings` (run_id, value: a variant) with problem, the first that holds, or null: not_an_object, unknown_setting,
    unknown_document, not_a_flag, bad_model, unrouted_model, unknown_effort, effort_not_in_style. Settings that are not named
    have their defaults, which are right. `documents`: document_id."""
    known = [*FLAGS, *MODELS, *MODELS.values(), "document_id"]
    kind = lambda c: F.regexp_extract(F.schema_of_variant(c), "^[A-Z]+", 0)
    field = lambda name: F.try_variant_get("value", f"$.{name}", "variant")
    text = lambda name: F.when(kind(field(name)) == "STRING", F.try_variant_get("value", f"$.{name}", "string"))
    names = F.map_keys(F.try_variant_get("value", "$", "map<string,variant>"))
    own = settings.withColumn("document_id", text("document_id"))
    for model in MODELS:
        style = table.select(F.col("model").alias(f"{model}_name"), F.col("style").alias(f"{model}_style"))
        own = own.withColumn(f"{model}_name", text(model)).join(style, f"{model}_name", "left")
    own = own.join(documents.select("document_id", F.lit(True).alias("registered")).distinct(), "document_id", "left")
    given = lambda name: field(name).isNotNull()
    any_of = lambda conditions: F.coalesce(F.array_max(F.array(*[F.coalesce(c, F.lit(False)) for c in conditions])), F.lit(False))

    def effort(model: str, setting: str) -> Column:
        style = F.coalesce(F.col(f"{model}_style"), F.lit("responses"))
        return F.when(given(setting), F.when(text(setting).isNull(), "unknown_effort").otherwise(effort_problem(style, text(setting))))

    rules = [
        ("not_an_object", ~F.coalesce(kind(F.col("value")) == "OBJECT", F.lit(False))),
        ("unknown_setting", F.size(F.array_except(names, F.array(*map(F.lit, known)))) > 0),
        ("unknown_document", F.col("registered").isNull()),
        ("not_a_flag", any_of([given(f) & (kind(field(f)) != "BOOLEAN") for f in FLAGS])),
        ("bad_model", any_of([given(m) & ~F.coalesce(text(m).rlike(MODEL_NAME), F.lit(False)) for m in MODELS])),
        ("unrouted_model", any_of([given(m) & F.col(f"{m}_style").isNull() for m in MODELS])),
    ]
    problem = F.coalesce(*[F.when(broken, name) for name, broken in rules], *[effort(m, e) for m, e in MODELS.items()])
    return own.select(*settings.columns, problem.alias("problem"))


def run_sources(runs: DataFrame, captures: DataFrame, documents: DataFrame) -> DataFrame:
    """runs (run_id) with document_id: of the first captured path that is a registered document's, else of the first captured
    hash that is one's content; null if neither is.

    `captures`: run_id, seq, path, sha (either may be null). `documents`: document_id, path, sha. Two joins on equality and a
    minimum for each run.
    """
    wellformed = F.col("sha").rlike("^[0-9a-f]{64}$")
    by_path = captures.where("path IS NOT NULL").join(documents.select("document_id", "path"), "path").groupBy("run_id").agg(F.min_by("document_id", F.struct("seq", "document_id")).alias("by_path"))
    shas = documents.groupBy("sha").agg(F.max("document_id").alias("document_id"))
    by_sha = captures.where(wellformed).select("run_id", "seq", "sha").join(shas, "sha").groupBy("run_id").agg(F.min_by("document_id", F.struct("seq", "document_id")).alias("by_sha"))
    return runs.join(by_path, "run_id", "left").join(by_sha, "run_id", "left").select(*runs.columns, F.coalesce("by_path", "by_sha").alias("document_id"))

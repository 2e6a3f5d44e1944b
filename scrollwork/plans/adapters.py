"""The canonical document model and event log, read from plain tables.

Lines of a document are its items in reading order. A short line is a heading, stretches of three other lines alternate
between list items and paragraphs, and English documents have pages (with every fifth line off the page).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Longest heading, lines of a page, lines of a list.
HEADING, PAGE_LINES, LIST_LINES = 60, 8, 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang, pos, item_id, text, page, label, level, list_key: one row per line.

    Lengths are taken before rows are dealt by document, so a query that needs no text shuffles and sorts none.
    """
    lines = table(spark, sf_dir, "documents").select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    sized = lines.withColumn("n", F.length("text"))
    heading = F.col("n") <= HEADING
    block = F.floor(F.col("pos") / LIST_LINES).cast("int")
    listed = ~heading & (block % 2 == 0)
    so_far = F.sum(heading.cast("int")).over(Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return sized.select(
        "doc_id",
        "lang",
        "pos",
        F.concat(F.lit("#/texts/"), "pos").alias("item_id"),
        "text",
        F.when((F.col("lang") == "en") & (F.col("pos") % 5 != 4), F.floor(F.col("pos") / PAGE_LINES).cast("int") + 1).alias("page"),
        F.when(heading, "section_header").when(listed, "list_item").otherwise("text").alias("label"),
        F.when(heading, 1 + F.col("n") % 3).alias("level"),
        F.when(listed, F.concat_ws("-", block, so_far)).alias("list_key"),
    )


#: The same in SQL.
ITEMS = """
lines AS (
  SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS text,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents
),
items AS (
  SELECT doc_id, lang, pos, '#/texts/' || pos AS item_id, text,
    CASE WHEN lang = 'en' AND pos % 5 <> 4 THEN pos // 8 + 1 END AS page,
    CASE WHEN length(text) <= 60 THEN 'section_header' WHEN (pos // 3) % 2 = 0 THEN 'list_item' ELSE 'text' END AS label,
    CASE WHEN length(text) <= 60 THEN 1 + length(text) % 3 END AS level,
    CASE WHEN length(text) > 60 AND (pos // 3) % 2 = 0
         THEN (pos // 3) || '-' || sum(CASE WHEN length(text) <= 60 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
    END AS list_key
  FROM lines
)"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a pipeline's trace log, in order of event_id."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        "event_id",
        (F.col("user_id") % 10).alias("run_id"),
        k.alias("k"),
        F.when(F.col("event_type") == "click", F.get(F.array(*map(F.lit, BATCHES)), k % 3)).otherwise(F.element_at(F.create_map(*[F.lit(x) for pair in EVENTS.items() for x in pair]), F.col("event_type"))).alias("event"),
        F.concat(F.lit("span-"), (k % 7).cast("string")).alias("span_id"),
        F.get(F.array(*map(F.lit, STAGES)), k % 4).alias("stage"),
        F.when(k % 5 == 4, None).otherwise(F.concat(F.lit("model-"), (k % 3).cast("string"))).alias("model"),
        F.when(F.col("user_id") % 6 == 0, None).otherwise(F.concat(F.lit("source-"), (F.col("user_id") % 4).cast("string"))).alias("source"),
        F.when(k % 9 == 0, None).otherwise(k % 8).alias("batch_id"),
        (1 + k % 2).alias("attempt"),
        F.when(k % 11 == 0, "failed").otherwise("completed").alias("status"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        F.when(k % 10 == 0, None).otherwise(k * 10).alias("input_tokens"),
        F.when(k % 13 == 0, -1).otherwise(k).alias("output_tokens"),
        F.when(k % 6 == 0, "unknown").when(k % 2 == 0, "estimated").otherwise("reported").alias("cost_kind"),
        F.when(k % 3 == 0, "EUR").when(k % 7 == 0, "GBP").when(k % 19 == 0, "").otherwise("USD").alias("currency"),
        F.when(k % 23 != 0, k * 3).alias("latency_ms"),
    )


#: What each type of the events table stands for in the log.
EVENTS = {"purchase": "llm_attempt", "error": "batch_failed", "signup": "stage_started", "view": "stage_finished"}
BATCHES = ("batch_attempt", "batch_validated", "batch_reused")
STAGES = ("A", "B2", "C")

LOG = """
log AS (
  SELECT event_id, user_id % 10 AS run_id, k,
    CASE event_type WHEN 'purchase' THEN 'llm_attempt' WHEN 'error' THEN 'batch_failed' WHEN 'signup' THEN 'stage_started'
                    WHEN 'view' THEN 'stage_finished' WHEN 'click' THEN ['batch_attempt', 'batch_validated', 'batch_reused'][k % 3 + 1] END AS event,
    'span-' || (k % 7) AS span_id,
    ['A', 'B2', 'C'][k % 4 + 1] AS stage,
    CASE WHEN k % 5 <> 4 THEN 'model-' || (k % 3) END AS model,
    CASE WHEN user_id % 6 <> 0 THEN 'source-' || (user_id % 4) END AS source,
    CASE WHEN k % 9 <> 0 THEN k % 8 END AS batch_id,
    1 + k % 2 AS attempt,
    CASE WHEN k % 11 = 0 THEN 'failed' ELSE 'completed' END AS status,
    CAST(round(value * 100) AS BIGINT) AS cents,
    CASE WHEN k % 10 <> 0 THEN k * 10 END AS input_tokens,
    CASE WHEN k % 13 = 0 THEN -1 ELSE k END AS output_tokens,
    CASE WHEN k % 6 = 0 THEN 'unknown' WHEN k % 2 = 0 THEN 'estimated' ELSE 'reported' END AS cost_kind,
    CASE WHEN k % 3 = 0 THEN 'EUR' WHEN k % 7 = 0 THEN 'GBP' WHEN k % 19 = 0 THEN '' ELSE 'USD' END AS currency,
    CASE WHEN k % 23 <> 0 THEN k * 3 END AS latency_ms
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
)"""

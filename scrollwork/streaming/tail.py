"""The log as a stream: the same analytics, kept up to date as files of events arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.logs import SPLIT, checked, stream_lines


def tail(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    """Events of a growing folder of JSON-lines files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def follow(spark: SparkSession, path: str, schema: str, split: int = SPLIT) -> DataFrame:
    """Events of growing JSON-lines files: lines are taken as they are ended, in any number of batches. A line that is ended
    and no object stops the stream."""
    found = checked(stream_lines(spark, path, split))
    line = F.when(F.col("is_valid"), F.col("line")).otherwise(F.raise_error(F.concat(F.lit("corrupt line at byte "), "offset", F.lit(" of "), "path")).cast("string"))
    return found.select(F.from_json(line, schema).alias("event")).select("event.*")


def running_totals(events: DataFrame) -> DataFrame:
    """Calls, failures and tokens of each run so far; state is one row a run."""
    calls = events.where("event = 'llm_attempt'")
    return calls.groupBy("run_id").agg(F.count("*").alias("request_count"), F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).alias("failed_count"), F.sum("input_tokens").alias("input_tokens"))


def last_batch_event(events: DataFrame) -> DataFrame:
    """Latest event of every batch so far."""
    return events.where("batch_id IS NOT NULL").groupBy("run_id", "batch_id").agg(F.max_by("event", "event_id").alias("event"))


def calls_by_minute(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """An extension: calls by event-time window, closed once events are `late` past it."""
    return events.withWatermark("ts", late).where("event = 'llm_attempt'").groupBy(F.window("ts", width), "run_id").agg(F.count("*").alias("n"))


def recovered(jobs: DataFrame) -> DataFrame:
    """Jobs after a restart: what was running or queued was interrupted."""
    return jobs.withColumn("status", F.when(F.col("status").isin("running", "queued"), "interrupted").otherwise(F.col("status")))

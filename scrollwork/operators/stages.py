"""Status of every stage of every run, from its events and from the job that ran it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: All stages.
STAGES = ("A", *(f"A{k}" for k in range(1, 12)), "A3.1", *(f"B{k}" for k in range(1, 7)), "C", *(f"D{k}" for k in range(1, 5)))
#: Events that decide a status, and those that decide it alone.
STARTED, FINISHED = "stage_started", "stage_finished"
DECIDED = {STARTED: "running", "stage_skipped": "skipped", "cache_hit": "cached"}


def first_status(job: Column) -> Column:
    """Before any event: `unrecorded` for runs without a job or of a former time, else `waiting`."""
    return F.when(F.coalesce(job != "historical", F.lit(False)), "waiting").otherwise("unrecorded")


def with_job(status: Column, job: Column) -> Column:
    """A stage that runs in a job that no longer does was interrupted; in a historical run it is unrecorded."""
    return F.when((status == "running") & job.isin("failed", "interrupted"), "interrupted").when((status == "running") & (job == "historical"), "unrecorded").otherwise(status)


def stage_status(log: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """run_id, stage, status, n_events and n_active (spans that started and did not end) for all stages of all runs.

    `log`: run_id, stage, event_id (its order), event, span_id, status. `jobs`: run_id, status; a run without one has no
    job. A start makes a stage run; so do spans that are left after an end, else the end's own status holds (completed if it
    has none). A failed end makes it failed until it starts again, is skipped, or comes from the cache. Starts without a
    span make it run and leave nothing to wait for.

    All of this is last events and which came later, so two aggregations, both combined before their shuffle, are enough:
    by span and then by stage. No run is gathered or sorted.
    """
    own = log.where(F.col("stage").isin(*STAGES))
    event, at = F.col("event"), F.col("event_id")
    last = lambda which: F.max(F.when(which, at))
    spans = own.groupBy("run_id", "stage", "span_id").agg(
        F.count("*").alias("n"),
        last(event == STARTED).alias("started"),
        last(event == FINISHED).alias("finished"),
        last(event.isin(*DECIDED)).alias("decided"),
        last((event == FINISHED) & (F.col("status") == "failed")).alias("failed"),
        F.max(F.when((event == FINISHED) | event.isin(*DECIDED), F.struct(at.alias("at"), event.alias("event"), F.coalesce("status", F.lit("completed")).alias("said")))).alias("last"),
    )
    active = (F.col("span_id") != "") & F.coalesce(F.col("started") > F.coalesce("finished", F.lit(-(2**63))), F.lit(False))
    stages = spans.groupBy("run_id", "stage").agg(F.sum("n").alias("n_events"), F.count(F.when(active, 1)).alias("n_active"), F.max("decided").alias("decided"), F.max("failed").alias("failed"), F.max("last").alias("last"))
    still_failed = F.col("failed") > F.coalesce("decided", F.lit(-(2**63)))
    ended = F.when(still_failed, "failed").when(F.col("n_active") > 0, "running").otherwise(F.col("last.said"))
    alone = F.element_at(F.create_map(*[F.lit(x) for pair in DECIDED.items() for x in pair]), F.col("last.event"))
    stages = stages.select("run_id", "stage", "n_events", "n_active", F.when(F.col("last.event") == FINISHED, ended).otherwise(alone).alias("seen"))
    runs = log.select("run_id").distinct()
    if jobs is None:
        runs = runs.withColumn("job", F.lit(None).cast("string"))
    else:
        runs = runs.join(jobs.select("run_id", F.col("status").alias("job")), "run_id", "full")
    every = runs.select("run_id", "job", F.explode(F.array(*map(F.lit, STAGES))).alias("stage")).join(stages, ["run_id", "stage"], "left")
    zero = F.lit(0).cast("long")
    return every.select("run_id", "stage", with_job(F.coalesce("seen", first_status(F.col("job"))), F.col("job")).alias("status"), F.coalesce("n_events", zero).alias("n_events"), F.coalesce("n_active", zero).alias("n_active"))

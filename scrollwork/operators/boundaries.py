"""What went into each stage of a run and what came out, put together from the snapshots that the run left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stages import STAGES
from .telemetry import EXTRACTION

#: Stages with boundaries, kinds of snapshots at them, and fields that are no input or output of a stage.
REVIEWED = tuple(s for s in STAGES if s != "B6")
KINDS = ("input-artifacts", "output-artifacts", "input", "output")
TRACE, CLASSIFIES, FORMER_INPUTS, FORMER_OUTPUTS = "_trace", "B2", ("signals", "topic_signals_json_path"), ("topic_signals_json_path",)
_NAME = rf"^([A-D][0-9.]*)-({'|'.join(KINDS)})-"


def stage_boundaries(snapshots: DataFrame, log: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """run_id, stage, input, input_artifacts, output, return_value (maps; null if the run has none) and n_events for every
    reviewed stage of every run with a snapshot.

    `snapshots`: run_id, seq, filename, span_id, data (map of fields to JSON). `log`: run_id, stage. `current`: run_id of the
    runs of the present layout, whose classification no longer has the former signals.

    Inputs captured in several snapshots are merged field by field, the later one wins: a maximum by sequence for each field,
    combined before the shuffle. The others are the last snapshot of their kind. The extraction's input and return value are
    those of one span, that of its last boundary, so a pending call never shows an older one's answer.
    """
    part = lambda k: F.regexp_extract("filename", _NAME, k)
    own = snapshots.select("run_id", "seq", "span_id", "data", part(1).alias("stage"), part(2).alias("kind")).where(F.col("stage").isin(*REVIEWED))
    if current is None:
        own = own.withColumn("is_current", F.lit(False))
    else:
        own = own.join(current.select("run_id", F.lit(True).alias("is_current")).distinct(), "run_id", "left").withColumn("is_current", F.coalesce("is_current", F.lit(False)))
    former = lambda names: F.col("is_current") & (F.col("stage") == CLASSIFIES) & F.lit(bool(names))
    kept = lambda names: F.map_filter("data", lambda k, _: (k != TRACE) & ~(former(names) & k.isin(*names)))
    fields = own.where(F.col("kind") == "input-artifacts").select("run_id", "stage", "seq", F.explode(kept(FORMER_INPUTS)).alias("field", "value"))
    merged = fields.groupBy("run_id", "stage", "field").agg(F.max_by("value", "seq").alias("value"))
    artifacts = merged.groupBy("run_id", "stage").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "value")))).alias("input_artifacts"))
    last = own.where(F.col("kind").isin("input", "output") & (F.col("stage") == EXTRACTION)).groupBy("run_id").agg(F.max_by(F.nullif("span_id", F.lit("")), "seq").alias("last_span"))
    paired = own.join(last, "run_id", "left")
    of_span = (F.col("stage") != EXTRACTION) | F.col("last_span").isNull() | F.col("span_id").eqNullSafe(F.col("last_span"))
    latest = lambda kind, what, also=F.lit(True): F.max_by(what, F.when((F.col("kind") == kind) & also, F.col("seq")))
    others = paired.groupBy("run_id", "stage").agg(
        latest("input", F.col("data"), of_span).alias("input"),
        latest("output-artifacts", kept(FORMER_OUTPUTS)).alias("output"),
        latest("output", F.col("data"), of_span).alias("return_value"),
    )
    events = log.groupBy("run_id", "stage").agg(F.count("*").alias("n_events"))
    every = snapshots.select("run_id").distinct().select("run_id", F.explode(F.array(*map(F.lit, REVIEWED))).alias("stage"))
    joined = every.join(others, ["run_id", "stage"], "left").join(artifacts, ["run_id", "stage"], "left").join(events, ["run_id", "stage"], "left")
    empty = F.create_map().cast("map<string,string>")
    return joined.select("run_id", "stage", "input", F.coalesce("input_artifacts", empty).alias("input_artifacts"), "output", "return_value", F.coalesce("n_events", F.lit(0).cast("long")).alias("n_events"))


def shown(fields: Column) -> Column:
    """A map as `name=value` in order of names, with commas between."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(fields)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")

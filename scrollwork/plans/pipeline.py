"""The whole document pipeline with an injected classifier: chunks, batches, classification, topic map, evidence."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import structure, topics


@dataclass(frozen=True)
class Settings:
    """Limits of a run, checked when they are made."""

    target: int = 12_000
    batch_chunks: int = 5
    batch_characters: int = 24_000
    neighbours: int = 1
    timeout_seconds: float = 60.0
    output_tokens: int = 8_192

    def __post_init__(self):
        for name in ("target", "batch_chunks", "batch_characters", "neighbours", "output_tokens"):
            if isinstance(value := getattr(self, name), bool) or not isinstance(value, int) or value < (name != "neighbours"):
                raise ValueError(f"{name} must be a whole number that is large enough")
        if self.batch_chunks > 5:
            raise ValueError("a batch holds at most 5 chunks")
        if isinstance(self.timeout_seconds, bool) or not 0 < self.timeout_seconds < float("inf"):
            raise ValueError("timeout_seconds must be positive and finite")


def chunked(items: DataFrame, settings: Settings) -> DataFrame:
    """Chunks of all documents, with pages or without."""
    units = structure.atomic_units(items)
    both = structure.paged_assignment(units, settings.target).unionByName(structure.pageless_assignment(units, settings.target))
    return structure.chunk_records(both, settings.target)


def run(items: DataFrame, classify: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]], settings: Settings | None = None) -> dict[str, DataFrame]:
    """Tables of a run. `classify(chunks, items)` gives groups (doc_id, chunk_no, topic, evidence, context) and the chunks
    it has answered (doc_id, chunk_no), those without a group too. What breaks a rule, and chunks without an answer, are in
    `violations`; the map is made of the rest."""
    settings = settings or Settings()
    chunks = chunked(items, settings)
    groups, answered = classify(chunks, items)
    scope = topics.packet_scope(items, structure.unit_spans(items), chunks, structure.heading_paths(items), settings.neighbours)
    wrong = topics.violations(groups, items, chunks, scope, answered)
    right = groups.join(wrong.select("doc_id", "chunk_no", "topic").distinct(), ["doc_id", "chunk_no", "topic"], "left_anti")
    mapped = topics.topic_map(topics.identified(topics.with_parents(right)))
    return {
        "chunks": chunks,
        "batches": structure.packed_batches(chunks, settings.batch_chunks, settings.batch_characters),
        "violations": wrong,
        "topic_map": mapped,
        "unclassified": topics.unclassified(chunks.select("doc_id", "chunk_no"), right),
        "evidence": topics.evidence(mapped, items),
    }


def specialist(packets: DataFrame, ask: Callable[[DataFrame], DataFrame], judge: Callable[[DataFrame], DataFrame], most: int = 2) -> DataFrame:
    """Answers of a model about packets (key, evidence: an array), each asked again with what was wrong, at most `most` times:
    key, answer, attempts, problem (`no_evidence`: not asked at all; else the last one, or null).

    `ask(packets)` gets key, evidence, attempt and feedback (null at first) and gives key and answer; `judge(answers)` gives
    key and problem for the answers that are wrong. Each round is one pass over the packets that are still open, written down
    so that no model is asked twice for it.
    """
    if most < 1:
        raise ValueError("a model is asked at least once")
    text = F.lit(None).cast("string")
    done = [packets.where(F.coalesce(F.size("evidence"), F.lit(0)) <= 0).select("key", text.alias("answer"), F.lit(0).alias("attempts"), F.lit("no_evidence").alias("problem"))]
    open_packets = packets.where(F.size("evidence") > 0).withColumn("feedback", text)
    for attempt in range(1, most + 1):
        answers = checkpointed(ask(open_packets.withColumn("attempt", F.lit(attempt))).select("key", "answer"))
        wrong = judge(answers).groupBy("key").agg(F.min("problem").alias("problem"))
        judged = checkpointed(open_packets.select("key").join(answers, "key", "left").join(wrong, "key", "left").withColumn("problem", F.when(F.col("answer").isNull(), F.coalesce("problem", F.lit("no_answer"))).otherwise(F.col("problem"))))
        last = attempt == most
        done.append(judged.where(F.lit(last) | F.col("problem").isNull()).select("key", "answer", F.lit(attempt).alias("attempts"), "problem"))
        open_packets = open_packets.drop("feedback").join(judged.where("problem IS NOT NULL").select("key", F.col("problem").alias("feedback")), "key")
    out = done[0]
    for frame in done[1:]:
        out = out.unionByName(frame)
    return out


def checkpointed(frame: DataFrame) -> DataFrame:
    """The rows, written to the session's checkpoint folder."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = frame.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            raise ValueError("spark.checkpoint.dir names a folder that all executors share")
        context.setCheckpointDir(folder)
    return frame.checkpoint()


def not_implemented(spark, name: str) -> DataFrame:
    """The party extraction that is only announced: its result says so."""
    return spark.createDataFrame([(name, "not_implemented")], "document_name string, status string").withColumns({c: F.array().cast("array<string>") for c in ("borrowers", "lenders", "errors")})

"""Whether artifacts belong together: packets and classifications, maps and selections, evidence and its sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .documents import answer_differences
from .topics import TAXONOMY, TOPICS, retrieve

#: Fixed value: the layout of a run whose classification is its second stage.
LAYOUT = "stage-b-v2"


def _first(rules: list[tuple[str, Column]]) -> Column:
    """The first rule that is broken, or null."""
    return F.coalesce(*[F.when(F.coalesce(broken, F.lit(True)), name) for name, broken in rules])


def packet_hashes(scope: DataFrame) -> DataFrame:
    """doc_id, packets_sha: the identity of what was asked, from `topics.packet_scope`. Hashed by chunk, then by document, so
    a document's citations never come together in one row."""
    chunks = scope.groupBy("doc_id", "chunk_no").agg(F.array_join(F.array_sort(F.collect_set("pos")), ",").alias("places"))
    hashed = chunks.select("doc_id", F.struct("chunk_no", F.sha2(F.concat_ws(":", "chunk_no", "places").cast("binary"), 256).alias("sha")).alias("c"))
    listed = hashed.groupBy("doc_id").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    return listed.select("doc_id", F.sha2(F.array_join(F.transform("cs", lambda c: c["sha"]), "\n").cast("binary"), 256).alias("packets_sha"))


def topic_map_problems(classifications: DataFrame, documents: DataFrame, packets: DataFrame) -> DataFrame:
    """doc_id, problem of classifications that no topic map may be made of: the first of no_document, not_final, other_source,
    other_taxonomy, unknown_layout, other_packets.

    `classifications`: doc_id, status, schema_version, classification_status, source_sha, taxonomy_version, taxonomy, layout,
    has_proposals, profile_version, packets_sha. `documents`: doc_id, source_sha; `packets`: doc_id, packets_sha as recomputed.
    Rows of version 1 have neither layout nor packets. Version 2 without a layout is taken if it carries its proposals, as its
    hash did then.
    """
    own = documents.select("doc_id", F.col("source_sha").alias("own_source"))
    now = packets.select("doc_id", F.col("packets_sha").alias("own_packets"))
    joined = classifications.join(own, "doc_id", "left").join(now, "doc_id", "left")
    is_old = F.col("schema_version").eqNullSafe(1)
    rules = [
        ("no_document", F.col("own_source").isNull()),
        ("not_final", ~(F.col("status").eqNullSafe("completed") & F.coalesce(F.col("schema_version").isin(1, 2), F.lit(False)) & F.col("classification_status").eqNullSafe("final"))),
        ("other_source", ~F.col("source_sha").eqNullSafe(F.col("own_source"))),
        ("other_taxonomy", ~(F.col("taxonomy_version").eqNullSafe(TAXONOMY) & F.col("taxonomy").eqNullSafe(F.array(*map(F.lit, TOPICS))))),
        ("unknown_layout", ~is_old & ~F.when(F.col("layout").isNull(), F.coalesce("has_proposals", F.lit(False))).otherwise(F.col("layout") == LAYOUT)),
        ("other_packets", ~is_old & ~(F.col("profile_version").eqNullSafe(2) & F.col("packets_sha").isNotNull() & F.col("packets_sha").eqNullSafe(F.col("own_packets")))),
    ]
    return joined.select("doc_id", _first(rules).alias("problem")).where("problem IS NOT NULL")


def selection_differences(selection: DataFrame, mapped: DataFrame, topics: list[str]) -> DataFrame:
    """Rows that a saved selection has and the map does not give for these topics, or the other way, with `side`. `selection`:
    doc_id, topic, ord, group_ord, group_id."""
    own = ["doc_id", "topic", "ord", "group_ord", "group_id"]
    return answer_differences(selection.select(*own), retrieve(mapped, topics).select(*own))


def evidence_problems(maps: DataFrame, chunks: DataFrame, conversions: DataFrame) -> DataFrame:
    """doc_id, problem: evidence may be put together only if map, chunk artifact and chunk document have one source
    (`sources_differ`), and, where a conversion is at hand, it has that source and the bytes that the chunks were made of
    (`conversion_differs`). `maps`: doc_id, source_sha. `chunks`: doc_id, artifact_source, document_source, canonical_sha (of
    the bytes they were made of). `conversions`: doc_id, source_sha, canonical_sha."""
    given = conversions.select("doc_id", F.col("source_sha").alias("converted_source"), F.col("canonical_sha").alias("converted_sha"), F.lit(True).alias("converted"))
    joined = maps.join(chunks, "doc_id", "left").join(given, "doc_id", "left")
    same = F.col("source_sha").isNotNull() & F.col("source_sha").eqNullSafe(F.col("artifact_source")) & F.col("source_sha").eqNullSafe(F.col("document_source"))
    fits = F.col("converted").isNull() | (F.col("converted_source").eqNullSafe(F.col("artifact_source")) & F.col("converted_sha").isNotNull() & F.col("converted_sha").eqNullSafe(F.col("canonical_sha")))
    return joined.select("doc_id", _first([("sources_differ", ~same), ("conversion_differs", ~fits)]).alias("problem")).where("problem IS NOT NULL")


def request_ids(packets: DataFrame, inputs: DataFrame) -> DataFrame:
    """doc_id, request_id: the identity of an evidence packet with all it was made of, so another map, chunk document,
    conversion or request never takes its place. `packets`: doc_id, topic, group_id, role, pos, text (rows of
    `topics.evidence`); `inputs`: doc_id, map_sha, chunks_sha, canonical_sha (null: none), topics (array)."""
    row = F.struct("topic", "group_id", "role", "pos", "text")
    groups = packets.select("doc_id", "topic", "group_id", F.sha2(F.to_json(row, {"ignoreNullFields": "false"}).cast("binary"), 256).alias("sha"))
    by_group = groups.groupBy("doc_id", "topic", "group_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("sha")), "\n").cast("binary"), 256).alias("sha"))
    by_doc = by_group.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list("sha")), "\n").alias("packet"))
    joined = inputs.join(by_doc, "doc_id", "left")
    parts = F.struct("map_sha", "chunks_sha", "canonical_sha", "topics", F.coalesce("packet", F.lit("")).alias("packet"))
    return joined.select("doc_id", F.sha2(F.to_json(parts, {"ignoreNullFields": "false"}).cast("binary"), 256).alias("request_id"))

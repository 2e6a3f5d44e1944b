"""Passage groups by topic: parents, identities, topic map, retrieval, evidence, and checks of classifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .documents import answer_differences

#: The topics in output order, and the version of the list.
TOPICS = (
    "contract_definitions",
    "parties_and_roles",
    "facility_and_commitment_terms",
    "interest_and_fees",
    "interest_and_fees.pik_toggle",
    "maturity_termination_extension",
    "repayment_and_prepayment",
    "repayment_and_prepayment.call_protection",
    "covenants",
    "guarantees_and_security",
    "default_and_remedies",
)
TAXONOMY = "credit-topics-v2"
#: A dotted topic belongs to the topic before the dot.
PARENTS = {t: t.split(".")[0] for t in TOPICS if "." in t}


def taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, k, PARENTS.get(t)) for k, t in enumerate(TOPICS)], "topic string, ord int, parent string")


def parent_of(topic: Column) -> Column:
    return F.when(topic.contains("."), F.substring_index(topic, ".", 1))


def with_parents(groups: DataFrame) -> DataFrame:
    """Groups, and those of subtopics once more under the parent topic."""
    lifted = groups.where(parent_of(F.col("topic")).isNotNull()).withColumn("topic", parent_of(F.col("topic")))
    return groups.unionByName(lifted)


def identified(groups: DataFrame) -> DataFrame:
    """Groups (doc_id, chunk_no, topic, evidence, context: arrays of positions) with group_id; exact repeats of a topic's
    group are one, with the smallest chunk."""
    ids = lambda c: F.transform(F.array_sort(F.array_distinct(c)), lambda p: F.concat(F.lit("#/texts/"), p.cast("string")))
    named = groups.withColumn("group_id", T.group_id(F.col("doc_id").cast("string"), F.lit(TAXONOMY), F.col("topic"), ids(F.col("evidence")), ids(F.col("context"))))
    return named.groupBy("doc_id", "topic", "group_id").agg(F.min("chunk_no").alias("chunk_no"), F.first("evidence").alias("evidence"), F.first("context").alias("context"))


def topic_map(groups: DataFrame) -> DataFrame:
    """Groups of each topic, in the order of their evidence and context in the document: group_ord from 0."""
    order = Window.partitionBy("doc_id", "topic").orderBy(F.array_sort("evidence"), F.array_sort("context"))
    return groups.withColumn("group_ord", F.row_number().over(order) - 1)


def enriched(groups: DataFrame, items: DataFrame) -> DataFrame:
    """Groups with where they come from: source_chunks (the chunks that own what they cite, in order), evidence_pages and
    context_pages (sorted). `groups`: doc_id, topic, group_id, evidence, context; `items`: doc_id, pos, chunk_no, page."""
    key = ["doc_id", "topic", "group_id"]
    cited = groups.select(*key, F.explode(F.concat(_in_role("evidence"), _in_role("context"))).alias("c")).select(*key, "c.role", "c.pos")
    known = cited.join(items.select("doc_id", "pos", "chunk_no", "page"), ["doc_id", "pos"])
    pages = lambda role: F.array_sort(F.collect_set(F.when(F.col("role") == role, F.col("page")))).alias(f"{role}_pages")
    found = known.groupBy(*key).agg(F.array_sort(F.collect_set("chunk_no")).alias("source_chunks"), pages("evidence"), pages("context"))
    return groups.join(found, key, "left")


def saved_differences(saved: DataFrame, items: DataFrame) -> DataFrame:
    """Saved groups (doc_id, chunk_no, topic, group_id, evidence, context, source_chunks, evidence_pages, context_pages) whose
    derived fields are not what their citations give, and what these give instead, with `side`. Only the citations are taken
    from the saved rows; everything else is made anew."""
    own = ["doc_id", "topic", "group_id", "source_chunks", "evidence_pages", "context_pages"]
    plain = identified(saved.select("doc_id", "chunk_no", "topic", "evidence", "context"))
    return answer_differences(saved.select(*own).distinct(), enriched(plain, items).select(*own))


def map_violations(mapped: DataFrame) -> DataFrame:
    """rule, doc_id, topic, group_id of a topic map (doc_id, topic, group_id, group_ord, evidence, context): unknown topics,
    groups of another identity than their citations give, groups that are repeated, and those that stand before an earlier
    one of the document."""
    rule = lambda frame, name: frame.select(F.lit(name).alias("rule"), "doc_id", "topic", "group_id")
    again = identified(mapped.select("doc_id", F.lit(0).alias("chunk_no"), "topic", "evidence", "context")).select("doc_id", "topic", "group_id")
    place = F.struct(F.array_sort("evidence"), F.array_sort("context"))
    ordered = mapped.withColumn("place", place).withColumn("before", F.lag("place").over(Window.partitionBy("doc_id", "topic").orderBy("group_ord")))
    return (
        rule(mapped.where(~F.col("topic").isin(*TOPICS)), "unknown_topic")
        .unionByName(rule(mapped.join(again, ["doc_id", "topic", "group_id"], "left_anti"), "other_identity"))
        .unionByName(rule(mapped.groupBy("doc_id", "topic", "group_id").agg(F.count("*").alias("n")).where("n > 1"), "repeated_group"))
        .unionByName(rule(ordered.where("place < before"), "out_of_order"))
    )


def unclassified(chunks: DataFrame, groups: DataFrame) -> DataFrame:
    return chunks.join(groups.select("doc_id", "chunk_no").distinct(), ["doc_id", "chunk_no"], "left_anti")


def requested(spark: SparkSession, topics: list[str]) -> DataFrame:
    """Distinct requested topics with their place in the taxonomy; unknown or no topics are an error."""
    if not topics or set(topics) - set(TOPICS):
        raise ValueError("topics must be some of the taxonomy's")
    return taxonomy(spark).where(F.col("topic").isin(topics)).select("topic", "ord")


def retrieve(mapped: DataFrame, topics: list[str]) -> DataFrame:
    """Groups of the requested topics, with the topic's place; subtopics only if asked for."""
    return mapped.join(requested(mapped.sparkSession, topics), "topic")


def empty_topics(mapped: DataFrame, topics: list[str]) -> DataFrame:
    """Requested topics of each document that have no group."""
    wanted = mapped.select("doc_id").distinct().crossJoin(F.broadcast(requested(mapped.sparkSession, topics)))  # at most 11 topics
    return wanted.join(mapped.select("doc_id", "topic"), ["doc_id", "topic"], "left_anti")


def evidence(groups: DataFrame, items: DataFrame) -> DataFrame:
    """One row per cited item of each group: role, position, text, page."""
    cited = groups.select("doc_id", "topic", "group_id", F.explode(F.concat(_in_role("evidence"), _in_role("context"))).alias("c")).select("doc_id", "topic", "group_id", "c.*")
    return cited.join(items.select("doc_id", "pos", "text", "page"), ["doc_id", "pos"], "left").withColumn("is_blank", T.is_blank(F.col("text")))


def _units_before(ends: DataFrame, units: DataFrame) -> DataFrame:
    """Chunks (doc_id, chunk_no, first_pos, last_pos) with the number of units (doc_id, a) that begin before them (start),
    and of those that begin before or within them (end).

    A chunk's start stands before the units that begin there, its end after those that begin at its last place; a running
    count over all borders of a document, in order, says both.
    """
    begun = units.select("doc_id", F.col("a").cast("long").alias("at"), F.lit(1).alias("turn"), F.lit(None).cast("long").alias("chunk_no"))
    border = lambda at, turn: F.struct(F.col(at).cast("long").alias("at"), F.lit(turn).alias("turn"))
    both = ends.select("doc_id", F.explode(F.array(border("first_pos", 0), border("last_pos", 2))).alias("b"), F.col("chunk_no").cast("long").alias("chunk_no"))
    borders = begun.unionByName(both.select("doc_id", "b.at", "b.turn", "chunk_no"))
    count = F.count(F.when(F.col("turn") == 1, 1)).over(Window.partitionBy("doc_id").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0))
    of = lambda turn, what: F.max(F.when(F.col("turn") == turn, F.col(what)))
    counted = borders.withColumn("n", count).where("chunk_no IS NOT NULL").groupBy("doc_id", "chunk_no")
    out = counted.agg(of(0, "at").alias("first_pos"), of(2, "at").alias("last_pos"), of(0, "n").alias("start"), of(2, "n").alias("end"))
    kinds = {f.name: f.dataType for f in ends.schema}
    return out.select("doc_id", *[F.col(c).cast(kinds[c]).alias(c) for c in ("chunk_no", "first_pos", "last_pos")], "start", "end")


def _in_role(role: str) -> Column:
    return F.transform(role, lambda p: F.struct(F.lit(role).alias("role"), p.alias("pos")))


def _block(pos: str) -> Column:
    return F.shiftright(F.col(pos).cast("long"), 6)


def _bit(pos: str) -> Column:
    """The bit of a place in its block of 64."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col(pos).cast("long").bitwiseAND(F.lit(63)).cast("int"))


def packet_scope(items: DataFrame, units: DataFrame, chunks: DataFrame, headings: DataFrame, neighbours: int = 1) -> DataFrame:
    """doc_id, chunk_no, pos of every item that an answer for a chunk may cite: the chunk's own, those of so many units
    before and after it, and the headings above any of these. `headings`: doc_id, pos, heading_positions, of every item
    (`structure.heading_paths`). `units`: doc_id, unit_no, pos, last_pos (`structure.unit_spans` is enough). Chunks begin at an item.

    A list that goes on from the chunk before is a unit that began there, and so a neighbour. Work and rows grow with the items
    that may be cited: chunks and units meet in one sweep over their borders, not chunk by unit. The headings above a stretch
    of items are those above its first item and those within, so headings are looked up for the first items alone, and places
    are made distinct within a chunk's own row. Which places are items is told by 64 bits a row, combined before they are shuffled.
    """
    ends = chunks.select("doc_id", "chunk_no", "first_pos", "last_pos")
    own = units.select("doc_id", "unit_no", F.col("pos").alias("a"), F.col("last_pos").alias("b"))
    begun = _units_before(ends, own)
    # a null stands for the chunk's own items
    wanted = F.concat(F.sequence(F.col("start") - neighbours, F.col("start") - 1), F.sequence(F.col("end"), F.col("end") + neighbours - 1)) if neighbours else F.array().cast("array<bigint>")
    asked = begun.select("doc_id", "chunk_no", "first_pos", "last_pos", F.explode(F.concat(wanted, F.array(F.lit(None).cast("bigint")))).alias("unit_no"))
    end = lambda at, of: F.when(F.col("unit_no").isNull(), F.col(at)).otherwise(F.col(of)).alias(of)
    spans = asked.join(own, ["doc_id", "unit_no"], "left").select("doc_id", "chunk_no", end("first_pos", "a"), end("last_pos", "b")).where("a IS NOT NULL")
    above = headings.select("doc_id", F.col("pos").alias("a"), "heading_positions")
    cited = F.concat(F.sequence("a", "b"), F.coalesce("heading_positions", F.array().cast("array<int>")))
    by_chunk = spans.join(above, ["doc_id", "a"], "left").groupBy("doc_id", "chunk_no").agg(F.flatten(F.collect_list(cited)).alias("cited"))
    scope = by_chunk.select("doc_id", "chunk_no", F.explode(F.array_distinct("cited")).alias("pos"))
    held = items.groupBy(F.col("doc_id").alias("doc"), _block("pos").alias("block")).agg(F.bit_or(_bit("pos")).alias("held"))
    found = scope.join(held.hint("merge"), (F.col("doc_id") == F.col("doc")) & (_block("pos") == F.col("block")))
    return found.where(F.col("held").bitwiseAND(_bit("pos")) != 0).select("doc_id", "chunk_no", "pos")


def violations(groups: DataFrame, items: DataFrame, chunks: DataFrame, scope: DataFrame | None = None, answered: DataFrame | None = None) -> DataFrame:
    """rule, doc_id, chunk_no, topic of every breach: unknown or repeated topics, no evidence, repeated or overlapping
    citations, evidence outside the chunk, citations of nothing, unknown chunks; with `scope` (`packet_scope`), citations
    of what the chunk's answer may not cite; with `answered` (doc_id, chunk_no of the answers, empty ones too), chunks
    without an answer, whose topic is null."""
    key = ["doc_id", "chunk_no", "topic"]
    rule = lambda frame, name: frame.select(F.lit(name).alias("rule"), *key)
    shape = [
        ("unknown_topic", ~F.col("topic").isin(*TOPICS)),
        ("no_evidence", F.size("evidence") == 0),
        ("repeated_citation", (F.size("evidence") != F.size(F.array_distinct("evidence"))) | (F.size("context") != F.size(F.array_distinct("context")))),
        ("overlap", F.arrays_overlap("evidence", "context")),
    ]
    out = [rule(groups.where(c), name) for name, c in shape]
    out.append(rule(groups.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1"), "repeated_topic"))
    cited = groups.select(*key, F.explode(F.concat("evidence", "context")).alias("pos"))
    out.append(rule(cited.join(items.select("doc_id", "pos"), ["doc_id", "pos"], "left_anti").distinct(), "unknown_item"))
    core = groups.select(*key, F.explode("evidence").alias("pos")).join(chunks.select("doc_id", "chunk_no", "first_pos", "last_pos"), ["doc_id", "chunk_no"])
    out.append(rule(core.groupBy(*key).agg(F.max(F.col("pos").between(F.col("first_pos"), F.col("last_pos"))).alias("inside")).where("NOT inside"), "evidence_outside"))
    out.append(rule(groups.join(chunks.select("doc_id", "chunk_no"), ["doc_id", "chunk_no"], "left_anti"), "unknown_chunk"))
    if scope is not None:
        out.append(rule(cited.join(scope, ["doc_id", "chunk_no", "pos"], "left_anti").distinct(), "out_of_scope"))
    if answered is not None:
        left = chunks.select("doc_id", "chunk_no").join(answered, ["doc_id", "chunk_no"], "left_anti")
        out.append(rule(left.withColumn("topic", F.lit(None).cast("string")), "unanswered"))
    total = out[0]
    for frame in out[1:]:
        total = total.unionByName(frame)
    return total


def facet_counts(groups: DataFrame) -> DataFrame:
    return groups.groupBy("topic").agg(F.count("*").alias("n_groups"), F.countDistinct("doc_id").alias("n_docs"))


def above_threshold(scores: DataFrame, least: float = 0.5) -> DataFrame:
    """Topics whose probability reaches the threshold, and their parents: doc_id, topic."""
    return with_parents(scores.where(F.col("p") >= least).select("doc_id", "topic")).distinct()


def signals(items: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """doc_id, pos, topic for every rule (topic, phrase) whose phrase stands in an item as whole words, in any case, and
    for the topic's parent; items without a signal keep a row with a null topic."""
    hits = F.array_compact(F.array(*[F.when(F.col("text").rlike(rf"(?iU)\b{phrase}\b"), F.lit(topic)) for topic, phrase in rules]))
    every = F.array_distinct(F.concat(hits, F.array_compact(F.transform(hits, parent_of))))
    return items.select("doc_id", "pos", F.explode_outer(every).alias("topic"))

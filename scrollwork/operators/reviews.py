"""Append-only review decisions: latest and past revisions, compare-and-set, derived flags, progress, upgrades."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank

DECISIONS = ("approved", "edited", "rejected", "skipped")
#: Most characters of an annotation's notes.
ANNOTATION_NOTES = 4_000
#: Most characters of a decision's notes and of a field's name, most quotes and pages, and ids of facts that a reviewer adds.
NOTES, FIELD, QUOTES, PAGES, MANUAL = 12_000, 300, 20, 10_000, "^manual-[a-zA-Z0-9-]{1,80}$"


def latest(decisions: DataFrame) -> DataFrame:
    """The row with the highest revision of each fact; combined before the shuffle."""
    rest = [c for c in decisions.columns if c != "fact_id"]
    return decisions.groupBy("fact_id").agg(F.max_by(F.struct(*rest), "revision").alias("row")).select("fact_id", "row.*")


def history(decisions: DataFrame) -> DataFrame:
    """All revisions with the decision before: fact_id, revision, decision, previous."""
    return decisions.select("fact_id", "revision", "decision", F.lag("decision").over(Window.partitionBy("fact_id").orderBy("revision")).alias("previous"))


def compare_and_set(decisions: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming (fact_id, expected, decision) with the current revision, and whether each is accepted: it expects the
    current revision (0 if there is none), is the only one for its fact, and names a decision."""
    current = decisions.groupBy("fact_id").agg(F.max("revision").alias("current"))
    alone = F.count("*").over(Window.partitionBy("fact_id")) == 1
    judged = incoming.select("*", alone.alias("alone")).join(current, "fact_id", "left").withColumn("current", F.coalesce("current", F.lit(0)))
    return judged.withColumn("accepted", (F.col("expected") == F.col("current")) & F.col("alone") & F.col("decision").isin(*DECISIONS)).drop("alone")


def applied(decisions: DataFrame, incoming: DataFrame) -> DataFrame:
    """Decisions and the accepted incoming ones as next revisions."""
    new = compare_and_set(decisions, incoming).where("accepted").select("fact_id", (F.col("current") + 1).alias("revision"), "decision")
    return decisions.select("fact_id", "revision", "decision").unionByName(new)


def decision_problems(incoming: DataFrame, decisions: DataFrame, drafts: DataFrame, documents: DataFrame, draft_sha: str) -> DataFrame:
    """`incoming` with problem: the first reason why a decision cannot be taken, or null.

    `incoming`: fact_id, document_id, draft_sha, expected, decision, notes, field, value, evidence (array of structs
    source_text, pdf_pages, item_id). `decisions`: fact_id, document_id, revision. `drafts`: fact_id, document_id. `documents`:
    document_id, format. A fact that no draft has is one that the reviewer adds: it has a manual id, a field and quotes, with
    pages in a PDF and with places elsewhere. `conflict`: another revision is current, or two of the incoming want the same fact;
    `prior_owner`: the fact's decisions so far are about another document. Joins on ids; all rules look at one row.
    """
    current = decisions.groupBy("fact_id").agg(F.max("revision").alias("current"), F.max_by("document_id", "revision").alias("prior_owner"))
    owners = drafts.select("fact_id", F.col("document_id").alias("draft_owner")).distinct()
    known = documents.select("document_id", F.lower("format").alias("format")).distinct()
    alone = F.count("*").over(Window.partitionBy("fact_id")) == 1
    judged = incoming.withColumn("alone", alone).join(current, "fact_id", "left").join(owners, "fact_id", "left").join(known, "document_id", "left")
    evidence, is_pdf, added = F.col("evidence"), F.col("format") == "pdf", F.col("draft_owner").isNull()
    pages = lambda e: F.coalesce(e["pdf_pages"], F.array().cast("array<int>"))
    any_quote = lambda wrong: F.coalesce(F.exists(evidence, lambda e: F.coalesce(wrong(e), F.lit(True))), F.lit(False))
    rules = [
        ("wrong_draft", ~F.col("draft_sha").eqNullSafe(draft_sha)),
        ("unknown_document", F.col("format").isNull()),
        ("bad_revision", F.col("expected").isNull() | (F.col("expected") < 0)),
        ("unknown_decision", F.col("decision").isNull() | ~F.col("decision").isin(*DECISIONS)),
        ("long_notes", F.length("notes") > NOTES),
        ("other_document", F.col("draft_owner") != F.col("document_id")),
        ("unknown_fact", added & ~F.coalesce(F.col("fact_id").rlike(MANUAL), F.lit(False))),
        ("no_field", added & (is_blank(F.col("field")) | (F.length("field") > FIELD))),
        ("no_evidence", added & ~F.coalesce(F.size(evidence).between(1, QUOTES), F.lit(False))),
        ("no_quote", added & any_quote(lambda e: is_blank(e["source_text"]))),
        ("bad_pages", added & any_quote(lambda e: F.exists(pages(e), lambda p: ~F.coalesce(p.between(1, PAGES), F.lit(False))))),
        ("no_pages", added & is_pdf & any_quote(lambda e: F.size(pages(e)) == 0)),
        ("pages_without_pdf", added & ~is_pdf & any_quote(lambda e: F.size(pages(e)) > 0)),
        ("no_place", added & ~is_pdf & any_quote(lambda e: F.coalesce(e["item_id"], F.lit("")) == "")),
        ("conflict", ~F.col("alone") | (F.col("expected") != F.coalesce("current", F.lit(0)))),
        ("prior_owner", F.col("prior_owner") != F.col("document_id")),
    ]
    problem = F.coalesce(*[F.when(F.coalesce(broken, F.lit(False)), name) for name, broken in rules])
    return judged.select(*incoming.columns, problem.alias("problem"))


def recorded(accepted: DataFrame, drafts: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows of the store for accepted decisions: the next revision with its value and what may be said of it. An edited or
    added fact has the reviewer's value, any other the draft's."""
    proposed = drafts.select("fact_id", F.col("field").alias("draft_field"), "proposed_value", F.coalesce("value_status", F.lit("proposed_supported")).alias("draft_status"), F.lit(True).alias("drafted"))
    rows = accepted.join(proposed, "fact_id", "left").join(documents.select("document_id", "source_sha"), "document_id")
    is_added, decision = F.col("drafted").isNull(), F.col("decision")
    own = is_added | (decision == "edited")
    value = F.when(own, F.col("value")).otherwise(F.col("proposed_value"))
    said = F.when(F.col("value").isNull(), "unresolved").otherwise("proposed_supported")
    return rows.select(
        "fact_id",
        "document_id",
        (F.col("expected") + 1).cast("long").alias("revision"),
        "decision",
        F.when(is_added, F.col("field")).otherwise(F.col("draft_field")).alias("field"),
        value.alias("value"),
        F.when(own, said).otherwise(F.col("draft_status")).alias("value_status"),
        F.coalesce("notes", F.lit("")).alias("notes"),
        is_added.alias("is_added"),
        "source_sha",
        "draft_sha",
        decision.isin("approved", "edited").alias("approved_for_reference"),
        F.when(is_added, "human_asserted").otherwise("draft_evidence_retained").alias("evidence_validation"),
    )


def flags(decisions: DataFrame) -> DataFrame:
    """What a decision says about its fact."""
    d = F.col("decision")
    return decisions.select(
        "fact_id",
        "revision",
        d.isin("approved", "edited").alias("approved_for_reference"),
        F.when(d == "approved", "supported").when(d == "edited", "edited").when(d == "rejected", "rejected").otherwise("unreviewed").alias("value_status"),
    )


def progress(decisions: DataFrame, total: DataFrame) -> DataFrame:
    """Facts, reviewed, approved and skipped (unsure) facts, and the share reviewed in whole percent."""
    last = latest(decisions)
    joined = total.join(last.select("fact_id", "decision"), "fact_id", "left")
    reviewed = F.sum(F.when(F.col("decision").isin("approved", "edited", "rejected"), 1).otherwise(0))
    return joined.agg(F.count("*").alias("n_facts"), reviewed.alias("n_reviewed"), F.sum(F.when(F.col("decision").isin("approved", "edited"), 1).otherwise(0)).alias("n_approved"), F.sum(F.when(F.col("decision") == "skipped", 1).otherwise(0)).alias("n_skipped")).withColumn("percent", F.floor(100 * F.col("n_reviewed") / F.greatest("n_facts", F.lit(1))))


def upgraded(annotations: DataFrame, vocabulary: tuple[str, ...], added: tuple[str, ...]) -> DataFrame:
    """Annotations with reviewed_topics: all of the vocabulary, but for legacy ones not what was added since, which is
    unknown and not negative; nothing for those not reviewed."""
    every, old = F.array(*map(F.lit, vocabulary)), F.array(*[F.lit(t) for t in vocabulary if t not in added])
    return annotations.withColumn("reviewed_topics", F.when(~F.col("reviewed"), F.array().cast("array<string>")).when(F.col("legacy"), old).otherwise(every))


def annotation_problems(incoming: DataFrame, annotations: DataFrame, passages: DataFrame, vocabulary: tuple[str, ...]) -> DataFrame:
    """`incoming` (doc_id, item_id, topics, notes, expected) with problem, the first that holds, or null: unknown_passage,
    bad_topics (unknown or repeated), bad_revision, long_notes, conflict (another revision is current, or two of the incoming
    want the same passage). `annotations`: doc_id, item_id, revision; `passages`: doc_id, item_id."""
    key = ["doc_id", "item_id"]
    current = annotations.groupBy(*key).agg(F.max("revision").alias("current"))
    known = passages.select(*key, F.lit(True).alias("known")).distinct()
    judged = incoming.withColumn("alone", F.count("*").over(Window.partitionBy(*key)) == 1).join(current, key, "left").join(known, key, "left")
    right = F.forall("topics", lambda t: t.isin(*vocabulary)) & (F.size("topics") == F.size(F.array_distinct("topics")))
    rules = [
        ("unknown_passage", F.col("known").isNull()),
        ("bad_topics", ~F.coalesce(right, F.lit(False))),
        ("bad_revision", F.col("expected").isNull() | (F.col("expected") < 0)),
        ("long_notes", F.length("notes") > ANNOTATION_NOTES),
        ("conflict", ~F.col("alone") | (F.col("expected") != F.coalesce("current", F.lit(0)))),
    ]
    problem = F.coalesce(*[F.when(F.coalesce(broken, F.lit(False)), name) for name, broken in rules])
    return judged.select(*incoming.columns, problem.alias("problem"))


def annotated(accepted: DataFrame, vocabulary: tuple[str, ...]) -> DataFrame:
    """Rows of accepted annotations: the next revision, topics in the vocabulary's order, all of it reviewed."""
    every = F.array(*map(F.lit, vocabulary))
    return accepted.select("doc_id", "item_id", (F.col("expected") + 1).alias("revision"), ordered_topics(F.col("topics"), vocabulary).alias("topics"), every.alias("reviewed_topics"), F.coalesce("notes", F.lit("")).alias("notes"), F.lit(True).alias("reviewed"))


def ordered_topics(topics, vocabulary: tuple[str, ...]):
    """Topics once each, in the vocabulary's order."""
    return F.array_intersect(F.array(*map(F.lit, vocabulary)), topics)

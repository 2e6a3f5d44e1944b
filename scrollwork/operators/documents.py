"""Checks of chunk documents before anything is made of them. Each returns the breaches as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def envelope_violations(envelopes: DataFrame) -> DataFrame:
    """rule, doc_id. `envelopes`: doc_id, schema_version, status, source_sha, is_annotation."""
    rules = [
        ("annotation_file", F.col("is_annotation")),
        ("not_completed", ~F.col("schema_version").eqNullSafe(1) | ~F.col("status").eqNullSafe("completed")),
        ("bad_source", ~F.coalesce(F.col("source_sha").rlike("^[0-9a-f]{64}$"), F.lit(False))),
    ]
    return envelopes.select(F.explode(F.array_compact(F.array(*[F.when(c, n) for n, c in rules]))).alias("rule"), "doc_id")


def coverage_breaches(chunk_items: DataFrame, order: DataFrame) -> DataFrame:
    """rule, doc_id of documents whose chunks, one after another, are not the reading order: `repeated_item`,
    `repeated_chunk` (one chunk_id for several chunks), or `coverage` (missing, unknown or moved items).

    `chunk_items`: doc_id, chunk_no, chunk_id, ord (within the chunk), item_id; `order`: doc_id, ord, item_id. Items are
    numbered per document and compared place by place, so no list of a document is ever built.
    """
    held = chunk_items.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("chunk_no", "ord")) - 1)
    wanted = order.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("ord")) - 1)
    both = held.select("doc_id", "place", F.col("item_id").alias("a")).join(wanted.select("doc_id", "place", F.col("item_id").alias("b")), ["doc_id", "place"], "full")
    moved = both.where("NOT a <=> b").select(F.lit("coverage").alias("rule"), "doc_id").distinct()
    twice = held.groupBy("doc_id", "item_id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("repeated_item").alias("rule"), "doc_id").distinct()
    chunks = chunk_items.groupBy("doc_id", "chunk_id").agg(F.countDistinct("chunk_no").alias("n")).where("n > 1").select(F.lit("repeated_chunk").alias("rule"), "doc_id").distinct()
    return _all([moved, twice, chunks])


def reading_order_violations(order: DataFrame, index: DataFrame) -> DataFrame:
    """rule, doc_id, item_id: places of the reading order that repeat an item, name none of the index, name a container,
    or whose item comes from another source. `index`: doc_id, item_id, is_container, source_sha; `order`: doc_id, ord,
    item_id, source_sha."""
    key = ["doc_id", "item_id"]
    rule = lambda frame, name: frame.select(F.lit(name).alias("rule"), *key)
    twice = order.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    known = order.join(index.withColumnRenamed("source_sha", "own_sha"), key)
    return _all([rule(twice, "repeated"), rule(order.join(index, key, "left_anti").distinct(), "unknown"), rule(known.where("is_container").distinct(), "not_a_leaf"), rule(known.where("NOT own_sha <=> source_sha").distinct(), "other_source")])


def item_violations(items: DataFrame) -> DataFrame:
    """rule, doc_id, item_id: pages that are not positive, parents and headings that no item of the document is, headings
    above an item that are no section headers, and section headers without a positive level.

    `items`: doc_id, item_id, label, level, pages (array), parent_id, heading_ids (array).
    """
    key = ["doc_id", "item_id"]
    rule = lambda frame, name: frame.select(F.lit(name).alias("rule"), *key)
    index = items.select("doc_id", F.col("item_id").alias("of"), F.col("label").alias("of_label"))
    above = items.select(*key, F.explode("heading_ids").alias("of")).join(index, ["doc_id", "of"], "left")
    parents = items.where("parent_id IS NOT NULL").select(*key, F.col("parent_id").alias("of")).join(index, ["doc_id", "of"], "left_anti")
    return _all(
        [
            rule(items.where(F.exists("pages", lambda p: p.isNull() | (p <= 0))), "bad_page"),
            rule(parents, "unknown_parent"),
            rule(above.where("of_label IS NULL").distinct(), "unknown_heading"),
            rule(above.where("of_label <> 'section_header'").distinct(), "not_a_heading"),
            rule(items.where("label = 'section_header' AND NOT coalesce(level > 0, false)"), "bad_level"),
        ]
    )


def answer_differences(saved: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Rows that only one of two tables of the same columns has, as often as it has them more, with `side`."""
    own = sorted(saved.columns)
    a, b = saved.select(*own), recomputed.select(*own)
    return a.exceptAll(b).withColumn("side", F.lit("saved")).unionByName(b.exceptAll(a).withColumn("side", F.lit("recomputed")))


def registration_violations(drafts: DataFrame, corpus: DataFrame) -> DataFrame:
    """rule, key: drafts (doc_id, fact_id, source_sha) whose fact ids repeat, whose documents are not in the corpus
    (doc_id, sha), or whose source is another than the corpus's."""
    key = F.concat_ws("/", "doc_id", "fact_id").alias("key")
    known = drafts.join(corpus, "doc_id")
    return _all(
        [
            drafts.groupBy("doc_id", "fact_id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("repeated_fact").alias("rule"), key),
            drafts.join(corpus, "doc_id", "left_anti").select(F.lit("unknown_document").alias("rule"), key).distinct(),
            known.where("NOT sha <=> source_sha").select(F.lit("other_source").alias("rule"), key).distinct(),
        ]
    )


def model_substitutions(calls: DataFrame) -> DataFrame:
    """Calls (key, asked_model, model, asked_style, style) that another model or API style answered than was asked."""
    return calls.where("NOT asked_model <=> model OR NOT asked_style <=> style")

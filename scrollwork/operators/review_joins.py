"""A human view of a classified document: chunks with their topics, passages with the chunks they answer for, tables from
their cells. Whatever does not fit together is a row of a breach, not a missing row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: What the id of a table starts with.
TABLES = "#/tables/"
#: A group is itself: one passage of a topic, with these citations in these roles.
GROUP = ["doc_id", "topic", "group_id", "evidence", "context"]


def passage_targets(mapped: DataFrame, classified: DataFrame) -> DataFrame:
    """Groups of the topic map with target_chunks: the chunks, in order, whose answers hold the same group for the topic; none
    if there is no such answer.

    Both: doc_id, topic, group_id, evidence, context (arrays of item ids or places); `classified` has chunk_no too. Groups
    are equal if all of this is, arrays too, so the join is one on equality and needs no look into a chunk's groups.
    """
    answers = classified.select(*GROUP, "chunk_no").distinct()
    found = mapped.select(*GROUP).distinct().join(answers, GROUP, "left").groupBy(*GROUP).agg(F.array_sort(F.collect_set("chunk_no")).alias("target_chunks"))
    return found


def review_breaches(mapped: DataFrame, classified: DataFrame, items: DataFrame, id_column: str = "item_id") -> DataFrame:
    """rule, doc_id, topic, group_id: groups that no answer holds (`no_target`), and those that cite what no captured chunk
    has (`missing_citation`). `items`: doc_id and the column that citations name."""
    rule = lambda frame, name: frame.select(F.lit(name).alias("rule"), "doc_id", "topic", "group_id")
    lost = mapped.join(classified.select(*GROUP), GROUP, "left_anti")
    cited = mapped.select("doc_id", "topic", "group_id", F.explode(F.concat("evidence", "context")).alias(id_column))
    missing = cited.join(items.select("doc_id", id_column), ["doc_id", id_column], "left_anti")
    return rule(lost, "no_target").distinct().unionByName(rule(missing, "missing_citation").distinct())


def chunk_reviews(chunks: DataFrame, items: DataFrame, classified: DataFrame) -> DataFrame:
    """Every chunk, classified or not: doc_id, chunk_no, n_items, pages, n_headings (distinct headings above its items),
    final_topics (sorted) and is_unclassified.

    `chunks`: doc_id, chunk_no; `items`: doc_id, chunk_no, item_id, page, heading_ids; `classified`: doc_id, chunk_no,
    topic.
    """
    key = ["doc_id", "chunk_no"]
    held = items.groupBy(*key).agg(F.countDistinct("item_id").alias("n_items"), F.array_sort(F.collect_set("page")).alias("pages"))
    headings = items.select(*key, F.explode("heading_ids").alias("heading")).groupBy(*key).agg(F.countDistinct("heading").alias("n_headings"))
    topics = classified.groupBy(*key).agg(F.array_sort(F.collect_set("topic")).alias("final_topics"))
    joined = chunks.select(*key).distinct().join(held, key, "left").join(headings, key, "left").join(topics, key, "left")
    none = F.array().cast("array<string>")
    return joined.select(
        *key,
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("pages", F.array().cast(held.schema["pages"].dataType)).alias("pages"),
        F.coalesce("n_headings", F.lit(0)).alias("n_headings"),
        F.coalesce("final_topics", none).alias("final_topics"),
        F.col("final_topics").isNull().alias("is_unclassified"),
    )


def table_grids(cells: DataFrame) -> DataFrame:
    """doc_id, item_id, grid (rows of cell texts) from single cells: doc_id, item_id, row_start, ord, text. Rows in order of
    their start (null: 0), cells in the order met; a null text is empty. Combined by row first, then by table."""
    rows = cells.groupBy("doc_id", "item_id", F.coalesce("row_start", F.lit(0)).alias("row_start")).agg(F.array_sort(F.collect_list(F.struct("ord", F.coalesce("text", F.lit("")).alias("text")))).alias("c"))
    rows = rows.select("doc_id", "item_id", F.struct("row_start", F.transform("c", lambda s: s["text"]).alias("cells")).alias("row"))
    return rows.groupBy("doc_id", "item_id").agg(F.transform(F.array_sort(F.collect_list("row")), lambda r: r["cells"]).alias("grid"))


def cited_texts(cited: DataFrame, items: DataFrame, cells: DataFrame) -> DataFrame:
    """`cited` (doc_id, item_id and more) with text and problem. A table's text is its canonical grid; any other item's is its
    original wording, else its text. Problems: `missing_citation` (no such item), `table_without_cells`, `unreadable` (nothing
    but white space). `items`: doc_id, item_id, original_text, text; only cells of cited tables are put together."""
    key = ["doc_id", "item_id"]
    wanted = cited.where(F.col("item_id").startswith(TABLES)).select(*key).distinct()
    grids = table_grids(cells.join(wanted, key, "left_semi"))
    own = items.select(*key, T.first_filled(F.col("original_text"), F.col("text")).alias("own_text"))
    joined = cited.join(own, key, "left").join(grids, key, "left")
    is_table = F.col("item_id").startswith(TABLES)
    text = F.when(is_table, T.render_grid(F.col("grid"))).otherwise(F.col("own_text"))
    problem = F.when(F.col("own_text").isNull(), "missing_citation").when(is_table & F.col("grid").isNull(), "table_without_cells").when(T.is_blank(text), "unreadable")
    return joined.select(*cited.columns, F.when(problem.isNull(), text).alias("text"), problem.alias("problem"))

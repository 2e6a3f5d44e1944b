"""Document structure: item index, tree walk, headings, atomic units, chunks, neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import text as T
from .folds import batch_step, by_document, dealt, expanded, fold, heading_step, pageless_step, paged_step
from .messages import canonical_json
from .terms import cyclic_parties

#: Rows of a tree that are handed on at once, the path entries among them, and the types of its columns.
_ROWS, _ENTRIES = 10_000, 1_000_000
_KINDS = {"item_id": pa.string(), "parent_id": pa.string(), "path": pa.list_(pa.string()), "depth": pa.int32(), "is_container": pa.bool_(), "reading_order": pa.int64(), "list_key": pa.string()}


def _by_pos() -> WindowSpec:
    return Window.partitionBy("doc_id").orderBy("pos")


def _so_far() -> WindowSpec:
    return _by_pos().rowsBetween(Window.unboundedPreceding, 0)


def item_index(items: DataFrame) -> DataFrame:
    """Collection, position and type of every item: its label in `texts`, else the singular of its collection."""
    collection = T.id_collection(F.col("item_id"))
    return items.select("doc_id", "item_id", collection.alias("collection"), T.id_position(F.col("item_id")).alias("position"), F.when((collection == "texts") & F.col("label").isNotNull(), F.col("label")).otherwise(F.regexp_replace(collection, "s$", "")).alias("item_type"))


def walk(edges: DataFrame, root: str = "#/body", paths: bool = True) -> DataFrame:
    """Depth-first expansion of each document from `root`: doc_id, item_id, parent_id, path (containers from the root; null
    unless `paths`), depth (1 below the root), is_container, reading_order (of leaves, from 0; null for containers) and
    list_key (the outermost list around or at it).

    `edges`: doc_id, parent_id, child_id, child_pos and, if there are lists, is_list (the child is one). A container is
    what `#/groups/` starts; other items are leaves whatever they hold. Equal places go by id. Every item is entered once,
    where it is met first; `tree_violations` reports those that are held twice or hold themselves. Trees of any depth: a task
    goes through its documents one by one and holds one document's edges. Paths of a very deep tree are as many entries as
    its depth for every item; leave them out there.
    """
    listed = F.coalesce("is_list", F.lit(False)) if "is_list" in edges.columns else F.lit(False)
    own = edges.select("doc_id", "parent_id", F.col("child_pos").cast("long").alias("child_pos"), "child_id", listed.alias("is_list"))
    schema = f"doc_id {edges.schema['doc_id'].dataType.simpleString()}, item_id string, parent_id string, path array<string>, depth int, is_container boolean, reading_order long, list_key string"

    def parts(found: Iterator[tuple]) -> Iterator[list[tuple]]:
        rows, entries = [], 0
        for row in found:
            rows.append(row)
            entries += row[3] if paths else 0
            if len(rows) >= _ROWS or entries >= _ENTRIES:
                yield rows
                rows, entries = [], 0
        if rows:
            yield rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, rows in by_document(batches, ["parent_id", "child_id", "is_list"]):
            children: dict[str, list] = {}
            for parent, child, is_list in rows:
                children.setdefault(parent, []).append((child, is_list))
            for part in parts(expanded(children, root, paths)):
                columns = dict(zip(_KINDS, map(list, zip(*part, strict=True)), strict=True))
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([doc.as_py()] * len(part), doc.type), **{n: pa.array(c, _KINDS[n]) for n, c in columns.items()}})

    return dealt(own, "doc_id").sortWithinPartitions("doc_id", "parent_id", "child_pos", "child_id").mapInArrow(run, schema)


def placed(items: DataFrame, tree: DataFrame) -> DataFrame:
    """Items (doc_id, item_id and more) that the walk meets as leaves, with the place and the list it gives them: pos,
    list_key."""
    leaves = tree.where("NOT is_container").select("doc_id", "item_id", F.col("reading_order").alias("pos"), "list_key")
    return items.drop("pos", "list_key").join(leaves, ["doc_id", "item_id"])


def reading_order(tree: DataFrame) -> DataFrame:
    """Leaves of each document, numbered in depth-first order."""
    return tree.where("NOT is_container").select("doc_id", "item_id", "parent_id", "path", "reading_order")


def tree_violations(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """rule, doc_id, item_id: references to nothing (`unresolved`), groups that contain themselves (`cycle`), items that
    are held more than once (`repeated`). `nodes`: doc_id, item_id."""
    rule = lambda frame, name, item: frame.select(F.lit(name).alias("rule"), "doc_id", F.col(item).alias("item_id"))
    groups = edges.where("parent_id LIKE '#/groups/%' AND child_id LIKE '#/groups/%'").select("doc_id", F.col("parent_id").alias("parent"), F.col("child_id").alias("child"))
    own = groups.where("parent = child").select("doc_id", F.col("parent").alias("party"))
    cycles = rule(cyclic_parties(groups).unionByName(own).distinct(), "cycle", "party")
    unresolved = rule(edges.join(nodes.select("doc_id", F.col("item_id").alias("child_id")), ["doc_id", "child_id"], "left_anti"), "unresolved", "child_id").distinct()
    repeated = rule(edges.groupBy("doc_id", "child_id").agg(F.count("*").alias("n")).where("n > 1"), "repeated", "child_id")
    return unresolved.unionByName(cycles).unionByName(repeated)


def heading_paths(items: DataFrame) -> DataFrame:
    """For every item the headings above it, itself included: heading_positions, outermost first. A heading closes those of
    its level and deeper ones.

    One fold over each document's items that keeps the open headings, whatever levels there are.
    """
    own = items.select("doc_id", "pos", "level")
    return fold(own, ["doc_id"], ["pos"], ["level", "pos"], heading_step, "heading_positions", f"array<{own.schema['pos'].dataType.simpleString()}>").drop("level")


def heading_warnings(items: DataFrame) -> DataFrame:
    """doc_id, code, n, first_pos: documents without headings, with skipped levels, with pages that run backward, and
    with only one level in two or more headings."""
    heads = items.where("level IS NOT NULL")
    before, page_before = F.lag("level").over(_by_pos()), F.lag("page").over(_by_pos())
    marked = heads.select("doc_id", "pos", "level", "page", before.alias("before"), page_before.alias("page_before"))
    skipped = marked.where("before IS NULL AND level > 1 OR level > before + 1").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos")).withColumn("code", F.lit("skipped_levels"))
    backward = marked.where("page < page_before").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos")).withColumn("code", F.lit("non_monotonic_pages"))
    flat = heads.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"), F.min("level").alias("a"), F.max("level").alias("b")).where("n > 1 AND a = b").drop("a", "b").withColumn("code", F.lit("flat_levels"))
    none = items.groupBy("doc_id").agg(F.count("level").alias("n")).where("n = 0").withColumn("first_pos", F.lit(None).cast("int")).withColumn("code", F.lit("no_headings"))
    columns = ["doc_id", "code", "n", "first_pos"]
    return none.select(columns).unionByName(skipped.select(columns)).unionByName(backward.select(columns)).unionByName(flat.select(columns))


def _unit_key() -> Column:
    return F.coalesce("list_key", F.concat(F.lit("#"), "pos"))


def _begins() -> Column:
    """Whether an item is the first of its unit."""
    return F.coalesce(F.lag(_unit_key()).over(_by_pos()) != _unit_key(), F.lit(True))


def unit_spans(items: DataFrame) -> DataFrame:
    """doc_id, unit_no, pos, last_pos of the atomic units, for those who need no more of them.

    A unit is told at its last item, with the latest beginning before: one pass over sorted items, and no table of units by key.
    """
    ends = F.coalesce(F.lead(_unit_key()).over(_by_pos()) != _unit_key(), F.lit(True))
    marked = items.select("doc_id", "pos", _begins().alias("begins"), ends.alias("ends"))
    begun = F.when(F.col("begins"), F.col("pos"))
    told = marked.select("doc_id", (F.count(begun).over(_so_far()) - 1).alias("unit_no"), F.max(begun).over(_so_far()).alias("first"), "pos", "ends").where("ends")
    return told.select("doc_id", "unit_no", F.col("first").alias("pos"), F.col("pos").alias("last_pos"))


def atomic_units(items: DataFrame) -> DataFrame:
    """Units that are never split: neighbouring items of one list are one, every other item is its own.

    doc_id, unit_no (from 0), pos, last_pos, n_items, length (joined by line feeds), first_page, last_page, pages (sorted),
    starts_heading, list_key.
    """
    numbered = items.withColumn("new", F.when(_begins(), 1).otherwise(0)).withColumn("unit_no", F.sum("new").over(_so_far()) - 1)
    filled = F.when(F.length("text") > 0, 1).otherwise(0)
    return numbered.groupBy("doc_id", "unit_no").agg(
        F.min("pos").alias("pos"),
        F.max("pos").alias("last_pos"),
        F.count("*").alias("n_items"),
        (F.sum(F.length("text")) + F.greatest(F.sum(filled) - 1, F.lit(0))).alias("length"),
        F.min("page").alias("first_page"),
        F.max("page").alias("last_page"),
        F.array_sort(F.collect_set("page")).alias("pages"),
        F.max(F.struct((-F.col("pos")).alias("p"), F.col("level").isNotNull().alias("h"))).getField("h").alias("starts_heading"),
        F.max("list_key").alias("list_key"),
    )


def list_violations(units: DataFrame) -> DataFrame:
    """Lists that come back after another item: doc_id, list_key, n."""
    return units.where("list_key IS NOT NULL").groupBy("doc_id", "list_key").agg(F.count("*").alias("n")).where("n > 1")


def paged_assignment(units: DataFrame, target: int) -> DataFrame:
    """Units of documents with pages, with chunk_no."""
    paged = units.groupBy("doc_id").agg(F.max("first_page").alias("any")).where("any IS NOT NULL").select("doc_id")
    return fold(units.join(paged, "doc_id", "left_semi"), ["doc_id"], ["unit_no"], ["first_page", "length"], paged_step(target), "chunk_no")


def pageless_assignment(units: DataFrame, target: int) -> DataFrame:
    """Units of documents without pages, with chunk_no. Blocks begin at units that start with a heading."""
    paged = units.groupBy("doc_id").agg(F.max("first_page").alias("any")).where("any IS NULL").select("doc_id")
    by_unit = Window.partitionBy("doc_id").orderBy("unit_no")
    own = units.join(paged, "doc_id", "left_semi").withColumn("block_no", F.sum(F.col("starts_heading").cast("int")).over(by_unit.rowsBetween(Window.unboundedPreceding, 0)))
    block = Window.partitionBy("doc_id", "block_no")
    filled = F.when(F.col("length") > 0, 1).otherwise(0)
    own = own.select(
        "*",
        (F.sum("length").over(block) + F.greatest(F.sum(filled).over(block) - 1, F.lit(0))).alias("block_length"),
        (F.row_number().over(block.orderBy("unit_no")) == 1).alias("starts_block"),
        (F.col("unit_no") == F.max("unit_no").over(block)).alias("ends_block"),
    )
    return fold(own, ["doc_id"], ["unit_no"], ["starts_block", "ends_block", "block_length", "length"], pageless_step(target), "chunk_no").drop("block_no", "block_length", "starts_block", "ends_block")


def chunk_records(assigned: DataFrame, target: int) -> DataFrame:
    """One row per chunk: extent, size, pages (sorted), group_ids (its lists, in order), neighbours, and why it is over the
    target if it is."""
    filled = F.when(F.col("length") > 0, 1).otherwise(0)
    chunks = assigned.groupBy("doc_id", "chunk_no").agg(
        F.min("pos").alias("first_pos"),
        F.max("last_pos").alias("last_pos"),
        F.sum("n_items").alias("n_items"),
        F.count("*").alias("n_units"),
        (F.sum("length") + F.greatest(F.sum(filled) - 1, F.lit(0))).alias("character_count"),
        F.min("first_page").alias("first_page"),
        F.max("last_page").alias("last_page"),
        F.count("list_key").alias("n_lists"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("pages")))).alias("pages"),
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("list_key").isNotNull(), F.struct("unit_no", "list_key")))), lambda u: u["list_key"])).alias("group_ids"),
    )
    by_doc = Window.partitionBy("doc_id").orderBy("chunk_no")
    name = lambda n: T.numbered("chunk", n + 1)
    return chunks.select(
        "*",
        name(F.col("chunk_no")).alias("chunk_id"),
        F.lag(name(F.col("chunk_no"))).over(by_doc).alias("previous_chunk_id"),
        F.lead(name(F.col("chunk_no"))).over(by_doc).alias("next_chunk_id"),
        F.when(F.col("character_count") > target, F.when(F.col("n_lists") > 0, "atomic_list").otherwise("atomic_item")).alias("oversized_reason"),
    )


def coverage_violations(items: DataFrame, chunks: DataFrame) -> DataFrame:
    """doc_id, n_items, n_covered of documents whose chunks do not hold every item once, in order."""
    wanted = items.groupBy("doc_id").agg(F.count("*").alias("n_items"))
    by_doc = Window.partitionBy("doc_id").orderBy("chunk_no")
    gaps = chunks.select("doc_id", "n_items", (F.col("first_pos") != F.coalesce(F.lag("last_pos").over(by_doc) + 1, F.lit(0))).cast("int").alias("gap"))
    held = gaps.groupBy("doc_id").agg(F.sum("n_items").alias("n_covered"), F.sum("gap").alias("gaps"))
    return wanted.join(held, "doc_id").where("n_items <> n_covered OR gaps > 0").select("doc_id", "n_items", "n_covered")


def json_size(columns: list[str]) -> Column:
    """Characters of these columns as a JSON object."""
    return F.length(canonical_json(F.to_variant_object(F.struct(*columns)))).cast("long")


def packed_batches(chunks: DataFrame, most: int = 5, most_characters: int = 24_000) -> DataFrame:
    """Chunks with batch_no; `is_oversized` marks those that fill a batch alone. character_count is what a chunk takes of a
    batch: its text, or the size of all that is sent (`json_size`)."""
    if not 1 <= most <= 5 or most_characters <= 0:
        raise ValueError("a batch holds 1 to 5 chunks and some characters")
    out = fold(chunks.select("doc_id", "chunk_no", "character_count"), ["doc_id"], ["chunk_no"], ["character_count"], batch_step(most, most_characters), "batch_no")
    return out.withColumn("is_oversized", F.col("character_count") > most_characters)


def neighbour_frames(assigned: DataFrame, k: int = 1) -> DataFrame:
    """For every chunk the units just outside it: doc_id, chunk_no, side, unit_no, pos, last_pos."""
    if k < 0:
        raise ValueError("the number of neighbours is 0 or more")
    ends = assigned.groupBy("doc_id", "chunk_no").agg(F.min("unit_no").alias("a"), F.max("unit_no").alias("b"))
    wanted = ends.select("doc_id", "chunk_no", F.explode(F.concat(*[F.array(F.struct(F.lit("before").alias("side"), (F.col("a") - d).alias("unit_no")), F.struct(F.lit("after").alias("side"), (F.col("b") + d).alias("unit_no"))) for d in range(1, k + 1)])).alias("w")).select("doc_id", "chunk_no", "w.*") if k else ends.select("doc_id", "chunk_no", F.lit("").alias("side"), F.col("a").alias("unit_no")).where("false")
    return wanted.join(assigned.select("doc_id", "unit_no", "pos", "last_pos"), ["doc_id", "unit_no"]).select("doc_id", "chunk_no", "side", "unit_no", "pos", "last_pos")


def context_frame(items: DataFrame, reach: int = 3) -> DataFrame:
    """Characters around every item: of its page, or without one, of `reach` items to either side."""
    near = F.sum(F.length("text")).over(_by_pos().rowsBetween(-reach, reach))
    page = F.sum(F.length("text")).over(Window.partitionBy("doc_id", "page"))
    return items.select("doc_id", "pos", F.when(F.col("page").isNotNull(), page).otherwise(near).alias("context_length"))

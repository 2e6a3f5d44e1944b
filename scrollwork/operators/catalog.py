"""What a reviewer labels: passages of a document in reading order, and the identity of such a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_filled, is_blank
from .review_joins import table_grids


def passages(items: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """doc_id, ord, item_id, text, grid (rows of cells; empty if the item is no table), label, pages, heading_ids and
    containers of every item that can be read; those without a visible character and without a grid are left out.

    `items`: doc_id, ord (place in the reading order), item_id, orig, text, label, pages, heading_ids, containers. `cells`:
    doc_id, item_id, row_start, ord, text of single table cells.
    """
    none = F.array().cast("array<array<string>>")
    own = items.withColumn("shown", first_filled(F.col("orig"), F.col("text")))
    if cells is None:
        own = own.withColumn("grid", none)
    else:
        own = own.join(table_grids(cells), ["doc_id", "item_id"], "left").withColumn("grid", F.coalesce("grid", none))
    kept = own.where(~is_blank(F.col("shown")) | (F.size("grid") > 0))
    return kept.select("doc_id", "ord", "item_id", F.col("shown").alias("text"), "grid", F.coalesce("label", F.lit("text")).alias("label"), "pages", "heading_ids", "containers")


def catalogs(found: DataFrame) -> DataFrame:
    """doc_id, n_passages and catalog_sha: another order, text, cell, page or heading gives another identity.

    A passage is hashed where it lies, and a document by the hashes of its passages in order, so 64 characters a passage come
    together and no text does.
    """
    own = ["item_id", "text", "grid", "label", "pages", "heading_ids", "containers"]
    hashed = found.select("doc_id", F.struct("ord", F.sha2(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}).cast("binary"), 256).alias("sha")).alias("p"))
    listed = hashed.groupBy("doc_id").agg(F.count("*").alias("n_passages"), F.array_sort(F.collect_list("p")).alias("ps"))
    return listed.select("doc_id", "n_passages", F.sha2(F.array_join(F.transform("ps", lambda p: p["sha"]), "\n").cast("binary"), 256).alias("catalog_sha"))

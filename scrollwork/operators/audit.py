"""Corpus audit: exact copies, keyword screens, vintages, agreement with human labels, redaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normal_key

#: Names of fields that hold secrets, as letters only.
SECRET_KEYS = ("apikey", "authorization", "headers", "credential", "credentials", "token", "secret", "password")


def exact_copies(docs: DataFrame) -> DataFrame:
    """Texts that several documents have: sha, how many, the smallest id."""
    return docs.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("sha")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


def keyword_screen(docs: DataFrame, signals: str, mechanics: str) -> DataFrame:
    """Documents with a word of either pattern."""
    return docs.where(F.col("text").rlike(signals) & F.col("text").rlike(mechanics)).select("doc_id", "source")


def vintage(year: Column, edges: tuple[int, ...]) -> Column:
    """The bucket of a year: before the first edge, from one to the next, or from the last on."""
    out = F.when(year < edges[0], F.lit(f"before {edges[0]}"))
    for a, b in zip(edges, edges[1:], strict=False):
        out = out.when(year < b, F.lit(f"{a}-{b - 1}"))
    return out.otherwise(F.lit(f"from {edges[-1]}"))


def agreement(predicted: DataFrame, reference: DataFrame) -> DataFrame:
    """Pooled hits and misses of labels (doc_id, label) on the documents of the reference (doc_id, label; a null label
    for a document with none), documents whose labels agree entirely, and micro precision, recall and F1 in
    ten-thousandths."""
    scope = reference.select("doc_id").distinct()
    mine = predicted.join(scope, "doc_id", "left_semi").select("doc_id", "label", F.lit(1).alias("p")).distinct()
    theirs = reference.where("label IS NOT NULL").select("doc_id", "label", F.lit(1).alias("r")).distinct()
    pairs = mine.join(theirs, ["doc_id", "label"], "full")
    per_doc = pairs.groupBy("doc_id").agg(F.sum(F.when(F.col("p").isNotNull() & F.col("r").isNotNull(), 1).otherwise(0)).alias("tp"), F.sum(F.when(F.col("r").isNull(), 1).otherwise(0)).alias("fp"), F.sum(F.when(F.col("p").isNull(), 1).otherwise(0)).alias("fn"))
    every = scope.join(per_doc, "doc_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    sums = every.agg(F.count("*").alias("n_docs"), F.sum(zero("tp")).alias("tp"), F.sum(zero("fp")).alias("fp"), F.sum(zero("fn")).alias("fn"), F.sum(F.when(zero("fp") + zero("fn") == 0, 1).otherwise(0)).alias("n_exact"))
    share = lambda a, b: F.when(b > 0, F.floor(10_000 * a / b))
    return sums.select("n_docs", "tp", "fp", "fn", "n_exact", share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), share(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"), share(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def redacted(fields: Column) -> Column:
    """A map with the values of secret fields replaced."""
    return F.transform_values(fields, lambda k, v: F.when(normal_key(k).isin(*SECRET_KEYS), F.lit("[REDACTED]")).otherwise(v))


def not_completed(inputs: DataFrame, manifest: DataFrame, profile: str) -> DataFrame:
    """Inputs (sha) that no completed manifest row has under this profile: what a cached job still has to do."""
    done = manifest.where((F.col("status") == "completed") & (F.col("profile") == profile)).select("sha")
    return inputs.join(done, "sha", "left_anti")

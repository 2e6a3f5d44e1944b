"""Checks of raw inputs before they are walked: references of containers, positions, manifests, classifications of old."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .topics import TOPICS, parent_of


def _kind(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def reference_problems(raw: DataFrame) -> DataFrame:
    """rule, doc_id, item_id of containers (doc_id, item_id, value: a variant) whose `children` are no list (`no_list`), or
    hold what is no object with a text `$ref` (`no_reference`). Without children a container is empty."""
    own = raw.select("doc_id", "item_id", F.try_variant_get("value", "$.children", "variant").alias("children")).where("children IS NOT NULL")
    no_list = own.where(_kind(F.col("children")) != "ARRAY").select(F.lit("no_list").alias("rule"), "doc_id", "item_id")
    each = F.try_variant_get("children", "$", "array<variant>")
    right = lambda c: F.coalesce((_kind(c) == "OBJECT") & (_kind(F.try_variant_get(c, "$['$ref']", "variant")) == "STRING"), F.lit(False))
    no_reference = own.where(F.coalesce(F.exists(each, lambda c: ~right(c)), F.lit(False))).select(F.lit("no_reference").alias("rule"), "doc_id", "item_id")
    return no_list.unionByName(no_reference)


def position_problems(items: DataFrame) -> DataFrame:
    """doc_id, collection, position, self_ref of items whose reference is not their place: `#/<collection>/<position>`."""
    due = F.concat_ws("/", F.lit("#"), "collection", F.col("position").cast("string"))
    return items.where(~F.col("self_ref").eqNullSafe(due)).select("doc_id", "collection", "position", "self_ref")


def manifest_mode_problems(manifests: DataFrame) -> DataFrame:
    """doc_id, problem: a manifest (doc_id, use_hierarchy, enabled, status, names_artifact, artifact, expected) must say itself
    that there is no hierarchy where none is used (`not_disabled`), and name the expected one where it is
    (`conflicting`). `names_artifact`: the manifest has the entry at all; `enabled` null: not said."""
    used = F.coalesce("enabled", F.lit(True)) & F.col("artifact").eqNullSafe(F.col("expected")) & F.col("expected").isNotNull()
    unused = F.col("enabled").eqNullSafe(False) & F.col("status").eqNullSafe("disabled") & F.coalesce("names_artifact", F.lit(False)) & F.col("artifact").isNull()
    problem = F.when(F.col("use_hierarchy") & ~used, "conflicting").when(~F.col("use_hierarchy") & ~unused, "not_disabled")
    return manifests.select("doc_id", problem.alias("problem")).where("problem IS NOT NULL")


def legacy_violations(rows: DataFrame, labels: DataFrame, scope: DataFrame, chunks: DataFrame) -> DataFrame:
    """rule, doc_id, chunk_no, topic of classifications of version 1, whose labels cite items without a role.

    `rows`: doc_id, chunk_no, row_no of every answer; `labels`: doc_id, chunk_no, topic, cited (array of item ids); `scope`:
    doc_id, chunk_no, item_id that an answer may cite (its items and the headings above them); `chunks`: doc_id, chunk_no.
    """
    key = ["doc_id", "chunk_no"]
    none = F.lit(None).cast("string")
    rule = lambda frame, name, topic=none: frame.select(F.lit(name).alias("rule"), *key, topic.alias("topic"))
    cited = labels.select(*key, "topic", F.explode("cited").alias("item_id"))
    # answers and chunks meet in one count by key, so neither is sent whole to every task; keys with a null meet nothing
    held = rows.select(*key, F.lit(1).alias("answer")).unionByName(chunks.select(*key, F.lit(0).alias("answer")))
    met = held.groupBy(*key).agg(F.sum("answer").alias("n"), F.sum(1 - F.col("answer")).alias("n_chunks"))
    apart = F.isnull("doc_id") | F.isnull("chunk_no")
    out = [
        rule(met.where((F.col("n") > 0) & ((F.col("n_chunks") == 0) | apart)), "unknown_chunk"),
        rule(met.where("n > 1"), "repeated_chunk"),
        rule(met.where((F.col("n_chunks") > 0) & ((F.col("n") == 0) | apart)), "unanswered"),
        rule(labels.where(~F.coalesce(F.col("topic").isin(*TOPICS), F.lit(False))), "unknown_topic", F.col("topic")),
        rule(labels.groupBy(*key, "topic").agg(F.count("*").alias("n")).where("n > 1"), "repeated_topic", F.col("topic")),
        rule(labels.where(F.size("cited") != F.size(F.array_distinct("cited"))), "repeated_citation", F.col("topic")),
        rule(cited.join(scope.select(*key, "item_id"), [*key, "item_id"], "left_anti").select(*key, "topic").distinct(), "out_of_scope", F.col("topic")),
    ]
    total = out[0]
    for frame in out[1:]:
        total = total.unionByName(frame)
    return total


def legacy_normalized(labels: DataFrame, scope: DataFrame) -> DataFrame:
    """doc_id, chunk_no, topic, topic_ord, cited: labels in the order of the taxonomy, those of a subtopic added to its parent's,
    each item once and in the order of `scope` (doc_id, chunk_no, item_id, ord)."""
    key = ["doc_id", "chunk_no"]
    lifted = labels.select(*key, F.explode(F.array_compact(F.array(F.col("topic"), parent_of(F.col("topic"))))).alias("topic"), "cited")
    cited = lifted.select(*key, "topic", F.explode_outer("cited").alias("item_id")).distinct().join(scope, [*key, "item_id"], "left")
    grouped = cited.groupBy(*key, "topic").agg(F.array_sort(F.collect_list(F.when(F.col("item_id").isNotNull(), F.struct("ord", "item_id")))).alias("c"))
    return grouped.select(*key, "topic", (F.array_position(F.array(*map(F.lit, TOPICS)), F.col("topic")) - 1).cast("int").alias("topic_ord"), F.transform("c", lambda x: x["item_id"]).alias("cited"))


def cache_problems(wanted: DataFrame, manifests: DataFrame, files: DataFrame) -> DataFrame:
    """`wanted` (sha, profile, version) with problem: why its cached result cannot be used, or null. The first of no_manifest,
    not_completed, other_source (the manifest names another hash), other_profile, other_version, other_names (its files are
    not `names`), missing_file (one of these is not there or empty).

    `manifests`: sha (of the folder it lies in), source_sha, status, profile, version, names, expected_names (arrays).
    `files`: sha, name, length.
    """
    held = files.where("length > 0").groupBy("sha").agg(F.collect_set("name").alias("held"))
    joined = wanted.join(manifests.withColumnsRenamed({"profile": "own_profile", "version": "own_version"}).withColumn("found", F.lit(True)), "sha", "left").join(held, "sha", "left")
    same = lambda a, b: F.array_sort(a).eqNullSafe(F.array_sort(b))
    rules = [
        ("no_manifest", F.col("found").isNull()),
        ("not_completed", ~F.col("status").eqNullSafe("completed")),
        ("other_source", ~F.col("source_sha").eqNullSafe(F.col("sha"))),
        ("other_profile", ~F.col("own_profile").eqNullSafe(F.col("profile"))),
        ("other_version", ~F.col("own_version").eqNullSafe(F.col("version"))),
        ("other_names", ~same(F.col("names"), F.col("expected_names"))),
        ("missing_file", F.size(F.array_except("names", F.coalesce("held", F.array().cast("array<string>")))) > 0),
    ]
    problem = F.coalesce(*[F.when(F.coalesce(broken, F.lit(False)), name) for name, broken in rules])
    return joined.select(*wanted.columns, problem.alias("problem"))

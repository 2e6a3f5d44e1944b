"""Document structure on rows written by hand."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from scrollwork.operators import structure as S
from scrollwork.operators import topics
from scrollwork.operators.folds import batch_step, paged_step, pageless_step
from scrollwork.plans import record_queries, topic_queries
from scrollwork.plans.pipeline import Settings

ITEM = "doc_id long, pos int, item_id string, text string, page int, label string, level int, list_key string"


def items(spark, rows):
    """(text, page, level, list_key) of one document."""
    return spark.createDataFrame([(1, k, f"#/texts/{k}", t, p, "section_header" if lv else "text", lv, key) for k, (t, p, lv, key) in enumerate(rows)], ITEM)


def run(step, rows):
    state, out = None, []
    for r in rows:
        state, n = step(state, *r)
        out.append(n)
    return out


def test_heading_path_drops_equal_and_deeper_levels(spark):
    rows = [("a", 1, 1, None), ("x", 1, None, None), ("b", 1, 2, None), ("c", 1, 3, None), ("d", 1, 2, None), ("y", 1, None, None), ("e", 1, 1, None)]
    got = {r["pos"]: r["heading_positions"] for r in S.heading_paths(items(spark, rows)).collect()}
    assert got == {0: [0], 1: [0], 2: [0, 2], 3: [0, 2, 3], 4: [0, 4], 5: [0, 4], 6: [6]}


def test_heading_warnings(spark):
    codes = lambda rows: {r["code"] for r in S.heading_warnings(items(spark, rows)).collect()}
    assert codes([("x", 1, None, None)]) == {"no_headings"}
    assert codes([("a", 1, 1, None), ("b", 2, 1, None)]) == {"flat_levels"}
    assert codes([("a", 1, 2, None), ("b", 1, 1, None)]) == {"skipped_levels"}
    assert codes([("a", 1, 1, None), ("b", 1, 3, None)]) == {"skipped_levels"}
    assert codes([("a", 3, 1, None), ("b", 2, 2, None)]) == {"non_monotonic_pages"}


def test_lists_are_one_unit_and_empty_texts_take_no_separator(spark):
    rows = [("ab", 1, None, "l"), ("", 1, None, "l"), ("c", 2, None, "l"), ("d", None, None, None)]
    units = S.atomic_units(items(spark, rows)).orderBy("unit_no").collect()
    assert [(u["n_items"], u["length"], u["first_page"], u["last_page"]) for u in units] == [(3, 4, 1, 2), (1, 1, None, None)]


def test_list_that_comes_back_is_reported(spark):
    rows = [("a", 1, None, "l"), ("b", 1, None, None), ("c", 1, None, "l")]
    assert [r["n"] for r in S.list_violations(S.atomic_units(items(spark, rows))).collect()] == [2]


def test_paged_packing_rules():
    assert run(paged_step(10), [(1, 4), (1, 5), (1, 1)]) == [0, 0, 1]  # 4 + 1 + 5 = 10 fits, one more does not
    assert run(paged_step(10), [(1, 50), (None, 50), (2, 1)]) == [0, 0, 1]  # without a page: never a split
    assert run(paged_step(10), [(None, 9), (1, 9), (1, 9)]) == [0, 0, 1]  # leading ones join the first page
    assert run(paged_step(99), [(1, 1), (2, 1), (1, 1)]) == [0, 1, 2]
    assert run(paged_step(2), [(1, 0), (1, 2), (1, 0)]) == [0, 0, 0]


def test_pageless_packing_rules():
    block = lambda lengths: [(k == 0, k == len(lengths) - 1, sum(lengths) + len(lengths) - 1, n) for k, n in enumerate(lengths)]
    assert run(pageless_step(10), block([3, 3]) + block([2])) == [0, 0, 0]
    assert run(pageless_step(10), block([3, 3]) + block([4])) == [0, 0, 1]
    assert run(pageless_step(10), block([2]) + block([6, 6, 1]) + block([1])) == [0, 1, 2, 2, 3]  # a large block stays alone
    assert run(pageless_step(10), block([3, 20, 3])) == [0, 1, 2]  # a large unit is alone


def test_batches_close_when_full():
    assert run(batch_step(2, 100), [(10,), (10,), (10,)]) == [0, 0, 1]
    assert run(batch_step(5, 100), [(60,), (60,), (200,), (1,)]) == [0, 1, 2, 3]


EDGE = "doc_id int, parent_id string, child_id string, child_pos int"


def test_walk_orders_and_violations(spark):
    own = [(1, "#/body", "#/texts/0", 0), (1, "#/body", "#/groups/0", 1), (1, "#/groups/0", "#/texts/1", 1), (1, "#/groups/0", "#/texts/2", 0), (1, "#/body", "#/texts/3", 2), (1, "#/texts/3", "#/texts/4", 0)]
    other = [(2, "#/body", "#/texts/1", 0), (2, "#/body", "#/texts/0", 1)]
    edges = spark.createDataFrame(own + other, EDGE)
    order = S.reading_order(S.walk(edges)).orderBy("doc_id", "reading_order").collect()
    # children of texts are not walked, and documents do not mix
    assert [(r["doc_id"], r["item_id"], r["reading_order"]) for r in order] == [(1, "#/texts/0", 0), (1, "#/texts/2", 1), (1, "#/texts/1", 2), (1, "#/texts/3", 3), (2, "#/texts/1", 0), (2, "#/texts/0", 1)]
    looped = edges.union(spark.createDataFrame([(1, "#/groups/0", "#/groups/1", 5), (1, "#/groups/1", "#/groups/0", 0), (1, "#/body", "#/texts/9", 9), (2, "#/body", "#/texts/4", 2), (2, "#/groups/7", "#/groups/7", 0)], EDGE))
    nodes = edges.selectExpr("doc_id", "child_id AS item_id").union(spark.createDataFrame([(1, "#/groups/1"), (2, "#/groups/7")], "doc_id int, item_id string"))
    got = {(r["rule"], r["doc_id"], r["item_id"]) for r in S.tree_violations(looped, nodes).collect()}
    assert got == {("unresolved", 1, "#/texts/9"), ("unresolved", 2, "#/texts/4"), ("cycle", 1, "#/groups/0"), ("cycle", 1, "#/groups/1"), ("cycle", 2, "#/groups/7"), ("repeated", 1, "#/groups/0")}
    assert S.walk(looped).where("doc_id = 1").count() == 7  # a group is not entered below itself


def test_walk_of_deep_trees_and_nested_lists(spark):
    deep = [(1, f"#/groups/{k - 1}" if k else "#/body", f"#/groups/{k}", 0) for k in range(300)] + [(1, "#/groups/299", "#/texts/0", 0)]
    last = S.walk(spark.createDataFrame(deep, EDGE)).where("NOT is_container").first()
    assert len(last["path"]) == 301 and last["reading_order"] == 0 and last["list_key"] is None
    lists = [(1, "#/body", "#/groups/0", 0, None), (1, "#/groups/0", "#/groups/1", 0, True), (1, "#/groups/1", "#/groups/2", 0, True), (1, "#/groups/2", "#/texts/0", 0, False), (1, "#/groups/1", "#/texts/1", 1, False), (1, "#/groups/0", "#/texts/2", 1, False)]
    got = {r["item_id"]: r["list_key"] for r in S.walk(spark.createDataFrame(lists, EDGE + ", is_list boolean")).collect()}
    assert got == {"#/groups/0": None, "#/groups/1": "#/groups/1", "#/groups/2": "#/groups/1", "#/texts/0": "#/groups/1", "#/texts/1": "#/groups/1", "#/texts/2": None}
    assert S.walk(spark.createDataFrame([], EDGE)).count() == 0


def test_walk_of_a_chain_of_100_000(spark):
    n = 100_000
    chain = spark.range(n).selectExpr("1 AS doc_id", "CASE WHEN id = 0 THEN '#/body' ELSE concat('#/groups/', id - 1) END AS parent_id", "concat('#/groups/', id) AS child_id", "0 AS child_pos")
    last = chain.union(spark.createDataFrame([(1, f"#/groups/{n - 1}", "#/texts/0", 0)], EDGE))
    found = S.walk(last, paths=False)
    assert tuple(found.agg(F.count("*"), F.max("depth"), F.count("path")).first()) == (n + 1, n + 1, 0)
    assert found.where("NOT is_container").first()["reading_order"] == 0


def test_groups_held_twice_are_entered_once(spark):
    levels = 20
    twice = [(1, f"#/groups/{k - 1}" if k else "#/body", f"#/groups/{k}", pos) for k in range(levels) for pos in (0, 1)] + [(1, f"#/groups/{levels - 1}", "#/texts/0", 0), (1, "#/body", "#/texts/0", 9)]
    edges = spark.createDataFrame(twice, EDGE)
    assert S.walk(edges).count() == levels + 1
    nodes = edges.selectExpr("doc_id", "child_id AS item_id").distinct()
    assert {(r["rule"], r["item_id"]) for r in S.tree_violations(edges, nodes).collect()} == {("repeated", f"#/groups/{k}") for k in range(levels)} | {("repeated", "#/texts/0")}


def test_walk_of_edges_whose_parts_are_read_apart(spark):
    """Lines and lists already lie by document, and the few lists are read together where the many lines are not."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lines = spark.range(8000).selectExpr("id % 80 AS doc_id", "'#/groups/0' AS parent_id", "concat('#/texts/', id) AS child_id", "id AS child_pos", "false AS is_list")
        lines = lines.withColumn("child_pos", F.row_number().over(Window.partitionBy("doc_id").orderBy("child_pos")).cast("long"))
        lists = spark.range(80).selectExpr("id % 80 AS doc_id").groupBy("doc_id").agg(F.lit("#/body").alias("parent_id"), F.lit("#/groups/0").alias("child_id"), F.lit(0).cast("long").alias("child_pos"), F.lit(True).alias("is_list"))
        met = S.walk(lines.unionByName(lists)).groupBy("doc_id").agg(F.count("list_key").alias("n")).collect()
        assert len(met) == 80 and {r["n"] for r in met} == {101}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_units_fed_from_the_walk(spark):
    edges = spark.createDataFrame([(1, "#/body", "#/texts/2", 0, False), (1, "#/body", "#/groups/0", 1, True), (1, "#/groups/0", "#/texts/0", 0, False), (1, "#/groups/0", "#/groups/1", 1, True), (1, "#/groups/1", "#/texts/1", 0, False), (1, "#/body", "#/texts/3", 2, False)], EDGE + ", is_list boolean")
    own = items(spark, [("a", 1, None, "old"), ("b", 1, None, None), ("c", 1, None, None), ("d", 1, None, None), ("lost", 1, None, None)])
    units = S.atomic_units(S.placed(own, S.walk(edges))).orderBy("unit_no").collect()
    assert [(u["pos"], u["last_pos"], u["n_items"], u["list_key"]) for u in units] == [(0, 0, 1, None), (1, 2, 2, "#/groups/0"), (3, 3, 1, None)]


def test_headings_of_any_levels_in_one_plan(spark):
    rows = [(f"h{k}", 1, level, None) for k, level in enumerate([40, 3, 1000, 7, 7, 1])]
    found = S.heading_paths(items(spark, rows))
    assert [r["heading_positions"] for r in found.orderBy("pos").collect()] == [[0], [1], [1, 2], [1, 3], [1, 4], [5]]
    assert dict(found.dtypes)["heading_positions"] == "array<int>"
    assert "Window" not in found._jdf.queryExecution().toString()


def test_citation_scope_grows_with_items_and_chunks(spark):
    own = spark.range(16_000).selectExpr("id - id % 16000 AS doc_id", "cast(id AS int) AS pos", "'x' AS text", "cast(NULL AS int) AS page", "cast(NULL AS int) AS level", "cast(NULL AS string) AS list_key", "concat('#/texts/', id) AS item_id")
    chunks = own.selectExpr("doc_id", "pos", "cast(floor(pos / 8) AS int) AS chunk_no").groupBy("doc_id", "chunk_no").agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))
    scope = topics.packet_scope(own, S.atomic_units(own), chunks, S.heading_paths(own))
    # a chunk's eight items and one more on either side
    assert scope.count() == 16_000 + 2 * 2_000 - 2
    joins = re.findall(r"(?:SortMergeJoin|HashJoin) \[([^\]]*)\]", scope._jdf.queryExecution().toString())
    assert joins and all("," in keys for keys in joins)  # never chunks with units by document alone


def _nodes(plan, name):
    below = plan.children()
    own = [plan] if plan.nodeName() == name else []
    return own + [n for k in range(below.size()) for n in _nodes(below.apply(k), name)]


def test_citation_scope_sorts_no_text(spark, small):
    plan = topic_queries.citation_scope(spark, small)._jdf.queryExecution().optimizedPlan()
    windows = _nodes(plan, "Window")
    held = [{w.output().apply(k).name() for k in range(w.output().size())} for w in windows]
    assert windows and not any("text" in names for names in held)


def test_scope_keeps_no_table_of_units_and_takes_chunks_once(spark, small):
    """Units are told as they end, chunks are made once (then swept, cited and counted), items are held
    as bits, and the fold carries no ids."""
    plan = topic_queries.citation_scope(spark, small)._jdf.queryExecution().optimizedPlan()
    keys = [n.groupingExpressions().mkString(",") for n in _nodes(plan, "Aggregate")]
    assert len(keys) == 5 and not any("unit_no" in k for k in keys)
    folds = [n.child().output().mkString(",") for n in _nodes(plan, "MapInArrow")]
    assert folds and not any("item_id" in f for f in folds)


def test_unit_spans_are_those_of_atomic_units(spark):
    made = spark.range(3_000).selectExpr("id % 7 AS doc_id", "cast(id / 7 AS int) AS pos", "'x' AS text", "cast(NULL AS int) AS page", "cast(NULL AS int) AS level", "CASE WHEN hash(id) % 3 <> 0 THEN concat('l', abs(hash(id div 14)) % 2) END AS list_key")
    columns = ["doc_id", "unit_no", "pos", "last_pos"]
    spans, units = (f(made).select(*columns) for f in (S.unit_spans, S.atomic_units))
    assert spans.exceptAll(units).count() == units.exceptAll(spans).count() == 0
    assert spans.where("last_pos > pos").count() > 100 and spans.groupBy("doc_id").count().count() == 7


def test_citation_scope_has_no_place_without_an_item(spark):
    # places 62 to 66 but for 64, and 128, stand in three blocks of 64 places
    own = items(spark, [("x", 1, None, None)] * 129).where("pos IN (62, 63, 65, 66, 128)")
    chunks = spark.createDataFrame([(1, 0, 62, 66), (1, 1, 128, 128)], "doc_id int, chunk_no int, first_pos int, last_pos int")
    scope = topics.packet_scope(own, S.unit_spans(own), chunks, S.heading_paths(own))
    assert sorted((r["chunk_no"], r["pos"]) for r in scope.collect()) == [(0, 62), (0, 63), (0, 65), (0, 66), (0, 128), (1, 66), (1, 128)]
    assert topics.packet_scope(own.where("false"), S.unit_spans(own), chunks, S.heading_paths(own)).count() == 0


@pytest.mark.parametrize("neighbours", [0, 1, 2])
def test_citation_scope_with_more_neighbours_than_there_are(spark, neighbours):
    own = items(spark, [("x", 1, None, None)] * 3)
    chunks = spark.createDataFrame([(1, 0, 0, 0), (1, 1, 1, 2)], "doc_id int, chunk_no int, first_pos int, last_pos int")
    scope = topics.packet_scope(own, S.unit_spans(own), chunks, S.heading_paths(own), neighbours)
    found = sorted((r["chunk_no"], r["pos"]) for r in scope.collect())
    near = {0: [0], 1: [0, 1], 2: [0, 1, 2]}[neighbours]
    assert found == [(0, p) for p in near] + [(1, p) for p in ([1, 2] if neighbours == 0 else [0, 1, 2])]


def test_citation_scope_has_headings_of_neighbours_and_lists(spark):
    # two headings over a list that begins in one chunk and goes on through the next; the third heading is closed by none
    own = items(spark, [("h", 1, 1, None), ("h", 1, 2, None)] + [("x", 1, None, "l")] * 4 + [("h", 1, 3, None), ("x", 1, None, None)])
    chunks = spark.createDataFrame([(1, 0, 0, 2), (1, 1, 3, 4), (1, 2, 7, 7)], "doc_id int, chunk_no int, first_pos int, last_pos int")
    scope = topics.packet_scope(own, S.atomic_units(own), chunks, S.heading_paths(own))
    found = sorted((r["chunk_no"], r["pos"]) for r in scope.select("chunk_no", "pos").collect())
    assert found == [(0, p) for p in (0, 1, 2, 6)] + [(1, p) for p in range(7)] + [(2, p) for p in (0, 1, 6, 7)]


@pytest.mark.parametrize("wrong", [{"target": 0}, {"target": True}, {"batch_chunks": 6}, {"batch_chunks": 0}, {"neighbours": -1}, {"timeout_seconds": float("inf")}, {"timeout_seconds": True}, {"output_tokens": 0}])
def test_settings_are_checked(wrong):
    with pytest.raises(ValueError):
        Settings(**wrong)

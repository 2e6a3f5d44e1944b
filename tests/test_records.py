"""Catalogs, identities, boundaries and review joins on rows written by hand."""

import pytest
from pyspark.sql import functions as F

from scrollwork.operators import boundaries, catalog, identity, inputs, review_joins, routes, stages

ITEM = "doc_id int, ord int, item_id string, orig string, text string, label string, pages array<int>, heading_ids array<string>, containers array<string>"
CELL = "doc_id int, item_id string, row_start int, ord int, text string"


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def passages(spark, *changes):
    made = [(1, 0, "#/texts/0", "Own words", "words", None, [1], [], []), (1, 1, "#/texts/1", " ", "not shown", "text", [1], [], []), (1, 2, "#/tables/0", None, None, "table", [2], ["#/texts/0"], ["#/groups/0"]), (1, 3, "#/pictures/0", None, "", "picture", [], [], [])]
    for k, column, value in changes:
        made[k] = (*made[k][:column], value, *made[k][column + 1 :])
    cells = spark.createDataFrame([(1, "#/tables/0", 1, 5, "b"), (1, "#/tables/0", 0, 1, "a"), (1, "#/tables/0", 0, 2, None), (1, "#/tables/0", None, 3, "c")], CELL)
    return catalog.passages(spark.createDataFrame(made, ITEM), cells)


def test_catalog_keeps_what_can_be_read(spark):
    assert rows(passages(spark), "ord", "text", "grid", "label") == [(0, "Own words", [], "text"), (2, "", [["a", "", "c"], ["b"]], "table")]


def test_any_change_of_a_passage_changes_the_catalog(spark):
    sha = lambda *changes: catalog.catalogs(passages(spark, *changes)).first()["catalog_sha"]
    own = sha()
    changed = [sha((0, 3, "Other words")), sha((0, 5, "title")), sha((0, 6, [2])), sha((2, 7, [])), sha((2, 8, None)), sha((0, 1, 9)), sha((1, 3, "shown"))]
    assert sha((1, 4, "still not shown")) == own and len({own, *changed}) == 8


def test_packets_and_requests_have_an_identity_of_all_they_hold(spark):
    scope = lambda *r: rows(identity.packet_hashes(spark.createDataFrame(list(r), "doc_id int, chunk_no int, pos int")), "packets_sha")
    assert scope((1, 0, 1), (1, 0, 2)) == scope((1, 0, 2), (1, 0, 1)) == scope((1, 0, 2), (1, 0, 1), (1, 0, 1))
    assert len({str(scope(*r)) for r in ([(1, 0, 1), (1, 0, 2)], [(1, 0, 1), (1, 1, 2)], [(1, 0, 12)], [(1, 1, 1), (1, 1, 2)])}) == 4
    packets = spark.createDataFrame([(1, "covenants", "g", "evidence", 1, "x")], "doc_id int, topic string, group_id string, role string, pos int, text string")
    request = lambda given, found=packets: identity.request_ids(found, spark.createDataFrame([(1, *given)], "doc_id int, map_sha string, chunks_sha string, canonical_sha string, topics array<string>")).first()["request_id"]
    given = [("m", "c", None, ["covenants"]), ("m2", "c", None, ["covenants"]), ("m", "c2", None, ["covenants"]), ("m", "c", "k", ["covenants"]), ("m", "c", None, ["covenants", "parties"])]
    assert len({request(g) for g in given} | {request(given[0], packets.withColumn("role", F.lit("context")))}) == 6
    assert request(given[0]) == request(given[0]) and request(given[0], packets.where("false")) is not None


SNAP = "run_id int, seq int, filename string, span_id string, data map<string,string>"


def reviewed(spark, snapshots, log=(), current=None):
    frame = spark.createDataFrame([(1, k, *s) for k, s in enumerate(snapshots)], SNAP)
    found = boundaries.stage_boundaries(frame, spark.createDataFrame([(1, s) for s in log], "run_id int, stage string"), current)
    return {r["stage"]: r for r in found.collect()}


def test_boundaries_of_a_stage(spark):
    got = reviewed(
        spark,
        [
            ("A-input-one.json", None, {"args": "agreement"}),
            ("B1-input-artifacts-one.json", None, {"canonical": "1", "_trace": "t"}),
            ("B1-input-artifacts-two.json", None, {"hierarchy": "2"}),
            ("B1-input-args.json", None, {"args": "artifact", "_trace": "t"}),
            ("B1-input-artifacts-last.json", None, {"canonical": "3"}),
            ("B1-output-value.json", None, {"cached": "false"}),
            ("B1-output-artifacts-last.json", None, {"chunks": "c", "_trace": "t"}),
            ("B1-outputs-none.json", None, {"x": "y"}),
        ],
        ["A", "A", "C"],
    )
    assert set(got) == set(boundaries.REVIEWED) and len(stages.STAGES) == len(got) + 1
    b1 = got["B1"]
    assert b1["input_artifacts"] == {"canonical": "3", "hierarchy": "2"} and b1["input"] == {"args": "artifact", "_trace": "t"}
    assert b1["return_value"] == {"cached": "false"} and b1["output"] == {"chunks": "c"}
    assert got["A"]["input"] == {"args": "agreement"} and got["A"]["n_events"] == 2 and got["A"]["output"] is None and got["A1"]["input_artifacts"] == {}


def test_former_signals_are_no_input_of_the_present_layout(spark):
    snapshots = [("B2-input-artifacts-a.json", None, {"signals": "s", "chunks": "c"}), ("B2-output-artifacts-a.json", None, {"topic_signals_json_path": "s", "final": "f"})]
    current = spark.createDataFrame([(1,)], "run_id int")
    now, then = reviewed(spark, snapshots, (), current)["B2"], reviewed(spark, snapshots)["B2"]
    assert now["input_artifacts"] == {"chunks": "c"} and now["output"] == {"final": "f"}
    assert then["input_artifacts"] == {"signals": "s", "chunks": "c"} and then["output"] == {"topic_signals_json_path": "s", "final": "f"}


def test_extraction_shows_one_span(spark):
    spans = [("C-input-a.json", "a", {"args": "A"}), ("C-input-b.json", "b", {"args": "B"}), ("C-output-b.json", "b", {"text": "B"}), ("C-output-a.json", "a", {"text": "A"})]
    got = reviewed(spark, spans)["C"]
    assert (got["input"], got["return_value"]) == ({"args": "A"}, {"text": "A"})
    pending = reviewed(spark, [spans[0], spans[3], spans[1]])["C"]
    assert (pending["input"], pending["return_value"]) == ({"args": "B"}, None)
    unnamed = reviewed(spark, [spans[0], ("C-output-x.json", None, {"text": "X"})])["C"]
    assert (unnamed["input"], unnamed["return_value"]) == ({"args": "A"}, {"text": "X"})


GROUP = "doc_id int, topic string, group_id string, evidence array<string>, context array<string>"


def test_passage_targets_and_breaches(spark):
    mapped = spark.createDataFrame([(1, "t", "g", ["a"], ["b"]), (1, "t", "h", ["a"], []), (1, "u", "g", ["z"], [])], GROUP)
    answers = spark.createDataFrame([(1, "t", "g", ["a"], ["b"], 2), (1, "t", "g", ["a"], ["b"], 0), (1, "t", "h", [], ["a"], 1), (1, "u", "g", ["z"], [], 3)], GROUP + ", chunk_no int")
    assert rows(review_joins.passage_targets(mapped, answers), "topic", "group_id", "target_chunks") == [("t", "g", [0, 2]), ("t", "h", []), ("u", "g", [3])]
    items = spark.createDataFrame([(1, "a"), (1, "b")], "doc_id int, item_id string")
    assert rows(review_joins.review_breaches(mapped, answers, items), "rule", "topic", "group_id") == [("missing_citation", "u", "g"), ("no_target", "t", "h")]


def test_chunks_without_topics_are_kept(spark):
    chunks = spark.createDataFrame([(1, 0), (1, 1)], "doc_id int, chunk_no int")
    items = spark.createDataFrame([(1, 0, "a", 1, ["h"]), (1, 0, "b", 2, ["h"])], "doc_id int, chunk_no int, item_id string, page int, heading_ids array<string>")
    answers = spark.createDataFrame([(1, 0, "t"), (1, 0, "s"), (1, 0, "t")], "doc_id int, chunk_no int, topic string")
    assert rows(review_joins.chunk_reviews(chunks, items, answers), "chunk_no", "n_items", "pages", "n_headings", "final_topics", "is_unclassified") == [(0, 2, [1, 2], 1, ["s", "t"], False), (1, 0, [], 0, [], True)]


def test_cited_texts(spark):
    cited = spark.createDataFrame([(1, i) for i in ("#/texts/0", "#/texts/1", "#/texts/2", "#/texts/9", "#/tables/0", "#/tables/1")], "doc_id int, item_id string")
    items = spark.createDataFrame([(1, "#/texts/0", "orig", "text"), (1, "#/texts/1", "", "text"), (1, "#/texts/2", None, " "), (1, "#/tables/0", None, "joined page"), (1, "#/tables/1", None, "joined page")], "doc_id int, item_id string, original_text string, text string")
    cells = spark.createDataFrame([(1, "#/tables/0", 0, 1, "Rate"), (1, "#/tables/0", 0, 2, "1.5%"), (1, "#/tables/0", 1, 3, "Payment"), (1, "#/tables/7", 0, 1, "x")], CELL)
    got = {r["item_id"]: (r["text"], r["problem"]) for r in review_joins.cited_texts(cited, items, cells).collect()}
    assert got == {"#/texts/0": ("orig", None), "#/texts/1": ("text", None), "#/texts/2": (None, "unreadable"), "#/texts/9": (None, "missing_citation"), "#/tables/0": ("Rate\t1.5%\nPayment", None), "#/tables/1": (None, "table_without_cells")}


def test_sources_of_past_runs(spark):
    documents = spark.createDataFrame([("d1", "/in/d1", "a" * 64), ("d2", "/in/d2", "b" * 64)], "document_id string, path string, sha string")
    captures = spark.createDataFrame([(1, 5, "/in/d2", None), (1, 3, "/elsewhere/d1", "a" * 64), (1, 9, "/in/d1", None), (2, 2, None, "short"), (2, 4, None, "b" * 64), (2, 6, None, "a" * 64), (3, 1, "/none", "c" * 64)], "run_id int, seq int, path string, sha string")
    runs = spark.createDataFrame([(1,), (2,), (3,), (4,)], "run_id int")
    assert rows(routes.run_sources(runs, captures, documents), "run_id", "document_id") == [(1, "d2"), (2, "d2"), (3, None), (4, None)]


def test_prices_and_routes_can_be_replaced(spark):
    calls = spark.createDataFrame([("m", 1000, 0, 0, 10)], "model string, input_tokens long, cached_tokens long, written_tokens long, output_tokens long")
    own = routes.prices(spark, [("m", "2020-01-01", "EUR", "1", "1", "1", "2", 5000)])
    assert float(routes.priced(calls, own).first()["estimate"]) == pytest.approx(0.00102)
    assert routes.priced(calls, routes.prices(spark, [])).first()["estimate"] is None
    asked = calls.withColumn("style", F.lit(None).cast("string"))
    assert routes.routed(asked, routes.routes(spark, {"m": "messages"})).first()["style"] == "messages"
    assert routes.routed(asked, routes.routes(spark)).first()["style"] is None


def test_raw_containers_without_a_value(spark):
    raw = spark.createDataFrame([(1, "a", None), (1, "b", "5"), (1, "c", '{"children": [[]]}')], "doc_id int, item_id string, raw string")
    found = inputs.reference_problems(raw.select("doc_id", "item_id", F.try_parse_json("raw").alias("value")))
    assert rows(found, "rule", "item_id") == [("no_reference", "c")]


def test_legacy_answers_and_chunks_meet_in_one_count(spark):
    key = "doc_id long, chunk_no int"
    rows = spark.createDataFrame([(1, 0), (1, 0), (1, 9), (1, 9), (None, 0)], key).withColumn("row_no", F.lit(1))
    chunks = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (None, 0)], key)
    none = spark.createDataFrame([], key + ", topic string, cited array<string>")
    scope = spark.createDataFrame([], key + ", item_id string")
    found = inputs.legacy_violations(rows, none, scope, chunks)
    got = sorted((r["rule"], r["doc_id"] or 0, r["chunk_no"]) for r in found.collect())
    assert got == [("repeated_chunk", 1, 0), ("repeated_chunk", 1, 9), ("unanswered", 0, 0), ("unanswered", 1, 1), ("unknown_chunk", 0, 0), ("unknown_chunk", 1, 9)]
    # labels look for their items; nothing else is joined, so no side of answers or chunks can be broadcast
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join LeftAnti") <= 1

"""Rules of extracted terms, saved groups, annotations, and a model that is asked again."""

import json

import pytest
from pyspark.sql import functions as F

from scrollwork.functions.money import cost_choice
from scrollwork.operators import extraction as X
from scrollwork.operators import reviews, structure, topics
from scrollwork.plans.pipeline import specialist


def rules(frame):
    return sorted((r["rule"], r["key"]) for r in frame.collect())


def test_parties_have_one_name_whatever_its_case(spark):
    rows = [(1, "a", " Straße AG ", ["Lender"]), (1, "b", "STRASSE ag", ["Lender", " lender "]), (1, "c", "ΟΔΟΣ", ["Parent"]), (1, "d", "οδος", ["Agent"]), (2, "e", "strasse ag", []), (2, "e", "other", ["Borrower"])]
    parties = spark.createDataFrame(rows, "doc_id int, party_id string, name string, roles array<string>")
    assert rules(X.party_violations(parties)) == [("corporate_role", "c"), ("repeated_name", "strasse ag"), ("repeated_name", "οδοσ"), ("repeated_party", "e"), ("repeated_role", "b")]


def test_lenders_and_evidence_of_facilities(spark):
    parties = spark.createDataFrame([(1, "a", ["  LENDER"]), (1, "b", ["Agent"])], "doc_id int, party_id string, roles array<string>")
    facilities = spark.createDataFrame([(1, "f", [], []), (1, "g", [], []), (1, "h", None, ["#/texts/0"])], "doc_id int, facility_id string, evidence array<string>, amount_evidence array<string>")
    commitments = spark.createDataFrame([(1, "f", "a"), (1, "h", "b"), (1, "h", "z")], "doc_id int, facility_id string, lender string")
    assert rules(X.facility_violations(facilities, commitments, parties)) == [("facility_without_evidence", "g"), ("no_lender", "h/b"), ("no_lender", "h/z")]


@pytest.mark.parametrize(
    ("row", "wrong"),
    [
        ((5.0, "supported", []), []),
        ((None, "supported", []), ["supported_without_total"]),
        ((5.0, "supported", ["margin"]), ["supported_without_total"]),
        ((5.0, "missing", []), ["unavailable_with_total"]),
        ((None, "missing", []), []),
        ((5.0, "uncertain", []), []),
        ((None, "missing_inputs", None), ["missing_without_name"]),
        ((None, "missing_inputs", ["margin"]), []),
        ((1.0, "missing_inputs", []), ["missing_without_name", "unavailable_with_total"]),
        ((1.0, None, []), ["unknown_status"]),
    ],
)
def test_states_of_totals(spark, row, wrong):
    totals = spark.createDataFrame([("k", *row)], "key string, value double, status string, missing_inputs array<string>")
    assert [r for r, _ in rules(X.total_violations(totals))] == wrong


def test_citations(spark):
    records = spark.createDataFrame([(1, "a", ["x"], True), (1, "b", [], True), (1, "c", None, True), (1, "d", [], False), (1, "e", ["x", "x"], True), (1, "f", ["x", "z"], False), (2, "g", ["x"], True)], "doc_id int, key string, evidence array<string>, required boolean")
    allowed = spark.createDataFrame([(1, "x")], "doc_id int, item_id string")
    assert rules(X.citation_violations(records, allowed)) == [("no_citation", "b"), ("no_citation", "c"), ("repeated_citation", "e"), ("unknown_citation", "f"), ("unknown_citation", "g")]


def test_infinite_costs_are_not_reported_ones(spark):
    frame = spark.createDataFrame([(1.5,), (float("inf"),), (float("nan"),), (-1.0,), (None,)], "cost double")
    assert [r[0] for r in frame.select(cost_choice(F.col("cost"), F.lit("USD"), F.lit(9.0))).collect()] == [1.5, 9.0, 9.0, 9.0, 9.0]


def test_saved_groups_are_made_again_from_their_citations(spark):
    items = spark.createDataFrame([(1, 0, 0, 1), (1, 1, 0, 2), (1, 8, 1, 2), (1, 9, 1, None)], "doc_id int, pos int, chunk_no int, page int")
    plain = topics.identified(spark.createDataFrame([(1, 0, "covenants", [1, 8], [9])], "doc_id int, chunk_no int, topic string, evidence array<int>, context array<int>"))
    saved = topics.enriched(plain, items)
    assert tuple(saved.select("source_chunks", "evidence_pages", "context_pages").first()) == ([0, 1], [2], [])
    assert topics.saved_differences(saved, items).count() == 0
    for column, value in (("source_chunks", F.array(F.lit(0))), ("evidence_pages", F.array(F.lit(7))), ("group_id", F.lit("passage-x")), ("context", F.array().cast("array<int>"))):
        assert {r["side"] for r in topics.saved_differences(saved.withColumn(column, value), items).collect()} == {"saved", "recomputed"}


def test_annotations(spark):
    passages = spark.createDataFrame([(1, "a"), (1, "b")], "doc_id int, item_id string")
    accepted = spark.createDataFrame([(1, "a", ["covenants", "contract_definitions"], None, 0)], "doc_id int, item_id string, topics array<string>, notes string, expected int")
    assert reviews.annotation_problems(accepted, accepted.select("doc_id", "item_id", F.lit(1).alias("revision")).where("false"), passages, topics.TOPICS).first()["problem"] is None
    row = reviews.annotated(accepted, topics.TOPICS).first()
    assert (row["revision"], row["topics"], row["notes"], row["reviewed_topics"]) == (1, ["contract_definitions", "covenants"], "", list(topics.TOPICS))


def test_size_of_what_is_sent(spark):
    row = {"chunk_id": "c", "items": [{"text": "é\n\"x\"", "page": None}], "n": 3}
    frame = spark.createDataFrame([(row["chunk_id"], row["items"], row["n"])], "chunk_id string, items array<struct<text: string, page: int>>, n int")
    assert frame.select(structure.json_size(["chunk_id", "items", "n"])).first()[0] == len(json.dumps(row, ensure_ascii=False))


def test_a_model_is_asked_again_with_what_was_wrong(spark):
    packets = spark.createDataFrame([(1, ["e"]), (2, ["e"]), (3, ["e"]), (4, []), (5, None), (6, ["e"])], "key int, evidence array<string>")
    asked = []

    def ask(frame):
        asked.append(sorted((r["key"], r["attempt"], r["feedback"]) for r in frame.collect()))
        said = F.when(F.col("key") == 1, "good").when((F.col("key") == 2) & (F.col("feedback") == "bad"), "good").otherwise("poor")
        return frame.where("key <> 6").select("key", said.alias("answer"))

    judge = lambda answers: answers.where("answer = 'poor'").select("key", F.lit("bad").alias("problem"))
    got = {r["key"]: (r["answer"], r["attempts"], r["problem"]) for r in specialist(packets, ask, judge).collect()}
    assert got == {1: ("good", 1, None), 2: ("good", 2, None), 3: ("poor", 2, "bad"), 4: (None, 0, "no_evidence"), 5: (None, 0, "no_evidence"), 6: (None, 2, "no_answer")}
    assert asked == [[(1, 1, None), (2, 1, None), (3, 1, None), (6, 1, None)], [(2, 2, "bad"), (3, 2, "bad"), (6, 2, "no_answer")]]
    with pytest.raises(ValueError):
        specialist(packets, ask, judge, 0)

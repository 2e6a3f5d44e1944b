"""Threshold-scaled sketches against plain loops."""

from collections import Counter

import pytest
from made_texts import edge_documents, prose
from pyspark.sql import functions as F

from scrollwork.llm.queries import QUERIES
from scrollwork.llm.sketches import BELOW, FLOOR, brute_force, brute_sketch, keep, likeness, sketch, with_next


def rounded(row):
    return tuple(round(v, 12) if isinstance(v, float) else v for v in row)


def agree(spark, folder, documents):
    got = QUERIES["op12_fingerprints"](spark, folder)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert Counter(map(rounded, got.collect())) == Counter(map(rounded, brute_force(documents)))


def test_query_on_edges(spark, edges):
    agree(spark, edges, [d[:2] for d in edge_documents()])


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_next_documents_across_ranges(spark, write, partitions):
    docs = [(k * 37 % 101 - 20, prose(k % 9, 3 + k)) for k in range(60)] + [(5, "tie"), (5, "tied"), (None, "last"), (1 << 60, prose(2, 300))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        agree(spark, write(docs), docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_document_and_only_null_ids(spark, write):
    for docs in ([(3, prose(1, 50))], [(None, "a b c"), (None, None)], [(1, "")]):
        agree(spark, write(docs), docs)


def test_no_plan_node_gathers_all_rows_or_runs_python(spark, write):
    plan = QUERIES["op12_fingerprints"](spark, write([(k, prose(k, 20)) for k in range(30)]))._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Python" not in plan and "Arrow" not in plan


def test_sketches_merge_exactly(spark):
    pairs = [(prose(k, n), prose(k + 50, m)) for k, (n, m) in enumerate([(3, 400), (10, 10), (300, 2000), (0, 5), (20, 90)])]
    frame = spark.createDataFrame(pairs, "a string, b string").select("a", "b", sketch(F.col("a")).alias("x"), sketch(F.col("b")).alias("y"))
    for r in frame.select("a", "b", "x", "y", keep(F.concat("x", "y")).alias("both")).collect():
        assert r["x"] == brute_sketch(r["a"]) and r["y"] == brute_sketch(r["b"])
        together = sorted(set(all_hashes(r["a"])) | set(all_hashes(r["b"])))
        low = [h for h in together if h < BELOW]
        assert r["both"] == (low if len(low) >= FLOOR else together[:FLOOR])


def all_hashes(text):
    """Every shingle hash, by the sketch of one shingle at a time."""
    words = text.split()
    return {h for k in range(max(len(words) - 4, min(len(words), 1))) for h in brute_sketch(" ".join(words[k : k + 5]))}


def test_containment_of_very_unequal_documents(spark):
    long = prose(1, 20_000, 5_000)
    part = " ".join(long.split()[3000:3400])
    frame = spark.createDataFrame([(long, part), (long, prose(2, 400, 5_000)), ("", " "), ("", "x"), ("same words here", "SAME words  here")], "a string, b string")
    got = [r[0] for r in frame.select(likeness(sketch(F.col("a")), sketch(F.col("b")))).collect()]
    assert got == [1.0, 0.0, 1.0, 0.0, 1.0]

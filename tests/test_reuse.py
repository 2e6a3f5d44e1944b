"""Results kept under a profile, and decisions of several writers."""

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scrollwork.sources.decisions import DecisionStore
from scrollwork.sources.reuse import Reused, profile


def inputs(spark, names):
    return spark.createDataFrame([(n, n * 2) for n in names], "sha string, text string")


def compute(rows):
    """One row a letter, so some inputs have several rows and the empty one has none."""
    return rows.select("sha", F.explode(F.array_compact(F.transform(F.split("text", ""), lambda c: F.nullif(c, F.lit(""))))).alias("letter"), F.length("text").alias("n_chars"))


def run(spark, path, names, by="p", valid=None):
    rows, made = Reused(spark, str(path), by, valid).rows(inputs(spark, names), compute)
    got = sorted((r["sha"], r["letter"], r["n_chars"]) for r in rows.collect())
    assert got == sorted((n, c, 2 * len(n)) for n in names for c in n * 2)
    return sorted(r["sha"] for r in made.collect())


def test_second_run_computes_only_what_is_new(spark, tmp_path):
    assert run(spark, tmp_path, ["ab", "c", ""]) == ["", "ab", "c"]
    assert run(spark, tmp_path, ["ab", "c", ""]) == []
    assert run(spark, tmp_path, ["ab", "new"]) == ["new"]
    assert run(spark, tmp_path, ["ab"], by="other") == ["ab"]  # another profile shares nothing
    assert run(spark, tmp_path, ["ab", "c", "new", ""]) == []


def test_damaged_results_are_made_again(spark, tmp_path):
    names = [f"n{k}" for k in range(40)]
    run(spark, tmp_path, names)
    files = sorted(p for p in Path(tmp_path, "rows").rglob("*.parquet"))
    files[0].write_bytes(b"PAR1 broken")
    crc = files[0].with_name(f".{files[0].name}.crc")
    crc.unlink(missing_ok=True)
    files[1].unlink()
    again = run(spark, tmp_path, names)
    assert 2 <= len(again) < 40 and run(spark, tmp_path, names) == []


def test_changed_rows_are_made_again(spark, tmp_path):
    run(spark, tmp_path, ["ab", "cd"])
    rows = spark.read.parquet(f"{tmp_path}/rows").where("sha = 'ab'").withColumn("letter", F.lit("z"))
    file = next(p for p in Path(tmp_path, "rows").rglob("*.parquet") if spark.read.parquet(str(p)).where("sha = 'ab'").count())
    rows.drop("profile", "bucket").coalesce(1).write.parquet(f"{tmp_path}/forged")
    forged = next(Path(tmp_path, "forged").glob("*.parquet"))
    file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    file.write_bytes(forged.read_bytes())
    assert "ab" in run(spark, tmp_path, ["ab", "cd"])


def test_rows_that_are_no_longer_valid_are_made_again(spark, tmp_path):
    run(spark, tmp_path, ["ab", "cde"])
    assert run(spark, tmp_path, ["ab", "cde"], valid=F.col("n_chars") < 5) == ["cde"]


def test_profiles():
    assert profile(model="m", temperature=0) == profile(temperature=0, model="m") != profile(model="m", temperature=1)


EVIDENCE = "array<struct<source_text: string, pdf_pages: array<int>, item_id: string>>"
INCOMING = f"fact_id string, document_id string, draft_sha string, expected long, decision string, notes string, field string, value string, evidence {EVIDENCE}"


@pytest.fixture
def store(spark, tmp_path):
    drafts = spark.createDataFrame([("f1", "d1", "rate", "5", None), ("f2", "d2", "date", None, "unresolved")], "fact_id string, document_id string, field string, proposed_value string, value_status string")
    documents = spark.createDataFrame([("d1", "s1", "pdf"), ("d2", "s2", "html")], "document_id string, source_sha string, format string")
    return DecisionStore(spark, str(tmp_path / "store"), "sha", drafts, documents)


def said(spark, *rows):
    return spark.createDataFrame(list(rows), INCOMING)


def decision(fact="f1", document="d1", expected=0, word="approved", draft="sha", notes=None, field=None, value=None, evidence=None):
    return (fact, document, draft, expected, word, notes, field, value, evidence)


def problems(frame):
    return [r["problem"] for r in frame.collect()]


def test_rules_of_decisions(spark, store):
    quote, place, pages = "q", "#/texts/1", [3]
    manual = lambda document="d1", field="x", evidence=((quote, pages, None),), fact="manual-1": decision(fact, document, field=field, evidence=list(evidence) if evidence is not None else None)
    wrong = {
        "wrong_draft": decision(draft="other"),
        "unknown_document": decision(document="d9"),
        "bad_revision": decision(expected=-1),
        "unknown_decision": decision(word="maybe"),
        "long_notes": decision(notes="x" * 12_001),
        "other_document": decision(document="d2"),
        "unknown_fact": decision(fact="manual_1"),
        "no_field": manual(field=" "),
        "no_evidence": manual(evidence=None),
        "no_quote": manual(evidence=[(" ", pages, None)]),
        "bad_pages": manual(evidence=[(quote, [0], None)]),
        "no_pages": manual(evidence=[(quote, None, place)]),
        "pages_without_pdf": manual("d2", evidence=[(quote, pages, place)]),
        "no_place": manual("d2", evidence=[(quote, None, "")]),
        "conflict": decision(expected=4),
    }
    for name, row in wrong.items():
        assert problems(store.judged(said(spark, row))) == [name]
    assert problems(store.judged(said(spark, decision(), decision(word="edited")))) == ["conflict", "conflict"]
    for row in (decision(), manual(), manual("d2", evidence=[(quote, None, place)])):
        assert problems(store.judged(said(spark, row))) == [None]


def test_revisions_and_what_is_recorded(spark, store):
    store.commit(said(spark, decision(), decision("f2", "d2", word="rejected"), decision("manual-a", "d2", field="x", value="7", evidence=[("q", None, "#/texts/1")])))
    assert problems(store.commit(said(spark, decision(expected=1, word="edited", value=None)))) == [None]
    assert problems(store.commit(said(spark, decision(expected=1)))) == ["conflict"]
    assert problems(store.commit(said(spark, decision("manual-a", "d1", expected=1, field="x", evidence=[("q", [1], None)])))) == ["prior_owner"]
    got = {(r["fact_id"], r["revision"]): (r["value"], r["value_status"], r["approved_for_reference"], r["evidence_validation"], r["field"], r["source_sha"]) for r in store.decisions().collect()}
    assert got == {
        ("f1", 1): ("5", "proposed_supported", True, "draft_evidence_retained", "rate", "s1"),
        ("f1", 2): (None, "unresolved", True, "draft_evidence_retained", "rate", "s1"),
        ("f2", 1): (None, "unresolved", False, "draft_evidence_retained", "date", "s2"),
        ("manual-a", 1): ("7", "proposed_supported", True, "human_asserted", "x", "s2"),
    }
    assert len(store.versions()) == 2  # commits without a row make no version


def test_of_two_writers_one_wins(spark, store):
    gate, results = threading.Barrier(4), {}

    def write(name):
        gate.wait()
        results[name] = problems(store.commit(said(spark, decision(word="edited", value=name))))[0]

    threads = [threading.Thread(target=write, args=(f"w{k}",)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    won = [n for n, p in results.items() if p is None]
    assert len(won) == 1 and sorted(p for p in results.values() if p) == ["conflict"] * 3
    assert [(r["revision"], r["value"]) for r in store.decisions().collect()] == [(1, won[0])]

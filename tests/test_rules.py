"""Topics, terms, logs, reviews and sources on rows written by hand."""

import gzip
import time

import pytest
from pyspark.sql import functions as F

from scrollwork.functions import money as M
from scrollwork.functions import text as T
from scrollwork.operators import audit, reviews, telemetry, terms, topics
from scrollwork.plans import pipeline
from scrollwork.sources import files, html
from scrollwork.streaming import tail

GROUP = "doc_id long, chunk_no int, topic string, evidence array<int>, context array<int>"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.fixture(scope="module")
def packet(spark):
    items = spark.createDataFrame([(1, k, f"text {k}", 1) for k in range(4)], "doc_id long, pos int, text string, page int")
    chunks = spark.createDataFrame([(1, 0, 0, 1), (1, 1, 2, 3)], "doc_id long, chunk_no int, first_pos int, last_pos int")
    return items, chunks


@pytest.mark.parametrize(
    ("group", "rule"),
    [
        ((1, 0, "covenants", [0], [2]), None),
        ((1, 1, "covenants", [1, 2], []), None),
        ((1, 0, "weather", [0], []), "unknown_topic"),
        ((1, 0, "covenants", [], [1]), "no_evidence"),
        ((1, 0, "covenants", [0, 0], []), "repeated_citation"),
        ((1, 0, "covenants", [0], [0]), "overlap"),
        ((1, 0, "covenants", [2], [0]), "evidence_outside"),
        ((1, 0, "covenants", [0], [77]), "unknown_item"),
        ((1, 9, "covenants", [0], []), "unknown_chunk"),
    ],
)
def test_each_breach_is_its_rule(spark, packet, group, rule):
    got = topics.violations(spark.createDataFrame([group], GROUP), *packet).collect()
    assert [r["rule"] for r in got] == ([rule] if rule else [])


def test_parents_repeats_and_order(spark):
    sub = "interest_and_fees.pik_toggle"
    rows = [(1, 0, sub, [3], []), (1, 1, sub, [3], []), (1, 0, "interest_and_fees", [1], []), (1, 0, "interest_and_fees", [3], [])]
    mapped = topics.topic_map(topics.identified(topics.with_parents(spark.createDataFrame(rows, GROUP)))).collect()
    assert sorted((r["topic"], r["group_ord"], r["evidence"]) for r in mapped) == [("interest_and_fees", 0, [1]), ("interest_and_fees", 1, [3]), (sub, 0, [3])]
    assert len({r["group_id"] for r in mapped}) == 3


def test_unknown_topics_are_refused(spark):
    for asked in ([], ["weather"]):
        with pytest.raises(ValueError):
            topics.requested(spark, asked)


def test_rates_and_costs(spark):
    none, lit = F.lit(None).cast("double"), F.lit
    assert str(value(spark, M.total_rate(lit("floating"), none, lit(0.1), lit(0.2), none)))[:5] == "0.300"
    assert str(value(spark, M.total_rate(lit("floating"), none, lit(0.01), lit(0.2), lit(0.05))))[:5] == "0.250"
    assert value(spark, M.total_rate(lit("floating"), none, none, lit(0.2), lit(0.05))) is None
    prices = {k: lit(1.0) for k in ("input", "cached", "written", "output")}
    cost = lambda *t: value(spark, M.estimated_cost(*map(lit, t), prices, 1000))
    assert float(cost(100, 10, 10, 50)) == pytest.approx(150e-6)
    assert cost(100, 90, 20, 5) is None and cost(2000, 0, 0, 5) is None and cost(10, -1, 0, 5) is None


def test_text_functions(spark):
    assert value(spark, T.is_blank(F.lit("   \t"))) and value(spark, T.is_blank(F.lit(None).cast("string")))
    assert value(spark, T.rendered(F.lit(" "), F.lit("x"))) == "x"
    grid = F.array(F.array(F.lit(" a\tb "), F.lit("")), F.array(F.lit("c\nd"), F.lit("e")), F.array(F.lit(""), F.lit(" ")))
    assert value(spark, T.render_grid(grid)) == "a b\nc d\te"
    assert value(spark, T.normal_role(F.lit("  Agent \t of  Record "))) == "agent_of_record"
    assert value(spark, T.joined_length(F.array(*map(F.lit, (2, 0, 3))))) == 6


def test_term_checks(spark):
    amounts = spark.createDataFrame([("a", "supported", None), ("b", "missing", 1.0), ("c", "supported", 1.0)], "key string, status string, value double")
    assert {(r["rule"], r["key"]) for r in terms.amount_violations(amounts).collect()} == {("value_missing", "a"), ("value_unexpected", "b")}
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1), (5, 5)], "parent int, child int")
    two = edges.selectExpr("7 AS doc_id", "parent", "child").union(spark.createDataFrame([(8, 3, 4), (8, 1, 2), (9, 1, 2), (9, 2, 3), (9, 3, 4), (9, 4, 3), (9, 4, 6), (9, 6, 7), (9, 7, 6)], "doc_id int, parent int, child int"))
    assert {(r["doc_id"], r["party"]) for r in terms.cyclic_parties(two).collect()} == {(7, 1), (7, 2), (7, 3), (9, 3), (9, 4), (9, 6), (9, 7)}
    chain = spark.range(5000).selectExpr("1L AS doc_id", "id AS parent", "(id + 1) % 5000 AS child")
    assert terms.cyclic_parties(chain).count() == 5000 and terms.cyclic_parties(chain.where("parent > 0")).isEmpty()
    assert [r["rule"] for r in terms.relationship_violations(edges).collect()] == ["self"]
    numbers = spark.createDataFrame([("a", float("nan")), ("b", float("inf")), ("c", -1.0), ("d", 0.0)], "key string, value double")
    assert {r["key"] for r in terms.number_violations(numbers).collect()} == {"a", "b", "c"}


def test_failure_keys_are_null_safe(spark):
    schema = "event_id long, run_id long, event string, span_id string, source string, batch_id int, attempt int, status string, stage string"
    rows = [(1, 0, "llm_attempt", "s", None, None, 1, "completed", "B2"), (2, 0, "batch_failed", "t", None, None, 1, "completed", "B2"), (3, 0, "llm_attempt", "s", "x", None, 1, "completed", "B2")]
    # a failed span counts only if it is the extraction stage's
    rows += [(4, 0, "llm_attempt", "u", "x", None, 1, "completed", "C"), (5, 0, "stage_finished", "u", "x", None, 1, "failed", "C"), (6, 0, "llm_attempt", "v", "x", None, 1, "completed", "B2"), (7, 0, "stage_finished", "v", "x", None, 1, "failed", "B2")]
    log = spark.createDataFrame(rows, schema)
    assert {r["event_id"]: r["is_failed"] for r in telemetry.calls_with_failures(log).collect()} == {1: True, 3: False, 4: True, 6: False}


def test_exchanges_interleave_by_attempt(spark):
    rows = [(0, "request", "a"), (1, "request", "b"), (2, "response", "b"), (3, "response", "a"), (4, "error", "a"), (5, "request", None), (6, "request", None), (7, "error", None), (8, "response", None), (9, "response", None)]
    schema = "run_id int, seq int, stage string, role string, attempt_id string, batch_id int, attempt int"
    messages = spark.createDataFrame([(1, s, "B2", r, a, 1, 1) for s, r, a in rows], schema)
    got = {r["request_seq"]: (r["response_seq"], r["error_seq"]) for r in telemetry.model_exchanges(messages).collect()}
    assert got == {0: (3, 4), 1: (2, None), 5: (None, None), 6: (8, 7)}
    # other stages neither answer nor stop a request, but for the one that validates the last
    rows = [(0, "B2", "request", None), (1, "D2", "request", None), (2, "B2", "response", None), (3, "D3", "error", None), (4, "D2", "response", None), (5, "B2", "request", "a"), (6, "D2", "response", "a"), (7, "B3", "request", None)]
    got = telemetry.model_exchanges(spark.createDataFrame([(1, s, g, r, a, 1, 1) for s, g, r, a in rows], schema)).collect()
    assert {tuple(r)[1:] for r in got} == {(0, 2, None), (1, 4, 3), (5, None, None)}


def test_exchanges_of_a_long_run_take_time_in_proportion(spark):
    """A hundred thousand messages with one key; looking through all later ones at each took minutes."""
    n = 100_000
    role = F.when(F.col("id") % 2 == 0, "request").otherwise("response")
    long = spark.range(0, n, 1, 1).select(F.lit(1).alias("run_id"), F.col("id").alias("seq"), F.lit("B2").alias("stage"), role.alias("role"), F.lit("a").alias("attempt_id"), F.lit(1).alias("batch_id"), F.lit(1).alias("attempt"))
    for found in (telemetry.model_exchanges(long), telemetry.exchange_pairs(long.select(F.lit(1).alias("key"), "seq", "role"))):
        began = time.monotonic()
        assert found.where("response_seq = request_seq + 1").count() == n // 2
        assert time.monotonic() - began < 30


def test_exchange_stops_at_the_next_request(spark):
    messages = spark.createDataFrame([(1, 0, "request"), (1, 1, "request"), (1, 2, "response"), (1, 3, "response")], "key int, seq int, role string")
    assert {r["request_seq"]: r["response_seq"] for r in telemetry.exchange_pairs(messages).collect()} == {0: None, 1: 2}


def test_compare_and_set(spark):
    decisions = spark.createDataFrame([(1, 1, "approved"), (1, 2, "edited")], "fact_id int, revision int, decision string")
    incoming = spark.createDataFrame([(1, 2, "rejected"), (2, 0, "approved"), (3, 1, "approved"), (4, 0, "guessed"), (5, 0, "approved"), (5, 0, "edited")], "fact_id int, expected int, decision string")
    got = reviews.compare_and_set(decisions, incoming).collect()
    assert {r["fact_id"] for r in got if r["accepted"]} == {1, 2}
    assert reviews.latest(reviews.applied(decisions, incoming)).where("fact_id = 1").first()["revision"] == 3


def test_log_tail_and_corrupt_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"event": "x"}\n\n{"event": "y"}\n{"ev')
    assert [r["line_no"] for r in files.read_events(spark, str(tmp_path)).orderBy("line_no").collect()] == [0, 2]
    with pytest.raises(Exception, match="corrupt line"):
        files.read_events(spark, str(tmp_path), strict=True).collect()
    (tmp_path / "a.jsonl").write_text('{"event": "x"}\noops\n{"event": "y"}\n')
    with pytest.raises(Exception, match="corrupt line"):
        files.read_events(spark, str(tmp_path)).collect()


def test_files_and_gzip(spark, tmp_path):
    page = b"<title>A &amp; B</title><h2>Head</h2><p>one<br>two</p><script>no()</script><ul><li>x</li></ul>"
    (tmp_path / "a.html").write_bytes(page)
    (tmp_path / "b.htm").write_bytes(gzip.compress(page))
    (tmp_path / "c.htm").write_bytes(b"\x1f\x8bbroken")
    (tmp_path / "d.txt").write_bytes(b"x")
    (tmp_path / "e.pdf").write_bytes(b"")
    got = {r["path"][-6:]: r for r in files.unzipped(files.read_files(spark, str(tmp_path))).collect()}
    assert {k: r["problem"] for k, r in got.items()} == {"a.html": None, "/b.htm": None, "/c.htm": "corrupt gzip", "/d.txt": "unknown format", "/e.pdf": "empty"}
    assert bytes(got["/b.htm"]["content"]) == page
    assert html.html_items(page.decode()) == [("title", None, "A & B"), ("section_header", 2, "Head"), ("text", None, "one"), ("text", None, "two"), ("list_item", None, "x")]


def test_manifest_written_last_and_read_back(spark, tmp_path):
    rows = spark.range(3)
    folder = files.write_once(rows, str(tmp_path), "abc", "plain")
    files.write_once(rows, str(tmp_path), "abc", "plain")
    assert spark.read.parquet(folder).count() == 3
    manifest = spark.read.parquet(f"{tmp_path}/_manifest").select(F.col("sha"), "profile", "status")
    assert [tuple(r) for r in manifest.collect()] == [("abc", "plain", "completed")]  # a second write leaves one row
    assert audit.not_completed(spark.createDataFrame([("abc",), ("new",)], "sha string"), manifest, "plain").collect()[0]["sha"] == "new"
    (tmp_path / "m.tsv").write_text("a\tb\n1\tx\n")
    assert files.read_manifest(spark, str(tmp_path / "m.tsv")).first().asDict() == {"a": "1", "b": "x"}


def test_redaction(spark):
    m = F.create_map(F.lit("API_key"), F.lit("x"), F.lit("name"), F.lit("y"))
    assert value(spark, audit.redacted(m)) == {"API_key": "[REDACTED]", "name": "y"}


def test_whole_pipeline(spark, small):
    from scrollwork.plans.adapters import items
    from scrollwork.plans.topic_queries import MODULUS

    def classify(chunks, own):
        inside = own.join(chunks.select("doc_id", "chunk_no", "first_pos", "last_pos"), "doc_id").where("pos BETWEEN first_pos AND last_pos")
        named = inside.withColumn("topic", F.get(F.array(*map(F.lit, topics.TOPICS)), F.length("text") % MODULUS)).where("topic IS NOT NULL")
        groups = named.groupBy("doc_id", "chunk_no", "topic").agg(F.array_sort(F.collect_list("pos")).alias("evidence")).withColumn("context", F.array().cast("array<int>"))
        return groups, chunks.select("doc_id", "chunk_no").where(left_out)

    left_out = "doc_id >= 0"
    got = pipeline.run(items(spark, small), classify, pipeline.Settings(target=2000))
    assert got["violations"].count() == 0 and got["topic_map"].count() > 0
    assert got["evidence"].where("text IS NULL").count() == 0
    left_out = "doc_id % 2 = 0"  # a classifier that skips chunks is reported
    skipped = pipeline.run(items(spark, small), classify, pipeline.Settings(target=2000))["violations"]
    assert skipped.where("rule = 'unanswered'").count() == got["chunks"].where("doc_id % 2 = 1").count() == skipped.count() > 0


def test_stream_equals_batch(spark, small, tmp_path):
    from scrollwork.plans.adapters import log

    events = log(spark, small).withColumn("ts", F.timestamp_seconds(F.col("event_id") * 60))
    files.append_events(events, str(tmp_path / "log"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema)
    for make in (tail.running_totals, tail.last_batch_event):
        query = make(tail.tail(spark, str(tmp_path / "log"), schema)).writeStream.outputMode("complete").format("memory").queryName(make.__name__).start()
        query.processAllAvailable()
        query.stop()
        assert sorted(map(str, spark.table(make.__name__).collect())) == sorted(map(str, make(events).collect()))
    query = tail.calls_by_minute(tail.tail(spark, str(tmp_path / "log"), schema)).writeStream.outputMode("append").format("memory").queryName("minutes").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("minutes").count() > 0

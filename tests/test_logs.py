"""Logs read in ranges of bytes, and stage status from them, as tables and as streams."""

import json
import random

import pytest
from pyspark.sql import functions as F

from scrollwork.operators import stages
from scrollwork.sources import files, logs
from scrollwork.streaming import tail
from scrollwork.streaming.stages import JOB, STATE_STORE, live_stage_status


def lines(spark, path, split):
    got = logs.read_lines(spark, str(path), split)
    return sorted((r["path"][-6:], r["line_no"], r["offset"], r["line"], r["is_ended"]) for r in logs.numbered(got, got).collect())


def expected(path):
    out = []
    for file in sorted(path.iterdir()):
        at = 0
        for k, line in enumerate(file.read_bytes().split(b"\n")):
            if at + len(line) < file.stat().st_size or line:
                out.append((str(file)[-6:], k, at, line.decode("utf-8", "replace"), at + len(line) < file.stat().st_size))
            at += len(line) + 1
    return sorted(out)


@pytest.mark.parametrize("split", [1, 2, 3, 7, 64, 1000, 1 << 20])
def test_ranges_give_what_whole_files_give(spark, tmp_path, split, monkeypatch):
    monkeypatch.setattr(logs, "BLOCK", 5)  # in this process; the tasks read larger blocks
    rng = random.Random(split)
    made = {"a.json": "one\ntwo\n\nthree é日\nlast", "b.json": "\n\n\n", "c.json": "", "d.json": "no end", "e.json": "".join(rng.choice("ab\né") for _ in range(400))}
    for name, text in made.items():
        (tmp_path / name).write_text(text)
    assert lines(spark, tmp_path, split) == expected(tmp_path)
    for name, text in made.items():
        raw = text.encode()
        with (tmp_path / name).open("rb") as file:
            found = [x for part in logs.ranges("", 0, len(raw), split) for x in logs.lines_of(file, part.start, part.end)]
        want, at = [], 0
        for line in raw.splitlines(keepends=True) if b"\r" not in raw else []:
            want.append((at, line.rstrip(b"\n"), line.endswith(b"\n")))
            at += len(line)
        assert found == want


def test_a_file_of_many_ranges(spark, tmp_path):
    with (tmp_path / "big.jsonl").open("w") as f:
        for k in range(60_000):
            f.write(json.dumps({"event": "x", "k": k, "text": "é" * (k % 50)}) + "\n")
    got = files.read_events(spark, str(tmp_path), split=100_000)
    assert logs.read_lines(spark, str(tmp_path), 100_000).rdd.getNumPartitions() > 30
    seen = got.select("line_no", F.variant_get("event", "$.k", "int").alias("k")).agg(F.count("*"), F.sum((F.col("line_no") != F.col("k")).cast("int"))).first()
    assert tuple(seen) == (60_000, 0)


def test_nothing_to_read(spark, tmp_path):
    assert logs.read_lines(spark, str(tmp_path)).count() == 0
    assert logs.read_lines(spark, str(tmp_path / "none")).count() == 0


def follow(spark, log, sink, checkpoint):
    query = tail.follow(spark, str(log), "event string, k int", split=20).writeStream.format("parquet").option("path", str(sink)).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted(r["k"] for r in spark.read.parquet(str(sink)).collect())


def test_stream_stays_before_an_unfinished_line(spark, tmp_path):
    log, sink, checkpoint = tmp_path / "log", tmp_path / "sink", tmp_path / "checkpoint"
    log.mkdir()
    (log / "a.jsonl").write_text('{"event": "x", "k": 1}\n{"event": "x", "k": 2}\n{"event": "x", "k"')
    assert follow(spark, log, sink, checkpoint) == [1, 2]
    with (log / "a.jsonl").open("a") as f:
        f.write(': 3}\n\n{"event": "x", "k": 4}')
    (log / "b.jsonl").write_text('{"event": "y", "k": 9}\n')
    assert follow(spark, log, sink, checkpoint) == [1, 2, 3, 9]
    with (log / "a.jsonl").open("a") as f:
        f.write("\n")
    assert follow(spark, log, sink, checkpoint) == [1, 2, 3, 4, 9]


def test_stream_stops_at_a_corrupt_line(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.jsonl").write_text('{"k": 1}\n[2]\n{"k": 3}\n')
    with pytest.raises(Exception, match="corrupt line at byte 9"):
        follow(spark, tmp_path / "log", tmp_path / "sink", tmp_path / "checkpoint")


LOG = "run_id long, event_id long, stage string, event string, span_id string, status string"


def machine(rows, job):
    """Status of each stage, event by event."""
    said = {}
    for _, _, stage, event, span, status in rows:
        if stage not in stages.STAGES:
            continue
        s = said.setdefault(stage, {"status": None, "open": set(), "n": 0})
        s["n"] += 1
        if event == "stage_started":
            s["open"] |= {span} if span else set()
            s["status"] = "running"
        elif event == "stage_finished":
            s["open"].discard(span)
            failed = status == "failed" or s["status"] == "failed"
            s["status"] = "failed" if failed else "running" if s["open"] else status or "completed"
        elif event in ("stage_skipped", "cache_hit"):
            s["status"] = "skipped" if event == "stage_skipped" else "cached"
    out = {}
    for stage in stages.STAGES:
        s = said.get(stage, {"status": None, "open": set(), "n": 0})
        status = s["status"] or ("unrecorded" if job in (None, "historical") else "waiting")
        if status == "running" and job in ("failed", "interrupted"):
            status = "interrupted"
        if status == "running" and job == "historical":
            status = "unrecorded"
        out[stage] = (status, s["n"], len(s["open"]))
    return out


def random_log(seed, runs=6, n=400):
    rng = random.Random(seed)
    rows = [(rng.randrange(runs), k, rng.choice(["A", "A3.1", "B2", "C", "Z", None]), rng.choice(["stage_started", "stage_finished", "stage_started", "stage_finished", "stage_skipped", "cache_hit", "note"]), rng.choice(["s", "t", "", None]), rng.choice(["completed", "failed", "partial", None])) for k in range(n)]
    return rows, {r: job for r, job in zip(range(runs + 1), ["running", "failed", "interrupted", "historical", None, "completed", "running"], strict=True) if job}


def by_machine(rows, jobs):
    runs = {r[0] for r in rows} | set(jobs)
    return {(run, s): v for run in runs for s, v in machine([r for r in rows if r[0] == run], jobs.get(run)).items()}


@pytest.mark.parametrize("seed", range(3))
def test_batch_equals_the_machine(spark, seed):
    rows, jobs = random_log(seed)
    got = stages.stage_status(spark.createDataFrame(rows, LOG), spark.createDataFrame(list(jobs.items()), "run_id long, status string")).collect()
    assert {(r["run_id"], r["stage"]): (r["status"], r["n_events"], r["n_active"]) for r in got} == by_machine(rows, jobs)
    assert len(got) == len({(r["run_id"], r["stage"]) for r in got})


def test_null_spans_leave_nothing_open(spark):
    rows = [(1, 0, "A", "stage_started", "a", None), (1, 1, "A", "stage_started", None, None), (1, 2, "A", "stage_finished", "a", "partial")]
    got = stages.stage_status(spark.createDataFrame(rows, LOG)).where("stage = 'A'").first()
    assert (got["status"], got["n_active"]) == ("partial", 0)


@pytest.fixture
def state_store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_stream_equals_batch(spark, tmp_path, state_store):
    rows, jobs = random_log(7)
    told = [(run, 1000 + run, None, JOB, None, job) for run, job in jobs.items()]
    log, seen = tmp_path / "log", {}
    log.mkdir()
    # jobs tell their status at different times, and the log arrives in four parts
    parts = [told[:3] + rows[:150], rows[150:151], told[3:] + rows[151:300], rows[300:]]

    def take(frame, _):
        seen.update({(r["run_id"], r["stage"]): (r["status"], r["n_events"], r["n_active"]) for r in frame.collect()})

    for k, part in enumerate(parts):
        with (log / "run.jsonl").open("a") as f:
            f.writelines(json.dumps(dict(zip(("run_id", "event_id", "stage", "event", "span_id", "status"), r, strict=True))) + "\n" for r in part)
        events = tail.follow(spark, str(log), LOG, split=2000)
        query = live_stage_status(events).writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert seen == by_machine(rows, jobs)

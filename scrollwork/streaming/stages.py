"""Stage status as a stream: one state for each run, kept by Spark from batch to batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.stages import DECIDED, FINISHED, STAGES, STARTED

#: The event of a job that takes another status; its `status` says which.
JOB = "job_status"
#: Where Spark keeps state of several kinds for a key.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "run_id long, stage string, status string, n_events long, n_active long"


def shown(status: str | None, job: str | None) -> str:
    """A stage's status as its job has it."""
    if status is None:
        return "unrecorded" if job in (None, "historical") else "waiting"
    if status == "running" and job in ("failed", "interrupted"):
        return "interrupted"
    return "unrecorded" if status == "running" and job == "historical" else status


class StageProcessor(StatefulProcessor):
    """For a run: its job's status, and of each stage the status, the number of events and the spans that have not ended.

    Each batch's events of a run are taken in order of event_id, and those of an earlier batch are earlier ones. With
    `quiet` milliseconds, a timer marks the running stages of a run without news as interrupted; news wakes them again.
    """

    def __init__(self, quiet: int | None = None):
        self.quiet = quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", "status string")
        self.stages = handle.getMapState("stages", "stage string", "status string, n_events long, spans array<string>")

    def close(self) -> None:
        pass

    def _read(self) -> dict[str, list]:
        return {key[0]: [status, n, list(spans)] for key, (status, n, spans) in self.stages.iterator()}

    def _rows(self, run_id, stages: dict[str, list], which) -> pd.DataFrame:
        job = self.job.get()[0] if self.job.exists() else None
        rows = [(run_id, s, shown(stages[s][0], job), stages[s][1], len(stages[s][2])) if s in stages else (run_id, s, shown(None, job), 0, 0) for s in STAGES if s in which]
        return pd.DataFrame(rows, columns=["run_id", "stage", "status", "n_events", "n_active"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values("event_id", kind="stable")
        first = not self.job.exists() and not self.stages.exists()
        stages, touched = self._read(), set(STAGES) if first else set()
        for event, stage, span, said in events[["event", "stage", "span_id", "status"]].astype(object).where(lambda x: x.notna(), None).itertuples(index=False):
            if event == JOB:
                self.job.update((said,))
                touched.update(STAGES)
            elif stage in STAGES:
                own = stages.setdefault(stage, [None, 0, []])
                advance(own, event, span, said)
                touched.add(stage)
        for s in touched & stages.keys():
            self.stages.updateValue((s,), tuple(stages[s]))
        if self.quiet is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.quiet)
        yield self._rows(key[0], stages, touched)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        stages = self._read()
        stalled = {s for s, own in stages.items() if own[0] == "running"}
        out = self._rows(key[0], stages, stalled)
        out["status"] = "interrupted"
        yield out


def advance(own: list, event: str, span: str | None, said: str | None) -> None:
    """[status, events, spans that have not ended] of a stage after one more event."""
    own[1] += 1
    open_spans = own[2]
    if event == FINISHED:
        if span in open_spans:
            open_spans.remove(span)
        if own[0] != "failed":
            own[0] = "failed" if said == "failed" else "running" if open_spans else said or "completed"
    elif event in DECIDED:
        own[0] = DECIDED[event]
        if event == STARTED and span and span not in open_spans:
            open_spans.append(span)


def live_stage_status(events: DataFrame, quiet: int | None = None) -> DataFrame:
    """Rows of `operators.stages.stage_status` as they change, in update mode: all stages of a run when it is first seen or its
    job changes, else those with news. `events`: run_id, event_id, stage, event, span_id, status; jobs tell their status by
    events JOB. The session's state store must be STATE_STORE. One state a run, dealt out by run_id."""
    own = events.select(events["run_id"].cast("long").alias("run_id"), "event_id", "stage", "event", "span_id", "status")
    mode = "None" if quiet is None else "ProcessingTime"
    return own.groupBy("run_id").transformWithStateInPandas(StageProcessor(quiet), OUT, "Update", mode)

"""The log-structured window index, stored: batches of documents are deduplicated one after another.

Runs are Parquet tables of window fingerprints (two 64-bit hashes, as in `substrings`), sorted and never changed. A new
batch's fingerprints are merge-joined with all runs; a window goes if a run has it or if it starts earlier in the batch.
What is new becomes a run, and the last two runs are compacted while the newer one has at least half the rows of the
older. A run counts once a small file says where its rows are; the file's name says which batches it holds, and one whose batches
another one holds too is ignored, so whatever a lost job leaves behind does no harm: the batch is added again. Only one
writer can create such a file, so of two that add batches at once the slower one is held against the other's run before it
is tried again; no batch is lost, and none misses the windows of one before it. A compaction takes its two runs away: a job
that still reads them fails and is to be started again.

Every window of a batch is shuffled here, unlike in `substrings`, where the whole corpus is at hand. A window that very
many documents share is no hot key: its earliest place is found by a combined minimum, and the rest by an anti join on
hash and place.

Defined results: as in `substrings`, with batches in the order in which they were added, whatever their ids.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import create_once, names_in, read_text, remove
from .common import SPACED, spans_of_words, text_blocks, window_hashes, window_rows, word_hashes
from .components import checkpointed
from .substrings import _ROW, ROW, WINDOW, _keep_words, _rows, documents


def _all_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in text_blocks(batch, "text"):
                starts, ends, per_text = spans_of_words(offsets, data, SPACED)
                first = window_rows(per_text, window)
                if len(first):
                    one, two = (window_hashes(word_hashes(data, starts, ends, w), window, w)[first] for w in (0, 1))
                    doc = np.searchsorted(per_text, first, "right") - 1
                    at, twin = (rows.column(c).to_numpy(zero_copy_only=False)[doc] for c in ("at", "twin"))
                    yield _rows(_ROW, one, two, at, twin, first - per_text[doc])

    return run


class WindowHistory:
    """Runs under `path`, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, window: int = WINDOW):
        self.spark, self.path, self.window = spark, path.rstrip("/"), window

    def runs(self) -> list[tuple[int, int]]:
        """First and last batch of each run in force, oldest first."""
        spans = [tuple(map(int, n.split("-")[1:])) for n in names_in(self.spark, self.path) if n.startswith("batches-")]
        return sorted(s for s in spans if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in spans))

    def _name(self, span: tuple[int, int]) -> str:
        return f"{self.path}/batches-{span[0]:08d}-{span[1]:08d}"

    def _read(self, span: tuple[int, int]) -> DataFrame:
        return self.spark.read.schema("key long, check long").parquet(f"{self.path}/rows/{read_text(self.spark, self._name(span))}")

    def _write(self, keys: DataFrame, span: tuple[int, int]) -> bool:
        """Whether these keys now are the run of these batches; another writer may have been faster."""
        folder = uuid.uuid4().hex
        keys.select("key", "check").repartition("key").sortWithinPartitions("key", "check").write.parquet(f"{self.path}/rows/{folder}")
        if create_once(self.spark, self._name(span), folder):
            return True
        remove(self.spark, f"{self.path}/rows/{folder}")
        return False

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """doc_id, n_words, n_removed and kept of each row of a batch, which becomes part of the history."""
        own = documents(docs, doc_id, text)
        windows = own.mapInArrow(_all_windows(self.window), ROW)
        earliest = windows.groupBy("key", "check").agg(F.min(F.struct("at", "twin", "pos")).alias("first")).select("key", "check", "first.*")
        while True:
            spans, new = self.runs(), earliest
            for span in spans:
                new = new.join(self._read(span), ["key", "check"], "left_anti")
            fresh = checkpointed(new)
            number = spans[-1][1] + 1 if spans else 0
            if self._write(fresh, (number, number)):
                break
        gone = windows.join(fresh, ["key", "check", "at", "twin", "pos"], "left_anti").groupBy("at", "twin")
        gone = gone.agg(F.collect_list(F.struct(F.col("pos").alias("start"), F.lit(self.window).cast("long").alias("n"))).alias("had"))
        texts = own.join(gone, ["at", "twin"], "left").select("id", "at", "twin", "text", "had")
        result = checkpointed(texts.mapInArrow(_keep_words, "doc_id long, n_words long, n_removed long, kept binary"))
        self.compact()
        return result

    def compact(self, everything: bool = False) -> None:
        """Merges the last two runs while the newer has at least half the rows of the older, or (`everything`) all."""
        while len(spans := self.runs()) > 1:
            a, b = spans[-2:]
            old, new = self._read(a), self._read(b)
            if not everything and 2 * new.count() < old.count():
                return
            self._write(old.unionByName(new), (a[0], b[1]))
            for span in (a, b):
                folder = f"{self.path}/rows/{read_text(self.spark, self._name(span))}"
                remove(self.spark, self._name(span))
                remove(self.spark, folder)

"""Removal of repeated word windows with a log-structured fingerprint index.

A window's fingerprint is that of 20 words. Shuffling one row a window would move many times the text, so windows are
first dealt with in stretches: each window has an anchor, its smallest hash of 6 consecutive words; the windows of one
anchor lie side by side and form a stretch. Equal windows have equal anchors at equal places, so

1. a stretch that also lies earlier as a whole is removed at once;
2. a stretch whose anchor hash nobody shares holds no repeated window;
3. only for different stretches with one anchor hash the windows themselves are compared.

For 1 and 2 each task owns a slice of the anchor hashes, for 3 a slice of the window hashes. It takes its rows as
batches in document order, merge-joins each batch with the sorted runs of what came before, verifies equal keys by a
second hash of the same words, made from their bytes with other constants (for stretches: the anchor's hash by one, the
stretch's by the other), and appends the new ones as a run; runs of one size are compacted. Rows that repeat within a block of text never leave the task that read it,
so a passage that a third of all documents share is a row a block, not a row a document, and an index holds a key once.

Defined results: a null or blank text has no words and the hash of the empty string; fewer than 20 words are never
removed; a null id comes before all others; rows with one id and different texts are different documents, in the order
of the texts' hashes; equal rows (same id, same text) count as one document and are answered alike; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACED, covered, joined, mix, spans_of_words, table, text_blocks, window_hashes, window_rows, word_hashes
from .runs import RunIndex

#: Words of a window, and of what anchors are chosen by.
WINDOW, ANCHOR = 20, 6
_FIRST_ID = -(1 << 63)
#: Stretches of a document are packed as start * _PACK + windows.
_PACK = 64


def documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, at (the id, or the least number for null), twin (hash of the text) and text, dealt out by document."""
    own = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = own.select("id", F.coalesce("id", F.lit(_FIRST_ID).cast("long")).alias("at"), F.xxhash64("text").alias("twin"), "text")
    return own.repartition("at", "twin")


def stretches(per_text: np.ndarray, words: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor hash of every stretch. `words`: hashes of all words of the texts."""
    first = window_rows(per_text, window)
    if not len(first):
        return first, first, np.zeros(0, np.uint64)
    hashes = window_hashes(words, anchor)
    best, place = hashes[first], first.copy()
    for d in range(1, window - anchor + 1):
        other = hashes[first + d]
        better = other < best
        best = np.where(better, other, best)
        place = np.where(better, first + d, place)
    begin = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (first[1:] != first[:-1] + 1)]))
    return first[begin], np.diff(np.concatenate([begin, [len(first)]])), best[begin]


def _earliest(keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, the row of its key that comes first by `order` (distinct ranks)."""
    by = np.lexsort((order, keys))
    begin = np.concatenate([[True], keys[by][1:] != keys[by][:-1]])
    out = np.zeros(len(keys), np.int64)
    out[by] = by[np.maximum.accumulate(np.where(begin, np.arange(len(by)), 0))]
    return out, np.flatnonzero(out == np.arange(len(keys)))


_ROW = pa.schema([("key", pa.int64()), ("check", pa.int64()), ("at", pa.int64()), ("twin", pa.int64()), ("pos", pa.int64())])
ROW = "key long, check long, at long, twin long, pos long"
_SPAN = pa.schema([("at", pa.int64()), ("twin", pa.int64()), ("kind", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])
SPAN = "at long, twin long, kind long, start long, n long"


def _rows(schema: pa.Schema, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in columns], schema=schema)


def by_document(at: np.ndarray, twin: np.ndarray) -> np.ndarray:
    """Keys that deal rows out by document, copies of one text too."""
    return mix(at.astype(np.int64).view(np.uint64)) ^ twin.astype(np.int64).view(np.uint64)


def _numbers(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _order(at: np.ndarray, twin: np.ndarray, pos: np.ndarray) -> np.ndarray:
    rank = np.zeros(len(at), np.int64)
    rank[np.lexsort((pos, twin, at))] = np.arange(len(at))
    return rank


def _find_stretches(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in text_blocks(batch, "text"):
                starts, ends, per_text = spans_of_words(offsets, data, SPACED)
                words = word_hashes(data, starts, ends)
                first, n, anchors = stretches(per_text, words, window, anchor)
                if not len(first):
                    continue
                # the first and the last window of a stretch cover all of it
                own = window_hashes(word_hashes(data, starts, ends, 1), window, 1)
                whole = joined(own[first] + n.astype(np.uint64), own[first + n - 1], 1)
                doc = np.searchsorted(per_text, first, "right") - 1
                at, twin = (rows.column(c).to_numpy(zero_copy_only=False)[doc] for c in ("at", "twin"))
                pos = (first - per_text[doc]) * _PACK + n
                lead, reps = _earliest(whole, _order(at, twin, pos))
                # a later one of the block goes past the index: it is removed, unless it is the same row again
                later = np.flatnonzero((lead != np.arange(len(lead))) & ((at[lead] != at) | (twin[lead] != twin) | (pos[lead] != pos)))
                yield _rows(_ROW, anchors[reps], whole[reps], at[reps], twin[reps], pos[reps])
                if len(later):
                    yield _rows(_ROW, by_document(at[later], twin[later]), whole[later], at[later], twin[later], -1 - pos[later])

    return run


def _past_same(last: tuple | None, at: np.ndarray, twin: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Rows that are not the row before once more."""
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (twin[1:] != twin[:-1]) | (pos[1:] != pos[:-1])
    if last is not None and len(at):
        new[0] = (at[0], twin[0], pos[0]) != last
    return new


def _match_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in document order -> kind 0: stretches that lie earlier as a whole; kind 1: those to compare by window."""
    wholes, anchors, last = RunIndex(0), RunIndex(4), None
    for batch in batches:
        key, check, at, twin, pos = _numbers(batch)
        if not len(key):
            continue
        gone = pos < 0
        if gone.any():
            done = -1 - pos[gone]
            yield _rows(_SPAN, at[gone], twin[gone], np.zeros(gone.sum()), done // _PACK, done % _PACK)
            key, check, at, twin, pos = (c[~gone] for c in (key, check, at, twin, pos))
        if not len(key):
            continue
        new = _past_same(last, at, twin, pos)
        last = (at[-1], twin[-1], pos[-1])
        key, check, at, twin, pos = (c[new] for c in (key, check, at, twin, pos))
        run, _ = wholes.find(check)
        lead, _ = _earliest(check, np.arange(len(check)))
        known = (run >= 0) | (lead != np.arange(len(check)))
        if known.any():
            yield _rows(_SPAN, at[known], twin[known], np.zeros(known.sum()), pos[known] // _PACK, pos[known] % _PACK)
        key, check, at, twin, pos = (c[~known] for c in (key, check, at, twin, pos))
        wholes.add(check, np.zeros((len(check), 0), np.int64))
        # new stretches whose anchor hash an earlier stretch has: both are to be compared by window
        run, place = anchors.find(key)
        lead, reps = _earliest(key, np.arange(len(key)))
        again = run >= 0
        old = np.flatnonzero(again & (lead == np.arange(len(key))))
        rows = anchors.rows(run[old], place[old])
        waiting = rows[:, 3] == 0
        if waiting.any():
            yield _rows(_SPAN, rows[waiting, 0], rows[waiting, 1], np.ones(waiting.sum()), rows[waiting, 2] // _PACK, rows[waiting, 2] % _PACK)
            anchors.put(run[old][waiting], place[old][waiting], 3, 1)
        several = np.bincount(lead, minlength=len(key))[lead] > 1 if len(key) else np.zeros(0, bool)
        told = again | several
        if told.any():
            yield _rows(_SPAN, at[told], twin[told], np.ones(told.sum()), pos[told] // _PACK, pos[told] % _PACK)
        fresh = reps[~again[reps]]
        anchors.add(key[fresh], np.stack([at[fresh], twin[fresh], pos[fresh], told[fresh].astype(np.int64)], 1))


def _runs_of(flags: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of flags that do not cross an edge."""
    start, end = flags.copy(), flags.copy()
    start[1:] &= ~flags[:-1]
    end[:-1] &= ~flags[1:]
    inner = edges[(edges > 0) & (edges < len(flags))]
    start[inner] |= flags[inner]
    end[inner - 1] |= flags[inner - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def _ragged(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row of each struct in a column of arrays of structs, and the structs' fields."""
    column = batch.column(name)
    counts = np.array([0 if x is None else x for x in column.value_lengths().to_pylist()], np.int64)
    flat = column.flatten()
    return np.repeat(np.arange(len(counts)), counts), {f.name: flat.field(k).to_numpy(zero_copy_only=False) for k, f in enumerate(flat.type)}


def _find_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in text_blocks(batch, "text"):
                starts, ends, per_text = spans_of_words(offsets, data, SPACED)
                doc, had = _ragged(rows, "had")
                at, twin = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("at", "twin"))
                begin, n = per_text[doc] + had["start"], had["n"]
                whole = had["kind"] == 0
                edge = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edge, begin[whole], 1)
                np.add.at(edge, (begin + n + window - 1)[whole], -1)
                gone = np.cumsum(edge[:-1]) > 0
                count = n[~whole]
                first = np.repeat(begin[~whole], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                if len(first):
                    one, two = (window_hashes(word_hashes(data, starts, ends, w), window, w)[first] for w in (0, 1))
                    of = np.searchsorted(per_text, first, "right") - 1
                    pos = first - per_text[of]
                    lead, reps = _earliest(one, _order(at[of], twin[of], pos))
                    later = (lead != np.arange(len(lead))) & (two[lead] == two) & ((at[of][lead] != at[of]) | (twin[of][lead] != twin[of]) | (pos[lead] != pos))
                    gone |= covered(len(starts), first[later], window)
                    yield _rows(_ROW, one[reps], two[reps], at[of][reps], twin[of][reps], pos[reps])
                a, b = _runs_of(gone, per_text)
                if len(a):
                    of = np.searchsorted(per_text, a, "right") - 1
                    yield _rows(_ROW, by_document(at[of], twin[of]), b - a, at[of], twin[of], -1 - (a - per_text[of]))

    return run


def _match_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, last = RunIndex(1), None
        for batch in batches:
            key, check, at, twin, pos = _numbers(batch)
            gone = pos < 0
            if gone.any():
                yield _rows(_SPAN, at[gone], twin[gone], np.zeros(gone.sum()), -1 - pos[gone], check[gone])
                key, check, at, twin, pos = (c[~gone] for c in (key, check, at, twin, pos))
            if not len(key):
                continue
            new = _past_same(last, at, twin, pos)
            last = (at[-1], twin[-1], pos[-1])
            key, check, at, twin, pos = (c[new] for c in (key, check, at, twin, pos))
            run_of, place = index.find(key)
            lead, reps = _earliest(key, np.arange(len(key)))
            known = (run_of >= 0) & (index.rows(run_of, place)[:, 0] == check) | (run_of < 0) & (lead != np.arange(len(key))) & (check[lead] == check)
            if known.any():
                yield _rows(_SPAN, at[known], twin[known], np.zeros(known.sum()), pos[known], np.full(known.sum(), window))
            fresh = reps[run_of[reps] < 0]
            index.add(key[fresh], check[fresh][:, None])

    return run


def _keep_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, offsets, data in text_blocks(batch, "text"):
            starts, ends, per_text = spans_of_words(offsets, data, SPACED)
            doc, had = _ragged(rows, "had")
            edge = np.zeros(len(starts) + 1, np.int64)
            np.add.at(edge, per_text[doc] + had["start"], 1)
            np.add.at(edge, per_text[doc] + had["start"] + had["n"], -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[per_text])
            raw, texts = data.tobytes(), []
            for k in range(len(offsets) - 1):
                own = raw[offsets[k] : offsets[k + 1]].split()
                if removed[k]:
                    own = [w for w, g in zip(own, gone[per_text[k] : per_text[k + 1]].tolist(), strict=True) if not g]
                texts.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(per_text)), pa.array(removed), pa.array(texts, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeated_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept (UTF-8 bytes: the words that stay, joined by one space) of every row.

    The texts are shuffled once; the three passes over them read the same shuffle.
    """
    own = documents(docs, doc_id, text)
    found = own.mapInArrow(_find_stretches(window, anchor), ROW)
    judged = found.repartition("key").sortWithinPartitions("at", "twin", "pos").mapInArrow(_match_stretches, SPAN)
    gather = F.collect_list(F.struct("kind", "start", "n")).alias("had")
    open_docs = judged.groupBy("at", "twin").agg(gather)
    windows = own.join(open_docs, ["at", "twin"]).select("id", "at", "twin", "text", "had").mapInArrow(_find_windows(window), ROW)
    removed = windows.repartition("key").sortWithinPartitions("at", "twin", "pos").mapInArrow(_match_windows(window), SPAN)
    spans = removed.groupBy("at", "twin").agg(gather)
    return own.join(spans, ["at", "twin"], "left").select("id", "at", "twin", "text", "had").mapInArrow(_keep_words, "doc_id long, n_words long, n_removed long, kept binary")


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_windows(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(documents: list[tuple[int, str | None]], window: int = WINDOW) -> dict[int, tuple[int, int, str]]:
    """doc -> n_words, n_removed, kept_sha256, by remembering every window."""
    seen, out = set(), {}
    for doc, text in sorted(documents):
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            if w in seen:
                gone.update(range(k, k + window))
            seen.add(w)
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[doc] = len(words), len(gone), hashlib.sha256(kept).hexdigest()
    return out

"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

A byte goes if a string of 400 bytes that covers it also starts anywhere else. Suffixes are sparse: every window of 400
bytes has an anchor, its smallest hash of 32 bytes, and the windows of one anchor lie side by side in a piece of at
most 768 bytes. Equal windows have equal anchors at equal places, so

1. a piece that occurs twice as a whole, by a hash of its anchor and another of all its bytes, is repeated throughout;
2. a piece whose anchor hash no other piece has holds no repeated window;
3. only different pieces with one anchor hash go on, each once, and meet in one task. There they come in batches, each
   batch gets suffix arrays at its anchors, and is scanned for long matches with the levels before it as equal-sized
   levels merge (`suffixes.SuffixLevels`). There, matches are compared byte for byte.

An anchor hash with more than `HOT` different pieces is not gathered: its windows are dealt out by the hash of their
own 400 bytes, held against an index of sorted runs and verified by a second, independent hash. Pieces and windows that repeat within a block of text are
combined before they are shuffled, so what a third of all documents share is a row a block.

Defined results: a null text is empty and has the hash of the empty string; texts under 400 bytes lose nothing; equal
rows are different documents here, as each holds the other's strings; null ids are ids like others; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import joined, mix, table, text_blocks
from .runs import RunIndex
from .substrings import _SPAN, SPAN, _ragged, _rows, _runs_of, by_document, documents
from .suffixes import SuffixLevels

#: Bytes of a window.
WINDOW = 400
#: Different pieces of one anchor hash that may meet in a task, about 0.75 KB each.
HOT = 4096
#: Pieces whose groups are handled together, and pieces of a batch.
TOGETHER, BATCH = 4096, 2048
#: Window starts that one pass hashes; also what the places in a pass must stay under.
PASS = 1 << 22
_GRAM = 32
_PLACE = np.uint64((1 << 24) - 1)
_START = (np.uint64(0), np.uint64(0x27D4EB2F165667C5))


def gram_hashes(data: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of the 32 bytes at each place, joined from those of 8 and 16; another `which`, an independent one."""
    if len(data) < _GRAM:
        return np.zeros(0, np.uint64)
    wide = data.astype(np.uint64)
    for step in (1, 2, 4):
        wide = wide[:-step] | wide[step:] << np.uint64(8 * step)
    hashes = mix(wide ^ _START[which])
    for step in (8, 16):
        hashes = joined(hashes[:-step], hashes[step:], which)
    return hashes


def spans_hashed(grams: np.ndarray, starts: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of the `size` bytes (32 or more) at each of `starts`, joined in turn from those of 32."""
    out = grams[starts]
    for at in [*range(_GRAM, size - _GRAM + 1, _GRAM), *([size - _GRAM] if size % _GRAM else [])]:
        out = joined(out, grams[starts + at], which)
    return out


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` values in a row, from minima of prefixes and suffixes of blocks."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    prefix = np.minimum.accumulate(blocks, 1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(suffix[: n - width + 1], prefix[width - 1 : n])


def pieces(offsets: np.ndarray, data: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor offset, anchor hash and hash of all bytes of every piece."""
    out = []
    for a in range(0, max(0, len(data) - window + 1), PASS):
        own = data[a : a + PASS + window - 1]
        hashes = gram_hashes(own)
        least = sliding_minimum(hashes & ~_PLACE | np.arange(len(hashes), dtype=np.uint64), window - _GRAM + 1)
        place = (least & _PLACE).astype(np.int64)
        first = np.arange(len(least))
        doc = np.searchsorted(offsets, first + a, "right") - 1
        inside = first + a + window <= offsets[doc + 1]
        first, place, doc = first[inside], place[inside], doc[inside]
        if not len(first):
            continue
        begin = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]))
        n = np.diff(np.concatenate([begin, [len(first)]]))
        # the first and the last window of a piece cover all of it
        begin_at, last_at = first[begin], first[begin] + n - 1
        whole = joined(spans_hashed(hashes, begin_at, window, 1) + n.astype(np.uint64), spans_hashed(hashes, last_at, window, 1), 1)
        out.append((begin_at + a, n, place[begin] - begin_at, hashes[place[begin]], whole))
    if not out:
        none, no_hash = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return none, none, none, no_hash, no_hash
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


_PIECE = pa.schema([(c, pa.int64()) for c in ("key", "check", "at", "twin", "start", "n", "off", "told")])
PIECE = "key long, check long, at long, twin long, start long, n long, off long, told long"
_JUDGED = pa.schema([(c, pa.int64()) for c in ("at", "twin", "kind", "key", "start", "n", "off")])
JUDGED = "at long, twin long, kind long, key long, start long, n long, off long"
_TEXT = pa.schema([("key", pa.int64()), ("content", pa.binary()), ("at", pa.int64()), ("twin", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("off", pa.int64())])
TEXT = "key long, content binary, at long, twin long, start long, n long, off long"
#: Kinds of judged rows: repeated throughout; to be compared; to be compared window by window.
REPEATED, OPEN, HOT_OPEN = 0, 1, 2


def _numbers(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _find_pieces(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in text_blocks(batch, "text"):
                first, n, off, anchors, whole = pieces(offsets, data, window)
                if not len(first):
                    continue
                doc = np.searchsorted(offsets, first, "right") - 1
                at, twin = (rows.column(c).to_numpy(zero_copy_only=False)[doc] for c in ("at", "twin"))
                start = first - offsets[doc]
                # pieces that repeat in the block: one goes on, marked; all are told here, past the index
                _, lead, inverse, counts = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
                told = (counts > 1).astype(np.int64)
                yield _rows(_PIECE, anchors[lead], whole[lead], at[lead], twin[lead], start[lead], n[lead], off[lead], told)
                again = np.flatnonzero(counts[inverse] > 1)
                if len(again):
                    yield _rows(_PIECE, by_document(at[again], twin[again]), whole[again], at[again], twin[again], start[again], n[again], np.full(len(again), -1), np.ones(len(again)))

    return run


def _match_pieces(hot: int):
    """Rows sorted by anchor hash and piece hash -> pieces that occur twice, and one of each that must be compared."""

    def settle(c: list[np.ndarray], always_hot: bool) -> Iterator[pa.RecordBatch]:
        key, check, at, twin, start, n, off, told = c
        begin = np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])])
        group = np.cumsum(begin) - 1
        several = np.bincount(group) > 1
        full = (several[group]) & (told == 0)
        if full.any():
            yield _rows(_JUDGED, at[full], twin[full], np.full(full.sum(), REPEATED), key[full], start[full], n[full], off[full])
        rep = np.flatnonzero(begin)
        of = np.cumsum(np.concatenate([[True], key[rep][1:] != key[rep][:-1]])) - 1
        kinds = np.bincount(of)[of]
        go = (kinds > 1) | always_hot
        if go.any():
            rep, kind = rep[go], np.where((kinds[go] > hot) | always_hot, HOT_OPEN, OPEN)
            yield _rows(_JUDGED, at[rep], twin[rep], kind, key[rep], start[rep], n[rep], off[rep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, is_hot = None, False  # rows of a key that may go on; whether its earlier rows were settled as hot
        for batch in batches:
            c = _numbers(batch)
            if not len(c[0]):
                continue
            past = c[6] < 0
            if past.any():
                yield _rows(_JUDGED, c[2][past], c[3][past], np.zeros(past.sum()), c[0][past], c[4][past], c[5][past], c[6][past])
                c = [x[~past] for x in c]
                if not len(c[0]):
                    continue
            if held is not None:
                c = [np.concatenate([a, b]) for a, b in zip(held, c, strict=True)]
            cut = int(np.searchsorted(c[0], c[0][-1]))
            if is_hot and cut:
                end = int(np.searchsorted(c[0], c[0][0], "right"))
                yield from settle([x[:end] for x in c], True)
                c, cut, is_hot = [x[end:] for x in c], cut - end, False
            if cut:
                yield from settle([x[:cut] for x in c], False)
                c = [x[cut:] for x in c]
            held = c
            if len(c[0]) > 4 * hot:
                # settle all but the last piece of the key, of which one row stays to meet the rest
                end = int(np.flatnonzero(c[1] != c[1][-1])[-1] + 1) if (c[1] != c[1][-1]).any() else 0
                if end:
                    yield from settle([x[:end] for x in c], True)
                    c, is_hot = [x[end:] for x in c], True
                if len(c[0]) > 1:
                    full = c[7] == 0
                    if full.any():
                        yield _rows(_JUDGED, c[2][full], c[3][full], np.zeros(full.sum()), c[0][full], c[4][full], c[5][full], c[6][full])
                    c = [x[:1].copy() for x in c]
                    c[7][:] = 1
                    # a second row of the piece would be needed for it to count as repeated later: keep it twice
                    c = [np.concatenate([x, x]) for x in c]
                held = c
        if held is not None:
            yield from settle(held, is_hot)

    return run


def _find_texts(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in text_blocks(batch, "text"):
                doc, had = _ragged(rows, "had")
                at, twin = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("at", "twin"))
                first, n, kind = offsets[doc] + had["start"], had["n"], had["kind"]
                gone = np.zeros(len(data) + 1, np.int32)
                full = kind == REPEATED
                np.add.at(gone, first[full], 1)
                np.add.at(gone, (first + n + window - 1)[full], -1)
                gone = np.cumsum(gone[:-1]) > 0
                k = np.flatnonzero(kind == OPEN)
                raw = data.tobytes()
                if len(k):
                    content = [raw[a:b] for a, b in zip(first[k].tolist(), (first + n + window - 1)[k].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(had["key"][k]), pa.array(content, pa.binary()), pa.array(at[doc[k]]), pa.array(twin[doc[k]]), pa.array(had["start"][k]), pa.array(n[k]), pa.array(had["off"][k])], schema=_TEXT)
                h = kind == HOT_OPEN
                if h.any():
                    count = n[h]
                    places = np.repeat(first[h], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    one, two = (spans_hashed(gram_hashes(data, w), places, window, w) for w in (0, 1))
                    of = np.searchsorted(offsets, places, "right") - 1
                    order = np.lexsort((two, one))
                    same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
                    begin = np.concatenate([[True], ~same])
                    several = np.zeros(len(order), bool)
                    several[order[1:][same]] = True
                    several[order[:-1][same]] = True
                    edge = np.zeros(len(data) + 1, np.int32)
                    np.add.at(edge, places[several], 1)
                    np.add.at(edge, places[several] + window, -1)
                    gone |= np.cumsum(edge[:-1]) > 0
                    lead = order[begin]
                    yield pa.RecordBatch.from_arrays([pa.array(one[lead].view(np.int64)), pa.nulls(len(lead), pa.binary()), pa.array(at[of[lead]]), pa.array(twin[of[lead]]), pa.array(places[lead] - offsets[of[lead]]), pa.array(two[lead].view(np.int64)), pa.array(-1 - several[lead].astype(np.int64))], schema=_TEXT)
                a, b = _runs_of(gone, offsets)
                if len(a):
                    of = np.searchsorted(offsets, a, "right") - 1
                    yield pa.RecordBatch.from_arrays([pa.array(by_document(at[of], twin[of]).view(np.int64)), pa.nulls(len(a), pa.binary()), pa.array(at[of]), pa.array(twin[of]), pa.array(a - offsets[of]), pa.array(b - a), pa.array(np.full(len(a), -3))], schema=_TEXT)

    return run


def _match_texts(window: int, together: int, batch_size: int):
    """Rows sorted by key -> spans of repeated bytes."""

    def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        levels = SuffixLevels(window)
        for at in range(0, len(rows), batch_size):
            own = rows[at : at + batch_size]
            levels.add([r[0] for r in own], [r[1] for r in own], [r[6] for r in own], [r[5] for r in own])
        out = []
        for r, flags in zip(rows, levels.finish(), strict=True):
            if flags.any():
                a, b = _runs_of(flags, np.zeros(0, np.int64))
                out += [(r[2], r[3], 0, r[4] + int(x), int(y - x) + window - 1) for x, y in zip(a, b, strict=True)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=_SPAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held = RunIndex(5), []
        for batch in batches:
            off = batch.column(6).to_numpy(zero_copy_only=False)
            key, at, twin, start, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2, 3, 4, 5))
            past = off == -3
            if past.any():
                yield _rows(_SPAN, at[past], twin[past], np.zeros(past.sum()), start[past], n[past])
            single = (off == -1) | (off == -2)
            if single.any():
                yield from _match_windows(index, window, *(x[single] for x in (key, n, at, twin, start, off)))
            for r in batch.filter(pa.array(off >= 0)).to_pylist():
                row = tuple(r.values())
                # groups are whole: none is open when the next begins
                if len(held) >= together and held[-1][0] != row[0]:
                    yield from settle(held)
                    held = []
                held.append(row)
        if held:
            yield from settle(held)

    return run


def _match_windows(index: RunIndex, window: int, key, check, at, twin, start, off) -> Iterator[pa.RecordBatch]:
    """Windows by their own hash: all that have been seen twice are repeated, the first of them too."""
    told = off == -2
    run, place = index.find(key)
    rows = index.rows(run, place)
    known = (run >= 0) & (rows[:, 3] == check)
    lead = np.zeros(len(key), np.int64)
    order = np.lexsort((np.arange(len(key)), key))
    begin = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    lead[order] = order[np.maximum.accumulate(np.where(begin, np.arange(len(order)), 0))]
    other = (lead != np.arange(len(key))) & (check[lead] == check)
    several = known | other
    several[lead[other]] = True
    out = several & ~told
    if out.any():
        yield _rows(_SPAN, at[out], twin[out], np.zeros(out.sum()), start[out], np.full(out.sum(), window))
    old = np.flatnonzero(known & (lead == np.arange(len(key))) & (rows[:, 4] == 0))
    if len(old):
        yield _rows(_SPAN, rows[old, 0], rows[old, 1], np.zeros(len(old)), rows[old, 2], np.full(len(old), window))
        index.put(run[old], place[old], 4, 1)
    fresh = np.flatnonzero((lead == np.arange(len(key))) & (run < 0))
    index.add(key[fresh], np.stack([at[fresh], twin[fresh], start[fresh], check[fresh], (told | several)[fresh].astype(np.int64)], 1))


def _keep_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, offsets, data in text_blocks(batch, "text"):
            doc, had = _ragged(rows, "had")
            edge = np.zeros(len(data) + 1, np.int32)
            np.add.at(edge, offsets[doc] + had["start"], 1)
            np.add.at(edge, offsets[doc] + had["start"] + had["n"], -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[offsets])
            a, _ = _runs_of(gone, offsets)
            spans = np.bincount(np.searchsorted(offsets, a, "right") - 1, minlength=len(offsets) - 1)
            kept, ends = data[~gone].tobytes(), np.cumsum(np.concatenate([[0], np.diff(offsets) - removed]))
            texts = [kept[x:y] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans), pa.array(texts, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, hot: int = HOT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (runs removed) and kept (the bytes that stay) of every row.

    The texts are shuffled once; the three passes over them read the same shuffle.
    """
    own = documents(docs, doc_id, text)
    found = own.mapInArrow(_find_pieces(window), PIECE)
    judged = found.repartition("key").sortWithinPartitions("key", "check").mapInArrow(_match_pieces(hot), JUDGED)
    open_docs = judged.groupBy("at", "twin").agg(F.collect_list(F.struct("kind", "key", "start", "n", "off")).alias("had"))
    texts = own.join(open_docs, ["at", "twin"]).select("id", "at", "twin", "text", "had").mapInArrow(_find_texts(window), TEXT)
    spans = texts.repartition("key").sortWithinPartitions("key").mapInArrow(_match_texts(window, TOGETHER, BATCH), SPAN)
    spans = spans.groupBy("at", "twin").agg(F.collect_list(F.struct("start", "n")).alias("had"))
    return own.join(spans, ["at", "twin"], "left").select("id", "at", "twin", "text", "had").mapInArrow(_keep_bytes, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op3_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[tuple[int, str | None]], window: int = WINDOW) -> dict[int, tuple[int, int, int, str]]:
    """doc -> n_bytes, n_removed, n_spans, kept_sha256, by counting every window."""
    from collections import Counter

    raw = [(d, (t or "").encode()) for d, t in texts]
    counts = Counter(hash(t[k : k + window]) for _, t in raw for k in range(len(t) - window + 1))
    out = {}
    for d, t in raw:
        gone = np.zeros(len(t) + 1, np.int64)
        for k in range(len(t) - window + 1):
            if counts[hash(t[k : k + window])] > 1:
                gone[k] += 1
                gone[k + window] -= 1
        flags = np.cumsum(gone)[:-1] > 0
        kept = np.frombuffer(t, np.uint8)[~flags].tobytes()
        spans = int((np.diff(np.concatenate([[0], flags.astype(np.int8)])) == 1).sum())
        out[d] = len(t), int(flags.sum()), spans, hashlib.sha256(kept).hexdigest()
    return out

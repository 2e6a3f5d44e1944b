"""Benchmark decontamination with an FM-index per training shard.

A shard is a stretch of one partition's documents. Words become symbols of the benchmark's own vocabulary; a word that
no benchmark item uses can be in no occurrence, so it only separates. Runs too short for any window are left out, which
loses nothing. Over the rest a shard builds a suffix array, its Burrows-Wheeler transform in a wavelet matrix and a
sample of suffix positions; every test window is searched backward, its occurrences are located by walking to the next
sampled position, and the spans are merged per document.

Defined results: a null text or one without a word has 0 words and no hit; a null item text gives no window; an item
with a null id still marks words but is in no item list; repeated rows are each answered; an empty benchmark hits
nothing; columns of `docs` other than the text stay as they are, also when named like the operator's own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, map_lean, raw_texts, table, words_alnum

#: Words of a window.
WINDOW = 10
#: Symbols of one shard's FM-index, which bounds its memory (about 100 bytes a symbol while it is built).
SHARD_SYMBOLS = 1 << 18
#: A suffix position in this many is kept.
SAMPLE_EVERY = 8
#: Bytes of benchmark text sent to the executors at once; a larger benchmark is searched block by block.
BENCHMARK_BLOCK = 16 << 20

SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by prefix doubling."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.zeros(n, np.int64)
    step = 1
    values = symbols[order].astype(np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(values[1:] != values[:-1])])
    while n and rank[order[-1]] < n - 1 and step < n:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        step *= 2
    return order


class WaveletMatrix:
    """Rank of any symbol before any place, one bit vector a level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit) & 1
            counts = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(ones, out=counts[1:])
            self.levels.append((bit, counts, len(symbols) - int(counts[-1])))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        first, place = np.zeros_like(place), place.copy()
        for bit, counts, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            a, b = counts[first], counts[place]
            first = np.where(one, zeros + a, first - a)
            place = np.where(one, zeros + b, place - b)
        return place - first


class FMIndex:
    """Backward search over a sequence of symbols from 1 to `top`; 0 separates."""

    def __init__(self, symbols: np.ndarray, top: int, every: int = SAMPLE_EVERY):
        text = np.concatenate([symbols.astype(np.int64) + 1, [0]])  # 0 ends the text and sorts first
        order = suffix_array(text)
        self.last = text[order - 1]
        self.wavelet = WaveletMatrix(self.last, max(1, int(top + 1).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 2))])
        kept = order % every == 0
        self.kept = kept
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.sample = order[kept]
        self.size = len(text)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of patterns of one length (a row each), all at once."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.size, np.int64)
        for j in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[:, j].astype(np.int64) + 1
            lo = self.before[symbol] + self.wavelet.rank(symbol, lo)
            hi = self.before[symbol] + self.wavelet.rank(symbol, hi)
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of index rows: step back through the text until a sampled row."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        going = np.flatnonzero(~self.kept[rows])
        while len(going):
            symbol = self.last[rows[going]]
            rows[going] = self.before[symbol] + self.wavelet.rank(symbol, rows[going])
            steps[going] += 1
            going = going[~self.kept[rows[going]]]
        return self.sample[self.kept_before[rows]] + steps


class Windows:
    """The distinct windows of some benchmark items, by length, with the items of each."""

    def __init__(self, items: list[tuple[object, str | None]], size: int):
        self.codes: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = words_alnum((text or "").encode())
            codes = [self.codes.setdefault(w, len(self.codes) + 1) for w in words]
            for k in range(max(1, len(codes) - size + 1) if codes else 0):
                found.setdefault(tuple(codes[k : k + size]), set()).update([] if item is None else [str(item)])
        self.by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        for length in sorted({len(w) for w in found}):
            own = sorted(w for w in found if len(w) == length)
            self.by_length[length] = np.array(own, np.int64), [sorted(found[w]) for w in own]
        self.shortest = min(self.by_length, default=0)


def _runs(codes: np.ndarray, shortest: int) -> list[tuple[int, int]]:
    inside = np.concatenate([[False], codes > 0, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    keep = ends - starts >= shortest
    return list(zip(starts[keep].tolist(), ends[keep].tolist(), strict=True))


def _search_shard(windows: Windows, runs: list[tuple[int, int, np.ndarray]]) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
    """Hits of the runs (document, first word, symbols): document -> spans of words, items."""
    lengths = np.array([len(r[2]) + 1 for r in runs])
    symbols = np.concatenate([np.concatenate([r[2], [0]]) for r in runs])
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    index = FMIndex(symbols, len(windows.codes))
    hits: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
    for length, (patterns, items) in windows.by_length.items():
        lo, hi = index.search(patterns)
        found = np.flatnonzero(hi > lo)
        if not len(found):
            continue
        counts = (hi - lo)[found]
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo[found], counts)
        places = index.locate(rows)
        run = np.searchsorted(starts, places, "right") - 1
        for which, r, place in zip(np.repeat(found, counts).tolist(), run.tolist(), (places - starts[run]).tolist(), strict=True):
            document, first, _ = runs[r]
            spans, ids = hits.setdefault(document, ([], set()))
            spans.append((first + place, first + place + length))
            ids.update(items[which])
    return hits


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, then: Callable | None = None, schema: T.StructType | None = None) -> tuple[DataFrame, str, str, str]:
    """`docs` with three columns more, and their names: word count, merged spans of hit words, ids of items found.

    `then(spans)`, if given, makes a function over the batches of the last pass, run in the same Python worker, and
    `schema` is what it yields.

    No shuffle: each pass keeps the rows where they are. The benchmark goes to the executors in blocks of a bounded
    size, one pass a block.
    """
    own = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text"))
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = 1 + size // BENCHMARK_BLOCK
    n_words, spans, items = (fresh(docs.columns, c) for c in ("fm_words", "fm_spans", "fm_items"))
    out = docs.select("*", F.lit(0).cast("long").alias(n_words), F.array().cast(SPAN).alias(spans), F.array().cast("array<string>").alias(items))
    for b in range(blocks):
        rows = own.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect() if blocks > 1 else own.collect()
        step = _pass([(r["id"], r["text"]) for r in rows], window, text, n_words, spans, items)
        if then and b == blocks - 1:
            out = map_lean(out, lambda batches, step=step, last=then(spans): last(step(batches)), schema)
        else:
            out = map_lean(out, step, out.schema)
    return out, n_words, spans, items


def _pass(rows: list, window: int, text: str, n_words: str, spans: str, items: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(rows, window)
        code = windows.codes.get
        for batch in batches:
            hits: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
            counts, held, symbols = [], [], 0
            for k, raw in enumerate(raw_texts(batch.column(text))):
                words = words_alnum(raw)
                counts.append(len(words))
                if not windows.shortest or len(words) < windows.shortest:
                    continue
                codes = np.fromiter((code(w, 0) for w in words), np.int32, len(words))
                for a, b in _runs(codes, windows.shortest):
                    held.append((k, a, codes[a:b]))
                    symbols += b - a + 1
                if symbols >= SHARD_SYMBOLS:
                    _gather(hits, _search_shard(windows, held))
                    held, symbols = [], 0
            if held:
                _gather(hits, _search_shard(windows, held))
            old = [[(x["start"], x["end"]) for x in s or []] for s in batch.column(spans).to_pylist()]
            kept = batch.column(items).to_pylist()
            new_spans = [merged(s + hits[k][0]) if k in hits else s for k, s in enumerate(old)]
            new_items = [sorted({*(i or []), *hits[k][1]}) if k in hits else i for k, i in enumerate(kept)]
            put = {
                n_words: pa.array(counts, pa.int64()),
                spans: pa.array([[{"start": a, "end": b} for a, b in s] for s in new_spans], batch.schema.field(spans).type),
                items: pa.array(new_items, batch.schema.field(items).type),
            }
            yield pa.RecordBatch.from_arrays([put.get(f.name, batch.column(k)) for k, f in enumerate(batch.schema)], schema=batch.schema)

    return run


def _gather(into: dict, more: dict) -> None:
    for k, (spans, ids) in more.items():
        a, b = into.setdefault(k, ([], set()))
        a.extend(spans)
        b.update(ids)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` (with doc_id, text, n_chars) without the words of benchmark windows; same columns and rows.

    The bytes from the first to past the last word of a span go, with the separators between them. `n_chars` follows
    the text. A document without a hit is unchanged.
    """
    columns = docs.columns

    def cutting(spans: str):
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text").to_pylist()
                chars = batch.column("n_chars").to_pylist() if "n_chars" in columns else [None] * len(texts)
                for k, cuts in enumerate(batch.column(spans).to_pylist()):
                    if cuts:
                        texts[k] = cut_words(texts[k], [(c["start"], c["end"]) for c in cuts])
                        chars[k] = len(texts[k])
                put = {"text": texts, "n_chars": chars}
                arrays = [pa.array(put[c], batch.schema.field(c).type) if c in put else batch.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema([batch.schema.field(c) for c in columns]))

        return cut

    return find_contamination(docs, benchmark, window=window, then=cutting, schema=docs.schema)[0]


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the stretches from the first to the last word of each span."""
    from .common import FOLD_ALNUM

    raw = text.encode()
    folded = raw.translate(FOLD_ALNUM)
    inside = np.concatenate([[False], np.frombuffer(folded, np.uint8) != 0x20, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : starts[a]])
        at = ends[b - 1]
    return b"".join([*out, raw[at:]]).decode()


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, n_words, spans, items = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    ids = F.array_sort(F.array_distinct(items))
    return found.select(
        "doc_id",
        F.col(n_words).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def brute_force(documents: list[tuple[int, str | None]], items: list[tuple[object, str | None]], window: int = WINDOW) -> dict:
    """What op1 returns, by looking for every window at every place: doc -> (n_words, n_hit, n_items, sha256)."""
    out = {}
    bench = [(i, words_alnum((t or "").encode())) for i, t in items]
    for doc, text in documents:
        words = words_alnum((text or "").encode())
        hit, ids = set(), set()
        for item, own in bench:
            for k in range(max(1, len(own) - window + 1) if own else 0):
                w = own[k : k + window]
                for p in range(len(words) - len(w) + 1):
                    if words[p : p + len(w)] == w:
                        hit.update(range(p, p + len(w)))
                        ids.add(str(item))
        joined = ",".join(sorted(ids))
        out[doc] = len(words), len(hit), len(ids), hashlib.sha256(joined.encode()).hexdigest()
    return out

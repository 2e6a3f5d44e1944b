"""Alignment of two tokenizers over the same bytes, by a string of one label per byte.

Each byte of a text is labelled: no token ends here, one of A does, one of B does, or both do. A regular expression scans
the labels for spans that run up to a both-label; the labels counted within a span say how many tokens of A and of B
make up its group. Every end within a span is one link: the pair of tokens that cover the byte there.

Both tokenizers start anew at a single space or line feed between two visible characters, so a both-label stands before
each of these, and the spans of such a chunk are scanned once and remembered. Other texts are scanned whole.

How often a pair of ids is linked is counted over all documents: each document's distinct pairs are stored once, tasks
add them up before they are shuffled, and the counts go back to the documents. The counts of the most frequent pairs, of a
bounded number, travel with the tasks; all others come by a join, so no key of that join is frequent.

Defined results: a text that is null, empty, or that either tokenizer does not give back byte by byte has no tokens: all
its figures are 0 and its groups ''. Rows with a null or repeated doc_id are rows of their own, and all of them count. An
empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FORGET, map_lean, table
from .components import stored

#: Labels of a byte.
NONE, A_END, B_END, BOTH = b".abx"
_SPAN = re.compile(rb"[^x]*x")
#: Fixed value: how byte-level vocabularies split a text before they merge.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Chunks of each of two generations that are remembered in a worker, about 500 bytes each, and the longest of them.
REMEMBERED, LONG = 150_000, 64
#: Characters of the texts that are aligned at a time.
TOGETHER = 1 << 20
#: Pairs whose counts travel with each task, 17 bytes each.
CARRIED = 1 << 18
#: Distinct pairs that a task holds before it hands their counts on, 16 bytes each.
HELD = 1 << 20
#: Rows of one task; more would need more than 2^33 documents in it.
PER_PARTITION = 1 << 33

ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"


class Spans(NamedTuple):
    """Groups and links of a stretch of text that starts and ends at a both-label, and its counts (see counted)."""

    groups: str
    links: bytes
    counts: int


#: What stands for a chunk that a tokenizer does not give back.
LOST = Spans("", b"", 0)
#: Bits of each of the three numbers in Spans.counts, so that one sum adds all three up.
WIDE = 40


def counted(spans: int) -> tuple[int, int, int]:
    """Tokens of A, tokens of B and groups."""
    low = (1 << WIDE) - 1
    return spans & low, spans >> WIDE & low, spans >> 2 * WIDE


class Vocabulary:
    """Bytes of each id, and its decimal form before another id of its group and at the end of it."""

    def __init__(self, entries: list[bytes], last: str):
        self.bytes = entries
        self.sizes = np.array(list(map(len, entries)))
        self.shown = np.array([f"{k}{end}" for k in range(len(entries)) for end in (",", last)], object)
        self.widths = np.array(list(map(len, self.shown)))


def label(ends_a: np.ndarray, ends_b: np.ndarray) -> bytes:
    """One label per byte; both arrays rise and end at the same byte."""
    kinds = np.zeros(ends_a[-1], np.uint8)
    kinds[ends_a - 1] = 1
    kinds[ends_b - 1] += 2
    return np.array([NONE, A_END, B_END, BOTH], np.uint8)[kinds].tobytes()


def scan(a: Vocabulary, b: Vocabulary, ids_a: np.ndarray, ids_b: np.ndarray, labels: bytes, upto_a: np.ndarray, upto_b: np.ndarray) -> list[Spans]:
    """Spans of stretches that end after so many tokens of A and of B, from their labels one after another."""
    marks = labels.translate(None, bytes([NONE]))
    spans = _SPAN.findall(marks)
    of_a = np.fromiter((s.count(A_END) for s in spans), np.int64, len(spans)) + 1
    of_b = np.fromiter(map(len, spans), np.int64, len(spans)) + 1 - of_a
    # the tokens that cover a byte where one ends: all before them have ended
    seen = np.frombuffer(marks, np.uint8)
    ends_a, ends_b = seen != B_END, seen != A_END
    links = (ids_a[np.cumsum(ends_a) - ends_a] << 32 | ids_b[np.cumsum(ends_b) - ends_b]).tobytes()
    # in each group its ids of A, then its ids of B, the last of either kind closed by another mark
    total_a, total_b = np.cumsum(of_a), np.cumsum(of_b)
    group_a, group_b = np.repeat(np.arange(len(spans)), of_a), np.repeat(np.arange(len(spans)), of_b)
    last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    last_a[total_a - 1] = last_b[total_b - 1] = 1
    shown, widths = np.empty(len(ids_a) + len(ids_b), object), np.empty(len(ids_a) + len(ids_b), np.int64)
    for own, ids, last, at in ((a, ids_a, last_a, np.arange(len(ids_a)) + (total_b - of_b)[group_a]), (b, ids_b, last_b, np.arange(len(ids_b)) + total_a[group_b])):
        shown[at], widths[at] = own.shown[2 * ids + last], own.widths[2 * ids + last]
    text = "".join(shown.tolist())
    cuts = np.cumsum(widths)[upto_a + upto_b - 1].tolist()
    n_groups = np.searchsorted(total_a, upto_a) + 1
    n_links = (8 * (upto_a + upto_b - n_groups)).tolist()
    counts = [np.diff(n, prepend=0).tolist() for n in (upto_a, upto_b, n_groups)]
    return [Spans(text[at : to - 1], links[low:high], x | y << WIDE | z << 2 * WIDE) for at, to, low, high, x, y, z in zip([0, *cuts], cuts, [0, *n_links], n_links, *counts, strict=False)]


class Aligner:
    """The spans of whole texts under a byte-level BPE (A, over space and text) and a piece model (B, which adds the space)."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        byte = _byte_level()
        size = self.a.get_vocab_size()
        entries = [bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode() for entry in map(self.a.id_to_token, range(size))]
        pieces = [self._piece_bytes(k) for k in range(self.b.get_piece_size())]
        self.of_a, self.of_b = Vocabulary(entries, "|"), Vocabulary(pieces, ";")
        self.space = self.b.piece_to_id("▁")
        self.ranked = _ranked(path_a, self.a, entries)
        # B starts anew at a space or line feed if no piece holds one after another character
        inner = any(b" " in p.lstrip(b" ") or b"\n" in p and len(p) > 1 for p in pieces)
        self.chunked = not inner and self.a.normalizer is None and self.whole("ﬁ é Å x\ny") is not LOST
        self.recent: dict[str, Spans] = {}
        self.older: dict[str, Spans] = {}

    def _piece_bytes(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()

    def _ids_a(self, text: str) -> list[int]:
        if self.ranked is not None and len(text) <= LONG:
            return self.ranked.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def _spans(self, ids_a: list[list[int]], ids_b: list[list[int]], texts: list[bytes]) -> list[Spans]:
        flat_a, flat_b = list(chain.from_iterable(ids_a)), list(chain.from_iterable(ids_b))
        whole = b"".join(texts)
        if b"".join(map(self.of_a.bytes.__getitem__, flat_a)) == whole == b"".join(map(self.of_b.bytes.__getitem__, flat_b)):
            flat_a, flat_b = np.array(flat_a, np.int64), np.array(flat_b, np.int64)
            ends_a, ends_b = np.cumsum(self.of_a.sizes[flat_a]), np.cumsum(self.of_b.sizes[flat_b])
            upto_a, upto_b = (np.cumsum(list(map(len, ids))) for ids in (ids_a, ids_b))
            cuts = np.cumsum(list(map(len, texts)))
            if np.array_equal(ends_a[upto_a - 1], cuts) and np.array_equal(ends_b[upto_b - 1], cuts):
                return scan(self.of_a, self.of_b, flat_a, flat_b, label(ends_a, ends_b), upto_a, upto_b)
        if len(texts) == 1:
            return [LOST]
        return [s for one in zip(ids_a, ids_b, texts, strict=True) for s in self._spans(*([x] for x in one))]

    def whole(self, text: str) -> Spans:
        return self._spans([self.a.encode(" " + text, add_special_tokens=False).ids], [self.b.encode(text)], [(" " + text).encode()])[0]

    def _learn(self, chunks: list[str]) -> None:
        """Spans of words after a space, and of those that bring their line feed along."""
        ids_b = [ids[1:] if c[0] == "\n" and ids[:1] == [self.space] else ids for c, ids in zip(chunks, self.b.encode(chunks), strict=True)]
        texts = [c if c[0] == "\n" else " " + c for c in chunks]
        self.recent.update(zip(chunks, self._spans(list(map(self._ids_a, texts)), ids_b, [t.encode() for t in texts]), strict=True))

    def _chunks(self, text: str) -> list[str] | None:
        if not self.chunked or text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return None
        if not all(map(str.isprintable, text.split("\n"))):
            return None
        return text.replace("\n", " \n").split(" ")

    def __call__(self, texts: list[str | None]) -> list[list[Spans]]:
        """Spans of each text, one after another; an empty list if a tokenizer does not give the text back."""
        if len(self.recent) >= REMEMBERED:
            self.older, self.recent = self.recent, {}
        cut = [self._chunks(t) if t else [] for t in texts]
        new = set(chain.from_iterable(c for c in cut if c)).difference(self.recent)
        again = new.intersection(self.older)
        self.recent.update((c, self.older[c]) for c in again)
        if again != new:
            self._learn(sorted(new - again))
        out = []
        for text, chunks in zip(texts, cut, strict=True):
            spans = None if chunks is None else [self.recent[c] for c in chunks]
            if spans is None or LOST in spans:
                got = self.whole(text)
                spans = [] if got is LOST else [got]
            out.append(spans)
        for c in new:
            if len(c) > LONG:
                del self.recent[c]
        return out


def _ranked(path: str, tokenizer, entries: list[bytes]):
    """The same encoding by ranks, which is quicker on words: where the ids rank the merges, and the text is split as below."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, split = told["model"], told["pre_tokenizer"] or {}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", ())]
    made = [model["vocab"].get("".join(m), -1) for m in merges] if model.get("type", "BPE") == "BPE" else [-1]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and tokenizer.normalizer is None
    if not plain or min(made, default=-1) < 0 or made != sorted(made) or model.get("dropout") or model.get("ignore_merges"):
        return None
    special = {t["id"] for t in told.get("added_tokens", ())}
    return tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks={b: k for k, b in enumerate(entries) if k not in special}, special_tokens={})


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible Latin-1 characters for themselves, the
    others, in order, for the characters from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(rest)}


_ALIGNERS: dict[tuple[str, str], Aligner] = {}
FORGET.append(_ALIGNERS.clear)


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _together(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str | None]]]:
    """Keys and texts of a batch, a bounded number of characters at a time; a longer text is alone."""
    keys, texts, size = [], [], 0
    for k in range(batch.num_rows):
        text = batch.column(1)[k].as_py()
        if size + len(text or "") > TOGETHER and texts:
            yield keys, texts
            keys, texts, size = [], [], 0
        keys.append(batch.column(0)[k].as_py())
        texts.append(text)
        size += len(text or "")
    if texts:
        yield keys, texts


def aligned(docs: DataFrame, paths: tuple[str, str] | None = None, doc_id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """A row per document, numbered by `row`: counts of tokens, groups and links, the groups as text (`a1,a2|b1;a3|b2`; with `digest` its SHA-256),
    and each distinct pair of linked ids (A's shifted left by 32, or B's) with the number of its links."""
    path_a, path_b = paths or vocabularies()
    kinds = pa.schema([*((n, pa.int64()) for n in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")), ("groups", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, row = aligner(path_a, path_b), TaskContext.get().partitionId() * PER_PARTITION
        for batch in batches:
            for keys, texts in _together(batch):
                rows, codes, counts = [], [], []
                for key, spans in zip(keys, align(texts), strict=True):
                    own_groups, own_links, own_counts = zip(*spans, strict=True) if spans else ((), (), ())
                    groups, links, (n_a, n_b, n_groups) = ";".join(own_groups), np.frombuffer(b"".join(own_links), np.int64), counted(sum(own_counts))
                    pairs, times = np.unique(links, return_counts=True)
                    codes.append(pairs)
                    counts.append(times)
                    rows.append((row, key, n_a, n_b, n_groups, len(links), hashlib.sha256(groups.encode()).hexdigest() if digest and spans else groups))
                    row += 1
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x).astype(kind))) for x, kind in ((codes, np.int64), (counts, np.int32))]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=False)), *lists], schema=kinds)

    return map_lean(docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")), run, ALIGNED)


def pair_counts(documents: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, n, best): links of each pair of ids in all documents, and the highest number that its B id has
    with any A id. Sums are made in each task before the shuffle."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        more: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            codes, where = np.unique(np.concatenate([held, *(m[0] for m in more)]), return_inverse=True)
            return codes, np.bincount(where, np.concatenate([n, *(m[1] for m in more)]), len(codes)).astype(np.int64)

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held), pa.array(n)], names=["pair", "n"])

        for batch in batches:
            more.append((batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy().astype(np.int64)))
            waiting += len(more[-1][0])
            if waiting > HELD:
                held, n = merged()
                more, waiting = [], 0
                if len(held) > HELD:
                    yield told()
                    held, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held, n = merged()
        yield told()

    sums = map_lean(documents.select("pairs", "times"), add_up, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    sums = sums.select("pair", F.shiftright("pair", 32).cast("int").alias("a_id"), F.expr("cast(pair & 4294967295 as int)").alias("b_id"), "n")
    return sums.join(sums.groupBy("b_id").agg(F.max("n").alias("best")), "b_id").select("pair", "a_id", "b_id", "n", "best")


def most_linked(pairs: DataFrame, most: int = CARRIED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rising), counts and flags of the best for the pairs above a count that at most `most` pairs reach.

    The count is read off a histogram of eight steps to each doubling, so no rows are sorted and at most `most` come to the
    driver.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    least, total = None, 0
    for r in sorted(pairs.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        total += r["count"]
        if total > most:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    got = pairs.where(step >= least).select("pair", "n", (F.col("n") == F.col("best")).alias("top")).toArrow()
    codes = got.column("pair").to_numpy()
    order = np.argsort(codes)
    return codes[order], got.column("n").to_numpy()[order], got.column("top").to_numpy()[order]


def scored(documents: DataFrame, pairs: DataFrame, most: int = CARRIED) -> DataFrame:
    """Rows of `aligned` without their pairs, with n_best (links whose pair is the most frequent of its B id) and count_sum
    (their pairs' counts, over all links). `documents` and `pairs` should be stored tables, as both are read twice."""
    codes, n, top = most_linked(pairs, most)
    own = [f.name for f in documents.schema if f.name not in ("pairs", "times")]
    long = pa.int64()

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            found, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            of = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(codes, found), max(len(codes) - 1, 0))
            known = codes[at] == found if len(codes) else np.zeros(len(found), bool)
            best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, of[known], n[at[known]] * times[known])
            np.add.at(best, of[known], top[at[known]] * times[known])
            rest = np.concatenate([[0], np.cumsum(np.bincount(of[~known], minlength=batch.num_rows))]).astype(np.int32)
            others = [pa.ListArray.from_arrays(pa.array(rest), pa.array(v[~known])) for v in (found, times)]
            arrays = [*(batch.column(c) for c in own), pa.array(best, long), pa.array(total, long), *others]
            yield pa.RecordBatch.from_arrays(arrays, names=[*own, "n_best", "count_sum", "other", "other_times"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in documents.schema if f.name in own)
    made = map_lean(documents, look_up, f"{kinds}, n_best long, count_sum long, other array<long>, other_times array<long>")
    others = made.where(F.size("other") > 0).select("row", F.explode(F.arrays_zip("other", "other_times")).alias("o")).select("row", F.col("o.other").alias("pair"), F.col("o.other_times").alias("times"))
    sums = others.join(pairs.select("pair", "n", "best"), "pair").groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more"))
    made = made.drop("other", "other_times").join(sums, "row", "left")
    return made.select(*own, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = stored(aligned(table(spark, sf_dir, "documents"), digest=True))
    pairs = stored(pair_counts(documents))
    return scored(documents, pairs).drop("row").withColumnRenamed("groups", "groups_sha256")


def brute_force(texts: list[str | None], paths: tuple[str, str] | None = None) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text, from whole texts and all pairs of tokens."""
    from collections import Counter

    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    path_a, path_b = paths or vocabularies()
    a, b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    byte = _byte_level()
    found = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        encoded = a.encode(" " + text, add_special_tokens=False) if text else None
        own_a = [(k, bytes(byte[c] for c in t)) for k, t in zip(encoded.ids, encoded.tokens, strict=True)] if text else []
        own_b = [(k, bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()) for k in (b.encode(text) if text else [])]
        if b"".join(t for _, t in own_a) != whole or b"".join(t for _, t in own_b) != whole:
            own_a = own_b = []
        # which token of each covers each byte, and where both end
        over = [[k for k, (_, t) in enumerate(own) for _ in t] for own in (own_a, own_b)]
        links = [(own_a[x][0], own_b[y][0]) for x, y in sorted(set(zip(*over, strict=True)))]
        cuts = [0, *(k + 1 for k in range(len(over[0])) if all(k + 1 == len(o) or o[k] != o[k + 1] for o in over))]
        groups = ["|".join(",".join(str(own[k][0]) for k in range(o[low], o[high - 1] + 1)) for own, o in zip((own_a, own_b), over, strict=True)) for low, high in zip(cuts, cuts[1:], strict=False)]
        found.append((len(own_a), len(own_b), groups, links))
    counts = Counter(link for f in found for link in f[3])
    best: dict[int, int] = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [(n_a, n_b, len(g), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for n_a, n_b, g, links in found]

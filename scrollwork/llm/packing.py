"""Best-fit decreasing packing of tokenised documents into fixed windows.

Every document is tokenised whole and ended by one id. A document of a window or more is cut into full windows first,
each a sequence of its own; what is left of the documents is packed, longest first, into the open sequence with the
least room that still holds it, found by a segment tree over remaining capacities. Packing is done within a
partition of the input: only lengths are held (16 bytes a document), so it needs no shuffle, and a lost task is redone
alone. Each partition may end with one sequence that is not full.

Defined results: a null or empty text is the one closing id; rows with a null or repeated doc_id are packed like any
other; equal lengths are taken in input order; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import FORGET, table

#: Tokens of a sequence.
LENGTH = 2048
#: The id that ends each document.
END = 1
#: Chunks of each of two generations whose ids are remembered in a worker, about 200 bytes each. A full generation takes
#: the place of the older one, from which what is met again is taken over.
REMEMBERED = 400_000
#: Sequence ids of one partition; more would need more than 2^33 sequences in a task.
PER_PARTITION = 1 << 33

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class CapacityTree:
    """Segment tree over remaining capacities 1..size: how many open bins have each; the tightest that fits is the
    leftmost non-empty leaf at or after a length."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, bin_id: int) -> None:
        if capacity <= 0:
            return
        self.bins[capacity].append(bin_id)
        node = capacity + self.leaves
        while node:
            self.count[node] += 1
            node //= 2

    def take(self, length: int) -> tuple[int, int] | None:
        """Removes and returns (capacity, bin) of the tightest bin with room for `length`."""
        node = length + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        while node:
            self.count[node] -= 1
            node //= 2
        return capacity, self.bins[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece (of 1 to `size`), and the number of bins."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, opened = CapacityTree(size), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[k])
        got = tree.take(length)
        if got is None:
            got = size, opened
            opened += 1
        room, b = got
        bins[k], offsets[k] = b, size - room
        tree.add(room - length, b)
    return bins, offsets, opened


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes, by a byte-level BPE that never merges across a single space or
    line feed between two other characters. Such chunks are remembered; a text with any other white space, or with one of
    the tokenizer's added tokens, is encoded in one go."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.strip() for t in added]
        # under a normaliser, text that is spelt otherwise can be such a token
        self.chunked = self.tokenizer.normalizer is None or not any(t.normalized for t in added)
        self.first, self.later = _Chunks(self.tokenizer, ""), _Chunks(self.tokenizer, " ")
        self.line = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not self.chunked or any(a in text for a in self.added):
            return self.whole(text)
        if not text.isprintable():
            lines = text.split("\n")
            if not all(map(str.isprintable, lines)):
                return self.whole(text)
        else:
            lines = [text]
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] in (" ", "\n") or text[-1:] in (" ", "\n"):
            return self.whole(text)
        out = []
        for line in lines:
            head, *rest = line.split(" ")
            out.append(self.first[head] + b"".join(map(self.later.__getitem__, rest)))
        return self.line.join(out)


class _Chunks(dict):
    """Ids of chunks, each split by the tokenizer's own rule; its parts go to the merge model one by one."""

    def __init__(self, tokenizer, before: str):
        super().__init__()
        self.tokenizer, self.before = tokenizer, before
        self.split, self.merge = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
        # how the model writes each byte, for Latin letters, which are one part whatever they are
        self.written = {b: self.split(chr(b))[0][0][-1] for b in range(0x20, 0x7F)}
        for first in range(0xC2, 0xCA):
            for last in range(0x80, 0xC0):
                self.written[first], self.written[last] = self.split(bytes([first, last]).decode())[0][0]
        self.plain = tokenizer.normalizer is None
        self.lead = before and self.written[ord(before)]
        self.ascii = self.plain and all(self.written[b] == chr(b) for b in range(0x21, 0x7F))
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = array("I", [t.id for t in self.merge(part)]).tobytes()
            if len(part) <= 4:
                self.parts[part] = ids
        return ids

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            if self.ascii and chunk.isascii() and chunk.isalpha():
                ids = array("I", [t.id for t in self.merge(self.lead + chunk)]).tobytes()
            else:
                ids = self._ids(chunk)
        if len(chunk) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
                self.parts.clear()
            self[chunk] = ids
        return ids

    def _ids(self, chunk: str) -> bytes:
        if not self.plain:
            return np.array(self.tokenizer.encode(self.before + chunk, add_special_tokens=False).ids, "<u4").tobytes()
        if chunk.isalpha() and max(chunk) < "\u0250":
            return self._part((self.before + chunk).encode().decode("latin-1").translate(self.written))
        if chunk[-1:] in (".", ",") and chunk[-2:-1].isalpha():
            return self[chunk[:-1]] + self._part(chunk[-1])
        return b"".join([self._part(p) for p, _ in self.split(self.before + chunk)])


#: The encoder of each vocabulary file, kept while the worker lives.
_ENCODERS: dict[str, Encoder] = {}
FORGET.append(_ENCODERS.clear)


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _parts(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def pack(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece: document, start and length in its ids, CRC-32 of the ids, the document's token count, and
    sequence and offset."""
    path = path or vocabulary()
    closing = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        base = TaskContext.get().partitionId() * PER_PARTITION
        opened = 0
        rest = []
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        kinds = pa.schema([(n, pa.int64()) for n in names])
        for batch in (part for whole in batches for part in _parts(whole)):
            full = []
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = (encode(t) if t else b"") + closing
                n = len(ids) // 4
                for at in range(0, n, length):
                    piece = ids[4 * at : 4 * (at + length)]
                    row = (key, at, len(piece) // 4, zlib.crc32(piece), n)
                    if row[2] == length:
                        full.append((*row, base + opened, 0))
                        opened += 1
                    else:
                        rest.append(row)
            if full:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*full, strict=True)], schema=kinds)
        if rest:
            bins, offsets, _ = best_fit_decreasing(np.array([r[2] for r in rest], np.int64), length)
            columns = [*zip(*rest, strict=True), (bins + base + opened).tolist(), offsets.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=kinds)

    return docs.select(docs[doc_id].cast("long"), docs[text]).mapInArrow(run, SCHEMA)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))

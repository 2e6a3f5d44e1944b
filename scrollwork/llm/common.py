"""Shared pieces of the training-data operators: Arrow text access, byte-level word splitting, hashes of words and windows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one numpy pass works on; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20

#: Tables over the 256 byte values. Every byte of a non-ASCII character is a word byte for both kinds of word.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Words `[^\x20\x09-\x0D]+`.
SPACED = ~_SPACE
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of a text whose A-Z were lower-cased.
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: bytes.translate table: A-Z to a-z, other ASCII separators to a space.
FOLD_ALNUM = bytes((b + 32 if 0x41 <= b <= 0x5A else b if _ALNUM[b] else 0x20) for b in range(256))
#: bytes.translate table: A-Z to a-z and nothing else.
FOLD_ASCII = bytes((b + 32 if 0x41 <= b <= 0x5A else b) for b in range(256))

#: Words over this many bytes are hashed by XXH3.
LONG_WORD = 512
_SEED = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_JOIN = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F))
#: Masks for the lowest 0 to 8 bytes of a word.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


#: What empties the caches that an operator keeps in a worker from task to task.
FORGET: list[Callable[[], None]] = []


def give_back() -> None:
    """Empties the caches of operators in this worker and returns freed memory to the system."""
    for forget in FORGET:
        forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_lean(frame: DataFrame, run: Callable, schema) -> DataFrame:
    """`frame.mapInArrow(run, schema)`, where a task holds nothing that tasks before it left in its worker, which lives
    on from one to the next, and leaves nothing itself."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from run(batches)
        give_back()

    return frame.mapInArrow(lean, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: list[str], name: str) -> str:
    """A column name that no input column has, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_alnum(text: bytes) -> list[bytes]:
    return text.translate(FOLD_ALNUM).split()


def words_spaced(text: bytes) -> list[bytes]:
    return text.split()


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def text_blocks(batch: pa.RecordBatch, name: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about `limit` bytes of text each, with their offsets (from 0) and bytes. Null is empty."""
    column = pc.fill_null(batch.column(batch.schema.get_field_index(name)).cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, n)
        yield batch.slice(at, to - at), offsets[at : to + 1] - offsets[at], data[offsets[at] : offsets[to]]
        at = to


def spans_of_words(offsets: np.ndarray, data: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in `data`, and for each text the number of words before it (one entry more than texts)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = word[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    begin[first] |= inside[first]
    end[last] |= inside[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a public bijection of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def joined(left: np.ndarray, right: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of two hashes, in this order."""
    return mix(left * _JOIN[which] + right)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of the bytes of each word, eight at a time; hashes with another `which` are independent of these.

    Each eight bytes are mixed before the next are joined to them, so words have no sums that could cancel out.
    """
    wide = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    size = ends - starts
    out = mix((wide[starts] & _LOW[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * _SEED[which]) ^ _SEED[which])
    at, done = np.flatnonzero((size > 8) & (size <= LONG_WORD)), 8
    while len(at):
        out[at] = joined(out[at], wide[starts[at] + done] & _LOW[np.minimum(size[at] - done, 8)], which)
        done += 8
        at = at[size[at] > done]
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes(), int(_SEED[which]))
    return out


def window_hashes(values: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of each `size` values in a row, joined from those of 1, 2, 4 and so on."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    out, own, n = None, values, 1
    done = 0
    while True:
        if size & n:
            if out is None:
                out = own
            else:
                last = len(values) - done - n + 1
                out = joined(out[:last], own[done : done + last], which)
            done += n
        if 2 * n > size:
            return out
        own = joined(own[:-n], own[n:], which)
        n *= 2


def window_rows(word_offsets: np.ndarray, size: int) -> np.ndarray:
    """Index of the first word of every window of `size` words that lies within one text."""
    counts = np.diff(word_offsets)
    keep = np.maximum(counts - size + 1, 0)
    total = int(keep.sum())
    before = np.concatenate([[0], np.cumsum(keep)])[:-1]
    return np.arange(total) + np.repeat(word_offsets[:-1] - before, keep)


def covered(n: int, starts: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """Flags of the n places that lie in [start, start + size) of any start."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge[:-1]) > 0

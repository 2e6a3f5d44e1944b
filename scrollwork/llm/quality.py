"""Quality rules as a short-circuit cascade.

The base figures of a text (words, their characters, symbols, repeated lines, repeated 8-word windows) are always
computed, in numpy over blocks of texts. Texts that pass the base rules go through the cascade: each rule's cost and
rejection rate are measured on a sample of the rows, the rules are ordered by rejections per second, and a text leaves
at the first rule that rejects it. A text is kept if no rule rejects it, so the order and the sample change the time
and never a verdict.

Defined results: a null or blank text has no words and fails the base rules; every row is answered, repeated ones each;
an empty table gives no row.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACED, covered, raw_texts, spans_of_words, table, text_blocks, window_hashes, window_rows, word_hashes, words_spaced

#: Words of a window that may not repeat.
WINDOW = 8
#: Fewest words of a text, and the most repeated words in a hundred.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Rows that costs and rejection rates are measured on, about.
SAMPLE_ROWS = 2000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER, _LETTERS = bytes(range(0x41, 0x5B)), bytes([*range(0x41, 0x5B), *range(0x61, 0x7B)])
_SYMBOLS = b"#*$%&|<>"
_WORDLIKE = re.compile(rb"[0-9A-Za-z\x80-\xff]")


@dataclass(frozen=True)
class Rule:
    """Rejects a text for which `rejects` is true; a text without a word is never asked."""

    name: str
    rejects: Callable[[bytes], bool]


def _without(text: bytes, which: bytes) -> int:
    return len(text) - len(text.translate(None, which))


def _symbols(text: bytes) -> bool:
    return 10 * _without(text, _SYMBOLS) > len(text)


def _capitals(text: bytes) -> bool:
    return 10 * _without(text, _UPPER) > 7 * _without(text, _LETTERS) > 0


def _line_repeats(text: bytes) -> bool:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return 2 * (len(lines) - len(set(lines))) > len(lines)


def _word_length(text: bytes) -> bool:
    words = words_spaced(text)
    chars = sum(map(len, words))
    return not 2 * len(words) <= chars <= 25 * len(words)


def _wordless(text: bytes) -> bool:
    words = words_spaced(text)
    return 2 * sum(_WORDLIKE.search(w) is not None for w in words) < len(words)


def _one_word(text: bytes) -> bool:
    words = words_spaced(text)
    top: dict[bytes, int] = {}
    for w in words:
        top[w] = top.get(w, 0) + 1
    return 2 * max(top.values()) > len(words)


#: Symbols over a tenth of the bytes; over 70 % capitals; over half the lines seen before; words of under 2 or over 25
#: bytes on average; over half the words without letter or digit; one word over half of all.
RULES = (
    Rule("symbols", _symbols),
    Rule("capitals", _capitals),
    Rule("line_repeats", _line_repeats),
    Rule("word_length", _word_length),
    Rule("wordless", _wordless),
    Rule("one_word", _one_word),
)


def _repeated(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Flags of the hashes that their text has twice or more."""
    order = np.lexsort((hashes, text))
    same = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    out = np.zeros(len(hashes), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def base_figures(offsets: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    starts, ends, per_text = spans_of_words(offsets, data, SPACED)
    n = len(offsets) - 1
    sums = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    chars = sums(SPACED[data] & ((data & 0xC0) != 0x80))
    symbols = sums(_SYMBOL[data])
    first = window_rows(per_text, WINDOW)
    repeats = np.zeros(n, np.int64)
    if len(first):
        # windows equal by one hash are verified by another one
        for which in (0, 1):
            hashes = window_hashes(word_hashes(data, starts, ends, which), WINDOW, which)[first]
            first = first[_repeated(hashes, np.searchsorted(per_text, first, "right") - 1)]
            if not len(first):
                break
        inside = covered(len(starts), first, WINDOW)
        repeats = np.diff(np.concatenate([[0], np.cumsum(inside)])[per_text])
    raw = data.tobytes()
    lines = np.zeros(n, np.int64)
    for k in range(n):
        own = raw[offsets[k] : offsets[k + 1]]
        if b"\n" in own:
            own = [x for x in own.split(b"\n") if x.strip()]
            lines[k] = len(own) - len(set(own))
    return {"n_words": np.diff(per_text), "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines, "n_repeat_words": repeats}


def measure_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Seconds a text and share rejected of each rule, on about `sample_rows` rows."""
    total = docs.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for b in batches for t in raw_texts(b.column(0)) if t.strip()]
        for r in rules:
            began = time.perf_counter()
            rejected = sum(map(r.rejects, texts))
            yield pa.RecordBatch.from_pydict({"name": [r.name], "s": [time.perf_counter() - began], "rejected": [rejected], "seen": [len(texts)]}, pa.schema([("name", pa.string()), ("s", pa.float64()), ("rejected", pa.int64()), ("seen", pa.int64())]))

    sample = docs.select(text).sample(min(1.0, sample_rows / max(total, 1)), seed=8)
    sums = sample.mapInArrow(run, "name string, s double, rejected long, seen long").groupBy("name").agg(F.sum("s").alias("s"), F.sum("rejected").alias("rejected"), F.sum("seen").alias("seen"))
    return {r["name"]: (r["s"] / r["seen"], r["rejected"] / r["seen"]) for r in sums.collect() if r["seen"]}


def order_rules(rules: tuple[Rule, ...], measured: dict[str, tuple[float, float]]) -> tuple[Rule, ...]:
    """Most rejections per second first; rules that nobody measured last, in their given order."""
    return tuple(sorted(rules, key=lambda r: -measured[r.name][1] / max(measured[r.name][0], 1e-9) if r.name in measured else 1.0))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per text: doc_id, the base figures, base_failed, kept, and the rule that rejected it (null: none)."""
    ordered = order_rules(rules, measure_rules(docs, rules, text))
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in text_blocks(batch, "text"):
                base = base_figures(offsets, data)
                failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])
                raw, by = data.tobytes(), [None] * len(failed)
                for k in np.flatnonzero(~failed).tolist():
                    own = raw[offsets[k] : offsets[k + 1]]
                    by[k] = next((r.name for r in ordered if r.rejects(own)), None)
                kept = ~failed & np.array([x is None for x in by])
                yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(base[c], pa.int64()) for c in figures), pa.array(failed), pa.array(kept), pa.array(by, pa.string())], names=["doc_id", *figures, "base_failed", "kept", "rejected_by"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, {', '.join(f'{c} long' for c in figures)}, base_failed boolean, kept boolean, rejected_by string")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("rejected_by")

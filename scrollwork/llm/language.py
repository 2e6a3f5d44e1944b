"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent 1- to 3-character sequences of some text, letters only, with a space at word
ends. A document goes to the language whose profile is nearest by out-of-place distance: for each n-gram of the document
the difference of the two ranks, or the profile's length where the language has no such n-gram.

Defined results: `und` with score 0 for a null text, a text without a letter, or when there is nothing to learn from;
equal distances go to the language that sorts first; rows with a null language or a held-out id teach nothing; a null
id is in no held-out set and teaches; every row is answered, repeated ones each.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, map_lean, table

#: N-grams of a profile.
PROFILE = 400
#: What a document's own profile may hold.
DOCUMENT_PROFILE = 400
UNKNOWN = "und"
#: N-grams that a task holds, 8 bytes each, before it counts them, and counts of distinct ones, about 130 bytes each, before
#: it hands them on.
HELD, COUNTED = 1 << 20, 400_000

_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Flags of the code points that are letters."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def ngram_codes(text: str) -> np.ndarray:
    """Codes of all 1- to 3-grams of the lower-cased text; 21 bits a character."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.int64)
    # runs of other characters become one space, with one at either end
    points = np.where(letter, points, 0x20).astype(np.int64)
    points = np.concatenate([[0x20], points, [0x20]])
    points = points[np.concatenate([[True], (points[1:] != 0x20) | (points[:-1] != 0x20)])]
    two = (points[:-1] << 21) | points[1:]
    three = (two[:-1] << 21) | points[2:]
    return np.concatenate([points[points != 0x20], two, three])


def ranked(codes: np.ndarray, top: int) -> np.ndarray:
    """The most frequent codes, most frequent first; equal counts by code."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    counts = np.diff(np.concatenate([first, [len(codes)]]))
    return codes[first][np.argsort(-counts, kind="stable")[:top]]


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """Profile of each language, from all rows of `docs`: counts are summed in each task before the shuffle, and handed on
    as soon as there are many, so a task's memory does not grow with the scripts it meets.

    What comes to the driver is `size` numbers a language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, Counter] = {}
        held: dict[str, list[np.ndarray]] = {}
        weight = 0

        def settle() -> None:
            for name, parts in held.items():
                codes, counts = np.unique(np.concatenate(parts), return_counts=True)
                own = total.setdefault(name, Counter())
                for c, n in zip(codes.tolist(), counts.tolist(), strict=True):
                    own[c] += n
            held.clear()

        def told() -> Iterator[pa.RecordBatch]:
            for name, own in total.items():
                yield pa.RecordBatch.from_pydict({"lang": [name] * len(own), "code": list(own.keys()), "n": list(own.values())}, pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())]))
            total.clear()

        for batch in batches:
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = ngram_codes(t)
                held.setdefault(name, []).append(codes)
                weight += len(codes)
                if weight > HELD:
                    settle()
                    weight = 0
                    if sum(map(len, total.values())) > COUNTED:
                        yield from told()
        settle()
        yield from told()

    own = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counts = map_lean(own, count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    out: dict[str, list[tuple[int, int]]] = {}
    for r in top.collect():
        out.setdefault(r["lang"], []).append((r["rank"], r["code"]))
    return {name: [c for _, c in sorted(v)] for name, v in sorted(out.items())}


class Profiles:
    """All languages' ranks of each n-gram, for distances to all of them at once."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.names = sorted(profiles)
        self.size = size
        self.codes = np.array(sorted({c for v in profiles.values() for c in v}), np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.names)), -1, np.int64)
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.codes, np.array(profiles[name], np.int64)), k] = np.arange(len(profiles[name]))

    def classify(self, text: str | None, top: int = DOCUMENT_PROFILE) -> tuple[str, float]:
        codes = ngram_codes(text or "")
        if not len(codes) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(codes, top)
        at = np.searchsorted(self.codes, own)
        found = np.minimum(at, len(self.codes) - 1)
        at = np.where(self.codes[found] == own, found, len(self.codes))
        ranks = self.ranks[at]
        place = np.arange(len(own))[:, None]
        distance = np.where(ranks < 0, self.size, np.minimum(np.abs(ranks - place), self.size)).sum(0)
        best = int(np.argmin(distance))
        return self.names[best], float(1 - distance[best] / (self.size * len(own)))


def detect(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", size: int = PROFILE) -> tuple[DataFrame, str, str]:
    """`docs` with two columns more, and their names: language and score (1: the profile's own order; 0: nothing shared)."""
    lang, score = fresh(docs.columns, "lang_pred"), fresh(docs.columns, "lang_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(profiles, size)
        for batch in batches:
            said = [model.classify(t) for t in batch.column(text).to_pylist()]
            arrays = [*batch.columns, pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, lang, score])

    schema = docs.withColumns({lang: F.lit(""), score: F.lit(0.0)}).schema
    return map_lean(docs, run, schema), lang, score


def held_out(doc_id: Column) -> Column:
    """The third of the documents that is never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = learn_profiles(docs.where(~held_out(F.col("doc_id"))))
    out, lang, score = detect(docs.select("doc_id", "text"), profiles)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(lang).alias("lang_pred"), F.col(score).alias("score"))


def keep_known(docs: DataFrame) -> DataFrame:
    """`docs` without the rows that no profile fits: `und`, or not one n-gram shared with the nearest language.

    Learns from the rows' own `lang` as op2 does; all languages that it knows stay.
    """
    profiles = learn_profiles(docs.where(~held_out(F.col("doc_id"))))
    out, lang, score = detect(docs, profiles)
    return out.where((F.col(lang) != UNKNOWN) & (F.col(score) > 0)).select(*docs.columns)


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1

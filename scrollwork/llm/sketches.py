"""Document fingerprints by a threshold-scaled sketch, with DataFrame functions only.

A sketch keeps every hash of a five-word shingle below a fixed fraction of all hashes. How much of one document lies in
another can so be estimated however unequal they are: below the fraction, both sketches are complete. A text with fewer
than FLOOR such hashes keeps its FLOOR smallest ones, so a short text is not left without a fingerprint; what is complete in
both then reaches as far as the lesser of the two. The sketch of two documents together is made from their sketches
(see `keep`).

The next document is found without a sort of all rows in one task: ids are dealt into ranges of about equal size, and the
first row of each range is sent along to the range before it, so each row's next one stands in its own range. What comes
to the driver is two ids for each range.

Words are `[^\\x20\\x09-\\x0D]+` in lower case; fewer than five are one shingle. Defined results: a null text is empty; a text
without a word has an empty fingerprint, like any other such text (likeness 1) and unlike all others (0). Rows with equal
ids follow each other by text, largest first; null ids come last. A document alone is its own next one. An empty table gives no
row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: Words of a shingle.
WORDS = 5
#: Hashes have 48 bits; those below this eighth are kept, or else so many of the smallest.
BITS = 48
BELOW, FLOOR = (1 << BITS) // 8, 16
#: Ranges of ids to a shuffle partition.
RANGES = 2
_BLANK = " \t\n\x0b\f\r"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once: what a lambda only refers to would be computed at its every turn."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingles(text: Column) -> Column:
    """The hash of each shingle, in order, repeats included."""
    bare = F.btrim(F.lower(text), F.lit(_BLANK))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))

    def joined(own: Column) -> Column:
        each = F.transform(own, lambda h, i: F.shiftrightunsigned(F.xxhash64(h, *(F.get(own, i + k) for k in range(1, WORDS))), 64 - BITS))
        return F.slice(each, 1, F.greatest(F.size(own) - (WORDS - 1), F.least(F.size(own), F.lit(1))))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), joined)


def keep(hashes: Column) -> Column:
    """The sketch of these hashes, in order. For two sketches one after another it is the sketch of both documents' shingles
    together: every hash that this keeps, they have kept."""

    def of(every: Column) -> Column:
        low = F.array_distinct(F.filter(every, lambda h: h < BELOW))
        return _let(low, lambda few: F.sort_array(F.when(F.size(few) >= FLOOR, few).otherwise(F.slice(F.sort_array(F.array_distinct(every)), 1, FLOOR))))

    return _let(hashes, of)


def sketch(text: Column) -> Column:
    return keep(shingles(text))


def complete(sketch: Column) -> Column:
    """The hash below which a sketch holds every one of its document."""
    return F.when(F.size(sketch) < FLOOR, F.lit(1 << BITS)).otherwise(F.greatest(F.lit(BELOW), F.get(sketch, F.size(sketch) - 1) + 1))


def likeness(a: Column, b: Column) -> Column:
    """The share of the smaller document's shingles that the other has, estimated where both sketches are complete."""
    held = lambda s, upto: F.size(F.filter(s, lambda h: h < upto))
    fewest = _let(F.least(complete(a), complete(b)), lambda upto: F.least(held(a, upto), held(b, upto)))
    share = _let(fewest, lambda n: F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(F.lit(0.0)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(share)


def shown(sketch: Column) -> Column:
    """The fingerprint as text, twelve hexadecimal digits a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), BITS // 4, "0")), "")


def _ranges(docs: DataFrame) -> tuple[Column, list, list[int]]:
    """The range of each id (0 for null), and for each range its largest id and the range that comes before it."""
    n = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 100 * n)).first()[0] if n > 1 else None
    cuts = sorted(set(cuts or ()))
    # two steps of about the square root of the number of ranges
    width = int(len(cuts) ** 0.5) + 1
    parts = [cuts[k : k + width] for k in range(0, len(cuts), width)]
    own = F.lit(0)
    if parts:
        key = F.col("doc_id")
        which = F.size(F.filter(F.lit([p[-1] for p in parts]), lambda c: c < key))
        within = F.size(F.filter(F.get(F.array(*map(F.lit, parts)), which), lambda c: c < key))
        own = which * width + F.greatest(within, F.lit(0))
    own = F.when(F.col("doc_id").isNull(), 0).otherwise(own + 1)
    heads = {r["range"]: r["head"] for r in docs.groupBy(own.alias("range")).agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads, reverse=True)
    before = dict(zip(order, [*order[-1:], *order[:-1]], strict=True))
    count = max(heads, default=-1) + 1
    return own, [heads.get(k) for k in range(count)], [before.get(k, 0) for k in range(count)]


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sketch, and those of the document with the next smaller id: next_text and next_sketch."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own, heads, before = _ranges(docs.select("doc_id"))
    if not heads:
        heads, before = [None], [0]
    place = lambda at, guest: F.struct(at.alias("range"), F.lit(guest).alias("guest"))
    made = docs.select("doc_id", "text", sketch(F.col("text")).alias("sketch"), own.alias("own"))
    leads = F.col("doc_id").eqNullSafe(F.get(F.lit(heads).cast("array<long>"), F.col("own")))
    both = F.array(place(F.col("own"), False), place(F.get(F.lit(before), F.col("own")), True))
    placed = made.select("doc_id", "text", "sketch", F.explode(F.when(leads, both).otherwise(F.slice(both, 1, 1))).alias("at"))
    placed = placed.select("doc_id", "text", "sketch", F.col("at.range").alias("range"), F.col("at.guest").alias("guest"))
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("text"))
    found = placed.select("doc_id", "text", "sketch", "guest", F.lead("text").over(order).alias("next_text"), F.lead("sketch").over(order).alias("next_sketch"))
    return found.where(~F.col("guest")).drop("guest")


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(table(spark, sf_dir, "documents")).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - cut), F.left("next_text", cut))
    rows = rows.select("doc_id", "n_chars", "sketch", "next_sketch", edited.alias("edited"))
    rows = rows.select("*", sketch(F.col("edited")).alias("edited_sketch"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        shown(F.col("sketch")).alias("fingerprint"),
        shown(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def brute_sketch(text: str) -> list[int]:
    """The same by plain loops."""
    import re
    import struct

    import xxhash

    signed = lambda h: h - (1 << 64) if h >> 63 else h
    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall(r"[^\x20\x09-\x0D]+", text.lower())]
    hashes = set()
    for k in range(max(len(words) - WORDS + 1, min(len(words), 1))):
        h = 42
        for w in words[k : k + WORDS]:
            h = xxhash.xxh64_intdigest(struct.pack("<q", w), h)
        hashes.add(h >> 64 - BITS)
    low = [h for h in hashes if h < BELOW]
    return sorted(low) if len(low) >= FLOOR else sorted(hashes)[:FLOOR]


def brute_force(documents: list[tuple[int | None, str | None]]) -> list[tuple]:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each document, unordered."""
    import hashlib

    def near(a: list[int], b: list[int]) -> float:
        if not a and not b:
            return 1.0
        upto = min(1 << BITS if len(s) < FLOOR else max(BELOW, s[-1] + 1) for s in (a, b))
        fewest = min(sum(h < upto for h in s) for s in (a, b))
        return len(set(a) & set(b)) / fewest if fewest else 0.0

    rows = sorted(((d is not None, d or 0, (t or "").encode()) for d, t in documents), reverse=True)
    texts = [t.decode() for _, _, t in rows]
    sketches = [brute_sketch(t) for t in texts]
    out = []
    for k, (known, doc_id, _) in enumerate(rows):
        text, after = texts[k], texts[(k + 1) % len(rows)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        own, other = sketches[k], brute_sketch(edited)
        show = lambda s: "".join(f"{h:012x}" for h in s)
        out.append((doc_id if known else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), show(own), show(other), near(own, other), near(own, sketches[(k + 1) % len(rows)])))
    return out

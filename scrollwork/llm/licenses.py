"""Licence scan over a positional index of the rarest licence words, with DataFrame functions only.

The templates' words are indexed by position. How many documents hold each of them is counted over all documents. For
a file and a template whose key phrase's words it all holds, the template words with the highest IDF that occur in the
file are looked up; each place in the file votes for where the template would begin; a place that enough of these
words agree on is kept if the key phrase stands there, and scored by the share of template words in their place.

Base labels are found apart from that: a phrase's words in a row, anywhere.

Defined results: a null text has no words, no places and empty labels; labels and scores of repeated rows are equal;
an empty table gives no row; other columns are ignored. Lower-casing is Unicode's; it gives the same words and places
as lower-casing A-Z, as no letter of a base phrase has another upper-case form than the ASCII one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    """A licence sentence in words, and the phrase in it that must stand in its place."""

    label: str
    text: str
    key: str

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        words, key = self.words, self.key.split()
        return next(k for k in range(len(words)) if words[k : k + len(key)] == key)


TEMPLATES = (
    Template("gpl", "this work is licensed under the gnu general public license version", "gnu general public license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "free software you can redistribute it"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "public license version 3"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    Template("apache", "licensed under the apache license version", "apache license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("cc-by", "licensed under cc by", "cc by"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("mpl", "subject to the terms of the mozilla public license v", "mozilla public license"),
)
#: Words looked up for a template, votes that a place needs of them, and share of template words in their place.
RARE_WORDS, VOTES, MIN_SCORE = 3, 2, 0.6

#: What separates words once the text is in lower case.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_string(text: Column) -> Column:
    """The words with one space before, between and after; a single space if there is none."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def licence_words() -> list[str]:
    return sorted({w for t in TEMPLATES for w in t.words})


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[dict[str, int], int]:
    """Documents that hold each licence word, and documents in all. What comes to the driver is one number a word of
    the templates."""
    words = F.split(words_string(F.col(text)), " ")
    held = docs.select(F.array_intersect(F.array(*map(F.lit, licence_words())), words).alias("held"))
    counts = held.select(F.explode(F.concat(F.array(F.lit("")), "held")).alias("word")).groupBy("word").count().collect()
    got = {r["word"]: r["count"] for r in counts}
    return {w: got.get(w, 0) for w in licence_words()}, got.get("", 0)


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once: what a lambda only refers to would be computed at its every turn."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _match(template: Template, words: Column, idf: dict[str, float]) -> Column:
    """Score of the best verified place of the template, or null. `words`: the file's words, from index 0."""
    own, key, at = template.words, template.key.split(), template.key_at
    rarest = sorted(set(own), key=lambda w: (-idf[w], w))
    texts = lambda values: F.array(*map(F.lit, values))
    postings = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(k).alias("k")) for k, w in enumerate(own)])

    def look_up(top: Column) -> Column:
        hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: F.array_contains(top, h["w"]))
        votes = F.flatten(F.transform(hits, lambda h: F.transform(F.filter(postings, lambda p: p["w"] == h["w"]), lambda p: h["i"] - p["k"])))
        return _let(votes, lambda v: best(v, F.least(F.lit(VOTES), F.size(top))))

    def best(votes: Column, needed: Column) -> Column:
        # equal votes stand together once sorted, so a place has enough if the vote some places on is the same
        ordered = F.array_sort(votes)
        agreed = _let(F.struct(ordered.alias("v"), needed.alias("n")), lambda s: F.array_distinct(F.filter(F.transform(s["v"], lambda v, i: F.when(F.get(s["v"], i + s["n"] - 1) == v, v)), lambda v: v.isNotNull())))
        verified = F.filter(agreed, lambda o: (o + at >= 0) & (F.slice(words, F.greatest(o + at + 1, F.lit(1)), len(key)) == texts(key)))
        return F.array_max(F.transform(verified, lambda o: F.size(F.filter(postings, lambda p: F.coalesce(F.get(words, o + p["k"]) == p["w"], F.lit(False)))) / F.lit(float(len(own)))))

    return _let(F.slice(F.array_intersect(texts(rarest), words), 1, RARE_WORDS), look_up)


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, licences (struct<label, score>)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    frequency, total = document_frequencies(docs)
    idf = {w: math.log((1 + total) / (1 + n)) for w, n in frequency.items()}
    row = F.col("__words")
    n_words = F.when(row == "  ", F.lit(0).cast("long")).otherwise(_spaces(row) - 1)
    places, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        found = F.contains(row, F.lit(f" {phrase} "))
        places.append(F.when(found, F.regexp_count(row, F.lit(f" {phrase}(?= )")).cast("long")).otherwise(0))
        firsts.append(F.when(found, _spaces(F.substring_index(row, f" {phrase} ", 1))))
        lasts.append(F.when(found, n_words - _spaces(F.substring_index(row, f" {phrase} ", -1)) - len(phrase.split())))
        labels.append(F.when(found, F.lit(label)))
    # a template can only be verified where every word of its key phrase occurs, so the others need no look-up
    words = F.col("__list")
    matches = []
    for t in TEMPLATES:
        possible = F.lit(True)
        for w in dict.fromkeys(t.key.split()):
            possible = possible & F.contains(row, F.lit(f" {w} "))
        score = F.when(possible, _match(t, words, idf))
        matches.append(F.struct(F.lit(t.label).alias("label"), score.alias("score")))
    base = F.array_compact(F.array(*labels))
    made = docs.select("doc_id", words_string(F.col("text")).alias("__words"))
    made = made.select("*", F.split(F.trim("__words"), " ").alias("__list"))
    made = made.select(
        "doc_id",
        n_words.alias("n_words"),
        sum(places[1:], places[0]).alias("n_base"),
        F.least(*firsts).alias("first_word"),
        F.greatest(*lasts).alias("last_word"),
        F.array_sort(F.array_distinct(base)).alias("__base"),
        F.filter(F.array(*matches), lambda m: m["score"] >= MIN_SCORE).alias("licences"),
    )
    every = F.array_sort(F.array_distinct(F.concat("__base", F.transform("licences", lambda m: m["label"]))))
    score = F.coalesce(F.array_max(F.transform("licences", lambda m: m["score"])), F.when(F.col("n_base") > 0, F.lit(0.5)), F.lit(0.0))
    return made.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("__base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), score.alias("score"), "licences")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("licences")


def brute_force(text: str | None) -> tuple[int, int, int | None, int | None, str]:
    """n_words, n_base, first_word, last_word, base_labels by looking at every place."""
    import re

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        own = phrase.split()
        found = [k for k in range(len(words)) if words[k : k + len(own)] == own]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))

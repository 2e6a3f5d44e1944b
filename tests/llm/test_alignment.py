"""Alignment of two tokenizers against a version that looks at every byte."""

import random
from collections import Counter

import pytest
from made_texts import edge_documents, prose

from scrollwork.llm import alignment
from scrollwork.llm.alignment import Aligner, aligned, brute_force, counted, pair_counts, scored, vocabularies
from scrollwork.llm.components import stored
from scrollwork.llm.queries import QUERIES

ODD = [
    "one <|endoftext|> two <s> three </s> <unk>",
    "a\u2581b",  # what B writes for a space
    "two  spaces and a tab\there",
    " leading",
    "trailing ",
    "lines\nof text\n\nand a gap",
    "line\nline",
    "\n",
    "it's 12345 don't 3.14 x=1;y=2",
    "ﬁ e\u0301 Å 日本語 😀 ñandú \u00a0 nbsp \u3000",
    "\x00\x01 <0x0A>",
    "a" * 300 + " " + "b" * 70,
    "x",
]


@pytest.fixture(scope="module")
def align():
    return Aligner(*vocabularies())


def shape(spans):
    n = counted(sum(s.counts for s in spans))
    return (*n, ";".join(s.groups for s in spans))


def test_chunks_say_what_whole_texts_say(align, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 50)  # generations change all the time
    rng = random.Random(1)
    texts = ODD + [prose(k, 40) for k in range(30)] + ["".join(rng.choices("ab é.日1\n ", k=rng.randrange(1, 40))) for _ in range(300)]
    for at in range(0, len(texts), 7):
        part = texts[at : at + 7]
        for text, spans in zip(part, align(part), strict=True):
            whole = align.whole(text)
            assert shape(spans) == shape([] if whole is alignment.LOST else [whole]), text


def test_groups_and_links_of_odd_texts(spark, align):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*ODD, None, ""])], "doc_id long, text string")
    documents = stored(aligned(docs))
    got = {r["doc_id"]: r for r in scored(documents, stored(pair_counts(documents))).collect()}
    for k, want in enumerate(brute_force([*ODD, None, ""])):
        r = got[k]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]) == want[:6]
        # the groups give the text back
        ids = [g.split("|") for g in r["groups"].split(";")] if r["groups"] else []
        if r["n_a"]:
            text = b" " + ODD[k].encode()
            assert b"".join(align.of_a.bytes[int(i)] for g in ids for i in g[0].split(",")) == text == b"".join(align.of_b.bytes[int(i)] for g in ids for i in g[1].split(","))
    assert got[1]["n_a"] == got[1]["n_links"] == 0 and got[1]["groups"] == ""


def test_query_on_edges(spark, edges):
    docs = edge_documents()
    want = Counter((d[0], *w) for d, w in zip(docs, brute_force([d[1] for d in docs]), strict=True))
    got = QUERIES["op11_alignment"](spark, edges)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert Counter((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in got.collect()) == want


def test_counts_are_the_same_however_many_pairs_are_carried(spark):
    docs = spark.createDataFrame([(k, prose(k % 7, 60)) for k in range(40)], "doc_id long, text string").repartition(3)
    documents = stored(aligned(docs))
    pairs = stored(pair_counts(documents))
    rows = [sorted(map(tuple, scored(documents, pairs, most).collect())) for most in (0, 1, 50, 1 << 20)]
    assert rows[0] == rows[1] == rows[2] == rows[3]
    assert pairs.agg({"n": "sum"}).first()[0] == sum(r["n_links"] for r in documents.collect())


def test_few_pairs_held_at_a_time(spark, monkeypatch):
    documents = stored(aligned(spark.createDataFrame([(k, prose(k, 60)) for k in range(20)], "doc_id long, text string")))
    want = sorted(map(tuple, pair_counts(documents).collect()))
    monkeypatch.setattr(alignment, "HELD", 10)
    assert sorted(map(tuple, pair_counts(documents).collect())) == want

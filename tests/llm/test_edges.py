"""Every query on null, empty, blank, repeated, tied, long and non-ASCII rows, with columns of clashing names."""

import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from made_texts import edge_documents
from tokenizers import Tokenizer

from scrollwork.llm import bytes_dedup, decontamination, licenses, neardup, quality, substrings
from scrollwork.llm.packing import vocabulary
from scrollwork.llm.queries import QUERIES


def rows(spark, name, folder):
    return QUERIES[name](spark, folder).collect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(name, spark, nothing):
    assert rows(spark, name, nothing) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op9_packing", "op13_whitening"}))
def test_a_row_for_every_row(name, spark, edges):
    assert Counter(r["doc_id"] for r in rows(spark, name, edges)) == Counter(d[0] for d in edge_documents())


def by_row(found, value):
    return Counter((r["doc_id"], value(r)) for r in found)


def test_op1(spark, edges):
    items = [tuple(r.values()) for r in pq.read_table(f"{edges}/benchmark.parquet").to_pylist()]
    want = Counter()
    for d in edge_documents():
        w, h, n, s = decontamination.brute_force([(0, d[1])], [i for i in items if i[0] is not None])[0]
        h = decontamination.brute_force([(0, d[1])], items)[0][1]  # an item without an id marks words
        want[d[0], (w, h, n, s, h > 0)] += 1
    assert by_row(rows(spark, "op1_decontamination", edges), lambda r: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])) == want


def test_op2(spark, edges):
    got = {r["doc_id"]: r for r in rows(spark, "op2_language", edges)}
    assert [got[k]["lang_pred"] for k in (2, 3, 4, 9)] == ["und"] * 4 and got[9]["score"] == 0 and got[8]["lang_pred"] == "en"


def test_op3(spark, edges):
    # rows are documents of their own, so the rows of one id get numbers of their own for the check
    docs = edge_documents()
    found = bytes_dedup.brute_force([(k, d[1]) for k, d in enumerate(docs)])
    assert by_row(rows(spark, "op3_bytes", edges), lambda r: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) == Counter((d[0], found[k]) for k, d in enumerate(docs))


def test_op4(spark, edges):
    # null ids come first; the two equal rows are one document
    docs = edge_documents()
    want = Counter()
    order = sorted({(d[0] is not None, d[0] or 0, d[1] or "") for d in docs})
    numbered = {o: k for k, o in enumerate(order)}
    found = substrings.brute_force([(k, o[2]) for o, k in numbered.items()])
    for d in docs:
        want[d[0], found[numbered[d[0] is not None, d[0] or 0, d[1] or ""]]] += 1
    assert by_row(rows(spark, "op4_substrings", edges), lambda r: (r["n_words"], r["n_removed"], r["kept_sha256"])) == want


def test_op5(spark, edges):
    prints = [neardup.fingerprint((d[1] or "").encode()) for d in edge_documents()]
    want, docs = Counter(), edge_documents()
    for k, p in enumerate(prints):
        reach, open_ = set(), {k}
        while open_:
            x = open_.pop()
            reach.add(x)
            open_ |= {y for y in range(len(prints)) if (prints[x] ^ prints[y]).bit_count() <= 4} - reach
        want[docs[k][0], (f"{p:016x}", min((docs[y][0] for y in reach if docs[y][0] is not None), default=None))] += 1
    assert by_row(rows(spark, "op5_neardup", edges), lambda r: (r["fingerprint"], r["component_id"])) == want


def test_op6(spark, edges):
    want = Counter((d[0], licenses.brute_force(d[1])) for d in edge_documents())
    assert by_row(rows(spark, "op6_licenses", edges), lambda r: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])) == want


def test_op7_keeps_null_and_clean_texts(spark, edges):
    assert by_row(rows(spark, "op7_privacy", edges), lambda r: (r["text"], r["n_replaced"])) == Counter((d[0], (d[1], 0)) for d in edge_documents())


def test_op8(spark, edges):
    want = Counter((d[0], base(d[1])) for d in edge_documents())
    assert by_row(rows(spark, "op8_quality", edges), lambda r: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])) == want


def base(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    counts = Counter(windows)
    repeated = {p for k, w in enumerate(windows) if counts[w] > 1 for p in range(k, k + 8)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), lines, len(repeated), len(words) < quality.MIN_WORDS or 100 * len(repeated) > quality.MAX_REPEAT_PERCENT * len(words)


def test_op9_pieces_make_up_every_document(spark, edges):
    assert_packed(rows(spark, "op9_packing", edges), edge_documents())


def assert_packed(pieces, documents):
    tokenizer = Tokenizer.from_file(vocabulary())
    want = Counter()
    total = 0
    for d in documents:
        ids = [*tokenizer.encode(d[1] or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        for at in range(0, len(ids), 2048):
            piece = np.array(ids[at : at + 2048], "<u4")
            want[d[0], at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter(tuple(p)[:5] for p in pieces) == want
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by_sequence), total


def test_op10(spark, edges):
    got = rows(spark, "op10_scoring", edges)
    assert all((r["n_tokens"] == 0) == (r["mean_log_likelihood"] is None) and r["log_likelihood"] <= 0 for r in got)
    assert len({r["log_likelihood"] for r in got if r["doc_id"] == 1}) == 1

"""The five stages on documents with planted cases."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
from made_texts import prose
from pyspark.sql import functions as F

from scrollwork.llm import components, jaccard, neardup
from scrollwork.llm.common import table


def test_stages(spark, write):
    item = prose(900, 40)
    copy = prose(1, 150)
    docs = [(1, copy, "en"), (2, copy, "en"), (3, copy.replace(copy.split()[70], "changed", 1), "en"), (4, "1234 !!!", "en"), (5, None, None), (6, f"{prose(2, 60)} {item} {prose(3, 60)}", "en"), (7, f"call +1 (429) 555-5467 {prose(4, 60)}", "en"), (8, prose(5, 80), "en")]
    folder = write(docs, [(1, item)])
    frame, seen = table(spark, folder, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        columns = frame.columns
        frame = components.stored(stage(spark, frame, folder))
        seen[name] = frame
        if name != "packing":
            assert frame.columns == columns
    ids = lambda name: sorted(r["doc_id"] for r in seen[name].select("doc_id").distinct().collect())
    assert ids("language") == [1, 2, 3, 6, 7, 8]
    assert ids("near_dedup") == [1, 6, 7, 8] and seen["near_dedup"].count() == 4
    cleaned = {r["doc_id"]: r for r in seen["decontaminate"].collect()}
    assert item not in cleaned[6]["text"] and prose(2, 60) in cleaned[6]["text"] and cleaned[6]["n_chars"] == len(cleaned[6]["text"]) and cleaned[8]["text"] == docs[-1][1]
    private = {r["doc_id"]: r["text"] for r in seen["privacy"].collect()}
    assert "555-5467" not in private[7] and private[8] == docs[-1][1]
    assert ids("packing") == [1, 6, 7, 8]
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(map(tuple, seen["packing"].select("doc_id", "start", "length", "ids_crc32").collect()))


def test_stages_on_empty_tables(spark, nothing, write):
    assert corpus_pipeline.run(spark, nothing).isEmpty()
    # an empty benchmark takes nothing away
    docs = [(k, prose(k, 80)) for k in range(1, 5)]
    pieces = corpus_pipeline.run(spark, write(docs)).collect()
    assert sorted({p["doc_id"] for p in pieces}) == [1, 2, 3, 4]


def test_stages_on_edges(spark, edges):
    """Null ids and texts, blank, repeated and long texts, and columns with the names that stages use inside."""
    frame, seen = table(spark, edges, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns, n = frame.columns, frame.count()
        frame = components.stored(stage(spark, frame, edges))
        assert frame.columns == columns and frame.count() <= n
        seen[name] = Counter(r["doc_id"] for r in frame.select("doc_id").collect())
    assert not {2, 3, 4, 9} & set(seen["language"]) and seen["language"][1] == 2
    # of the rows with one text the smallest id stays, once; another text under a null id stays
    assert seen["near_dedup"][1] == 1 and seen["near_dedup"][None] == 1 and seen["near_dedup"][8] == 1
    assert seen["decontaminate"] == seen["privacy"] == seen["near_dedup"]
    pieces = corpus_pipeline.STAGES[-1][1](spark, frame, edges).collect()
    assert {p["doc_id"] for p in pieces} == set(seen["privacy"])
    assert sum(p["length"] for p in pieces if p["doc_id"] == 8) == next(p["doc_tokens"] for p in pieces if p["doc_id"] == 8)


def test_one_of_equal_rows_stays(spark, write):
    text = prose(1, 100)
    rows = [(1, text), (1, text), (2, text), (None, text), (None, "of its own, " + prose(2, 50)), (3, None), (3, "")]
    kept = neardup.keep_one_of_each(table(spark, write(rows), "documents")).collect()
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:3]) for r in kept) == sorted([(1, text[:3]), (0, "of "), (3, "")])


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(500, k) for k in range(100, 140)] + [(900, 901), (901, 900), (7, 7)]
    got = {r["node"]: r["label"] for r in components.label_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in (*range(100, 140), 500)} == {100} and got[901] == got[900] == 900


def test_components_of_a_long_chain_take_few_rounds(spark):
    rounds = []
    got = components.label_components(spark.range(1000).selectExpr("id AS u", "id + 1 AS v"), rounds).select("label").distinct().collect()
    assert [r["label"] for r in got] == [0] and len(rounds) < 20
    order = random.Random(2).sample(range(1001), 1001)
    rounds.clear()
    got = components.label_components(spark.createDataFrame(list(zip(order, order[1:], strict=False)), "u long, v long"), rounds)
    assert got.count() == 1001 and got.where("label <> 0").isEmpty() and len(rounds) < 20


def test_counts_in_parts_rule_out_no_similar_pair():
    rng = np.random.default_rng(2)
    for size in (1, 2, 3, 9, 100, 700, 5000):
        for share in (0.5, 0.9, 1.0):
            x = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
            y = np.unique(np.concatenate([x[: int(share * len(x))], rng.integers(0, 1 << 63, rng.integers(0, size // 4 + 1), dtype=np.uint64)]))
            shared = len(np.intersect1d(x, y))
            assert jaccard.most_shared(jaccard.part_counts(x), jaccard.part_counts(y)) >= shared
            assert jaccard.most_shared(jaccard.part_counts(x), jaccard.part_counts(x)) == len(x)


def test_codewords_of_fingerprints_propose_near_copies(spark, write, monkeypatch):
    """Closest copies come through op5's fingerprints and codewords; the sets then say which of them are similar enough."""
    texts = [prose(k, 400) for k in range(20)]
    docs = [(2 * k + c, text + " end" * c) for k, text in enumerate(texts) for c in (0, 1)]
    frame = table(spark, write(docs), "documents").select(F.col("doc_id").alias("key"), "text")
    nodes = jaccard.nodes_of(frame, 5)
    key = {r["node"]: r["least"] for r in nodes.collect()}
    pairs = {tuple(sorted((key[r["u"]], key[r["v"]]))) for r in neardup.fingerprint_pairs(nodes).collect()}
    assert len(pairs & {(2 * k, 2 * k + 1) for k in range(20)}) >= 18
    asked = []
    monkeypatch.setattr(neardup, "fingerprint_pairs", lambda nodes, made=neardup.fingerprint_pairs: asked.append(1) or made(nodes))
    assert sorted(r["doc_id"] for r in neardup.keep_one_of_each(table(spark, write(docs), "documents")).collect()) == list(range(0, 40, 2)) and asked
    assert jaccard.simhash(np.array([1, 3, 1 << 63], np.uint64)) == 1


def test_near_copies_are_those_of_exact_similarity(spark, write):
    """Texts around a similarity of 0.8, some with one shared line, and a group large enough to be compared in turns."""
    rng = random.Random(8)
    docs = []
    for k in range(40):
        words = prose(2000 + k, 150, 5000).split()
        for changed in (0, *(rng.randint(1, 5) for _ in range(30 if k == 0 else 3))):
            own = list(words)
            for p in rng.sample(range(150), changed):
                own[p] = f"changed{rng.random()}"
            docs.append((len(docs), " ".join(own) + (" one line that is the same in many texts" if k % 2 else "")))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.lower().split() for _, t in docs)]
    links = [[5 * len(a & b) >= 4 * len(a | b) for b in sets] for a in sets]
    assert any(0.75 < len(a & b) / len(a | b) < 0.8 for a in sets for b in sets)
    want, seen = set(), set()
    for d in range(len(docs)):
        if d not in seen:
            want.add(d)
            open_ = {d}
            while open_:
                x = open_.pop()
                seen.add(x)
                open_ |= {y for y in range(len(docs)) if links[x][y]} - seen
    kept = [r["doc_id"] for r in neardup.keep_one_of_each(table(spark, write(docs), "documents")).collect()]
    assert sorted(kept) == sorted(want)

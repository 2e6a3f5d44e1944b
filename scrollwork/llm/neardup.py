"""SimHash near-duplicates found through Golay codewords.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each read as a word of the perfect [23,12,7] Golay
code. A word within 2 bits of its codeword gives that codeword's index; a word 3 bits away gives it and the five
codewords 4 bits away. Any two words that differ in at most 2 bits then have an index in common.

Two fingerprints that differ in at most 4 bits agree in a key of one of two kinds:
* a segment is equal: of the other two, one has at most 2 errors. Key: the equal segment and an index of that one;
* no segment is equal: each has 1 or 2 errors. Key: an index of each of the three.
Keys hold 33 bits or more. Equal keys are sorted together, and the bits of the fingerprints are compared. Fingerprints
are distinct before this, so copies cost nothing here, and what a task reports of the links it verified is a spanning
forest, never all pairs.

Defined results: a null or blank text has fingerprint 0 and is linked like any other; repeated rows are answered each;
a null id is no candidate for component_id, which is null only if no id in the component is known; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import FOLD_ASCII, fresh, raw_texts, table, words_spaced
from .components import checkpointed, label_components
from .jaccard import nodes_of, similar_components, simhash

#: Words of a shingle for op5, and seed of its hash.
SHINGLE, SEED = 4, 42
#: Most differing bits of a link.
MAX_BITS = 4
#: Groups of one key up to this size are compared in bulk.
SMALL = 6
#: In the pipeline: words of a shingle.
PIPELINE_SHINGLE = 5
#: Generator polynomial of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101


def fingerprint(text: bytes, shingle: int = SHINGLE, seeds: tuple[int, ...] = (SEED,)) -> int | list[int]:
    """64-bit SimHash of the lower-cased text's word shingles; a list of them if there are several seeds."""
    words = words_spaced(text.translate(FOLD_ASCII))
    out = [0] * len(seeds)
    if words:
        joined = b" ".join(words)
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        size = min(shingle, len(words))
        shingles = [joined[a:b] for a, b in zip(starts[: len(words) - size + 1].tolist(), (starts[size:] - 1).tolist(), strict=True)]
        digest = xxhash.xxh64_intdigest
        for k, seed in enumerate(seeds):
            out[k] = simhash(np.array([digest(s, seed) for s in shingles], np.uint64))
    return out[0] if len(seeds) == 1 else out


class Golay:
    """Indices of the codewords near 23-bit words."""

    def __init__(self):
        residue = [1]
        for _ in range(22):
            x = residue[-1] << 1
            residue.append(x ^ GOLAY if x >> 11 else x)
        self.residues = np.zeros((3, 256), np.int64)
        for byte in range(3):
            for value in range(256):
                for bit in range(8):
                    if value >> bit & 1 and 8 * byte + bit < 23:
                        self.residues[byte, value] ^= residue[8 * byte + bit]
        leader: dict[int, int] = {}
        beyond: dict[int, list[int]] = {}
        for weight in range(5):
            for bits in combinations(range(23), weight):
                pattern = sum(1 << b for b in bits)
                syndrome = 0
                for b in bits:
                    syndrome ^= residue[b]
                if weight < 4:
                    leader[syndrome] = pattern
                elif leader[syndrome].bit_count() == 3:
                    beyond.setdefault(syndrome, []).append(pattern)
        self.errors = np.array([[leader[s], *beyond.get(s, [leader[s]] * 5)] for s in range(2048)], np.int64)
        self.many = np.array([s in beyond for s in range(2048)])

    def indices(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Six codeword indices of each word, and whether they are six different ones (else all are the same)."""
        syndrome = self.residues[0, words & 255] ^ self.residues[1, words >> 8 & 255] ^ self.residues[2, words >> 16 & 255]
        return (words[:, None] ^ self.errors[syndrome]) >> 11, self.many[syndrome]


def segments(prints: np.ndarray) -> list[np.ndarray]:
    prints = prints.astype(np.uint64)
    low = np.uint64((1 << 21) - 1)
    return [(prints >> np.uint64(42)).astype(np.int64), (prints >> np.uint64(21) & low).astype(np.int64), (prints & low).astype(np.int64)]


def keys_of(prints: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """Keys for all links of up to 4 bits, and for each the place of its fingerprint."""
    parts = segments(prints)
    near = [code.indices(p) for p in parts]
    row = np.arange(len(prints))
    six = np.arange(6)
    keys, rows = [], []
    for k, (equal, other) in enumerate([(0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)]):
        index, many = near[other]
        use = many[:, None] | (six == 0)
        keys.append(((np.int64(k) << 34 | parts[equal][:, None] << 12) | index)[use])
        rows.append(np.broadcast_to(row[:, None], use.shape)[use])
    (a, am), (b, bm), (c, cm) = near
    use = (am[:, None] | (six == 0))[:, :, None, None] & (bm[:, None] | (six == 0))[:, None, :, None] & (cm[:, None] | (six == 0))[:, None, None, :]
    keys.append((np.int64(7) << 36 | a[:, :, None, None] << 24 | b[:, None, :, None] << 12 | c[:, None, None, :])[use])
    rows.append(np.broadcast_to(row[:, None, None, None], use.shape)[use])
    return np.concatenate(keys), np.concatenate(rows)


class Forest:
    """Union-find over fingerprints; `join` says whether the link was needed."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (up := self.parent.get(x, x)) != x:
            path.append(x)
            x = up
        for p in path:
            self.parent[p] = x
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


class Rule:
    """When two fingerprints are linked: their bits differ in at most `max_bits` places, and with those of the second
    fingerprint in at most `max_both`. Without a second fingerprint it is 0 for all."""

    def __init__(self, max_bits: int, max_both: int | None = None):
        self.max_bits, self.max_both = max_bits, max_bits if max_both is None else max_both

    def near(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        differ = np.bitwise_count(x ^ y)
        return (differ[..., 0] <= self.max_bits) & (differ.sum(-1) <= self.max_both)


def small_groups(values: np.ndarray, first: np.ndarray, ends: np.ndarray, rule: Rule) -> list[np.ndarray]:
    """Linked pairs of the groups of up to `SMALL` rows (fingerprint, second), all compared at once."""
    size = ends - first
    first, size = first[(size > 1) & (size <= SMALL)], size[(size > 1) & (size <= SMALL)]
    out = []
    for step in range(1, SMALL):
        for at in range(SMALL - step):
            left = first[size > at + step] + at
            near = left[rule.near(values[left], values[left + step])]
            if len(near):
                out += list(np.unique(np.stack([values[near, 0], values[near + step, 0]], 1), axis=0))
    return out


def links_in(group: np.ndarray, forest: Forest, rule: Rule) -> list[tuple[int, int]]:
    """Verified links among rows (fingerprint, second) with one key, those only that join two trees. Each row is
    compared with those not reached yet, which in a cluster are soon few."""
    group = np.unique(group, axis=0)
    if len(group) < 2 or len({forest.root(x) for x in group[:, 0].tolist()}) == 1:
        return []
    out, rest = [], group
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = rule.near(rest, x)
            if near.any():
                found, rest = rest[near], rest[~near]
                queue.extend(found)
                out += [(int(x[0]), y) for y in found[:, 0].tolist() if forest.join(int(x[0]), y)]
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seeds: tuple[int, ...] = (SEED,), text: str = "text") -> DataFrame:
    """`docs` with the fingerprints `fp` and `fp2` of each row, as signed 64-bit numbers; `fp2` is 0 for one seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t, shingle, seeds) for at in range(0, batch.num_rows, 1000) for t in raw_texts(batch.column(text).slice(at, 1000))]
            pairs = np.array(made if len(seeds) > 1 else [(m, 0) for m in made], np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=[*batch.schema.names, "fp", "fp2"])

    return docs.mapInArrow(run, docs.withColumns({c: F.lit(0).cast("long") for c in ("fp", "fp2")}).schema)


def fingerprint_links(nodes: DataFrame, max_bits: int = MAX_BITS, max_both: int | None = None) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints `fp` of `nodes` (fp, fp2) as all their links of up to
    `max_bits`, at most `MAX_BITS`, do. See `Rule` for `max_both`."""
    rule = Rule(max_bits, max_both)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            prints, second = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "fp2"))
            for at in range(0, len(prints), 4096):
                keys, rows = keys_of(prints[at : at + 4096].view(np.uint64), code)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[at + rows]), pa.array(second[at + rows])], names=["key", "fp", "fp2"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        open_key, held = None, []
        kinds = pa.schema([("u", pa.int64()), ("v", pa.int64())])

        def settled(pairs: list[np.ndarray], groups: list[np.ndarray]) -> pa.RecordBatch:
            got = [(int(x), int(y)) for x, y in pairs if forest.join(int(x), int(y))]
            got += [p for g in groups for p in links_in(g, forest, rule)]
            ends = np.array(got, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], schema=kinds)

        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            values = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "fp2")], 1).view(np.uint64)
            if not len(keys):
                continue
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            ends = np.append(first[1:], len(keys))
            done = []
            if open_key is not None and keys[0] == open_key:
                held.append(values[: ends[0]])
                first, ends = first[1:], ends[1:]
                if not len(first):
                    continue
            if held:
                done.append(np.concatenate(held))
            open_key, held = keys[-1], [values[first[-1] : ends[-1]]]
            first, ends = first[:-1], ends[:-1]
            done += [values[first[k] : ends[k]] for k in np.flatnonzero(ends - first > SMALL).tolist()]
            yield settled(small_groups(values, first, ends, rule), done)
        if held:
            yield settled([], [np.concatenate(held)])

    # each fingerprint makes over a hundred keys, so their few bytes are dealt out to all tasks first; by fp itself they
    # already are, in as few tasks as their size asks for, and Spark would leave this step out
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = nodes.select("fp", "fp2").repartition(tasks, F.xxhash64("fp")).mapInArrow(spread, "key long, fp long, fp2 long")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(match, "u long, v long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp and component_id of every row."""
    prints = checkpointed(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "fp"))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.lit(0).cast("long").alias("fp2"))
    labels = label_components(fingerprint_links(nodes))
    labelled = nodes.join(labels, nodes["fp"] == labels["node"], "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = labelled.join(least, "label").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs u < v of `nodes` (node, fp) that connect all nodes whose fingerprints are equal or linked."""
    least = nodes.groupBy("fp").agg(F.min("node").alias("first"))
    equal = nodes.join(least, "fp").where("node <> first").select(F.col("first").alias("u"), F.col("node").alias("v"))
    links = fingerprint_links(least.select("fp", F.lit(0).cast("long").alias("fp2")))
    a, b = (least.select(F.col("fp").alias(n), F.col("first").alias(f"{n}_node")) for n in ("u", "v"))
    linked = links.join(a, "u").join(b, "v").select(F.least("u_node", "v_node").alias("u"), F.greatest("u_node", "v_node").alias("v"))
    return equal.unionByName(linked)


def keep_one_of_each(docs: DataFrame, shingle: int = PIPELINE_SHINGLE) -> DataFrame:
    """One row of `docs` for each group of near copies, which links of a Jaccard similarity of 0.8 or more make: the one
    with the smallest doc_id, then the smallest text; of equal rows, one. Texts without a word are one group. Rows with
    null ids are kept only if a group has no other.

    Golay codewords of SimHash fingerprints propose the closest pairs, prefixes of the sets all others that can be similar
    enough, as 64 bits cannot tell; every pair is verified on its whole sets.
    """
    absent, least_id, mark, seen = (fresh(docs.columns, n) for n in ("near_absent", "near_id", "near_mark", "near_rank"))
    # null ids get a number, so that rows are dealt out by plain columns, once for both the join and the window
    own = {absent: F.col("doc_id").isNull(), least_id: F.coalesce("doc_id", F.lit(0)), mark: F.xxhash64("text")}
    key = F.struct(*(c.alias(n) for n, c in zip(("absent", "id", "mark"), own.values(), strict=True))).alias("key")
    nodes = checkpointed(nodes_of(docs.select(key, "text"), shingle))
    labels = similar_components(docs.select("text"), nodes, shingle, checkpointed(fingerprint_pairs(nodes.where("n > 0")))).withColumnRenamed("node", "of")
    labelled = nodes.join(labels, nodes["node"] == labels["of"], "left").select("least", F.coalesce("label", "node").alias("label"))
    winners = labelled.groupBy("label").agg(F.min("least").alias("least")).select(*(F.col(f"least.{n}").alias(c) for n, c in zip(("absent", "id", "mark"), own, strict=True)))
    kept = docs.withColumns(own).join(winners, [absent, least_id, mark], "left_semi")
    # equal rows that won together: only such rows share id and text, so the window holds copies of one row
    order = Window.partitionBy(absent, least_id, mark).orderBy(mark)
    return kept.withColumn(seen, F.row_number().over(order)).where(F.col(seen) == 1).select(*docs.columns)


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

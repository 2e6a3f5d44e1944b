"""Texts whose sets of word shingles have a Jaccard similarity of 0.8 or more, all of them, by prefixes of the sets.

The shingles of all texts have one order. If two sets of sizes x and y have a similarity of 0.8 or more, the first
x - ceil(0.8 x) + 1 shingles of the one and the first y - ceil(0.8 y) + 1 of the other have one in common, and from the
first that they share on, enough are left in both. Only these prefixes are shuffled; pairs that meet are verified on
their whole sets. Any order gives the same links; here shingles that a sample shows to be common come last, so that few
texts meet at one of them.

Where many texts meet at a shingle, each is first verified against one of them, another one at each shingle; the pairs
still in different components after that are then verified too. So a large group of near copies costs no square, and
no link between two components is left out. Before sets are shuffled, counts of their shingles in parts of the range of
hashes, a fraction of a byte a shingle, rule out most pairs that are not similar enough. Sets are of 64-bit hashes, and
equal sets are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FOLD_ASCII, SPACED, joined, map_lean, mix, spans_of_words, text_blocks, window_hashes, window_rows, word_hashes
from .components import checkpointed, label_components

#: Groups at one shingle up to this size are compared pair by pair at once.
SMALL = 6
#: One text in this many is looked at for common shingles; how often one must be seen there; the most that are told.
SAMPLE, SEEN, TOLD = 16, 3, 200_000
#: Shingles that a part of the range of hashes holds on average, at least, where those of a set are counted.
IN_PART = 2
#: Words of 64 bits that tell tasks which sets are asked for, a power of 2: 2 MB.
ASKED = 1 << 18
#: Bytes of text that are cut into shingles at once.
BLOCK = 1 << 20
_FOLD = np.frombuffer(FOLD_ASCII, np.uint8)


def shingle_sets(batch: pa.RecordBatch, name: str, size: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its lower-cased word shingles; a text with fewer words is one."""
    for part, offsets, data in text_blocks(batch, name, BLOCK):
        data = _FOLD[data]
        starts, ends, words = spans_of_words(offsets, data, SPACED)
        own = word_hashes(data, starts, ends)
        values = window_hashes(own, size)[window_rows(words, size)]
        count = np.diff(words)
        cuts = np.concatenate([[0], np.cumsum(np.maximum(count - size + 1, 0))])
        for k in range(part.num_rows):
            if 0 < count[k] < size:
                yield joined(window_hashes(own[words[k] : words[k + 1]], int(count[k])), count[k : k + 1].astype(np.uint64))
            else:
                yield np.unique(values[cuts[k] : cuts[k + 1]])


def node_of(shingles: np.ndarray) -> int:
    """Identity of a set, as a signed number."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes())).view(np.int64))


def simhash(hashes: np.ndarray) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half of the hashes."""
    hashes, bits = hashes.astype(">u8"), np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big")


def _each(texts: DataFrame, size: int, made, schema: str) -> DataFrame:
    """`made` of the sets of each batch of `texts` (text), as a record batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield made(part, list(shingle_sets(part, "text", size)))

    return map_lean(texts, run, schema)


def part_counts(shingles: np.ndarray) -> np.ndarray:
    """How many shingles are in each of equal parts of the range of hashes, a power of 2 that grows with the set. 255
    stands for more, too."""
    bits = max(0, (len(shingles) // IN_PART).bit_length() - 1)
    part = (shingles >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(shingles), np.int64)
    return np.minimum(np.bincount(part, minlength=1 << bits), 255).astype(np.uint8)


def nodes_of(docs: DataFrame, size: int) -> DataFrame:
    """node, n (its shingles), counts (of their parts), fp (their SimHash, as a signed number) and least, the smallest key that
    has it, from `docs` (key, text)."""
    kind = docs.schema["key"].dataType.simpleString()

    def made(part: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        counts = pa.array([part_counts(s).tobytes() for s in sets], pa.binary())
        prints = pa.array(np.array([simhash(s) for s in sets], np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([part.column("key"), pa.array([node_of(s) for s in sets], pa.int64()), pa.array(list(map(len, sets)), pa.int64()), counts, prints], names=["key", "node", "n", "counts", "fp"])

    each = _each(docs, size, made, f"key {kind}, node long, n long, counts binary, fp long")
    return each.groupBy("node").agg(F.min("key").alias("least"), F.first("n").alias("n"), F.first("counts").alias("counts"), F.first("fp").alias("fp"))


def asked_bits(nodes: DataFrame) -> np.ndarray:
    """Bits, `ASKED` words of them at any number of nodes, of which each of `nodes` (node) sets one."""
    word = F.shiftright("node", 6).bitwiseAND(ASKED - 1).cast("int").alias("word")
    got = nodes.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, CAST(node & 63 AS INT))")).alias("bits")).toPandas()
    bits = np.zeros(ASKED, np.int64)
    bits[got["word"]] = got["bits"]
    return bits


def sets_of(texts: DataFrame, size: int, bits: np.ndarray | None = None) -> DataFrame:
    """node and shingles of each text; with `bits`, of all texts whose node has its bit set."""

    def made(part: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        if bits is not None:
            sets = [s for s in sets if bits[(n := node_of(s)) >> 6 & ASKED - 1] >> (n & 63) & 1]
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=["node", "shingles"])

    return _each(texts, size, made, "node long, shingles array<long>")


def common_shingles(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that come often in a sample of the texts, sorted, and how often. They only set the order."""
    some = sets_of(texts.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0), size).dropDuplicates(["node"])
    seen = some.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") >= SEEN)
    got = sorted((r["s"] & (1 << 64) - 1, r["n"]) for r in seen.orderBy(F.desc("n"), "s").limit(TOLD).collect())
    return np.array([g[0] for g in got], np.uint64), np.array([g[1] for g in got], np.int64)


def prefixes(texts: DataFrame, size: int) -> DataFrame:
    """key (a shingle), node and mark (size of the set and place of the shingle) for the prefix of each set."""
    common, often = common_shingles(texts, size)

    def made(part: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        out, done = [np.zeros((3, 0), np.int64)], set()
        for s in sets:
            n, node = len(s), node_of(s)
            if not n or node in done:
                continue
            done.add(node)
            if len(common):
                at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                rank = np.where(common[at] == s, often[at], 0)
                if rank.any():
                    s = s[np.lexsort((s, rank))]
            reach = n - (4 * n + 4) // 5 + 1
            out.append(np.stack([s[:reach].view(np.int64), np.full(reach, node), (n << 32) + np.arange(reach)]))
        return pa.RecordBatch.from_arrays(list(map(pa.array, np.concatenate(out, 1))), names=["key", "node", "mark"])

    return _each(texts, size, made, "key long, node long, mark long")


def _can_be(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether two sets with these marks can be similar enough, if the shingle is the first that they share."""
    low = (1 << 32) - 1
    left = np.minimum((x >> 32) - (x & low), (y >> 32) - (y & low))
    return 9 * left >= 4 * ((x >> 32) + (y >> 32))


def _by_key(rows: DataFrame, columns: list[str], made, schema: str) -> DataFrame:
    """`made` of all rows (as one array, a line for each column) of one or more whole keys, the first column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            block = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
            last = int(np.searchsorted(block[0], block[0, -1]))
            if not last and held and held[0][0, -1] == block[0, 0]:
                held.append(block)
                continue
            whole, held = np.concatenate([*held, block[:, :last]], 1), [block[:, last:]]
            yield made(whole)
        if held:
            yield made(np.concatenate(held, 1))

    return map_lean(rows.select(*columns).repartition("key").sortWithinPartitions("key", "node"), run, schema)


def _meet(rows: np.ndarray) -> pa.RecordBatch:
    """Pairs u, v to verify; and of keys with more than `SMALL` nodes, which have one pair for each node, key, node (as
    u) and mark."""
    fresh = np.ones(rows.shape[1], bool)
    fresh[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(0)
    keys, nodes, marks = rows = rows[:, fresh]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(keys)))
    own = np.repeat(sizes, sizes)
    left, right = [], []
    for step in range(1, SMALL):
        at = np.flatnonzero((keys[:-step] == keys[step:]) & (own[:-step] <= SMALL))
        left.append(at)
        right.append(at + step)
    for at, n in zip(first[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        # in the text that others were made from, fewest shingles of its own come before a shared one
        place, turn = marks[at : at + n] & (1 << 32) - 1, mix((nodes[at : at + n] ^ keys[at]).view(np.uint64))
        left.append(np.full(n, at + int(np.lexsort((turn, place))[0])))
        right.append(np.arange(at, at + n))
    x, y = np.concatenate(left), np.concatenate(right)
    use = _can_be(marks[x], marks[y]) & (nodes[x] != nodes[y])
    u, v = nodes[x[use]], nodes[y[use]]
    pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1) if len(u) else np.zeros((2, 0), np.int64)
    many = rows[:, own > SMALL]
    none = lambda n: pa.nulls(n, pa.int64())
    n, m = pairs.shape[1], many.shape[1]
    columns = [(none(n), many[0]), (pairs[0], many[1]), (pairs[1], none(m)), (none(n), many[2])]
    return pa.RecordBatch.from_arrays([pa.concat_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in two]) for two in columns], names=["key", "u", "v", "mark"])


def _still_apart(rows: np.ndarray) -> pa.RecordBatch:
    """Pairs of nodes at one key that have different labels."""
    out = [np.zeros((2, 0), np.int64)]
    edges = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])).tolist()
    for at, to in zip(edges, [*edges[1:], rows.shape[1]], strict=True):
        _, nodes, marks, labels = rows[:, at:to]
        kinds, counts = np.unique(labels, return_counts=True)
        # every pair of different labels has a node outside the largest one
        for k in np.flatnonzero(labels != kinds[counts.argmax()]).tolist() if len(kinds) > 1 else ():
            near = nodes[(labels != labels[k]) & _can_be(marks, marks[k])]
            out.append(np.stack([np.minimum(near, nodes[k]), np.maximum(near, nodes[k])]))
    u, v = np.concatenate(out, 1)
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def most_shared(x: np.ndarray, y: np.ndarray) -> int:
    """Most shingles that sets with these counts can share: in each part, as many as the smaller count."""
    if len(x) < len(y):
        x, y = y, x
    full = x.max() == 255 or y.max() == 255
    x = x.reshape(len(y), -1).sum(1, dtype=np.int64)
    return (1 << 62) if full else int(np.minimum(x, y).sum())


def possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of `pairs` (u, v), those that can be similar enough by the counts of their shingles in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [[np.frombuffer(c, np.uint8) for c in batch.column(n).to_pylist()] for n in ("u_counts", "v_counts")]
            both = batch.column("both").to_numpy(zero_copy_only=False)
            shared = np.array([most_shared(x, y) for x, y in zip(*counts, strict=True)], np.int64)
            yield batch.select(["u", "v"]).filter(pa.array(shared >= (4 * both + 8) // 9))

    a, b = (nodes.select(F.col("node").alias(n), F.col("counts").alias(f"{n}_counts"), F.col("n").alias(f"{n}_n")) for n in ("u", "v"))
    met = pairs.join(a, "u").join(b, "v").select("u", "v", "u_counts", "v_counts", (F.col("u_n") + F.col("v_n")).alias("both"))
    return map_lean(met, run, "u long, v long")


def verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """Of `pairs` (u, v), those whose sets have a similarity of 0.8 or more."""
    pairs = checkpointed(possible(pairs.distinct(), nodes))
    bits = asked_bits(pairs.select(F.explode(F.array("u", "v")).alias("node")))
    # sets that no pair asks for can be among them; the joins drop these
    sets = sets_of(texts, size, bits).dropDuplicates(["node"])
    a, b = (sets.select(F.col("node").alias(n), F.col("shingles").alias(f"{n}_set")) for n in ("u", "v"))
    both = F.size("u_set") + F.size("v_set")
    return pairs.join(a, "u").join(b, "v").where(9 * F.size(F.array_intersect("u_set", "v_set")) >= 4 * both).select("u", "v")


def similar_components(texts: DataFrame, nodes: DataFrame, size: int, proposed: DataFrame) -> DataFrame:
    """(node, label) of every one of `nodes` (as `nodes_of` makes them of `texts`) that has a link: label is the
    smallest node that links lead to. `proposed`: pairs (u, v) to verify that were found another way; the prefixes find all
    that these leave out."""
    met = checkpointed(_by_key(prefixes(texts, size), ["key", "node", "mark"], _meet, "key long, u long, v long, mark long"))
    links = checkpointed(verified(met.where("mark IS NULL").select("u", "v").unionByName(proposed), texts, nodes, size))
    labels = label_components(links)
    many = met.where("mark IS NOT NULL").select("key", F.col("u").alias("node"), "mark")
    if many.isEmpty():
        return labels
    labelled = many.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    apart = checkpointed(_by_key(labelled, ["key", "node", "mark", "label"], _still_apart, "u long, v long").distinct())
    if apart.isEmpty():
        return labels
    return label_components(links.unionByName(verified(apart, texts, nodes, size)))

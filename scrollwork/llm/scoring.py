"""Document scores by masked pseudo-likelihood.

Every word is counted, over all documents. The most frequent words are known by name; each other word is one of a few
tokens by its shape (digits, letters and digits, other scripts, short, middling and long words). A network, written and
trained in numpy, sees the two tokens on either side and predicts the one between: a class of tokens first, then the
token within its class, both from the same hidden layer, so every token's probability depends on its context. A word
without a name then has its counted share among the words of its shape; all counts are kept, in a table, of which every
task holds the `LISTED` highest and the rest is joined. The summed logarithms of these conditional probabilities score a document.

Training goes through all documents once, and every word is predicted. Documents are dealt out to shards, as many as
their words ask for, and to rounds by hashes of their own; in each round every shard starts from the same network, goes
through its documents in the order of their hashes, and the networks are averaged by words seen. Averages are of whole
numbers and shards depend on the documents alone, so neither tasks nor their order change the network.

What is left coarser: words beyond the `NAMED` most frequent are not told apart as context, and among words of one shape
only counts tell them apart. Words are 64-bit hashes of their bytes.

Defined results: a null text or one without a word has 0 tokens, score 0 and a null mean; every row is answered,
repeated ones each, equal texts alike; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FOLD_ALNUM, spans_of_words, table, text_blocks, word_hashes
from .components import checkpointed

#: Words known by name, and about how many classes these have.
NAMED, CLASSES = 4096, 48
#: Words, at most, whose counted shares every task holds, 12 bytes each; those of the rest are joined.
LISTED = 1 << 18
#: Shapes of words: all digits, digits and letters, non-ASCII; else up to 4, up to 8, more letters.
SHAPES = 6
#: Words to either side, and width of the hidden layer.
REACH, HIDDEN = 2, 16
#: Rounds, words of a shard, shards of a task where there are many, words of a step, step size.
ROUNDS, SHARD, TOGETHER, BATCH, RATE = 4, 1 << 21, 2, 8192, 0.2
#: Different words that a task counts before it hands the counts on; words scored at once.
COUNTED, BLOCK = 400_000, 1 << 15
#: Bytes of text that are spelled at once.
TEXT_BLOCK = 1 << 20
#: Pieces in which networks travel, and steps to one when they are added up.
PIECES, FIXED = 32, 1 << 24
_FOLD = np.frombuffer(FOLD_ALNUM, np.uint8)
_WORD = np.zeros(256, bool)
_WORD[np.unique(_FOLD)] = True
_WORD[0x20] = False
_DIGIT = np.zeros(256, np.int32)
_DIGIT[0x30:0x3A] = 1


def hashed_words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shape of every word, as `words_alnum` finds them, and the words before each text."""
    data = _FOLD[data]
    starts, ends, per_text = spans_of_words(offsets, data, _WORD)
    digits, other = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)]) for x in (_DIGIT[data], data >= 0x80))
    size, digits, other = ends - starts, digits[ends] - digits[starts], other[ends] - other[starts]
    shape = np.select([digits == size, digits > 0, other > 0, size <= 4, size <= 8], [0, 1, 2, 3, 4], 5)
    return word_hashes(data, starts, ends).view(np.int64), shape, per_text


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """word (hash), shape, n over all rows. Counted in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def combined() -> tuple[np.ndarray, ...]:
            word, shape, n = (np.concatenate([h[k] for h in held]) for k in range(3))
            word, first, inverse = np.unique(word, return_index=True, return_inverse=True)
            return word, shape[first], np.bincount(inverse, n).astype(np.int64)

        def handed_on() -> pa.RecordBatch:
            word, shape, n = combined()
            return pa.RecordBatch.from_arrays([pa.array(word), pa.array(shape.astype(np.int32)), pa.array(n)], names=["word", "shape", "n"])

        for batch in batches:
            for _, offsets, data in text_blocks(batch, text, TEXT_BLOCK):
                word, shape, _ = hashed_words(offsets, data)
                word, first, n = np.unique(word, return_index=True, return_counts=True)
                held.append((word, shape[first], n))
                size += len(word)
                if size >= 2 * COUNTED:
                    held = [combined()]
                    size = len(held[0][0])
                    if size >= COUNTED:
                        yield handed_on()
                        held, size = [], 0
        if size:
            yield handed_on()

    return docs.select(text).mapInArrow(run, "word long, shape int, n long").groupBy("word").agg(F.first("shape").alias("shape"), F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, size: int) -> DataFrame:
    """The words, at most `size`, whose counts lie in the highest steps of a histogram (eight steps to a doubling) that
    hold no more words. So ties stay together and the driver gets no word that it does not use."""
    step = F.floor(F.log2("n") * 8).cast("long")
    seen, least = 0, 1 << 62
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        seen += r["count"]
        if seen > size:
            break
        least = r["step"]
    return counts.where(step >= least)


@dataclass
class Lexicon:
    """Tokens, most frequent first: the hashes of those that are words, sorted, with their tokens; the token and the
    count (of words without a name) of each shape; the edges of the classes, which are ranges of tokens; the logarithm of
    each class's share, and of each token's share in its class; the hashes of the most frequent words without a name,
    sorted, with the logarithms of their shares in their shapes; how many words there are."""

    words: np.ndarray
    tokens: np.ndarray
    shape_tokens: np.ndarray
    shape_counts: np.ndarray
    edges: np.ndarray
    class_logs: np.ndarray
    token_logs: np.ndarray
    listed: np.ndarray
    listed_logs: np.ndarray
    total: int

    def spelled(self, words: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token of each word, and whether it is a name."""
        at, known = _found(self.words, words)
        out = self.shape_tokens[shapes]
        out[known] = self.tokens[at[known]]
        return out, known


def _found(own: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words in sorted ones, and whether they are there."""
    if not len(own):
        return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
    at = np.minimum(np.searchsorted(own, words), len(own) - 1)
    return at, own[at] == words


def build_lexicon(counts: DataFrame, named: int = NAMED, classes: int = CLASSES, listed: int = LISTED) -> Lexicon:
    """From all counts; the driver gets the `listed` most frequent words, at most, and a number a shape. Those with names
    are the first of them, ties by word."""
    most = most_frequent(counts, listed).toPandas().sort_values(["n", "word"], ascending=[False, True])
    top = list(most[["word", "shape", "n"]][:named].itertuples(index=False, name=None))
    rest = most[named:].sort_values("word")
    shape_counts = np.zeros(SHAPES, np.int64)
    for r in counts.groupBy("shape").agg(F.sum("n").alias("n")).collect():
        shape_counts[r["shape"]] = r["n"]
    for _, shape, n in top:
        shape_counts[shape] -= n
    every = sorted([(-n, 0, w) for w, _, n in top] + [(-max(int(n), 1), 1, k) for k, n in enumerate(shape_counts)])
    words = sorted((w, t) for t, (_, kind, w) in enumerate(every) if not kind)
    shape_tokens = np.zeros(SHAPES, np.int64)
    for t, (_, kind, k) in enumerate(every):
        if kind:
            shape_tokens[k] = t
    n = np.array([-e[0] for e in every], np.float64)
    # classes of equal sums of roots: the most frequent tokens are classes of their own, the rarest ones share large ones
    reach = np.cumsum(np.sqrt(n))
    edges = np.unique(np.concatenate([[0], np.searchsorted(reach, reach[-1] * np.arange(1, classes) / classes), [len(n)]]))
    whole = np.add.reduceat(n, edges[:-1])
    token_logs = np.log(n) - np.log(np.repeat(whole, np.diff(edges)))
    listed_logs = np.log(rest["n"].to_numpy(np.float64) / (shape_counts + 1)[rest["shape"].to_numpy(np.int64)])
    return Lexicon(np.array([w for w, _ in words], np.int64), np.array([t for _, t in words], np.int64), shape_tokens, shape_counts, edges, np.log(whole / whole.sum()), token_logs, rest["word"].to_numpy(np.int64), listed_logs.astype(np.float32), int(n.sum()))


def spell(docs: DataFrame, lexicon: Lexicon, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, k1 and k2 (a 128-bit hash of the text), n_tokens, tokens (little-endian 16-bit numbers), listed (the summed
    log-shares of the listed words) and rare (word and n, of the words that are neither named nor listed) of each row."""
    kinds = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in text_blocks(batch, "text", TEXT_BLOCK):
                words, shapes, per_text = hashed_words(offsets, data)
                tokens, known = lexicon.spelled(words, shapes)
                doc = np.repeat(np.arange(len(per_text) - 1), np.diff(per_text))
                word, doc = words[~known], doc[~known]
                at, known = _found(lexicon.listed, word)
                listed = np.bincount(doc[known], lexicon.listed_logs[at[known]], len(per_text) - 1)
                word, doc = word[~known], doc[~known]
                order = np.lexsort((word, doc))
                word, doc = word[order], doc[order]
                first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])])) if len(word) else np.zeros(0, np.int64)
                times = np.diff(np.append(first, len(word)))
                ends = np.searchsorted(doc[first], np.arange(len(per_text))).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(word[first]), pa.array(times.astype(np.int32))], names=["word", "n"]))
                raw, own = data.tobytes(), tokens.astype("<u2").tobytes()
                keys = np.array([divmod(xxhash.xxh3_128_intdigest(raw[a:b]), 1 << 64) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.uint64).reshape(-1, 2).view(np.int64)
                cuts = (2 * per_text).tolist()
                texts = [own[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(np.diff(per_text)), pa.array(texts, pa.binary()), pa.array(listed, pa.float64()), rare.cast(kinds)], names=["doc_id", "k1", "k2", "n_tokens", "tokens", "listed", "rare"])

    kind = docs.schema[doc_id].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(run, f"doc_id {kind}, k1 long, k2 long, n_tokens long, tokens binary, listed double, rare array<struct<word: long, n: int>>")


class Network:
    """Tokens around -> hidden layer -> class, and token within the class. One token more stands for the edge of a text.
    A new one gives each token its share in the corpus."""

    def __init__(self, lexicon: Lexicon, flat: np.ndarray | None = None, seed: int = 10):
        self.edges, tokens = lexicon.edges, len(lexicon.token_logs)
        self.classes = np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges))
        shapes = [(2 * REACH, tokens + 1, HIDDEN), (1, HIDDEN), (len(self.edges) - 1, HIDDEN), (len(self.edges) - 1, 1), (tokens, HIDDEN), (tokens, 1)]
        if flat is None:
            rng = np.random.default_rng(seed)
            parts = [rng.normal(0, 0.1, shapes[0]), np.zeros(shapes[1]), np.zeros(shapes[2]), lexicon.class_logs, np.zeros(shapes[4]), lexicon.token_logs]
            flat = np.concatenate([p.ravel() for p in parts])
        self.flat = flat.astype(np.float32)
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
        self.embed, self.bias, self.class_out, self.class_bias, self.token_out, self.token_bias = (p.reshape(s) for p, s in zip(np.split(self.flat, cuts), shapes, strict=True))

    def hidden(self, context: np.ndarray) -> np.ndarray:
        h = self.bias + self.embed[0][context[0]]
        for k in range(1, 2 * REACH):
            h += self.embed[k][context[k]]
        return np.tanh(h, out=h)

    def _within(self, target: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """First and last token, and rows, of each class that has several tokens and is a target's."""
        own = self.classes[target]
        order = np.argsort(own, kind="stable")
        ends = np.searchsorted(own[order], np.arange(len(self.edges)))
        for c in np.flatnonzero((np.diff(ends) > 0) & (np.diff(self.edges) > 1)).tolist():
            yield int(self.edges[c]), int(self.edges[c + 1]), order[ends[c] : ends[c + 1]]

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        h = self.hidden(context)
        out = _log_softmax(h @ self.class_out.T + self.class_bias[:, 0], self.classes[target])[0]
        for lo, hi, rows in self._within(target):
            out[rows] += _log_softmax(h[rows] @ self.token_out[lo:hi].T + self.token_bias[lo:hi, 0], target[rows] - lo)[0]
        return out


class Trainer:
    """Steps of one shard: gradients of the summed log-probabilities, each row of parameters with a step size that falls
    with what it has moved."""

    def __init__(self, network: Network, rate: float):
        self.net, self.rate = network, rate
        n = network
        self.moved = {k: np.full(p.shape[:-1], 1e-6, np.float32) for k, p in (("embed", n.embed), ("bias", n.bias), ("class_out", n.class_out), ("class_bias", n.class_bias), ("token_out", n.token_out), ("token_bias", n.token_bias))}

    def _move(self, name: str, at, gradient: np.ndarray) -> None:
        moved = self.moved[name]
        moved[at] += np.einsum("ij,ij->i", gradient, gradient) / np.float32(gradient.shape[1])
        gradient *= (np.float32(self.rate) / np.sqrt(moved[at]))[:, None]
        getattr(self.net, name)[at] -= gradient

    def step(self, context: np.ndarray, target: np.ndarray) -> float:
        """One step; the log-probability of the targets before it, summed."""
        net, n = self.net, np.float32(len(target))
        h = net.hidden(context)
        logs, z = _log_softmax(h @ net.class_out.T + net.class_bias[:, 0], net.classes[target])
        back, total = z @ net.class_out, float(logs.sum())
        self._move("class_out", slice(None), z.T @ h / n)
        self._move("class_bias", slice(None), z.sum(0)[:, None] / n)
        for lo, hi, rows in net._within(target):
            own = h[rows]
            logs, z = _log_softmax(own @ net.token_out[lo:hi].T + net.token_bias[lo:hi, 0], target[rows] - lo)
            total += float(logs.sum())
            back[rows] += z @ net.token_out[lo:hi]
            self._move("token_out", slice(lo, hi), z.T @ own / n)
            self._move("token_bias", slice(lo, hi), z.sum(0)[:, None] / n)
        back *= (1 - h * h) / n
        self._move("bias", slice(None), back.sum(0)[None])
        columns, tokens = np.ascontiguousarray(back.T, np.float64), net.embed.shape[1]
        for k in range(2 * REACH):
            sums = np.stack([np.bincount(context[k], c, tokens) for c in columns], 1)
            seen = np.flatnonzero(np.bincount(context[k], minlength=tokens))
            self._move("embed", (k, seen), sums[seen].astype(np.float32))
        return total


def _log_softmax(z: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of each row's target, and the probabilities less one at the target."""
    rows = np.arange(len(z))
    z -= z.max(1, keepdims=True)
    own = z[rows, target].astype(np.float64)
    np.exp(z, out=z)
    sums = z.sum(1, keepdims=True)
    z /= sums
    z[rows, target] -= 1
    return own - np.log(sums[:, 0].astype(np.float64)), z


def contexts(tokens: list[np.ndarray], edge: int) -> tuple[np.ndarray, np.ndarray]:
    """For each token of the texts a row for each place around it, left to right, and the tokens."""
    gap = np.full(REACH, edge)
    wide = np.concatenate([gap, *(x for t in tokens for x in (t, gap))])
    own = np.concatenate([np.arange(len(t)) for t in tokens]) + np.repeat(np.cumsum([0, *(len(t) + REACH for t in tokens)])[:-1], list(map(len, tokens)))
    return np.stack([wide[own + k] for k in range(2 * REACH + 1) if k != REACH]), wide[own + REACH]


def _read(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(t, "<u2").astype(np.int64) for t in column.to_pylist()]


def train(spelled: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS, epochs: int = 1, losses: list[float] | None = None) -> Network:
    """The network after all rows, each `epochs` times; the driver gets the parameters, added up, once a round. `losses`:
    gets the mean negative log-probability of each round's tokens before they were learnt."""
    network, edge = Network(lexicon), len(lexicon.token_logs)
    shards = max(1, -(-lexicon.total // SHARD))
    mark = lambda seed, n: F.pmod(F.xxhash64("k1", "k2", "doc_id", F.lit(seed)), F.lit(n))
    for r in range(rounds * epochs):
        start, rate = network.flat, RATE / (1 + r) ** 0.5

        def run(batches: Iterator[pa.RecordBatch], start=start, rate=rate) -> Iterator[pa.RecordBatch]:
            total, loss, all_seen = np.zeros(len(start), np.int64), 0.0, 0
            shard, own, seen = None, None, 0
            held: list[np.ndarray] = []
            size = 0

            def learnt() -> None:
                nonlocal held, size, seen, loss
                context, target = contexts(held, edge)
                for at in range(0, len(target), BATCH):
                    loss -= own.step(context[:, at : at + BATCH], target[at : at + BATCH])
                seen, held, size = seen + len(target), [], 0

            def closed() -> None:
                nonlocal total, all_seen
                if size:
                    learnt()
                if seen:
                    total += np.rint(own.net.flat.astype(np.float64) * FIXED).astype(np.int64) * -(-seen // BATCH)
                    all_seen += -(-seen // BATCH)

            for batch in batches:
                for s, t in zip(batch.column("shard").to_pylist(), _read(batch.column("tokens")), strict=True):
                    if s != shard:
                        if own is not None:
                            closed()
                        shard, own, seen, held, size = s, Trainer(Network(lexicon, start), rate), 0, [], 0
                    held.append(t)
                    size += len(t)
                    if size >= BLOCK:
                        learnt()
            if own is not None:
                closed()
            if all_seen:
                for k, piece in enumerate(np.array_split(total, PIECES)):
                    yield pa.RecordBatch.from_pydict({"piece": [k], "values": [piece.tobytes()], "steps": [all_seen], "loss": [loss]}, _PIECE)

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list] = {}
            for batch in batches:
                for k, v, n, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    s = sums.setdefault(k, [0, 0, 0.0])
                    sums[k] = [s[0] + np.frombuffer(v, np.int64), s[1] + n, s[2] + x]
            for k, (v, n, x) in sums.items():
                yield pa.RecordBatch.from_pydict({"piece": [k], "values": [v.tobytes()], "steps": [n], "loss": [x]}, _PIECE)

        slice_ = spelled.where((mark(1, rounds) == r % rounds) & (F.col("n_tokens") > 0)).select(mark(2, shards).alias("shard"), "k1", "k2", "tokens")
        kind = "piece int, values binary, steps long, loss double"
        # tasks add up the networks of their shards, so there are fewer to send
        parts = slice_.repartition(max(min(shards, 8), shards // TOGETHER), "shard").sortWithinPartitions("shard", "k1", "k2").mapInArrow(run, kind).repartition("piece").mapInArrow(added, kind)
        got = sorted(parts.collect(), key=lambda x: x["piece"])
        if got:
            network = Network(lexicon, np.concatenate([np.frombuffer(g["values"], np.int64) for g in got]) / (FIXED * float(got[0]["steps"])))
            if losses is not None:
                losses.append(got[0]["loss"])
    return network


_PIECE = pa.schema([("piece", pa.int32()), ("values", pa.binary()), ("steps", pa.int64()), ("loss", pa.float64())])


def named_scores(spelled: DataFrame, lexicon: Lexicon, network: Network) -> DataFrame:
    """k1, k2, named: the summed log-probabilities of the tokens, and log-shares of the listed words, of each text, one row
    a different text."""
    flat, edge = network.flat, len(lexicon.token_logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(lexicon, flat)
        for batch in batches:
            texts, sums, held, size = _read(batch.column("tokens")), [], [], 0
            for k, t in enumerate(texts):
                held.append(t)
                size += len(t)
                if size < BLOCK and k + 1 < len(texts):
                    continue
                context, target = contexts(held, edge)
                logs = np.concatenate([np.zeros(1), *(own.log_probabilities(context[:, at : at + BLOCK], target[at : at + BLOCK]) for at in range(0, len(target), BLOCK))])
                ends = np.cumsum([0, *map(len, held)])
                total = np.cumsum(logs)
                sums += (total[ends[1:]] - total[ends[:-1]]).tolist()
                held, size = [], 0
            sums = np.array(sums) + batch.column("listed").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), pa.array(sums, pa.float64())], names=["k1", "k2", "named"])

    each = spelled.where("n_tokens > 0").select("k1", "k2", "tokens", "listed").mapInArrow(run, "k1 long, k2 long, named double")
    return each.groupBy("k1", "k2").agg(F.max("named").alias("named"))


def rare_scores(spelled: DataFrame, lexicon: Lexicon, counts: DataFrame) -> DataFrame:
    """k1, k2, rare: the summed log-shares, among the words of their shape, of each text's words that are neither named nor
    listed. A word that was never counted has the share of one that was counted once."""
    whole = F.get(F.array(*[F.lit(int(n) + 1) for n in lexicon.shape_counts]), F.col("shape"))
    each = spelled.select("k1", "k2", F.explode("rare").alias("w")).select("k1", "k2", "w.word", "w.n").groupBy("k1", "k2", "word").agg(F.max("n").alias("times"))
    share = F.log(F.coalesce("n", F.lit(1))) - F.log(F.coalesce(whole, F.lit(int(lexicon.shape_counts.sum()) + 1)))
    return each.join(counts.select("word", "shape", "n"), "word", "left").groupBy("k1", "k2").agg(F.sum(F.col("times") * share).alias("rare"))


def score(spelled: DataFrame, lexicon: Lexicon, network: Network, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (summed) and mean_log_likelihood of each row. Texts are scored once, whatever
    their copies; a much-copied one is a skewed key of the last join only, which Spark splits."""
    texts = named_scores(spelled, lexicon, network).join(rare_scores(spelled, lexicon, counts), ["k1", "k2"], "left")
    texts = texts.select("k1", "k2", F.round(F.col("named") + F.coalesce("rare", F.lit(0.0)), 6).alias("total"))
    rows = spelled.select("doc_id", "k1", "k2", "n_tokens").join(texts, ["k1", "k2"], "left")
    return rows.select("doc_id", "n_tokens", F.coalesce("total", F.lit(0.0)).alias("log_likelihood"), F.when(F.col("n_tokens") > 0, F.col("total") / F.col("n_tokens")).alias("mean_log_likelihood"))


def op10_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = checkpointed(count_words(docs))
    lexicon = build_lexicon(counts)
    spelled = checkpointed(spell(docs, lexicon))
    return score(spelled, lexicon, train(spelled, lexicon), counts)

"""Masked pseudo-likelihood of texts under a bidirectional window network.

Each word is hidden in turn and predicted from REACH words on either side: each neighbour's class has its own embedding table
by position, their sum goes through tanh, and a softmax over the classes follows; a word's probability is its class's times
its share of the class. A text's score is the sum of the log probabilities of its words, and no word goes unpredicted.

Tokens are words in lower case, counted over all documents. The commonest have a class each, the others a class by their
last two letters (one for rare endings). The vocabulary holds as many of the commonest words as fit TOKENS; words of one
count are all in it or all out. The words beyond it are one class, and within it a word's probability is that of its
spelling, byte by byte from the two before (hashed to CONTEXTS), counted over all words beyond the vocabulary, or over those
that occur once if it holds all. So memory is bounded at any size of the corpus. Class shares set the biases that training
starts from.

The network is trained in numpy on every position of all documents once, in ROUNDS parts chosen by a hash of the text and the
position. Documents are dealt to shards of about SHARD words by a hash of their id and words, and come in the order of that
hash, so that the network does not depend on how the table is partitioned. Each shard trains from the same network; the
shards' networks are averaged, weighed by their positions, by an aggregation per parameter, after each part.

Edge cases: null and empty texts, and those without words, have 0 tokens, score 0 and mean 0; an empty corpus gives an
untrained network and no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cladeframe.llm.shared import coded_words, stash

TOKENS, CLASSES, HIDDEN, REACH, EVERY, ROUNDS = 1 << 18, 256, 24, 2, 1, 2
EDGE, OTHER = 0, 1
OFFSETS = [o for o in range(-REACH, REACH + 1) if o]
BLOCK, BATCHES, RATE = 2048, (16, 1024), 0.1
SHARD = 1 << 22
SAFE = 80  # exp of it is a finite float
STREAM = 1 << 17
CONTEXTS, NEW_BYTE = 4096, 0.1


def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of the words and a zero after each word, as its place in a table of contexts and bytes; and its word's number."""
    codes = np.frombuffer(("\0\0" + "".join(w + "\0\0" for w in words)).encode(), np.uint8).astype(np.int64)
    at = np.flatnonzero((codes != 0) | (np.concatenate([[0], codes[:-1]]) != 0))
    ends = codes[at] == 0
    return ((codes[at - 2] << 4 ^ codes[at - 1]) % CONTEXTS) * 256 + codes[at], np.cumsum(ends) - ends


@dataclass
class Words:
    """Each token's class and the log of its share of it; log probabilities of bytes after their contexts."""

    classes: np.ndarray
    within: np.ndarray
    spelling: np.ndarray

    @staticmethod
    def new(tokens: int = TOKENS, classes: int = CLASSES) -> Words:
        """Like words in like classes; edges and other words have their own."""
        of = np.concatenate([[EDGE, OTHER], 2 + np.arange(tokens - 2) % (classes - 2)]).astype(np.uint16)
        return Words(of, -np.log(np.bincount(of)[of]).astype(np.float32), Words.spelling_of(np.zeros(CONTEXTS * 256)))

    @staticmethod
    def spelling_of(counts: np.ndarray) -> np.ndarray:
        table = counts.reshape(CONTEXTS, 256) + NEW_BYTE
        return np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32).ravel()


def vocabulary(docs: DataFrame, tokens: int = TOKENS) -> tuple[dict[str, int], Words, np.ndarray]:
    """Tokens of the commonest words of all documents, what is known of them, and each class's share of all words; a bounded number of words comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, places, _ in coded_words(t.as_py() for batch in batches for t in batch.column(0)):
            yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(places, minlength=len(words)), pa.int64())], names=["word", "n"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CONTEXTS * 256)
        for batch in batches:
            if len(batch):
                places, owner = spelled(batch.column(0).to_pylist())
                counts += np.bincount(places, weights=batch.column(1).to_numpy()[owner], minlength=len(counts))
        places = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(counts[places].astype(np.int64))], names=["at", "n"])

    counts = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stash(counts, "word-counts")
    sizes = sorted(((r.n, r.words) for r in counts.groupBy("n").agg(F.count("*").alias("words")).collect()), reverse=True)
    total, held, least = sum(n * k for n, k in sizes), 0, 0
    for n, k in sizes:
        held += k
        if held > tokens - 2:
            least = n
            break
    top = counts.where(F.col("n") > least).toArrow()
    top = sorted(zip((-n for n in top["n"].to_pylist()), top["word"].to_pylist(), strict=True))
    singles, most = CLASSES // 2 - 2, CLASSES // 2 - 1
    ends: Counter[str] = Counter()
    for n, word in top[singles:]:
        ends[word[-2:]] -= n
    common = [e for _, e in sorted((-n, e) for e, n in ends.items())[:most]]
    class_of = {e: 2 + min(singles, len(top)) + k for k, e in enumerate(common)}
    rare = 2 + min(singles, len(top)) + len(common)
    classes = np.array([EDGE, OTHER, *(2 + k if k < singles else class_of.get(w[-2:], rare) for k, (_, w) in enumerate(top))], np.uint16)
    n = np.array([0, 0, *(-n for n, _ in top)], float)
    n[OTHER] = total - n.sum()
    sums = np.bincount(classes, weights=n)
    within = np.zeros(len(n), np.float32)
    within[2:] = np.log(n[2:] / sums[classes[2:]])
    spellings = np.zeros(CONTEXTS * 256)
    for r in counts.where(F.col("n") <= max(least, 1)).mapInArrow(spell, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        spellings[r["at"]] = r.n
    return {w: k + 2 for k, (_, w) in enumerate(top)}, Words(classes, within, Words.spelling_of(spellings)), sums / max(1, total)


def joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' classes one after the other with edges around each, and where each text starts."""
    edge = np.full(REACH, EDGE, np.uint16)
    starts = REACH + np.cumsum([0] + [len(t) + REACH for t in texts[:-1]])
    return np.concatenate([edge, *(x for t in texts for x in (t, edge))]), starts


@dataclass
class Network:
    class_tables: np.ndarray  # (offsets, classes, hidden)
    bias: np.ndarray
    class_out: np.ndarray  # (hidden, classes)
    class_bias: np.ndarray
    words: Words | None

    @staticmethod
    def new(words: Words | None = None, hidden: int = HIDDEN, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        words = words or Words.new()
        classes = int(words.classes.max()) + 1
        make = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return Network(make(len(OFFSETS), classes, hidden), np.zeros(hidden, np.float32), make(hidden, classes), np.zeros(classes, np.float32), words)

    @cached_property
    def tables(self) -> np.ndarray:
        """Embeddings by token: (offsets, tokens, hidden)."""
        return self.class_tables[:, self.words.classes]

    @cached_property
    def out(self) -> np.ndarray:
        """Output weights by token: (hidden, tokens)."""
        return self.class_out[:, self.words.classes]

    @cached_property
    def out_bias(self) -> np.ndarray:
        return self.class_bias[self.words.classes] + self.words.within

    def params(self) -> list[np.ndarray]:
        return [self.class_tables, self.bias, self.class_out, self.class_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.params()])

    def like(self, flat: np.ndarray) -> Network:
        parts, at = [], 0
        for x in self.params():
            parts.append(flat[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return Network(*parts, self.words)

    @cached_property
    def outer(self) -> np.ndarray:
        """Output weights, and the biases as a last row."""
        return np.concatenate([self.class_out, self.class_bias[None]])

    def hidden(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hidden values at the places, and a last column of ones."""
        total = np.repeat(self.bias[None], len(at), axis=0)
        for k, o in enumerate(OFFSETS):
            total += self.class_tables[k].take(flat.take(at + o), axis=0)
        out = np.ones((len(at), total.shape[1] + 1), np.float32)
        np.tanh(total, out=out[:, :-1])
        return out

    @staticmethod
    def logits(h: np.ndarray, outer: np.ndarray) -> np.ndarray:
        z = h @ outer
        if z.max(initial=0) > SAFE:
            z -= z.max(axis=1, keepdims=True)
        return z

    def log_probs(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probability of the class at each of the places."""
        z = self.logits(self.hidden(flat, at), self.outer)
        own = z[np.arange(len(at)), flat[at]]
        return own - np.log(np.exp(z, out=z).sum(axis=1))

    def train(self, streams: Iterable[tuple[np.ndarray, np.ndarray]], rate: float = RATE) -> tuple[Network, int]:
        """One pass of Adagrad over the streams' places, in batches that grow; a new network and the number of places."""
        net = self.like(self.flat())
        outer = net.outer
        learned = [net.class_tables, net.bias, outer]
        past = [np.full(x.shape, 1e-6, np.float32) for x in learned]
        tables = np.empty_like(net.class_tables)
        cells = np.arange(tables[0].size).reshape(tables[0].shape)
        done = 0
        for flat, places in streams:
            flat, first = flat.astype(np.intp), 0
            while first < len(places):
                at = places[first : first + min(max(done // 64, BATCHES[0]), BATCHES[1])]
                first += len(at)
                done += len(at)
                h = net.hidden(flat, at)
                p = net.logits(h, outer)
                np.exp(p, out=p)
                p *= 1 / (p.sum(axis=1, keepdims=True) * len(at))
                p[np.arange(len(at)), flat[at]] -= np.float32(1 / len(at))
                inner = (p @ outer[:-1].T) * (1 - h[:, :-1] ** 2)
                weights = inner.ravel().astype(float)
                for k, o in enumerate(OFFSETS):
                    tables[k] = np.bincount(cells.take(flat.take(at + o), axis=0).ravel(), weights=weights, minlength=cells.size).reshape(cells.shape)
                for x, g, s in zip(learned, (tables, inner.sum(axis=0), h.T @ p), past, strict=True):
                    s += g * g
                    x -= rate * g / np.sqrt(s)
        return Network(net.class_tables, net.bias, outer[:-1].copy(), outer[-1].copy(), self.words), done


def encoded(docs: DataFrame, known: dict[str, int], words: Words) -> DataFrame:
    """doc_id, n_tokens, within (log probability of the words in their classes), classes (packed) for each row."""
    shared = docs.sparkSession.sparkContext.broadcast((known, words))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words = shared.value
        for batch in batches:
            first = 0
            for names, places, lengths in coded_words(t.as_py() for t in batch.column(1)):
                names = names.to_pylist()
                ids = np.fromiter(map(known.get, names, repeat(OTHER)), dtype=np.int64, count=len(names))
                logs = words.within[ids].astype(float)
                rest = np.flatnonzero(ids == OTHER)
                if len(rest):
                    spelling, owner = spelled([names[i] for i in rest])
                    logs[rest] += np.bincount(owner, weights=words.spelling[spelling])
                ends = np.cumsum(lengths)
                within, some = np.zeros(len(lengths)), np.flatnonzero(lengths)
                if len(some):
                    within[some] = np.add.reduceat(logs[places], (ends - lengths)[some])
                offsets = np.concatenate([[0], 2 * ends]).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(words.classes[ids].astype("<u2")[places])])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(ends)), pa.array(lengths, pa.int64()), pa.array(within), packed], names=["doc_id", "n_tokens", "within", "classes"])
                first += len(ends)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, "doc_id long, n_tokens long, within double, classes binary")


def places_of(packed: bytes, n: int, every: int, rounds: int, round_: int) -> np.ndarray:
    """A text's positions for a round: one in `every`, of which each belongs to one round."""
    step = every * rounds
    return np.arange((xxh64_intdigest(packed, 3) + round_ * every) % step, n, step)


def streams(shard: pa.ChunkedArray, every: int, rounds: int, round_: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Joined texts of about STREAM words with their places for a round, in an order by lot."""
    rng = np.random.default_rng(round_)
    texts: list[np.ndarray] = []
    places: list[np.ndarray] = []
    waiting = 0

    def shuffled() -> tuple[np.ndarray, np.ndarray]:
        flat, starts = joined(texts)
        return flat, rng.permutation(np.concatenate([p + s for p, s in zip(places, starts, strict=True)]))

    for value in shard:
        packed = value.as_py()
        texts.append(np.frombuffer(packed, "<u2"))
        places.append(places_of(packed, len(texts[-1]), every, rounds, round_))
        waiting += len(texts[-1])
        if waiting >= STREAM:
            yield shuffled()
            texts.clear()
            places.clear()
            waiting = 0
    if texts:
        yield shuffled()


def fit(table: DataFrame, words: Words, shares: np.ndarray, every: int = EVERY, rounds: int = ROUNDS) -> Network:
    """The network after training on an encoded table."""
    net = Network.new(words)
    lot = F.xxhash64("doc_id", "classes")
    shards = max(1, -(-(table.agg(F.sum("n_tokens")).first()[0] or 0) // SHARD))
    dealt = table.where("n_tokens > 0").select(F.pmod(lot, F.lit(shards)).alias("shard"), lot.alias("lot"), "classes")
    net.class_bias[: len(shares)] = np.log(np.maximum(shares, 1e-6))

    def trainer(start: Network, round_: int) -> Callable[[pa.Table], pa.Table]:
        def part(shard: pa.Table) -> pa.Table:
            fitted, n = start.train(streams(shard.sort_by([("lot", "ascending"), ("classes", "ascending")])["classes"], every, rounds, round_))
            return pa.table({"n": pa.array([n], pa.int64()), "values": pa.array([fitted.flat().astype(float)], pa.list_(pa.float64()))})

        return part

    for round_ in range(rounds):
        part = trainer(replace(net, words=None), round_)
        parts = dealt.groupBy("shard").applyInArrow(part, "n long, values array<double>").where("n > 0").select("n", F.posexplode("values").alias("at", "value"))
        means = parts.groupBy("at").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("value")).toArrow().sort_by("at")
        if len(means):
            net = net.like(means["value"].to_numpy())
    return net


def train(docs: DataFrame, tokens: int = TOKENS, every: int = EVERY, rounds: int = ROUNDS) -> tuple[dict[str, int], Network]:
    known, words, shares = vocabulary(docs, tokens)
    return known, fit(stash(encoded(docs, known, words), "classes"), words, shares, every, rounds)


def scores(table: DataFrame, net: Network) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (the sum), mean_log_likelihood for each row of an encoded table."""
    shared = table.sparkSession.sparkContext.broadcast(replace(net, words=None))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            n, total = batch.column(1).to_numpy(), batch.column(2).to_numpy().copy()
            held: list[tuple[int, np.ndarray]] = []

            def flush(total=total, held=held) -> None:
                flat = joined([t for _, t in held])[0].astype(np.intp)
                places = np.flatnonzero(flat)
                owner = np.repeat([d for d, _ in held], [len(t) for _, t in held])
                for at in range(0, len(places), BLOCK):
                    mine = owner[at : at + BLOCK]
                    total[mine[0] : mine[-1] + 1] += np.bincount(mine - mine[0], weights=model.log_probs(flat, places[at : at + BLOCK]))
                held.clear()

            waiting = 0
            for d, t in enumerate(batch.column(3)):
                if n[d]:
                    held.append((d, np.frombuffer(t.as_py(), "<u2")))
                    waiting += n[d]
                    if waiting >= STREAM:
                        flush()
                        waiting = 0
            if held:
                flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(total), pa.array(total / np.maximum(n, 1))], names=["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"])

    return table.mapInArrow(score, "doc_id long, n_tokens long, log_likelihood double, mean_log_likelihood double")


def pseudo_likelihoods(docs: DataFrame, known: dict[str, int], net: Network) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (the sum), mean_log_likelihood for each row."""
    return scores(encoded(docs, known, net.words), net)


def trained_and_scored(docs: DataFrame) -> DataFrame:
    """The scores of the documents that the network is trained on, which are encoded once."""
    known, words, shares = vocabulary(docs)
    table = stash(encoded(docs, known, words), "classes")
    return scores(table, fit(table, words, shares))

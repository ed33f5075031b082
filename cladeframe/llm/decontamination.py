"""Benchmark decontamination: which documents hold which test items.

An item is held by a document if at least `least` of its distinct word shingles occur in it. Items are short and documents
may be very long, so sketches of both would lose the item; only the item is sketched, and each of its sketch's hashes is
looked for in the document's whole set of shingle hashes (containment MinHash).

Items are partitioned by size, each class with its own sketch length and its own index. A sketch holds the smallest hashes of an item, one
more than the shingles that a document may lack: then any document that holds the item has one of them, so the candidates
are complete. A candidate has, besides, the sketch's share of matches tested against what the class's bound allows. Each
candidate is verified with the shingles themselves, not their hashes.

The sketches go to the tasks in blocks of bounded size; a benchmark of one block takes one pass over the documents and
no shuffle, a larger one a pass for each block.

Words are runs of letters, marks, digits and underscores in lower case. An item of fewer words than a shingle is one shingle of
all its words and is looked for as such; an item without words is held by nothing. Null texts are empty; a null doc_id
stays null in the result; rows that repeat give the same rows again; a null item_id is an item like any other.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cladeframe.llm.shared import words_of

SHINGLE, LEAST = 5, 0.8
BLOCK_WORDS = 2_000_000  # of items that one pass holds
SEED = 17
FACTORS = (2 * np.random.default_rng(SEED).integers(1 << 62, size=64, dtype=np.uint64) + 1).astype(np.uint64)


def hashes_of(words: list[str], n: int) -> np.ndarray:
    """A 64-bit hash for each run of n words."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(xxh64_intdigest, words, repeat(SEED)), dtype=np.uint64, count=len(words))
    size = len(words) - n + 1
    out = each[:size] * FACTORS[0]
    for k in range(1, n):
        out += each[k : k + size] * FACTORS[k]
    return out ^ (out >> np.uint64(31))


class Sketches:
    """Sketches of a block of items, by size class (powers of two of the number of shingles) and words in a shingle."""

    def __init__(self, items: list[tuple[int, str]], shingle: int, least: float):
        self.least, self.items = least, []
        by: dict[int, dict[int, list[tuple[np.uint64, int]]]] = defaultdict(lambda: defaultdict(list))
        self.needed: list[int] = []
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            n = min(shingle, len(words))
            exact = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
            hashes = np.unique(hashes_of(words, n))
            lacking = len(exact) - int(np.ceil(least * len(exact) - 1e-9))  # shingles that a holder may lack
            size_class = 1 << (len(exact) - 1).bit_length()
            length = min(len(hashes), max(lacking + 1, size_class // 4))
            k = len(self.items)
            self.items.append((item, n, exact))
            self.needed.append(max(1, length - lacking))
            by[n][size_class] += [(h, k) for h in hashes[:length]]
        self.index = {}
        for n, classes in by.items():
            parts = [(np.array([h for h, _ in pairs], dtype=np.uint64), np.array([k for _, k in pairs])) for pairs in map(sorted, classes.values())]
            self.index[n] = np.unique(np.concatenate([h for h, _ in parts])), parts

    def held(self, text: str | None) -> Iterator[tuple[int, int, int]]:
        """(item, its shingles, how many of them the text has) for each item held."""
        words = words_of(text)
        for n, (every, parts) in self.index.items():
            mine = hashes_of(words, n)
            if not len(mine):
                continue
            at = np.searchsorted(every, mine)
            at[at == len(every)] = 0
            found = np.unique(mine[every[at] == mine])
            if not len(found):
                continue
            hits: dict[int, int] = defaultdict(int)
            for hashes, owner in parts:
                low, high = np.searchsorted(hashes, found), np.searchsorted(hashes, found, side="right")
                for a, b in zip(low.tolist(), high.tolist(), strict=True):
                    for k in owner[a:b].tolist():
                        hits[k] += 1
            candidates = [k for k, h in hits.items() if h >= self.needed[k]]
            if candidates:
                have = set(zip(*(words[i:] for i in range(n)), strict=False))
                for k in candidates:
                    item, _, exact = self.items[k]
                    shared = len(exact & have)
                    if shared >= self.least * len(exact) - 1e-9:
                        yield item, len(exact), shared


def blocks_of(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded size, through an iterator that holds one partition of the benchmark at a time."""
    block, n = [], 0
    for item in benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null").toLocalIterator():
        block.append((item[0], item[1]))
        n += len(item[1]) // 4 + 1
        if n >= block_words:
            yield block
            block, n = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, least: float = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment), one row for each item that a document holds."""
    schema = "doc_id long, item_id long, n_shingles long, n_shared long, containment double"
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    out = None
    for items in blocks_of(benchmark, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(Sketches(items, shingle, least))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(d, i, n, k, k / n) for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for i, n, k in shared.value.held(t.as_py())]
                if found:
                    arrays = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), [pa.int64()] * 4 + [pa.float64()], strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "n_shingles", "n_shared", "containment"])

        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, least: float = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that hold no item, row by row, with all their columns and without a shuffle."""
    out = docs
    for items in blocks_of(benchmark, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(Sketches(items, shingle, least))
        place = docs.columns.index("text")

        def keep(batches: Iterator[pa.RecordBatch], shared=shared, place=place) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([next(shared.value.held(t.as_py()), None) is None for t in batch.column(place)], pa.bool_()))

        out = out.mapInArrow(keep, docs.schema)
    return out

"""Quality by compression: a text is like the class whose zstandard dictionary compresses it better.

Two dictionaries are built from good and bad texts. A whole text is compressed in pieces of PIECE bytes, each on its own
with either dictionary, so that a long text's later parts count as much as its first; the difference of the two sizes
over the text's size, (bad - good) / bytes, is the measure, and a logistic curve fitted on other labelled texts makes it
the probability of a good text. The curve sees the measure in robust standard deviations from the median good text, cut
at 1 and, below, where a tenth of the bad texts are above, so that the worst texts do not flatten it where the classes
meet.

Fitted on at most SAMPLE labelled documents outside the held-out fold, the one bound there is: half of them (by a hash of
the text) make the dictionaries, with all of their pieces, in an order by lot; the other half, in its natural proportion,
makes the curve. If either half lacks a label, all texts make both. The pieces of the one half and the measures of all come
to the driver. Text is the only input of a score.

Edge cases: a null or empty text has measure 0 and so the score of the curve there; all texts are scored whole. With labels
of one kind only, or none (so too where documents or labels are empty), nothing tells texts apart: all get the share of
good labels, counted as if there were one more of either kind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cladeframe.llm.labelled import HELD_OUT, fold, sample
from cladeframe.llm.shared import stash

SAMPLE = 8_000
PIECE, DICTIONARY, LEVEL = 512, 64 << 10, 3
CUT = 0.3


class Measure:
    """Compressed sizes with two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.by = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False) for d in (good, bad)]
        for c, d in zip(self.by, (good, bad), strict=True):
            zstandard.ZstdCompressionDict(d).precompute_compress(level=LEVEL)

    def __call__(self, text: bytes | None) -> float:
        if not text:
            return 0.0
        good, bad = (c.compress for c in self.by)
        difference = 0
        for at in range(0, len(text), PIECE):
            piece = text[at : at + PIECE]
            difference += len(bad(piece)) - len(good(piece))
        return difference / len(text)


@dataclass
class Model:
    good: bytes
    bad: bytes
    middle: float
    spread: float
    floor: float
    slope: float
    base: float

    def measure(self) -> Callable[[bytes | None], float]:
        return Measure(self.good, self.bad) if self.good else lambda text: 0.0

    def score(self, measures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * standing(measures, self.middle, self.spread, self.floor) + self.base, -40, 40)))


def untold(good: int, bad: int) -> Model:
    """Without labels of both kinds: the share of good ones."""
    return Model(b"", b"", 0.0, 1.0, -1.0, 0.0, float(np.log((good + 1) / (bad + 1))))


def dictionary(pieces: list[bytes]) -> bytes:
    """A zstandard dictionary from all of the pieces, in an order by lot: the library stops where a run of them adds nothing,
    and by itself keeps the last quarter only to try the dictionary on."""
    pieces = [pieces[k] for k in np.random.default_rng(3).permutation(len(pieces))]
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces, k=256, d=8, f=18, split_point=1.0, steps=1, accel=1).as_bytes()
    except zstandard.ZstdError:  # too few pieces to choose from: the dictionary is their plain content
        return b"".join(pieces)[-DICTIONARY:].ljust(8, b" ")


def standing(x: np.ndarray, middle: float, spread: float, floor: float) -> np.ndarray:
    return np.clip((x - middle) / spread, floor, 1)


def curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float, float, float]:
    """Middle and spread of the good texts, the floor, slope and base of a logistic curve by Newton's method."""
    low, middle, high = np.quantile(x[y > 0], [0.25, 0.5, 0.75])
    spread = max((high - low) / 1.349, 1e-4)
    floor = min(0.0, float(np.quantile((x[y <= 0] - middle) / spread, 0.9)))
    a = np.stack([standing(x, middle, spread, floor), np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag([1e-2, 1e-4]), a.T @ (y - p) - np.array([1e-2, 0]) * w)
        w += np.clip(step, -2, 2)
    return float(middle), float(spread), floor, float(w[0]), float(w[1])


def for_dictionary(text: bytes) -> bool:
    return xxh64_intdigest(text, 7) % 2 == 0


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    some = stash(sample(docs, labels, "quality", most).select("doc_id", F.col("text").cast("binary").alias("text"), F.col("y").cast("int").alias("y")), "labelled")
    good, every = some.agg(F.count_if(F.col("y") > 0), F.count("*")).first()
    if good in (0, every):
        return untold(good, every - good)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d, [t[at : at + PIECE] for at in range(0, len(t), PIECE)], y, for_dictionary(t)) for d, t, y in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.list_(pa.binary()), pa.int32(), pa.bool_()), strict=True)], names=["doc_id", "pieces", "y", "used"])

    cuts = some.mapInArrow(cut, "doc_id long, pieces array<binary>, y int, used boolean")
    pieces = cuts.where("used").toArrow().sort_by("doc_id")
    if len(set(v > 0 for v in pieces["y"].to_pylist())) < 2:
        pieces = cuts.toArrow().sort_by("doc_id")
    of = lambda kind: [p for ps, v in zip(pieces["pieces"].to_pylist(), pieces["y"].to_pylist(), strict=True) if (v > 0) == kind for p in ps]
    good, bad = dictionary(of(True)), dictionary(of(False))

    def gauge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure(good, bad)
        for batch in batches:
            rows = [(d, measure(t), y, for_dictionary(t)) for d, t, y in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if not rows:
                continue
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.float64(), pa.int32(), pa.bool_()), strict=True)], names=["doc_id", "x", "y", "used"])

    measures = some.mapInArrow(gauge, "doc_id long, x double, y int, used boolean").toArrow().sort_by("doc_id")
    x, y, used = (measures[c].to_numpy() for c in ("x", "y", "used"))
    rest = ~used if len(set((y[~used] > 0).tolist())) > 1 else np.ones(len(y), dtype=bool)
    return Model(good, bad, *curve(x[rest], (y[rest] > 0).astype(float)))


def quality_scores(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = shared.value.measure()
        for batch in batches:
            scores = shared.value.score(np.array([measure(t.as_py()) for t in batch.column(2)], dtype=float))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= cut).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold() == HELD_OUT).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")

"""Severity of toxic texts by cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(w . x - theta_k): one weight vector for all thresholds, theta ascending. The expected severity is
the sum of these over k, and a text is rejected where grade 1 or more is likelier than not.

Features are whole words and beginnings of words (3 to 8 letters), in lower case; a feature's value is how often it
occurs in 100 words of the whole text. Most say nothing of the class: weights go only to those of MIN_DOCS documents or
more whose share among toxic texts differs from that among others by MIN_Z standard errors, at most MOST of them (the
largest differences); these shares are counted by a grouped sum. A weight sum per word is all that scoring needs.

Grades: labels say only whether a text is toxic; toxic ones are graded 1 to GRADES by how much of the text is made of
features that mark the toxic class in the sample, in equal shares of the sample's toxic texts. A label that has more
grades itself is taken as it is.

Fitted on at most SAMPLE labelled documents outside the held-out fold; what comes to the driver is the chosen features of
the sample, not its texts.

Edge cases: a null text is an empty one; texts without known words get the severity of the thresholds alone. With labels
of one kind only, or none (so too where documents or labels are empty), nothing tells texts apart: all get the small
chances that begin with PRIOR for grade 1, and none is rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe.llm.labelled import sample
from cladeframe.llm.shared import stash, words_of

SAMPLE, MIN_DOCS, MIN_Z, MOST, GRADES, STEPS, PENALTY = 10_000, 5, 6.0, 3000, 3, 400, 1e-4
SHORTEST, LONGEST = 3, 8
PRIOR = 0.05
PART = 512  # rows whose copies a worker holds at once
KEPT = 50_000  # words whose weights a worker remembers


def parts(word: str) -> list[str]:
    """A word's features: its beginnings, and the word itself behind a mark."""
    return [word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1)] + ["=" + word]


def features(text: str | None) -> tuple[dict[str, float], int]:
    """How often each feature occurs, and the number of words."""
    counts: Counter[str] = Counter()
    words = Counter(words_of(text))
    for w, n in words.items():
        for f in parts(w):
            counts[f] += n
    return counts, words.total()


def per_hundred(n, words):
    return 100 * n / (words + 10)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    weights: dict[str, float]  # by feature
    thresholds: np.ndarray

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and threshold."""
        return sigmoid(scores[:, None] - self.thresholds)


class Scorer(dict):
    """Texts to scores w . x; the dict is the memory of words."""

    def __init__(self, model: Model):
        super().__init__()
        self.weights = model.weights

    def __missing__(self, word: str) -> float:
        get = self.weights.get
        total = sum(get(f, 0.0) for f in parts(word))
        if len(self) >= KEPT:
            self.clear()
        self[word] = total
        return total

    def __call__(self, text: str | None) -> float:
        words = words_of(text)
        return per_hundred(sum(map(self.__getitem__, words)), len(words))


def untold(grades: int = GRADES) -> Model:
    """Without labels of both kinds: no weights, and half the chance for each grade more."""
    return Model({}, -np.log([PRIOR / 2**k / (1 - PRIOR / 2**k) for k in range(grades)]))


def grade_by_marks(row: np.ndarray, col: np.ndarray, n: np.ndarray, y: np.ndarray, grades: int) -> np.ndarray:
    """Grades 0 to `grades` from a label that is 0 or 1."""
    toxic = y > 0
    size = int(col.max()) + 1 if len(col) else 1
    inside = np.bincount(col[toxic[row]], minlength=size) / max(1, toxic.sum())
    outside = np.bincount(col[~toxic[row]], minlength=size) / max(1, (~toxic).sum())
    marks = (inside >= 0.02) & (inside >= 10 * outside)
    share = np.bincount(row, weights=n * marks[col], minlength=len(y))
    out = np.zeros(len(y), dtype=np.int64)
    order = np.flatnonzero(toxic)[np.argsort(share[toxic], kind="stable")]
    out[order] = 1 + np.arange(len(order)) * grades // max(1, len(order))
    return out


def fit(row: np.ndarray, col: np.ndarray, n: np.ndarray, names: list[str], y: np.ndarray, grades: int = GRADES) -> Model:
    """Full-batch Adam on the log-likelihood of all thresholds, with an L2 penalty on the weights. Text row[i] has the
    value n[i] for feature col[i]."""
    if len(y) == 0 or y.min() == y.max():
        return untold(grades)
    if y.max() == 1:
        y = grade_by_marks(row, col, n, y, grades)
    x, levels, size = n, int(y.max()), len(names)
    above = (y[:, None] > np.arange(levels)).astype(float)
    rate = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
    theta = -np.log(rate / (1 - rate))
    p = np.concatenate([np.zeros(size), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    unfold = lambda p: np.cumsum(np.concatenate([p[size : size + 1], np.exp(p[size + 1 :])]))
    for t in range(1, STEPS + 1):
        w, theta = p[:size], unfold(p)
        line = np.bincount(row, weights=x * w[col], minlength=len(y))
        wrong = (sigmoid(line[:, None] - theta) - above) / len(y)
        g_theta = -wrong.sum(axis=0)
        gaps = np.cumsum(g_theta[::-1])[::-1][1:] * np.exp(p[size + 1 :])
        g = np.concatenate([np.bincount(col, weights=x * wrong.sum(axis=1)[row], minlength=size) + PENALTY * w, [g_theta.sum()], gaps])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p = p - 0.1 * (1 - t / (STEPS + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Model(dict(zip(names, p[:size].tolist(), strict=True)), unfold(p))


def chosen_features(some: DataFrame, toxic: int, rest: int) -> list[str]:
    """The features whose shares among toxic and other texts differ most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside: Counter[str] = Counter()
            docs: Counter[str] = Counter()
            for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = list(features(text.as_py())[0])
                docs.update(found)
                if y > 0:
                    inside.update(found)
            yield pa.RecordBatch.from_arrays([pa.array(list(docs), pa.string()), pa.array([inside[f] for f in docs], pa.int64()), pa.array(list(docs.values()), pa.int64())], names=["feature", "inside", "docs"])

    counts = some.select("text", "y").mapInArrow(count, "feature string, inside long, docs long").groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("docs").alias("docs"))
    share = F.col("docs") / (toxic + rest)
    error = F.sqrt(share * (1 - share) * (1 / toxic + 1 / rest))
    z = F.abs(F.col("inside") / toxic - (F.col("docs") - F.col("inside")) / rest) / error
    few = counts.where((F.col("docs") >= MIN_DOCS) & (share < 1)).withColumn("z", z).where(F.col("z") >= MIN_Z)
    return [r.feature for r in few.orderBy(F.desc("z"), "feature").limit(MOST).collect()]


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    some = stash(sample(docs, labels, "toxic", most).withColumn("y", F.col("y").cast("int")), "labelled")
    toxic, every = some.agg(F.count_if(F.col("y") > 0), F.count("*")).first()
    if toxic in (0, every):
        return untold()
    names = chosen_features(some, toxic, every - toxic)
    place = {f: k for k, f in enumerate(names)}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, text, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts, words = features(text)
                known = [(place[f], per_hundred(n, words)) for f, n in counts.items() if f in place]
                at, n = np.array([k for k, _ in known], dtype="<i4"), np.array([v for _, v in known], dtype="<f4")
                yield pa.RecordBatch.from_arrays([pa.array([d]), pa.array([at.tobytes()]), pa.array([n.tobytes()]), pa.array([y], pa.int32())], names=["doc_id", "at", "n", "y"])

    table = some.select("doc_id", "text", "y").mapInArrow(extract, "doc_id long, at binary, n binary, y int").toArrow().sort_by("doc_id")
    cols = [np.frombuffer(a, "<i4") for a in table["at"].to_pylist()]
    row = np.repeat(np.arange(len(cols)), [len(c) for c in cols])
    n = np.concatenate([np.frombuffer(x, "<f4") for x in table["n"].to_pylist()]).astype(float)
    return fit(row, np.concatenate(cols), n, names, table["y"].to_numpy())


def severities(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic (grade 1 or more), grade (the most severe that is likelier than not),
    toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = Scorer(shared.value)
        for batch in batches:
            p = shared.value.grades(np.array([score_of(t.as_py()) for t in batch.column(1)], dtype=float))
            grade = (p >= 0.5).sum(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(grade), pa.array(grade > 0)], names=["doc_id", "severity", "p_toxic", "grade", "toxic"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, severity double, p_toxic double, grade int, toxic boolean")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that are not rejected, with all their columns."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = Scorer(shared.value)
        for batch in batches:
            for at in range(0, len(batch), PART):
                part = batch.slice(at, PART)
                p = shared.value.grades(np.array([score_of(t.as_py()) for t in part.column(place)], dtype=float))
                yield part.filter(pa.array(p[:, 0] < 0.5))
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(keep, docs.schema)

"""Hard negatives from blocks of vectors in the order of a Hilbert curve, with zone maps.

Rows are quantised to integers and lie along a Hilbert curve (two bits a component, from its mean and deviation; labels
first). Runs of BLOCK rows are written as one Parquet row each, with a zone map: the least and largest value of every
component, and of the labels. A window asks for the best k rows of an anchor's own label, or of others, whose inner product
with the anchor is between two bounds. The product of an anchor with any row of a block is between the sums of the smaller
and of the larger of a.min and a.max, component by component; a block whose interval does not meet the window's, or whose
labels do not fit, holds none of its rows and is not read.

Windows narrow in two rounds: each first reads SEEDS blocks whose middles are nearest to its upper end; its k-th best score
there is a lower bound from then on, and all blocks that may reach it are read. So results are exact, ties included: the
order of rows and the choice of the first blocks only decide how much is read. Positives are one such search, with open
bounds; each (anchor, positive) is a window of the second.

Windows go in chunks of CHUNK along the same curve, and zone maps in pages; chunks meet pages to choose blocks, and the
blocks chosen are joined by their number. A block goes to a task once for each chunk that asks for it; a chunk's blocks are
dealt to SPREAD tasks, each of which keeps the k best of each window and gives no more. Nothing but counts and sums a
component reaches the driver.

Edge cases: rows with a null label or vector, an empty vector, a null or non-finite component, or no vec_id take no part;
vectors of different lengths have no product and never meet; rows that repeat a vec_id count once, the least by label, then
by vector; an anchor without positives, or a positive without negatives, gives no rows; integers too large for exact doubles are multiplied as whole
numbers, and a product beyond 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe.llm.shared import stash

BLOCK, CHUNK, PAGE, SEEDS, SPREAD, DEAL, BITS = 1024, 256, 256, 2, 8, 64, 2
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
LEAST, MOST = -(2**63), 2**63 - 1
EXACT = float(2**53)


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, label, v (integers, as doubles) of the rows that take part, with the labels of every seventh moved on."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda a: F.coalesce(F.abs(a) < float("inf"), F.lit(False)) & ~F.isnan(a)) & (F.size(v) > 0)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & fine)
    whole = F.transform(v, lambda x: F.when(F.abs(x) < 2.0**40, F.floor(x * 256).cast("double")).otherwise(x * 256))  # large doubles are whole
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), whole.alias("v"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


def hilbert(levels: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Places along the Hilbert curve of points (n, dims) of so many bits a component: bytes that sort like them."""
    x = levels.astype(np.uint8).copy()
    n, dims = x.shape
    top = np.uint8(1 << (bits - 1))
    q = top
    while q > 1:  # undo the rotations of each level, from the highest bit down
        low = np.uint8(q - 1)
        for d in range(dims):
            flip = (x[:, d] & q) > 0
            x[flip, 0] ^= low
            swap = np.where(flip, 0, (x[:, 0] ^ x[:, d]) & low).astype(np.uint8)
            x[:, 0] ^= swap
            x[:, d] ^= swap
        q = np.uint8(q >> 1)
    for d in range(1, dims):  # Gray code
        x[:, d] ^= x[:, d - 1]
    t, q = np.zeros(n, dtype=np.uint8), top
    while q > 1:
        t ^= np.where((x[:, -1] & q) > 0, np.uint8(q - 1), np.uint8(0))
        q = np.uint8(q >> 1)
    x ^= t[:, None]
    planes = np.stack([(x >> b) & 1 for b in range(bits - 1, -1, -1)], axis=1)
    return [r.tobytes() for r in np.packbits(planes.reshape(n, -1), axis=1)]


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def spread_of(rows: DataFrame) -> DataFrame:
    """dim, mean, deviation: of each component, for each length of vectors. Sums are made a batch at a time."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            sizes = np.diff(batch.column(0).offsets.to_numpy())
            for dim in np.unique(sizes):
                x = matrix(batch.column(0).filter(pa.array(sizes == dim)), dim)
                at = total.setdefault(int(dim), [0, np.zeros(dim), np.zeros(dim)])
                at[0], at[1], at[2] = at[0] + len(x), at[1] + x.sum(axis=0), at[2] + (x**2).sum(axis=0)
        out = [(dim, d, n, float(s[d]), float(s2[d])) for dim, (n, s, s2) in total.items() for d in range(dim)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names=["dim", "d", "n", "s", "s2"])

    made = rows.select("v").mapInArrow(sums, "dim long, d long, n long, s double, s2 double").groupBy("dim", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("s2").alias("s2"))
    mean = F.col("s") / F.col("n")
    made = made.select("dim", F.struct("d", mean.alias("mean"), F.sqrt(F.greatest(F.col("s2") / F.col("n") - mean * mean, F.lit(0.0))).alias("dev")).alias("m"))
    made = made.groupBy("dim").agg(F.array_sort(F.collect_list("m")).alias("m"))
    return made.select("dim", F.transform("m", lambda m: m["mean"]).alias("mean"), F.transform("m", lambda m: m["dev"]).alias("dev"))


def placed(rows: DataFrame, spread: DataFrame) -> DataFrame:
    """Rows (label, v and others) with dim and their place on the curve. spread has one row for each length of vectors."""
    joined = rows.withColumn("dim", F.size("v").cast("long")).join(spread, "dim")
    edges = lambda m, d, x: F.when(x < m - 0.67 * d, 0).when(x < m, 1).when(x < m + 0.67 * d, 2).otherwise(3)  # noqa: E731  quarters of a normal distribution
    level = F.transform("v", lambda x, i: edges(F.get("mean", i), F.get("dev", i), x).cast("byte"))
    own = [*rows.columns, "dim"]

    def curve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels, dims = batch.column(len(own)), batch.column(own.index("dim")).to_numpy()
            keys = np.empty(len(batch), dtype=object)
            for dim in np.unique(dims):
                where = np.flatnonzero(dims == dim)
                keys[where] = hilbert(matrix(levels.take(pa.array(where)), int(dim)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], pa.array(list(keys), pa.binary())], names=[*own, "place"])

    types = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    return joined.select(*own, level.alias("level")).mapInArrow(curve, ", ".join(f"{c} {types[c]}" for c in own) + ", place binary")


def packed(rows: DataFrame, size: int, fields: list[str], zones: bool) -> DataFrame:
    """Runs of rows along the curve as single rows: number, dim, n, v and the other fields as bytes, and the zone map."""
    kinds = {"label": "<i8", "vec_id": "<i8", "lo": "<i8", "hi": "<i8", "other": "<i8"}
    order = ["dim", "label", "place"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, have = TaskContext.get().partitionId(), 0, [], 0

        def close(rows: pa.Table) -> pa.RecordBatch:
            nonlocal made
            dim = rows["dim"][0].as_py()
            x = matrix(rows["v"].combine_chunks(), dim)
            row = {"number": part << 32 | made, "dim": dim, "n": len(x), "v": stored(x)} | {f: rows[f].to_numpy().astype(kinds[f]).tobytes() for f in fields}
            if zones:
                labels = rows["label"].to_numpy()
                row |= {"low": x.min(axis=0).tobytes(), "high": x.max(axis=0).tobytes(), "first_label": int(labels.min()), "last_label": int(labels.max())}
            made += 1
            return pa.RecordBatch.from_pylist([row])

        rest: pa.Table | None = None
        for batch in batches:
            rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            while len(rest):
                same = rest["dim"].to_numpy() == rest["dim"][0].as_py()
                run = int(np.argmin(same)) if not same.all() else len(rest)
                if run < size and run == len(rest):
                    break  # more may come
                yield close(rest.slice(0, min(run, size)))
                rest = rest.slice(min(run, size))
        if rest is not None and len(rest):
            yield close(rest)

    schema = "number long, dim long, n long, v binary, " + ", ".join(f"{f} binary" for f in fields) + (", low binary, high binary, first_label long, last_label long" if zones else "")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*dict.fromkeys(["dim", "v", "label", *fields])).mapInArrow(pack, schema)


def stored(x: np.ndarray) -> bytes:
    """Small integers take two bytes each."""
    return x.astype("<i2" if np.abs(x).max() < 2**15 else "<f8").tobytes()


def loaded(data: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, dtype="<i2" if len(data) == 2 * n * dim else "<f8").reshape(n, dim).astype(np.float64)


def pages_of(zones: DataFrame, page: int) -> DataFrame:
    """Zone maps by the page: page, and lists of their columns."""
    named = zones.withColumn("page", F.pmod(F.xxhash64("number"), F.lit(page)))
    return named.groupBy("dim", "page").agg(F.collect_list(F.struct("number", "low", "high", "first_label", "last_label")).alias("zones"))


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest product that anchors (n, dim) can have with a row of each block (m, dim): (n, m) each. Beyond
    exact doubles the interval is widened by more than what rounding may take."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    size = np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T
    room = np.where(size < EXACT, 0.0, size * 1e-9)
    return least - room, most + room


def windows_in(row: dict) -> dict[str, np.ndarray]:
    out = {f: np.frombuffer(row[f], dtype="<i8") for f in ("vec_id", "label", "other", "lo", "hi")}
    return out | {"v": loaded(row["v"], row["n"], row["dim"])}


def choose(chunks: DataFrame, n_chunks: int, pages: DataFrame, n_pages: int, same: bool, seeds: int | None) -> DataFrame:
    """(chunk, number): the blocks that windows of a chunk must read; with seeds, so many for each window to begin with."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1).to_pylist()[0]
                w, zones = windows_in(row), row["zones"]
                edge = lambda f, zones=zones: np.stack([np.frombuffer(z[f], dtype="<f8") for z in zones])
                low, high = edge("low"), edge("high")
                least, most = bounds(w["v"], low, high)
                first, last = (np.array([z[f] for z in zones]) for f in ("first_label", "last_label"))
                mine = w["label"][:, None]
                fits = (first <= mine) & (mine <= last) if same else ~((first == mine) & (last == mine))
                fits &= (least <= w["hi"][:, None]) & (most >= w["lo"][:, None])
                numbers = np.array([z["number"] for z in zones])
                if seeds is None:
                    which = np.flatnonzero(fits.any(axis=0))
                    columns = [np.zeros(len(which), dtype=np.int64), numbers[which], np.zeros(len(which))]
                else:
                    middle = (w["v"] @ (low + high).T) / 2
                    far = np.where(w["hi"][:, None] == MOST, -middle, np.abs(middle - w["hi"][:, None]))
                    far[~fits] = np.inf
                    near = np.argsort(far, axis=1, kind="stable")[:, :seeds]
                    windows = np.repeat(np.arange(len(far)), near.shape[1])
                    columns = [windows, numbers[near.ravel()], far[windows, near.ravel()]]
                    columns = [c[columns[2] < np.inf] for c in columns]
                chunk = np.full(len(columns[0]), row["chunk"])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (chunk, *columns)], names=["chunk", "window", "number", "far"])

    # each page meets each chunk, a page once for every DEAL chunks
    deals = -(-n_chunks // DEAL) or 1
    asked = chunks.withColumnRenamed("number", "chunk").withColumns({"deal": F.pmod(F.xxhash64("chunk"), F.lit(deals)), "page": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_pages - 1).cast("long")))})
    dealt = pages.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))))
    met = asked.join(dealt, ["dim", "page", "deal"]).mapInArrow(meet, "chunk long, window long, number long, far double")
    if seeds is not None:
        nearest = F.slice(F.array_sort(F.collect_list(F.struct("far", "number"))), 1, seeds)  # seeds a page
        met = met.groupBy("chunk", "window").agg(nearest.alias("near")).select("chunk", F.explode("near.number").alias("number"))
    return met.select("chunk", "number").distinct()


class Best:
    """The k best rows of each window of a chunk, as blocks come."""

    def __init__(self, row: dict, same: bool, k: int):
        self.w, self.same, self.k, self.found = windows_in(row), same, k, [(np.zeros(0, dtype=np.int64),) * 2] * row["n"]

    def read(self, v: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        a = self.w["v"]
        if (np.abs(a).max() * np.abs(v).max() * a.shape[1]) < EXACT:
            score = (a @ v.T).astype(np.int64)
        else:
            score = np.array([[sum(int(p) * int(q) for p, q in zip(x, y, strict=True)) for y in v] for x in a], dtype=np.int64)
        for n in range(len(a)):
            fits = (labels == self.w["label"][n]) & (ids != self.w["vec_id"][n]) if self.same else labels != self.w["label"][n]
            fits &= (score[n] >= self.w["lo"][n]) & (score[n] <= self.w["hi"][n])
            where = np.flatnonzero(fits)
            if len(where) > self.k:
                least = np.partition(score[n][where], len(where) - self.k)[len(where) - self.k]
                where = where[score[n][where] >= least]
            s, i = np.concatenate([self.found[n][0], score[n][where]]), np.concatenate([self.found[n][1], ids[where]])
            top = np.lexsort((i, -s))[: self.k]
            self.found[n] = s[top], i[top]

    def rows(self) -> pa.RecordBatch:
        sizes = [len(s) for s, _ in self.found]
        own = {f: np.repeat(self.w[f], sizes) for f in ("vec_id", "other")}
        s, i = (np.concatenate([f[k] for f in self.found]) for k in (0, 1))
        window = np.repeat(np.arange(len(sizes)), sizes)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (window, own["vec_id"], own["other"], i, s)], names=["window", "anchor_id", "other", "vec_id", "score"])


def read(needs: DataFrame, chunks: DataFrame, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    """chunk, window, anchor_id, other, vec_id, score: the k best rows of each window in the blocks that its chunk needs."""
    asked = needs.withColumn("deal", F.pmod(F.xxhash64("number"), F.lit(SPREAD)))
    windows = chunks.select(F.col("number").alias("chunk"), "n", "dim", *[F.col(f).alias(f) for f in ("vec_id", "label", "other", "lo", "hi", "v")])
    stored = blocks.select("number", F.struct("n", "dim", "v", F.col("vec_id").alias("ids"), F.col("label").alias("labels")).alias("b"))
    pairs = asked.join(stored, "number").select("chunk", "deal", "b")
    # the windows of a chunk come once for each deal, before its blocks
    heads = asked.select("chunk", "deal").distinct().join(windows, "chunk").select("chunk", "deal", F.struct("n", "dim", "vec_id", "label", "other", "lo", "hi", "v").alias("w"))
    both = heads.withColumn("b", F.lit(None).cast(pairs.schema["b"].dataType)).unionByName(pairs.withColumn("w", F.lit(None).cast(heads.schema["w"].dataType)))
    dealt = both.repartition("chunk", "deal").sortWithinPartitions("chunk", "deal", F.col("w").isNull())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, chunk = None, None

        def out() -> pa.RecordBatch:
            made = best.rows()
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(made), chunk)), *made.columns], names=["chunk", *made.schema.names])

        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["w"] is not None:
                    if best is not None:
                        yield out()
                    best, chunk = Best(row["w"], same, k), row["chunk"]
                else:
                    b = row["b"]
                    best.read(loaded(b["v"], b["n"], b["dim"]), np.frombuffer(b["ids"], dtype="<i8"), np.frombuffer(b["labels"], dtype="<i8"))
        if best is not None:
            yield out()

    found = dealt.select("chunk", "w", "b").mapInArrow(scan, "chunk long, window long, anchor_id long, other long, vec_id long, score long")
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("order"), "vec_id"))), 1, k)  # k from each of SPREAD tasks
    return found.groupBy("chunk", "window", "anchor_id", "other").agg(top.alias("top"))


def search(windows: DataFrame, spread: DataFrame, blocks: DataFrame, pages: DataFrame, n_pages: int, same: bool, k: int, chunk: int = CHUNK) -> DataFrame:
    """anchor_id, other, rank, vec_id, score: the k best rows for each window (vec_id, label, other, lo, hi, v)."""
    fields = ["vec_id", "label", "other", "lo", "hi"]
    chunks = stash(packed(placed(windows, spread), chunk, fields, zones=False), "windows")
    n_chunks = chunks.count()
    first = read(choose(chunks, n_chunks, pages, n_pages, same, SEEDS), chunks, blocks, same, k)
    reached = F.when(F.size("top") == k, -F.element_at("top", -1)["order"])
    narrowed = stash(first.select("chunk", "window", reached.alias("reached")).where("reached is not null"), "reached")
    raised = narrowed.groupBy("chunk").agg(F.map_from_entries(F.collect_list(F.struct("window", "reached"))).alias("reached"))  # CHUNK entries at most

    columns = chunks.columns

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = []
            for lo, reached in zip(batch.column("lo").to_pylist(), batch.column("reached").to_pylist(), strict=True):
                made = np.frombuffer(lo, dtype="<i8").copy()
                for window, score in reached or ():
                    made[window] = max(made[window], score)
                bounds.append(made.tobytes())
            yield pa.RecordBatch.from_pydict({c: pa.array(bounds, pa.binary()) if c == "lo" else batch.column(c) for c in columns})

    tight = chunks.join(raised, F.col("number") == F.col("chunk"), "left").select(*columns, "reached")
    tight = stash(tight.mapInArrow(narrow, chunks.schema), "windows")
    found = read(choose(tight, n_chunks, pages, n_pages, same, None), tight, blocks, same, k)
    return found.select("anchor_id", "other", F.posexplode("top").alias("rank", "t")).select("anchor_id", "other", (F.col("rank") + 1).alias("rank"), F.col("t.vec_id").alias("vec_id"), (-F.col("t.order")).alias("score"))


def mine(vectors: DataFrame, every: int = 100, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. vectors: vec_id, embedding, label."""
    rows = quantised(vectors)
    spread = stash(spread_of(rows), "spread")
    blocks = stash(packed(placed(rows, spread), block, ["vec_id", "label"], zones=True), "blocks")
    n_pages = -(-blocks.count() // PAGE) or 1
    pages = stash(pages_of(blocks.select("number", "dim", "low", "high", "first_label", "last_label"), n_pages), "zones")
    anchors = stash(rows.where(F.col("vec_id") % every == 0), "anchors")
    bound = lambda x, name: F.lit(x).cast("long").alias(name)
    asked = anchors.select("vec_id", "label", bound(0, "other"), bound(LEAST + 1, "lo"), bound(MOST, "hi"), "v")
    positives = stash(search(asked, spread, blocks, pages, n_pages, True, POSITIVES, chunk).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # LOW p <= 100 n <= HIGH p for a whole number n; below a product of 0 there is none
    p = "cast(positive_score as decimal(20, 0))"
    named = positives.where("positive_score >= 0").select(F.col("anchor_id").alias("vec_id"), F.col("positive_id").alias("other"), F.expr(f"({p} * {LOW} + 99) div 100").alias("lo"), F.expr(f"({p} * {HIGH}) div 100").alias("hi"))
    windows = named.join(anchors, "vec_id").select("vec_id", "label", "other", "lo", "hi", "v")
    found = search(windows, spread, blocks, pages, n_pages, False, NEGATIVES, chunk).withColumnRenamed("other", "positive_id").join(positives, ["anchor_id", "positive_id"])
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

"""Nearest neighbours with score-aware (anisotropic) product quantisation.

A vector is cut in pairs of components, each coded by one of 16 codewords: four bits. Euclidean nearness to a query q is
the inner product q.x - |x|^2 / 2; |x|^2 is kept as it is, and q.x is estimated from the codes. Queries that matter have a
large product, that is, lie along x; so the part of the residual that is parallel to x spoils scores most, and codes and
codewords are fitted with that part weighing ETA times as much as the rest: codes by coordinate descent, codewords by the
joint least squares of all of them.

Codewords are fitted on a bounded sample of SAMPLE vectors (those with the smallest hash of their id); all vectors are
coded. Codes, not vectors, are dealt in parts of about PART rows, and queries in blocks of about BLOCK; for each pair of a
part and a block, one task group makes the tables of the queries (16 sums a pair of components) and scans the part's codes.

The scan gives the estimate d'^2 - e^2 of a squared distance, d' being that to the coded vector and e the length of the
row's residual r; it is off by 2 (q - x).r. Two scans find the neighbours. The first returns the best RERANK by estimate,
which are joined with the original vectors; the k-th of their distances, D, is an upper bound from then on. The second
returns every row that may be as near as that: the estimate of a row within D is at most D^2 + 2 D e m. With m = 1 that
holds always (Cauchy and Schwarz); vectors of up to FEW components are searched so, and no neighbour is missed. With more
of them r has next to no part along q - x: m is MARGIN / sqrt(components), MARGIN deviations of it. On 51,282 vectors of
64 components the first scan alone finds 0.982 of the neighbours, both find all, with 346 candidates a query. What the second scan
returns is joined with the original vectors as well, and all are ranked by their distance in double precision; how many it
returns depends on how many are near, without a cap. Equal vectors are told by a hash of their components: as ties go to
the smaller vec_id, only the first k + 1 of them are candidates (one more, as a row never finds itself).

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do those whose
length is not the most frequent one (the smaller of two); ties go to the smaller vec_id; a row never finds rows of its own
vec_id; rows that repeat count once; rows without an id take no part; fewer candidates than asked for are all returned.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.llm.shared import stash

SAMPLE, PART, BLOCK, RERANK = 8192, 32768, 1024, 192
FEW, MARGIN = 8, 1.5
CODES, ETA = 16, 3.0
ROUNDS, SWEEPS, SEED = 6, 2, 11


def encode(x: np.ndarray, words: np.ndarray, sweeps: int = SWEEPS, eta: float = ETA) -> np.ndarray:
    """Codes of vectors x (n, 2 m) with codewords (m, 16, 2): from the nearest ones on, each code in turn becomes the
    one of the least loss with the others as they are."""
    if len(x) > 2048:
        return np.concatenate([encode(x[at : at + 2048], words, sweeps, eta) for at in range(0, len(x), 2048)])
    m = len(words)
    parts = x.reshape(len(x), m, 2)
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).reshape(parts.shape)
    square = ((parts[:, :, None, :] - words[None]) ** 2).sum(axis=3)
    along = np.einsum("nmd,nmkd->nmk", unit, parts[:, :, None, :] - words[None])
    codes = square.argmin(axis=2)
    rows = np.arange(len(x))
    parallel = np.take_along_axis(along, codes[:, :, None], axis=2)[:, :, 0].sum(axis=1)
    for _ in range(sweeps):
        for j in range(m):
            rest = parallel - along[rows, j, codes[:, j]]
            codes[:, j] = (square[:, j] + (eta - 1) * (rest[:, None] + along[:, j]) ** 2).argmin(axis=1)
            parallel = rest + along[rows, j, codes[:, j]]
    return codes.astype(np.uint8)


def fit(x: np.ndarray, rounds: int = ROUNDS, eta: float = ETA, seed: int = SEED) -> np.ndarray:
    """Codewords (m, 16, 2) of a sample."""
    rng, m = np.random.default_rng(seed), x.shape[1] // 2
    parts = x.reshape(len(x), m, 2)
    words = parts[rng.integers(len(x), size=CODES)].transpose(1, 0, 2).copy()
    for _ in range(8):
        near = encode(x, words, sweeps=0)
        for j in range(m):
            n = np.bincount(near[:, j], minlength=CODES)
            for d in range(2):
                total = np.bincount(near[:, j], weights=parts[:, j, d], minlength=CODES)
                words[j, n > 0, d] = total[n > 0] / n[n > 0]
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).reshape(parts.shape)
    size = m * CODES * 2
    for _ in range(rounds):
        codes = encode(x, words, eta=eta)
        # each vector is a row that picks its codewords' components; loss = |r|^2 + (eta - 1) (unit . r)^2
        column = (np.arange(m)[None, :, None] * CODES + codes[:, :, None]) * 2 + np.arange(2)
        column = column.reshape(len(x), -1)
        left, right = np.zeros((size, size)), np.zeros(size)
        norm = np.einsum("nmd,nmd->n", unit, parts)
        for at in range(0, len(x), 2048):
            c, u, p = column[at : at + 2048], unit[at : at + 2048].reshape(-1, m * 2), parts[at : at + 2048].reshape(-1, m * 2)
            picked = np.zeros((len(c), size))
            np.put_along_axis(picked, c, u, axis=1)
            left += (eta - 1) * picked.T @ picked
            right += (eta - 1) * picked.T @ norm[at : at + 2048] + np.bincount(c.ravel(), weights=p.ravel(), minlength=size)
        left[np.diag_indices(size)] += np.bincount(column.ravel(), minlength=size) + 1e-6
        right += 1e-6 * words.ravel()
        words = np.linalg.solve(left, right).reshape(words.shape)
    return words


def pack(codes: np.ndarray) -> np.ndarray:
    if codes.shape[1] % 2:
        codes = np.concatenate([codes, np.zeros((len(codes), 1), dtype=np.uint8)], axis=1)
    return codes[:, ::2] | (codes[:, 1::2] << 4)


def unpack(packed: np.ndarray, m: int) -> np.ndarray:
    out = np.empty((len(packed), packed.shape[1] * 2), dtype=np.uint8)
    out[:, ::2], out[:, 1::2] = packed & 15, packed >> 4
    return out[:, :m]


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def even(x: np.ndarray) -> np.ndarray:
    """In double precision, with a zero added to an odd number of components."""
    x = x.astype(np.float64)
    return np.concatenate([x, np.zeros((len(x), 1))], axis=1) if x.shape[1] % 2 else x


def best(score: np.ndarray, n: int) -> np.ndarray:
    """Places of the n largest; of equal ones at the end, the first."""
    if len(score) <= n:
        return np.flatnonzero(score > -np.inf)
    least = np.partition(score, len(score) - n)[len(score) - n]
    above = np.flatnonzero(score > least)
    return np.concatenate([above, np.flatnonzero((score == least) & (score > -np.inf))[: n - len(above)]])


def firsts(same: np.ndarray, most: int) -> np.ndarray:
    """Rows without those that have `most` rows of the same hash before them."""
    _, group = np.unique(same, return_inverse=True)
    order = np.argsort(group, kind="stable")
    begin = np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1]]))
    nth = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    return np.sort(order[nth < most])


def scan(rows: dict[str, np.ndarray], words: np.ndarray, queries: dict[str, np.ndarray], rerank: int, alike: int, margin: float) -> list[tuple[np.ndarray, ...]]:
    """Rows of a part for each query by estimate (query ids, row ids, hashes, estimates of -d^2 / 2 and more): the best
    `rerank`, or, where a query has a reach, all that may be within it."""
    order = np.argsort(rows["vec_id"], kind="stable")
    order = order[np.concatenate([[True], rows["vec_id"][order][1:] != rows["vec_id"][order][:-1]])]  # rows that repeat an id count once
    order = order[firsts(rows["same"][order], alike)]
    ids, half, error, same = (rows[c][order] for c in ("vec_id", "half", "error", "same"))
    codes, out, m = np.ascontiguousarray(rows["codes"][order].T), [], len(words)
    for at in range(0, len(queries["q"]), 32):
        q, q_ids = queries["q"][at : at + 32], queries["query_id"][at : at + 32]
        tables = np.einsum("qmd,mkd->qmk", q.reshape(len(q), m, 2), words).astype(np.float32)
        score = np.repeat(-half.astype(np.float32)[None], len(q), axis=0)
        for j in range(m):
            score += np.take(tables[:, j], codes[j], axis=1)
        score[q_ids[:, None] == ids[None]] = -np.inf
        for r in range(len(q)):
            reach = queries["reach"][at + r]
            if np.isnan(reach):
                top = best(score[r], rerank)
            else:
                square = q[r] @ q[r]
                room = 1e-5 * (square + 2 * np.abs(half) + error**2)  # single precision of the tables
                top = np.flatnonzero(square - 2 * score[r].astype(np.float64) <= reach**2 + 2 * reach * error * margin + room)
            out.append((np.full(len(top), q_ids[r]), ids[top], same[top], score[r, top].astype(float)))
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, part: int = PART, block: int = BLOCK, rerank: int = RERANK, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of queries its k nearest rows of vectors (both vec_id, embedding)."""
    spark = vectors.sparkSession
    schema = "query_id long, vec_id long, score double"

    def usable(df: DataFrame) -> DataFrame:
        v = F.col("embedding")
        fine = F.forall(v, lambda a: F.coalesce(F.abs(a) < float("inf"), F.lit(False)) & ~F.isnan(a)) & F.exists(v, lambda a: a != 0)
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & v.isNotNull() & fine)

    good = usable(vectors)
    sizes = good.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, rows = sizes
    good, asked = good.where(F.size("embedding") == dim), usable(queries).where(F.size("embedding") == dim)
    sampled = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    words = fit(even(matrix(sampled["embedding"], dim)))
    parts = max(1, -(-rows // part))
    blocks = max(1, -(-asked.count() // block))

    margin = 1.0 if dim <= FEW else min(1.0, MARGIN / dim**0.5)

    def code(batches):
        for batch in batches:
            x = even(matrix(batch.column("embedding"), dim))
            codes = encode(x, words)
            coded = words[np.arange(len(words))[None], codes].reshape(x.shape)
            error = np.linalg.norm(x - coded, axis=1)
            same = [blake2b((r + 0.0).tobytes(), digest_size=16).digest() for r in x]  # -0.0 is 0.0
            columns = [batch.column(0), pa.array(((coded**2).sum(axis=1) - error**2) / 2), pa.array(error), pa.array([bytes(r) for r in pack(codes)], pa.binary()), pa.array(same, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "half", "error", "codes", "same"])

    coded = stash(good.mapInArrow(code, "vec_id long, half double, error double, codes binary, same binary"), "codes")
    coded = coded.withColumns({"part": F.pmod(F.xxhash64("vec_id"), F.lit(parts)), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            codes = unpack(np.frombuffer(b"".join(left["codes"].to_pylist()), dtype=np.uint8).reshape(len(left), -1), len(words))
            rows = {c: left[c].to_numpy() for c in ("vec_id", "half", "error")} | {"codes": codes, "same": np.frombuffer(b"".join(left["same"].to_pylist()), dtype="V16")}
            asks = {"query_id": right["vec_id"].to_numpy(), "q": even(matrix(right["embedding"], dim)), "reach": right["reach"].to_numpy()}
            found = scan(rows, words, asks, rerank, k + 1, margin)
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [np.zeros(0, dtype=np.int64)] * 2 + [np.zeros(0, dtype="V16"), np.zeros(0)]
        same = pa.array([bytes(h) for h in columns[2]], pa.binary())
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), same, pa.array(columns[3], pa.float64())], names=["query_id", "vec_id", "same", "estimate"])

    def candidates(reach: DataFrame) -> DataFrame:
        """query_id, vec_id of one scan. reach: vec_id, embedding, reach."""
        dealt = reach.withColumns({"block": F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")})
        dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        met = coded.groupBy("part", "block").cogroup(dealt.groupBy("part", "block")).applyInArrow(meet, "query_id long, vec_id long, same binary, estimate double")
        met = met.groupBy("query_id", "vec_id").agg(F.max("estimate").alias("estimate"), F.min("same").alias("same"))
        equal = F.row_number().over(Window.partitionBy("query_id", "same").orderBy("vec_id"))
        return met.withColumn("equal", equal).where(F.col("equal") <= k + 1).select("query_id", "vec_id", "estimate")

    def scored(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select("query_id", "vec_id").join(good.withColumnRenamed("embedding", "x"), "vec_id").join(asked.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")), "query_id")
        squares = F.zip_with("q", "x", lambda a, b: (a - b) * (a - b))
        made = pairs.select("query_id", "vec_id", F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x)).alias("score"))
        return made.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))

    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("estimate"), "vec_id"))
    first = candidates(asked.withColumn("reach", F.lit(float("nan"))))
    first = stash(scored(first.withColumn("place", place).where(F.col("place") <= rerank)), "first-candidates")
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    reach = first.withColumn("nth", nth).where(F.col("nth") == k).select("query_id", F.col("score").alias("reach"))
    # a query with fewer candidates than k has them all
    second = candidates(asked.join(reach, F.col("vec_id") == F.col("query_id")).select("vec_id", "embedding", "reach"))
    more = second.join(first.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_anti")
    ranked = first.unionByName(scored(more)).withColumn("rank", nth)
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""SimHash near-duplicates by multi-index hashing.

Fingerprints are made from word shingles (XXH64, seed 42; a bit is set if it is set in over half of the shingles). Those
that differ in at most two of 64 bits are found with an index of the two 32-bit halves, high and low. Two bits of
difference are spread over the halves as (0, <=2), (<=2, 0) or (1, 1):

* equal halves are looked up as they are, together with one of three pieces of the other half, of which two changed bits
  leave one whole;
* for (1, 1), the ball of radius one around the high half is enumerated and looked up, together with one of two pieces
  of the low half. Bits are only ever set, never cleared: of two halves that differ in one bit, one side does the setting.

Every match found is verified by its full distance. All is done on distinct fingerprints, so that a group of equal texts
is one row here, and no pair within it is written out.

Two bits find copies with next to no changes. Texts that share 0.8 of their shingles differ in 10 bits of 64 on average,
and balls of that size hold most of the table. So `similar_links` first takes what the index finds (`close_texts`), and then
looks for the others: for them a fingerprint has, besides its 64 bits, keys that texts are looked up by as they are:

* texts of more than SHORT shingles have SEGMENTS segments, each made of a sample, the SAMPLED shingles that come first in
  an order of the segment's own. Two that share 0.8 of their shingles have a given segment in common with a chance of a
  half, so one in a million such pairs is missed. Matches are verified by their full distance first; one in ten million
  pairs differs in more than WITHIN bits;
* shorter ones have their first shingles, so many that two similar ones have one of these in common; none is missed. Texts
  somewhat longer than SHORT have both kinds, as they may be like shorter ones.

What is left of the matches is verified by the shingles. Pairs within a crowd of near copies are not written out: first
every text of a bucket is compared with the bucket's smallest. Then, in buckets whose texts that has not put together, the
shingles are counted: one that no other text has can be shared with none, and texts with too many such shingles have
no partner (texts that share a passage and nothing else go here). The text with the fewest of them, that in the middle of
a crowd, is compared with the others. Last, texts of a bucket that are still apart are compared with each other, where it
is possible that they are similar: by those counts, and by bitmaps of BITS places that a text's shingles are set in (a
place that is set for one text alone is a shingle that the other lacks).

Edge cases: a null text counts as empty; texts without words get fingerprint zero, which links like any other, and are
all alike; rows with the same id and text give rows that are the same. A null doc_id is never the smallest of a group
unless alone. In `similar_links`, texts of fewer words than a shingle are one shingle, and rows that share an id count
as one text, similar to all that any of them is similar to.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cladeframe.llm.decontamination import hashes_of
from cladeframe.operators.sequences import numbers
from cladeframe.llm.shared import components, remove, stash

SEED = 42
BLOCK = 1 << 16
SHINGLE, LEAST = 5, 0.8  # of near copies
SEGMENTS, SAMPLED = 20, 3
SHORT, BITS = 32, 1024  # shingles, places
WITHIN = 26  # bits of 64; similarity 0.8 gives 9.7 with a standard deviation of 2.9
ODD = (2 * np.random.default_rng(SEED).integers(1 << 62, size=SEGMENTS + SAMPLED, dtype=np.uint64) + 1).astype(np.uint64)


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of one text as an unsigned 64-bit number; bytes.lower() and split() know ASCII alone, as wanted."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)) if len(words) >= shingle else iter([b" ".join(words)])
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8", count=n)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) for each row; fp is the fingerprint as a signed long."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(make, "doc_id long, fp long")


def near_pairs(fps: DataFrame, bits: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints in fps.fp that differ in 1 to `bits` (at most 2) bits."""
    if not 1 <= bits <= 2:
        raise ValueError("bits must be 1 or 2")
    fp = F.col("fp")
    high, low = F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(0xFFFFFFFF))

    def piece(half, at: int, width: int):
        return F.shiftrightunsigned(half, at).bitwiseAND(F.lit((1 << width) - 1))

    def key(kind: int, whole, part):
        return F.struct(F.lit(kind).cast("byte").alias("kind"), F.shiftleft(whole, 16).bitwiseOR(part).alias("key"))

    thirds, halves = ((0, 11), (11, 11), (22, 10)), ((0, 16), (16, 16))
    as_is = [key(k, high, piece(low, *w)) for k, w in enumerate(thirds)] + [key(3 + k, low, piece(high, *w)) for k, w in enumerate(thirds)]
    table = [key(6 + k, high, piece(low, *w)) for k, w in enumerate(halves)]
    clear = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda i: F.call_function("getbit", high, i) == 0)

    def ball(kind: int, width: tuple[int, int]):
        part = piece(low, *width)
        return F.transform(clear, lambda i: key(kind, high.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)), part))

    balls = [ball(6 + k, w) for k, w in enumerate(halves)]
    left = fps.select(fp.alias("a"), F.explode(F.array(*as_is, *table)).alias("at")).select("a", "at.*")
    right = fps.select(fp.alias("b"), F.explode(F.concat(F.array(*as_is), *balls)).alias("at")).select("b", "at.*")
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits) & ((F.col("l.kind") >= 6) | (F.col("a") < F.col("b")))
    # never a broadcast: the planner sizes both sides as the table, but they have 8 and up to 70 rows for each of its rows
    joined = left.alias("l").hint("merge").join(right.alias("r").hint("merge"), (F.col("l.kind") == F.col("r.kind")) & (F.col("l.key") == F.col("r.key")) & near)
    return joined.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def simhash_groups(docs: DataFrame, bits: int = 2, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for each row: component_id is the smallest doc_id that links reach from it."""
    rows = stash(fingerprints(docs, shingle), "fingerprints")
    nodes = stash(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(near_pairs(nodes.select("fp"), bits)).withColumnRenamed("node", "fp")
    linked = stash(nodes.join(roots, "fp"), "linked-fingerprints")
    lowest = linked.groupBy("root").agg(F.min("first").alias("lowest"))
    known = linked.join(lowest, "root").select("fp", "lowest")
    named = nodes.join(known, "fp", "left").select("fp", F.coalesce("lowest", "first").alias("component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes of hashes, by two rounds of shift and multiplication."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    """Distinct hashes of the shingles of a text, in order; none without words."""
    words = text.lower().split() if text else []
    return np.unique(mixed(hashes_of(words, min(shingle, len(words))))) if words else np.zeros(0, dtype=np.uint64)


def segments(shingles: np.ndarray) -> np.ndarray:
    """A hash of each segment's sample; none without shingles."""
    if not len(shingles):
        return shingles
    out, step = np.empty(SEGMENTS, dtype=np.uint64), max(1, BLOCK // len(shingles))
    for at in range(0, SEGMENTS, step):
        first = mixed(shingles * ODD[at : min(at + step, SEGMENTS), None])
        if first.shape[1] > SAMPLED:
            first = np.partition(first, SAMPLED - 1, axis=1)[:, :SAMPLED]
        first.sort(axis=1)
        out[at : at + step] = mixed((first * ODD[SEGMENTS : SEGMENTS + first.shape[1]]).sum(axis=1, dtype=np.uint64))
    return out


def first_shingles(shingles: np.ndarray, least: float = LEAST) -> np.ndarray:
    """Of two sets that are similar, these share at least one."""
    n = len(shingles)
    return mixed(shingles[: n - int(np.ceil(least * n - 1e-9)) + 1] ^ ODD[0])


def keys_of(shingles: np.ndarray) -> np.ndarray:
    n = len(shingles)
    parts = [first_shingles(shingles)] if n <= SHORT / LEAST else []
    return np.concatenate([*parts, segments(shingles)]) if n > SHORT else parts[0]


def signed(xs: list[int]) -> pa.Array:
    return pa.array(np.array(xs, dtype="<u8").view("<i8"))


def signed_lists(xs: list[np.ndarray]) -> pa.Array:
    return pa.array([x.view("<i8") for x in xs], pa.list_(pa.int64()))


def sketches(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """A row for each row with a doc_id: fp, the number of distinct shingles, two sums of them that are equal where they
    are, and the keys."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t.as_py(), shingle) for t in part.column(1)]
                sums = [signed([x.sum(dtype=np.uint64) for x in sets]), signed([mixed(x).sum(dtype=np.uint64) for x in sets])]
                columns = [part.column(0), signed([majority(x) if len(x) else 0 for x in sets]), *sums, pa.array([len(x) for x in sets], pa.int32()), signed_lists(list(map(keys_of, sets)))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "sum_a", "sum_b", "n", "keys"])
        pa.default_memory_pool().release_unused()  # the worker stays while the joins run

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).where("doc_id is not null")
    return rows.mapInArrow(make, "doc_id long, fp long, sum_a long, sum_b long, n int, keys array<long>")


def bitmap(shingles: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, dtype=np.uint8)
    bits[mixed(shingles ^ ODD[1]) % np.uint64(BITS)] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


def shingle_sets(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """node, shingles (as hashes) and their bitmap of the documents whose doc_id is in nodes.node. Joins with whole texts are
    sort-merge joins at any size, so that small inputs tell how large ones will do."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t.as_py(), shingle) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), signed_lists(sets), signed_lists(list(map(bitmap, sets)))], names=["node", "shingles", "bits"])
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("binary").alias("text"))
    return rows.hint("merge").join(nodes, "node", "left_semi").mapInArrow(make, "node long, shingles array<long>, bits array<long>")


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose shingles are similar."""
    x, y = (sets.select(F.col("node").alias(k), F.col("shingles").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    both = pairs.distinct().join(y, "b").join(x, "a")
    shared = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("shared"), (F.size("x") + F.size("y")).alias("sizes"))
    return shared.where(F.col("shared") >= least * (F.col("sizes") - F.col("shared")) - 1e-9).select("a", "b").distinct()


def as_links(roots: DataFrame) -> DataFrame:
    """Components as links (a, b) that give the same components."""
    return roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def close_texts(texts: DataFrame, bits: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of texts (node, fp) whose fingerprints are near by the index of their halves, or equal. Of texts that
    share a fingerprint, the first stands for all in the pairs with others, and is paired with each."""
    firsts = stash(texts.groupBy("fp").agg(F.min("node").alias("first")), "distinct-fingerprints")
    x, y = (firsts.select(F.col("fp").alias(k), F.col("first").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    near = near_pairs(firsts.select("fp"), bits).join(y, "b").join(x, "a").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    found = stash(near.union(texts.join(firsts, "fp").where("node > first").select("first", "node")).where("a < b"), "close-texts")
    remove(firsts)
    return found


def similar_links(docs: DataFrame, texts: DataFrame, shingle: int = SHINGLE, least: float = LEAST) -> DataFrame:
    """Links (a, b) whose components are those of the texts with a similarity of `least` or more (0.8 at least): what links
    reach from a text is what similar texts reach. texts: node (a doc_id of docs), fp, n, keys, one row for each distinct set of shingles."""
    if least < LEAST:
        raise ValueError(f"keys are made for similarities of {LEAST} or more")

    def near(x: str, y: str):
        xs, ys = F.col(f"{x}.n"), F.col(f"{y}.n")
        bits = F.bit_count(F.col(f"{x}.fp").bitwiseXOR(F.col(f"{y}.fp"))) <= WITHIN
        return (F.least(xs, ys) >= least * F.greatest(xs, ys) - 1e-9) & (bits | (F.least(xs, ys) <= SHORT))

    def possible(x: str, y: str):
        """As far as the counts of shingles that other texts have as well, and the bitmaps, tell."""

        def lacking(a: str, b: str):
            return F.coalesce(reduce(add, [F.bit_count(F.col(f"{a}.bits")[k].bitwiseAND(F.bitwise_not(F.col(f"{b}.bits")[k]))) for k in range(BITS // 64)]), F.lit(0))

        shared = F.least(f"{x}.common", f"{y}.common", F.col(f"{x}.n") - lacking(x, y), F.col(f"{y}.n") - lacking(y, x))
        return shared >= least / (1 + least) * (F.col(f"{x}.n") + F.col(f"{y}.n")) - 1e-9

    def ordered(x, y):
        return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")

    def apart(members: DataFrame, roots: DataFrame) -> DataFrame:
        """Members of the buckets that links have not put together as a whole, each with its root."""
        placed = members.join(roots.withColumnRenamed("node", "r_node"), F.col("m.node") == F.col("r_node"), "left").select("key", "m", F.coalesce("root", "m.node").alias("root"))
        several = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
        return placed.join(several, "key")

    each = texts.select(F.explode("keys").alias("key"), F.struct("node", "fp", "n").alias("m"))
    leads = each.groupBy("key").agg(F.min("m").alias("lead"), F.count("*").alias("size")).where("size > 1").drop("size")
    found = stash(each.join(leads, "key"), "buckets")
    close = close_texts(texts)
    wanted = found.select("m.node").union(close.select("a")).union(close.select("b")).distinct()
    sets = stash(shingle_sets(docs, wanted, shingle), "bucket-shingles")

    led = found.where((F.col("m.node") > F.col("lead.node")) & near("m", "lead"))
    first = stash(verified(led.select(*ordered(F.col("m.node"), F.col("lead.node"))).union(close), sets, least), "links")

    roots = components(first)
    left_over = stash(apart(found.select("key", "m"), roots), "left-over")
    shingles = sets.join(left_over.select("m.node").distinct(), "node", "left_semi").select("node", F.explode("shingles").alias("s"))
    lone = shingles.groupBy("s").agg(F.count("*").alias("texts"), F.min("node").alias("o_node")).where("texts = 1").groupBy("o_node").agg(F.count("*").alias("own"))
    maps = sets.groupBy("node").agg(F.min("bits").alias("bits"), F.count("*").alias("rows")).select(F.col("node").alias("b_node"), F.when(F.col("rows") == 1, F.col("bits")).alias("bits"))  # not of an id with several texts
    counted = left_over.join(lone, F.col("m.node") == F.col("o_node"), "left").withColumn("common", F.col("m.n") - F.coalesce("own", F.lit(0)))
    counted = counted.where(F.col("common") >= least * F.col("m.n") - 1e-9).join(maps, F.col("m.node") == F.col("b_node"))
    counted = stash(counted.select("key", F.struct("m.node", "m.fp", "m.n", "common", "bits").alias("m"), "root"), "counted")
    middle = counted.groupBy("key").agg(F.min(F.struct((F.col("m.n") - F.col("m.common")).alias("own"), "m", "root")).alias("c")).select("key", F.col("c.m").alias("c"), F.col("c.root").alias("c_root"))
    around = counted.join(middle, "key").where((F.col("root") != F.col("c_root")) & possible("m", "c") & near("m", "c"))
    second = stash(verified(around.select(*ordered(F.col("m.node"), F.col("c.node"))), sets, least), "links")

    roots = components(as_links(roots).union(second))
    last = stash(apart(counted.select("key", "m"), roots), "left-over")
    # sizes in steps of a quarter: similar texts are of the same step or of neighbours
    step = F.floor(F.log(F.col("m.n")) / F.log(F.lit(1 / LEAST)) + 1e-9)
    left = last.select("key", step.alias("step"), F.col("m").alias("x"), F.col("root").alias("x_root"))
    right = last.select("key", F.explode(F.array(step, step - 1)).alias("step"), F.col("m").alias("y"), F.col("root").alias("y_root"))
    in_order = F.struct("x.n", "x.node") < F.struct("y.n", "y.node")
    across = left.join(right, ["key", "step"]).where((F.col("x_root") != F.col("y_root")) & in_order & possible("x", "y") & near("x", "y"))
    third = stash(verified(across.select(*ordered(F.col("x.node"), F.col("y.node"))), sets, least), "links")
    for table in (found, close, sets, left_over, counted, last):
        remove(table)
    return as_links(roots).union(third)


def similar_groups(docs: DataFrame, shingle: int = SHINGLE, least: float = LEAST) -> DataFrame:
    """(doc_id, component_id) for each doc_id: component_id is the smallest doc_id that similar texts reach from it."""
    rows = stash(sketches(docs, shingle), "sketches")
    texts = rows.groupBy("sum_a", "sum_b", "n").agg(F.min(F.struct("doc_id", "fp", "keys")).alias("t"))
    texts = stash(texts.select("sum_a", "sum_b", F.col("t.doc_id").alias("node"), "t.fp", "n", "t.keys"), "texts")
    links = similar_links(docs, texts, shingle, least)
    alike = texts.select("node", "sum_a", "sum_b")
    same = rows.select("doc_id", "sum_a", "sum_b").join(alike, ["sum_a", "sum_b"]).select("doc_id", "node").distinct()
    twice = same.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")  # ids with several texts
    roots = components(links.union(twice.select("a", "b")))
    named = same.groupBy("doc_id").agg(F.min("node").alias("node")).join(roots, "node", "left")
    named = stash(named.select("doc_id", F.coalesce("root", "node").alias("component_id")), "similar-texts")
    remove(rows)
    remove(texts)
    return named


def keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """docs with s_key, and whether rows repeat a key: s_key is the doc_id, or, of ids that several texts share, a number of its
    own for each text, beyond all ids."""
    content = F.xxhash64("text")
    several = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.min(content).alias("low"), F.max(content).alias("high"))
    several = stash(several.where("n > 1").select("doc_id", (F.col("low") < F.col("high")).alias("differ")), "repeated-ids")
    repeats = not several.isEmpty()
    if several.where("differ").isEmpty():
        return docs.withColumn("s_key", F.col("doc_id").cast("long")), repeats
    rows = docs.withColumn("s_text", F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = rows.join(several.where("differ").select("doc_id"), "doc_id", "left_semi").select("doc_id", "s_text").distinct()
    top = docs.agg(F.max("doc_id")).first()[0]
    own = numbers(texts.withColumn("s_all", F.lit(0)), ["s_all"], ["doc_id", "s_text"]).select("doc_id", "s_text", (F.col("n") + top).alias("s_own"))
    own = stash(own, "keys-of-texts")
    return rows.join(own, ["doc_id", "s_text"], "left").withColumn("s_key", F.coalesce("s_own", "doc_id")).drop("s_own", "s_text"), repeats


def keep_first(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """One document of each group (similar_groups, or other groups of docs by doc_id): the one whose doc_id is the smallest. Of
    ids that several texts share, each text is a document of its own, behind those of unshared ids. Rows of one doc_id and
    text stay once, the least by their other columns; rows with a null doc_id all stay."""
    (whole, repeats), columns = keyed(docs), docs.columns
    if groups is None:
        groups = similar_groups(whole.select(F.col("s_key").alias("doc_id"), "text"))
        firsts = groups.where("doc_id = component_id").select(F.col("doc_id").alias("s_key"))
    else:
        named = whole.select("doc_id", "s_key").distinct().join(groups.select("doc_id", "component_id"), "doc_id")
        firsts = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "s_key")).alias("f")).where("f.doc_id = component_id").select("f.s_key")
    firsts = stash(firsts.distinct(), "first-documents")
    kept = whole.hint("merge").join(firsts, "s_key", "left_semi")
    if repeats:
        kept = kept.groupBy("s_key").agg(F.min(F.struct(*columns)).alias("r")).select("r.*")
    return kept.select(columns).unionByName(docs.where("doc_id is null"))

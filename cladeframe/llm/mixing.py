"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations alone.

Each source gets a share of the budget by its weight, at most `most` times its size; what a source cannot use is shared
again by weight. Its documents are shuffled (by a hash of their id) and queue up; a source that may be read more than once
queues up again, in the same order. A document's virtual finish time is the words queued up to its end over the target of
its source. All documents are ranged by virtual finish time, and the mix is what comes before the total budget is spent:
that is where the running sum of words reaches it, near time 1, when every source has had about its target.

Running sums are in levels: within buckets of the shuffled order or of virtual time (some thousand rows each, however
large the source), over the sums of buckets, and, for virtual time, over the sums of BUCKETS_TOGETHER buckets. No task gets
a source as a whole. The place where the budget ends is one row, found in the one bucket that holds it.

Edge cases: a null text has size 0; null is a source of its own, last in order; an empty table gives an empty mix; rows that
repeat an id queue one after the other. Ties in the shuffled order go by id, then size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.llm.shared import stash

WEIGHTS = (3, 1, 2)
ROWS_PER_BUCKET = 4096
BUCKETS_TOGETHER = 1024
DIGITS = 13  # of the hash: 52 bits


def words_in(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes: (source, source_size, n_rows), one row a source. Adds weight and target.

    Sources are capped in the order of their cap over their weight. For each place in that order the level that is left
    for it and those behind it is known from running sums; the first place where the level is under its cap settles it.
    """
    by_name, by_cap = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("cap_rate", F.col("source").asc_nulls_last())
    named = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    named = named.withColumn("cap_rate", most * F.col("source_size") / F.col("weight"))
    before, after, every = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    spare = F.lit(budget) * F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    level = named.withColumn("level", spare / F.sum("weight").over(after))
    settled = level.withColumn("level", F.min_by(F.col("level"), F.when(F.col("level") <= F.col("cap_rate"), F.col("cap_rate"))).over(every))
    return settled.select("source", "source_size", "n_rows", "weight", F.least(most * F.col("source_size"), F.col("level") * F.col("weight")).alias("target"))


def queued(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, start (words of its source before it)."""
    order = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, DIGITS), 16, 10).cast("long")
    rows = stash(docs.select("doc_id", "source", words_in("text").alias("size"), order.alias("order")), "sizes")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows")), weights, budget, most)
    buckets = F.ceil(F.col("n_rows") / ROWS_PER_BUCKET)
    placed = rows.alias("r").join(sources.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
    placed = placed.select("doc_id", "r.source", "size", "order", "source_size", "target", F.floor(F.col("order") / float(16**DIGITS) * buckets).alias("bucket"))
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("o_source"), F.col("bucket").alias("o_bucket"), F.coalesce(F.sum("words").over(running), F.lit(0)).alias("offset"))
    within = Window.partitionBy("source", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("so_far", F.sum("size").over(within))
    summed = summed.join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket")))
    return summed.select("doc_id", "source", "size", "source_size", "target", (F.col("offset") + F.col("so_far") - F.col("size")).alias("start"))


def place(turn: int | Column) -> Column:
    """The place in the order of all sources of a document that is read for the turn-th time (from 0)."""
    end = F.col("start") + F.col("size") + turn * F.col("source_size")
    return F.struct((end / F.col("target")).alias("finish"), F.col("source").isNull().alias("last"), F.coalesce("source", F.lit("")).alias("source"), end.alias("end"))


def truncated(rows: DataFrame, total: int, turns: int) -> DataFrame:
    """One row at most: the place where the running sum of words in the order of virtual finish times reaches the total, and
    the words of that document that are inside. rows: as queued() returns them."""
    n = max(1, -(-rows.count() * turns // ROWS_PER_BUCKET))
    copies = rows.where("target > 0").select("*", F.explode(F.array(*map(F.lit, range(turns)))).alias("turn")).select("size", place(F.col("turn")).alias("at"))
    copies = copies.withColumn("bucket", F.least(F.floor(F.col("at.finish") / 2 * n), F.lit(2 * n)))
    sums = copies.groupBy("bucket").agg(F.sum("size").alias("words")).withColumn("together", F.floor(F.col("bucket") / BUCKETS_TOGETHER))
    before = lambda w: F.coalesce(F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    large = sums.groupBy("together").agg(F.sum("words").alias("words")).select("together", before(Window.orderBy("together")).alias("large"))
    placed = sums.join(large, "together").select("bucket", "words", (F.col("large") + before(Window.partitionBy("together").orderBy("bucket"))).alias("offset"))
    edge = placed.where((F.col("offset") < total) & (F.col("offset") + F.col("words") >= total)).select("bucket", "offset")
    inside = copies.join(edge, "bucket").withColumn("so_far", F.col("offset") + F.sum("size").over(Window.partitionBy("bucket").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
    first = inside.where(F.col("so_far") >= total).agg(F.min(F.struct("so_far", "at", "size")).alias("x")).where("x is not null")
    return first.select(F.col("x.at").alias("cut"), (F.lit(total) - F.col("x.so_far") + F.col("x.size")).alias("inside"))


def schedule(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, start, virtual_finish (of its first reading) and takes
    (words that the mix takes of it, by reading)."""
    rows = stash(queued(docs, weights, budget, most, seed), "queued")
    turns = max(1, int(-(-most // 1)))
    words = rows.agg(F.sum("size")).first()[0] or 0
    cut = truncated(rows, int(min(budget, most) * words), turns).first()  # one row
    size, none = F.col("size"), F.lit(0).cast("long")
    if cut is None:
        taken = [size if words else none] * turns
    else:
        end = F.struct(*[F.lit(cut["cut"][k]).cast(t).alias(k) for k, t in (("finish", "double"), ("last", "boolean"), ("source", "string"), ("end", "long"))])
        taken = [F.when(place(k) < end, size).when(place(k) == end, F.least(size, F.lit(cut["inside"]))).otherwise(none) for k in range(turns)]
    return rows.withColumns({"takes": F.when(F.col("target") > 0, F.array(*taken)).otherwise(F.array(*[none] * turns)), "virtual_finish": F.when(F.col("target") > 0, place(0)["finish"])})


def mix_sizes(docs: DataFrame, **how) -> DataFrame:
    """What the mix takes of each document, cut to the word where the budget ends, in the order of virtual finish times
    (a global range sort)."""
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = schedule(docs, **how).select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "virtual_finish")
    return rows.orderBy(F.col("virtual_finish").asc_nulls_last(), "source", "doc_id", "size")


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mix as whole documents with the columns of docs, once for each time that it is read, in no order. A document in
    which the budget ends stays whole if at least half of it is inside."""
    times = F.aggregate(F.transform("takes", lambda x: ((x * 2 >= F.col("size")) & (F.col("target") > 0)).cast("int")), F.lit(0), lambda a, x: a + x)
    rows = schedule(docs, **how).select(F.col("doc_id").alias("m_id"), F.col("size").alias("m_size"), "start", times.alias("m_times"))
    words = docs.withColumns({"m_words": words_in("text"), "m_nth_row": F.lit(1)})
    repeated = rows.groupBy("m_id", "m_size").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0
    if repeated:  # of rows that share an id and a size, each is chosen as often as the schedule says
        rows = rows.withColumn("m_nth", F.row_number().over(Window.partitionBy("m_id", "m_size").orderBy("start")))
        words = words.withColumn("m_nth_row", F.row_number().over(Window.partitionBy("doc_id", "m_words").orderBy(F.md5(F.coalesce("text", F.lit(""))))))
    else:
        rows = rows.withColumn("m_nth", F.lit(1))
    rows = rows.where("m_times > 0")
    matched = words.hint("merge").join(rows, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("m_words") == F.col("m_size")) & (F.col("m_nth_row") == F.col("m_nth")))
    return matched.withColumn("m_turn", F.explode(F.sequence(F.lit(1), F.col("m_times")))).select(docs.columns)

"""Sequences: genome_id, gene_ord, gene_id, header, seq, len."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.functions import text
from cladeframe.scratch import stash


def filter_by_ids(seqs: DataFrame, ids: DataFrame, inverse: bool = False) -> DataFrame:
    """Sequences whose gene_id is listed (column id), or is not."""
    return seqs.join(ids.select(F.col("id").alias("gene_id")), "gene_id", "left_anti" if inverse else "left_semi")


def seq_lengths(seqs: DataFrame) -> DataFrame:
    return seqs.select("gene_id", F.length("seq").alias("len"))


def strip_stops(seqs: DataFrame) -> DataFrame:
    seq = text.strip_stops("seq")
    return seqs.withColumns({"seq": seq, "len": F.length(seq)})


LARGE = 100_000  # rows of a group that are numbered in one task
SLOTS = 16_384  # of groups by their hash: what is counted of all groups, whatever their number


def numbers(keys: DataFrame, within: Sequence[str], order: Sequence[str], large: int = LARGE) -> DataFrame:
    """keys with n: the place of each row, from 1, in the order of some columns within the groups of others, nulls first.

    Groups are counted first, by slots of their hash, which moves no more than a row a slot and task; only groups in slots of
    over `large` rows are counted one by one. Those of up to `large` rows are numbered where a shuffle by the group brings them;
    larger ones (a row for each of them is saved) are spread over ranges. Only keys are moved."""
    slot = F.pmod(F.xxhash64(*within), F.lit(SLOTS))
    nth = F.row_number().over(Window.partitionBy(*within).orderBy(*order)).cast("long")
    full = [r["slot"] for r in keys.groupBy(slot.alias("slot")).count().where(F.col("count") > large).collect()]
    if not full:
        return keys.withColumn("n", nth)
    sizes = keys.where(slot.isin(full)).groupBy(*within).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > large)
    found = stash(sizes.select(*[F.col(c).alias(f"l_{c}") for c in within]), "large-groups")
    if found.isEmpty():
        return keys.withColumn("n", nth)
    same = [F.col(c).eqNullSafe(F.col(f"l_{c}")) for c in within]
    small, spread = keys.join(found, same, "left_anti"), keys.join(found, same, "left_semi")
    return small.withColumn("n", nth).unionByName(range_numbers(spread, within, order))


def range_numbers(keys: DataFrame, within: Sequence[str], order: Sequence[str]) -> DataFrame:
    """numbers for groups of any size. Rows are ranged by sampled bounds, so that tasks are of like size whatever the keys are;
    each range is numbered, and begins with the rows that its groups have in the ranges before."""
    by = [*within, *order]
    ranged = keys.repartitionByRange(*by).withColumn("n_range", F.spark_partition_id())
    ranged = stash(ranged, "ranges")
    counts = ranged.groupBy(*within, "n_range").agg(F.count("*").alias("n_rows"))
    before = F.coalesce(F.sum("n_rows").over(Window.partitionBy(*within).orderBy("n_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*[F.col(c).alias(f"c_{c}") for c in [*within, "n_range"]], before.alias("n_before"))
    nth = ranged.withColumn("n_nth", F.row_number().over(Window.partitionBy(*within, "n_range").orderBy(*order)))
    same = [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in [*within, "n_range"]]
    return nth.join(counts, same).select(*keys.columns, (F.col("n_before") + F.col("n_nth")).alias("n"))


def numbered(seqs: DataFrame, within: Sequence[str], order: Sequence[str], stored: bool = False) -> DataFrame:
    """seqs with n (see numbers). Of rows with a seq the keys alone are numbered, and meet them in one join, which moves each
    sequence once, or, of a store whose keys these are (see sources.store), not at all. Two sequences of one place are an
    error then."""
    if "seq" not in seqs.columns:
        return numbers(seqs, within, order)
    by = [*within, *order]
    placed = numbers(seqs.select(*by), within, order).groupBy(*by).agg(F.min("n").alias("n"), F.count("*").alias("n_rows"))
    n = F.when(F.col("n_rows") == 1, F.col("n")).otherwise(F.raise_error(F.lit("several sequences of one place")).cast("long")).alias("n")
    if stored:  # its keys are never null
        return seqs.join(placed.select(*by, n), by).select(*seqs.columns, "n")
    placed = placed.select(*[F.col(c).alias(f"k_{c}") for c in by], n)
    return seqs.join(placed, [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in by]).select(*seqs.columns, "n")


def gene_names(seqs: DataFrame, *more: str) -> DataFrame:
    """genome_id, gene_ord, gene_id and len, if there is one, of sequences that are called <genome>_<n>, and more of their columns;
    no sequence is moved."""
    keys = seqs.select("genome_id", "gene_ord", *[c for c in ("len",) if c in seqs.columns], *more)
    return numbers(keys, ["genome_id"], ["gene_ord"]).withColumn("gene_id", F.concat_ws("_", "genome_id", "n")).drop("n")


def rename_sequential(seqs: DataFrame, stored: bool = False) -> DataFrame:
    """gene_id becomes <genome>_<n>, n from 1 in file order."""
    return numbered(seqs, ["genome_id"], ["gene_ord"], stored).withColumn("gene_id", F.concat_ws("_", "genome_id", "n")).drop("n")


def prefix_headers(seqs: DataFrame, prefix: Sequence[str] | str, within: Sequence[str] = ("genome_id",), order: Sequence[str] = ("gene_ord",)) -> DataFrame:
    """gene_id becomes <prefix>_<id>_<n>; prefix names columns, and n counts within what is one file: a genome, or a genome's
    hits of one target."""
    lead = [prefix] if isinstance(prefix, str) else list(prefix)
    return numbered(seqs, within, order).withColumn("gene_id", F.concat_ws("_", *lead, "gene_id", "n")).drop("n")


def swap_ids(df: DataFrame, swaps: DataFrame, column: str) -> DataFrame:
    """Ids replaced by a partial map (old, new, ord): the later of two rows for an id counts; ids not in it stay."""
    last = swaps.groupBy(F.col("old").alias(column)).agg(F.max_by("new", "ord").alias("swapped_id"))
    return df.join(last, column, "left").withColumn(column, F.coalesce("swapped_id", column)).drop("swapped_id").select(df.columns)


def reorder(seqs: DataFrame, listed: DataFrame, column: str = "gene_id") -> DataFrame:
    """Exactly the listed ids (column id) in the order of the list (column ord); an id that is missing is an error."""
    wanted = listed.select(F.col("id").alias(column), F.col("ord").alias("list_ord"))
    absent = wanted.join(seqs.select(column), column, "left_anti").limit(5).collect()
    if absent:
        raise ValueError("no sequence for " + ", ".join(str(r[column]) for r in absent))
    return seqs.join(wanted, column).orderBy("list_ord").drop("list_ord").select(seqs.columns)


def filter_cds(features: DataFrame) -> DataFrame:
    """Features that are whole: no joined or open location, no note of a broken frame, no exception, no pseudogene."""
    q, location = F.col("qualifiers"), F.col("location")
    note = F.coalesce(F.element_at(q["note"], 1), F.lit(""))
    broken = location.contains("join") | location.rlike("[<>]") | note.rlike("frameshifted|internal stop|incomplete")
    return features.where(~broken & ~F.map_contains_key(q, F.lit("transl_except")) & ~F.map_contains_key(q, F.lit("pseudo")))


def cds_to_sequences(features: DataFrame) -> DataFrame:
    """gene_id and protein of features: the locus tag, else <contig>_<start>_<end>; features without translation are left out."""
    q = F.col("qualifiers")
    place = F.concat_ws("_", "contig", F.regexp_extract("location", r"(\d+)\D+\d+", 1), F.regexp_extract("location", r"\d+\D+(\d+)", 1))
    seq = F.regexp_replace(q["translation"][0], r"\s", "")
    rows = features.select("genome_id", F.coalesce(q["locus_tag"][0], place).alias("gene_id"), seq.alias("seq"))
    return rows.where("seq is not null").withColumn("len", F.length("seq"))

"""Length bounds from medians; which markers and genomes stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def length_bounds(hit_seqs: DataFrame, cutoff: float = 0.2) -> DataFrame:
    """marker, median, lo, hi: the exact median length, and it less and more a share of itself, rounded half to even.

    The median comes from a count per length, so that a marker of very many genomes is as many rows as it has lengths."""
    by_length = hit_seqs.groupBy("marker", "len").count()
    median = by_length.groupBy("marker").agg(F.expr("percentile(len, 0.5, count)").alias("median"))
    m = F.col("median")
    return median.select("marker", "median", F.bround(m - m * cutoff, 0).alias("lo"), F.bround(m + m * cutoff, 0).alias("hi"))


def filter_by_bounds(hit_seqs: DataFrame, bounds: DataFrame) -> DataFrame:
    """Sequences within their marker's bounds, ends included."""
    return hit_seqs.join(bounds.select("marker", "lo", "hi"), "marker").where("len between lo and hi").drop("lo", "hi")


def filter_by_length(seqs: DataFrame, lo: int, hi: int) -> DataFrame:
    return seqs.where(F.length("seq").between(lo, hi))


def retention(seqs: DataFrame, kept: DataFrame) -> DataFrame:
    """kept, total and percent of both tables' rows in one row."""
    both = seqs.agg(F.count("*").alias("total")).withColumn("kept", F.lit(0)).unionByName(kept.agg(F.count("*").alias("kept")).withColumn("total", F.lit(0)))
    sums = both.agg(F.sum("kept").alias("kept"), F.sum("total").alias("total"))
    return sums.withColumn("percent", F.when(F.col("total") > 0, F.bround(F.col("kept") / F.col("total") * 100, 2)))


def retain_markers(hit_seqs: DataFrame, markers: DataFrame, min_seqs: int = 2) -> tuple[DataFrame, DataFrame]:
    """Markers with enough sequences (marker, n), and those without with the reason."""
    n = F.coalesce(F.col("n"), F.lit(0))
    counted = markers.select("marker").distinct().join(hit_seqs.groupBy("marker").agg(F.count("*").alias("n")), "marker", "left").select("marker", n.alias("n"))
    removed = counted.where(F.col("n") < min_seqs).withColumn("reason", F.when(F.col("n") == 0, "no hits").otherwise("too few hits"))
    return counted.where(F.col("n") >= min_seqs), removed


def drop_emptied(kept: DataFrame, removed: DataFrame, filtered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """retain_markers' two tables after the length filter: markers that it left without a sequence are removed as well."""
    left = filtered.select("marker").distinct()
    emptied = kept.join(left, "marker", "left_anti").withColumn("reason", F.lit("all filtered by length"))
    return kept.join(left, "marker", "left_semi"), removed.unionByName(emptied)


def genome_cutoff(n_markers: int, share: float) -> int:
    return max(1, round(share * n_markers))  # Python rounds half to even


def retain_genomes(filtered: DataFrame, genomes: DataFrame, n_markers: int, share: float = 0.5, min_genomes: int = 3) -> tuple[DataFrame, DataFrame]:
    """Genomes with enough retained sequences, and the others, both (genome_id, uniq_hits). Fewer than min_genomes is an error."""
    n = F.coalesce(F.col("uniq_hits"), F.lit(0))
    counted = genomes.select("genome_id").distinct().join(filtered.groupBy("genome_id").agg(F.count("*").alias("uniq_hits")), "genome_id", "left").select("genome_id", n.alias("uniq_hits"))
    cutoff = genome_cutoff(n_markers, share)
    kept = counted.where(F.col("uniq_hits") >= cutoff)
    if kept.limit(min_genomes).count() < min_genomes:
        raise ValueError(f"fewer than {min_genomes} genomes have {cutoff} markers or more")
    return kept, counted.where(F.col("uniq_hits") < cutoff)

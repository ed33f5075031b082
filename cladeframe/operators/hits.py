"""Hit counts, completeness and the choice of hits. hits: genome_id, gene_id, marker, evalue, ord and others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.operators.names import listed


def hit_counts(hits: DataFrame, genomes: DataFrame, markers: Sequence[str]) -> DataFrame:
    """genome_id, marker, n for each genome and marker, zeros included. The zeros are made after the join: the markers that a
    genome's counts lack come from one difference of two lists, which takes time with the markers, not with their square, and
    genomes times markers are never shuffled."""
    found = hits.where(F.col("marker").isin(list(markers))).groupBy("genome_id", "marker").agg(F.count("*").alias("n"))
    each = found.groupBy("genome_id").agg(F.collect_list(F.struct("marker", "n")).alias("found"))
    known = genomes.select("genome_id").distinct().join(each, "genome_id", "left").withColumn("found", F.coalesce("found", F.array().cast("array<struct<marker:string,n:bigint>>")))
    absent = F.transform(F.array_except(listed(markers), F.col("found.marker")), lambda m: F.struct(m.alias("marker"), F.lit(0).cast("long").alias("n")))
    return known.select("genome_id", F.inline(F.concat("found", absent)))


def hit_matrix(counts: DataFrame, markers: Sequence[str], gene_counts: DataFrame | None = None, genomes: DataFrame | None = None) -> DataFrame:
    """One row a genome, one column a marker; total_gene_count too if given. counts (a row for each genome and marker) need no
    zeros where the genomes are given; without them, only for a genome that has no rows.

    A genome's counts meet in one map, which the columns are looked up in: genomes times markers are never rows."""
    entry = F.when(F.col("marker").isin(list(markers)), F.struct("marker", "n"))
    wide = counts.groupBy("genome_id").agg(F.map_from_entries(F.collect_list(entry)).alias("found"))
    if genomes is not None:
        wide = genomes.select("genome_id").distinct().join(wide, "genome_id", "left")
    wide = wide.select("genome_id", *[F.coalesce(F.try_element_at("found", F.lit(m)), F.lit(0).cast("long")).alias(m) for m in markers])
    return wide if gene_counts is None else wide.join(gene_counts, "genome_id", "left").select("genome_id", "total_gene_count", *[F.col(f"`{m}`") for m in markers])


def found_counts(hits: DataFrame, markers: Sequence[str]) -> DataFrame:
    """genome_id, marker, n of the wanted markers, without zeros."""
    return hits.where(F.col("marker").isin(list(markers))).groupBy("genome_id", "marker").agg(F.count("*").alias("n"))


def genome_quality(counts: DataFrame, total: int, genomes: DataFrame | None = None) -> DataFrame:
    """num_hits (markers found), uniq_hits (found once), redund (hits beyond the first), and both as percent of the marker set,
    rounded half to even. counts need no zeros where the genomes are given; without them, only for a genome that has no rows."""
    n = F.col("n")
    sums = counts.groupBy("genome_id").agg(
        F.sum((n > 0).cast("long")).alias("num_hits"), F.sum((n == 1).cast("long")).alias("uniq_hits"), F.sum(F.greatest(n - 1, F.lit(0))).cast("long").alias("redund")
    )
    if genomes is not None:
        sums = genomes.select("genome_id").distinct().join(sums, "genome_id", "left").na.fill(0, ["num_hits", "uniq_hits", "redund"])
    percent = lambda c: F.bround(F.col(c) / F.lit(float(total)) * 100, 2)
    return sums.withColumns({"perc_comp": percent("num_hits"), "perc_redund": percent("redund")})


def flag_redundant(quality: DataFrame, least: float = 10.0) -> DataFrame:
    return quality.where(F.col("perc_redund") >= least)


def gene_counts(seqs: DataFrame) -> DataFrame:
    return seqs.groupBy("genome_id").agg(F.count("*").alias("total_gene_count"))


def select_single_copy(hits: DataFrame) -> DataFrame:
    """Hits of markers that the genome has once."""
    return hits.withColumn("copies", F.count("*").over(Window.partitionBy("genome_id", "marker"))).where("copies = 1").drop("copies")


def select_best_hit(hits: DataFrame, order: Sequence[str] = ("evalue", "ord")) -> DataFrame:
    """The first hit of each genome and marker in this order."""
    return hits.withColumn("place", F.row_number().over(Window.partitionBy("genome_id", "marker").orderBy(*order))).where("place = 1").drop("place")


def select_all(hits: DataFrame, targets: DataFrame) -> DataFrame:
    """All hits of the wanted markers. targets: marker."""
    return hits.join(targets.select("marker"), "marker", "left_semi")


def place_hits(hits: DataFrame, named: DataFrame) -> DataFrame:
    """Hits with gene_ord, and len if it is known, of their genes (named: see sequences.gene_names)."""
    return hits.drop("gene_ord").join(named, ["genome_id", "gene_id"])


def fetch_hit_seqs(hits: DataFrame, seqs: DataFrame) -> DataFrame:
    """Hits with the seq of their genes: by (genome_id, gene_ord) where hits are placed, which a store answers in place, else
    by (genome_id, gene_id). With nucleotide sequences of the same genes, the gene of a protein's hit."""
    keys = ["genome_id", "gene_ord" if "gene_ord" in hits.columns else "gene_id"]
    return hits.join(seqs.select(*keys, "seq"), keys)

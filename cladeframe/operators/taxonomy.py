"""Lineages: splitting, searching, counting and sub-sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.scratch import stash

RANKS = ["domain", "phylum", "class", "order", "family", "genus", "species"]


def split_lineage(df: DataFrame, column: str, ranks: Sequence[str] = RANKS) -> DataFrame:
    """d__..;p__..;.. as one column a rank, without the tags; a row of another number of parts is an error."""
    parts = F.split(column, ";")
    right = F.when(F.size(parts) == len(ranks), parts).otherwise(F.raise_error(F.concat(F.lit("not a lineage of so many ranks: "), F.coalesce(F.col(column), F.lit("null")))))
    return df.withColumn("lineage_parts", right).select("*", *[F.substring(F.col("lineage_parts")[k], 4, 1000).alias(r) for k, r in enumerate(ranks)]).drop("lineage_parts")


def representatives(gtdb: DataFrame, source: str | None) -> DataFrame:
    """Rows that are representatives by GTDB or by RefSeq; all for None."""
    if source is None:
        return gtdb
    column, value = {"gtdb": ("gtdb_representative", "t"), "refseq": ("ncbi_refseq_category", "representative genome")}[source]
    return gtdb.where(F.col(column) == value)


def long_ranks(gtdb: DataFrame, ranks: Sequence[str], *more: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(r).alias("rank"), F.col(f"`{r}`").alias("taxon")) for r in ranks])
    return gtdb.select(*more, F.inline(pairs))


def rank_counts(gtdb: DataFrame, ranks: Sequence[str] = RANKS, reps: str = "refseq") -> DataFrame:
    """rank, n_taxa, n_taxa_rep: distinct taxa of each rank, in all rows and among representatives; nulls do not count."""
    column, value = {"gtdb": ("gtdb_representative", "t"), "refseq": ("ncbi_refseq_category", "representative genome")}[reps]
    flagged = long_ranks(gtdb.withColumn("is_rep", F.coalesce(F.col(column) == value, F.lit(False))), ranks, "is_rep")
    taxa = flagged.where("taxon is not null").groupBy("rank", "taxon").agg(F.max("is_rep").alias("is_rep"))
    return taxa.groupBy("rank").agg(F.count("*").alias("n_taxa"), F.count_if("is_rep").alias("n_taxa_rep"))


def taxon_counts(gtdb: DataFrame, taxon: str, ranks: Sequence[str] = RANKS, reps: str = "refseq") -> DataFrame:
    """rank, n, n_rep: rows of a taxon by rank, letter case as given; all counts every row, as rank all."""
    column, value = {"gtdb": ("gtdb_representative", "t"), "refseq": ("ncbi_refseq_category", "representative genome")}[reps]
    flagged = gtdb.withColumn("is_rep", F.coalesce(F.col(column) == value, F.lit(False)))
    if taxon == "all":
        return flagged.agg(F.lit("all").alias("rank"), F.count("*").alias("n"), F.count_if("is_rep").alias("n_rep"))
    return long_ranks(flagged, ranks, "is_rep").where(F.col("taxon") == taxon).groupBy("rank").agg(F.count("*").alias("n"), F.count_if("is_rep").alias("n_rep"))


def taxon_search(gtdb: DataFrame, taxon: str, rank: str | None = None, reps: str | None = None, ranks: Sequence[str] = RANKS) -> DataFrame:
    """The rows of a taxon. Without a rank it must be in one rank alone; to be in none is an error."""
    if taxon == "all":
        return representatives(gtdb, reps)
    found = [r["rank"] for r in taxon_counts(gtdb, taxon, ranks).collect()]
    rank = rank.lower() if rank else None
    if not found or rank and rank not in found:
        raise ValueError(f"no {rank or 'rank'} holds {taxon}")
    if rank is None and len(found) > 1:
        raise ValueError(f"{taxon} is in several ranks: {', '.join(sorted(found))}")
    return representatives(gtdb.where(F.col(f"`{rank or found[0]}`") == taxon), reps)


def lot(seed: int, column: str = "accession") -> Column:
    """The order of a draw that can be repeated."""
    return F.md5(F.concat(F.lit(f"{seed}|"), column))


def one_per_rank(gtdb: DataFrame, rank: str, seed: int = 1) -> DataFrame:
    """One row for each taxon of a rank, drawn by lot, with the accession's source prefix left out. The lot is a grouped
    minimum: a taxon of very many rows is combined before the shuffle."""
    drawn = gtdb.where(F.col(f"`{rank}`").isNotNull()).groupBy(F.col(f"`{rank}`").alias("taxon")).agg(F.min_by("accession", F.struct(lot(seed), "accession")).alias("accession"))
    return drawn.select("taxon", F.substring("accession", 4, 1000).alias("accession"))


def downsample_classes(gtdb: DataFrame, cutoff: float = 0.0005, fraction: float = 0.01, seed: int = 1, min_keep: int = 0) -> DataFrame:
    """Classes of int(rows x cutoff) rows or more keep int(their rows x fraction), drawn by lot; others stay whole."""
    sizes = gtdb.groupBy("class").agg(F.count("*").alias("class_rows"))
    total = sizes.agg(F.sum("class_rows")).first()[0] or 0
    large = int(total * cutoff)
    keep = F.greatest(F.floor(F.col("class_rows") * fraction), F.lit(min_keep))
    sized = gtdb.join(sizes.withColumnRenamed("class", "sized_class"), F.col("class").eqNullSafe(F.col("sized_class"))).drop("sized_class")
    whole = sized.where(F.col("class_rows") < large)
    # places in two levels, so that no task sorts a class as a whole: within a bucket of the lot, and over buckets' counts
    drawn = sized.where(F.col("class_rows") >= large).withColumn("lot", lot(seed)).withColumn("bucket", F.substring("lot", 1, 2))
    counts = drawn.groupBy("class", "bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col("class").alias("o_class"), F.col("bucket").alias("o_bucket"), before.alias("before"))
    placed = drawn.withColumn("place", F.row_number().over(Window.partitionBy("class", "bucket").orderBy("lot", "accession")))
    placed = placed.join(offsets, F.col("class").eqNullSafe(F.col("o_class")) & (F.col("bucket") == F.col("o_bucket")))
    cut = placed.where(F.col("before") + F.col("place") <= keep).drop("lot", "bucket", "place", "before", "o_class", "o_bucket")
    return whole.unionByName(cut).drop("class_rows").withColumn("accession", F.substring("accession", 4, 1000))


def resolve_lineage(taxids: DataFrame, nodes: DataFrame, names: DataFrame, ranks: Sequence[str] = RANKS) -> DataFrame:
    """taxid and one column a rank, NA where there is none: for each rank the nearest ancestor's name, the node itself first.

    Pointers are doubled: a node knows the ranks of its next 2^k ancestors and where they end; a round gives it those of that
    node as well, so the written rounds are as many as the binary digits of the deepest line (five or six in the public
    tree), each a join of the tree (a row a node) with itself. A parent that is missing, or the node itself, ends a line. In
    a circle no line ends; its nodes are done when the lines are as long as the nodes that are left are many."""
    tree = nodes.groupBy("taxid").agg(F.min(F.struct("parent", "rank")).alias("n")).select("taxid", "n.parent", "n.rank")
    named = tree.join(names.groupBy("taxid").agg(F.min("name").alias("name")), "taxid", "left")
    wanted = [f"r{k}" for k in range(len(ranks))]
    own = [F.when(F.col("rank") == r, F.col("name")).alias(c) for c, r in zip(wanted, ranks, strict=True)]
    at = stash(named.select("taxid", F.when(F.col("parent") != F.col("taxid"), F.col("parent")).alias("up"), *own), "lineages")
    reach, left = 1, at.where("up is not null").count()
    while left:
        above = at.select(F.col("taxid").alias("up"), F.col("up").alias("next"), *[F.col(c).alias(f"up_{c}") for c in wanted])
        at = stash(at.join(above, "up", "left").select("taxid", F.col("next").alias("up"), *[F.coalesce(c, f"up_{c}").alias(c) for c in wanted]), "lineages")
        reach, before, left = 2 * reach, left, at.where("up is not null").count()
        if left == before and reach >= left:
            break
    wide = at.select("taxid", *[F.col(c).alias(r) for c, r in zip(wanted, ranks, strict=True)])
    return taxids.select("taxid").distinct().join(wide, "taxid", "left").na.fill("NA", list(ranks))

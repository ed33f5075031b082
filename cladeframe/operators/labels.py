"""Labels of genomes: from lineages, strains and the user's map, in that order of strength."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe.functions.text import label_text, screen_label
from cladeframe.operators.sequences import swap_ids

ORDER = ["domain", "phylum", "class", "order", "family", "genus", "species", "strain"]
DEFAULT = ["domain", "phylum", "class", "species", "strain"]


def lineage_labels(lineage: DataFrame, ranks: Sequence[str] = DEFAULT) -> DataFrame:
    """genome_id, label: the id and the wanted ranks from domain to species, blanks and marks replaced; null and NA are left out."""
    wanted = {r.lower() for r in ranks}
    if unknown := wanted - set(ORDER):
        raise ValueError(f"no such ranks: {sorted(unknown)}")
    parts = [F.nullif(label_text(F.nullif(F.col(f"`{r}`"), F.lit("NA")), species=r == "species"), F.lit("")) for r in ORDER[:-1] if r in wanted and r in lineage.columns]
    return lineage.select("genome_id", F.concat_ws("_", F.col("genome_id").cast("string"), *parts).alias("label"))


def add_strain(labels: DataFrame, infra: DataFrame) -> DataFrame:
    """Labels with the strain behind them (infra: genome_id, infraspecific), 'strain=' left out; none for null and NA."""
    strain = F.nullif(F.regexp_replace("infraspecific", "strain=", ""), F.lit("NA"))
    joined = labels.join(infra.select("genome_id", F.nullif(label_text(strain), F.lit("")).alias("strain_text")), "genome_id", "left")
    return joined.select("genome_id", F.concat_ws("_", "label", "strain_text").alias("label"))


def final_labels(genomes: DataFrame, user_map: DataFrame, gtdb: DataFrame | None = None, ncbi: DataFrame | None = None) -> DataFrame:
    """genome_id, label, label_source. The user's label is preferred to GTDB's, that to NCBI's (marked _NCBI where GTDB was
    asked for as well), that to the id; the user's suffix goes behind any of them."""
    none = genomes.select("genome_id", F.lit(None).cast("string").alias("label")).where("false")
    g, n = (none if gtdb is None else gtdb), (none if ncbi is None else ncbi)
    rows = genomes.select("genome_id").distinct()
    for df, name in ((user_map.select("genome_id", F.col("label").alias("own"), "suffix"), None), (g, "by_gtdb"), (n, "by_ncbi")):
        rows = rows.join(df if name is None else df.select("genome_id", F.col("label").alias(name)), "genome_id", "left")
    own, suffix = F.nullif("own", F.lit("")), F.nullif("suffix", F.lit(""))
    from_ncbi = F.concat("by_ncbi", F.lit("_NCBI")) if gtdb is not None else F.col("by_ncbi")
    label = F.coalesce(own, "by_gtdb", from_ncbi, F.col("genome_id").cast("string"))
    source = F.when(own.isNotNull(), "user_map").when(F.col("by_gtdb").isNotNull(), "GTDB").when(F.col("by_ncbi").isNotNull(), "NCBI").otherwise("input")
    return rows.select("genome_id", screen_label(F.concat_ws("_", label, suffix)).alias("label"), F.concat(source, F.when(suffix.isNotNull(), "_and_appended").otherwise("")).alias("label_source"))


def apply_labels(df: DataFrame, labels: DataFrame) -> DataFrame:
    """genome_id replaced by its label."""
    swaps = labels.select(F.col("genome_id").cast("string").alias("old"), F.col("label").alias("new"), F.lit(0).alias("ord"))
    return swap_ids(df.withColumn("genome_id", F.col("genome_id").cast("string")), swaps, "genome_id")

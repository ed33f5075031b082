"""Summaries and tree-viewer files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cladeframe.scratch import stash

COLORS = {"blue": "#0000ff", "green": "#00a33f", "red": "#a30000"}


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def genome_summary(sources: Sequence[DataFrame], filtered_counts: DataFrame, kept: DataFrame) -> DataFrame:
    """Summaries of the sources (assembly_id, taxid, num_hits, uniq_hits, perc_comp, perc_redund), with the count after the
    length filter (filtered_counts: genome_id, uniq_hits) and in_final_tree."""
    rows = union_all([s.select("assembly_id", "taxid", "num_hits", "uniq_hits", "perc_comp", "perc_redund") for s in sources])
    after = filtered_counts.select(F.col("genome_id").alias("assembly_id"), F.col("uniq_hits").alias("after"))
    final = kept.select(F.col("genome_id").alias("assembly_id"), F.lit("Yes").alias("final"))
    joined = rows.join(after, "assembly_id", "left").join(final, "assembly_id", "left")
    return joined.select(*rows.columns, F.coalesce("after", F.lit(0)).alias("num_hits_after_len_filt"), F.coalesce("final", F.lit("No")).alias("in_final_tree"))


def summary_with_taxonomy(summary: DataFrame, ncbi: DataFrame, gtdb: DataFrame, ranks: Sequence[str]) -> DataFrame:
    """The summary with NCBI_ and GTDB_ columns for each rank, NA where unknown."""
    out = summary
    for name, df in (("NCBI", ncbi), ("GTDB", gtdb)):
        have = [r for r in ranks if r in df.columns]
        out = out.join(df.select(F.col("genome_id").alias("assembly_id"), *[F.col(f"`{r}`").alias(f"{name}_{r}") for r in have]), "assembly_id", "left")
        out = out.withColumns({f"{name}_{r}": F.coalesce(F.col(f"{name}_{r}"), F.lit("NA")) for r in have})
    return out


def run_totals(summary: DataFrame, missing: DataFrame, least: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """The run's summary, written, and one row of totals: genomes given, retained, removed, redundant, and ids not found.

    The totals are observed while both tables are written, so nothing is read again to count it. summary: perc_redund and
    in_final_tree, a row a genome; missing: a row for each id that was not found."""
    seen, absent = Observation("genomes"), Observation("missing")
    yes = F.col("in_final_tree") == "Yes"
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    watched = summary.observe(seen, F.count(F.lit(1)).alias("n_input"), count(yes).alias("n_retained"), count(F.col("perc_redund") >= least).alias("n_redundant"))
    written = stash(watched, "summary")
    stash(missing.observe(absent, F.count(F.lit(1)).alias("n_not_found")), "missing")
    got = seen.get | absent.get
    row = (got["n_input"], got["n_retained"], got["n_input"] - got["n_retained"], got["n_redundant"], got["n_not_found"])
    return written, summary.sparkSession.createDataFrame([row], "n_input long, n_retained long, n_removed long, n_redundant long, n_not_found long")


def itol_dataset(counts: DataFrame, labels: DataFrame, color: str = "blue") -> DataFrame:
    """target, ord, line: a header block for each marker, then a branch style for each genome that has it (labels:
    genome_id, label; genomes that are not in it are left out)."""
    header = ["DATASET_STYLE", "SEPARATOR SPACE", "DATASET_LABEL %s", f"COLOR {COLORS[color]}", "DATA"]
    lines = F.array(*[F.struct(F.lit(k).alias("ord"), F.regexp_replace(F.lit(h), "%s", F.col("marker")).alias("line")) for k, h in enumerate(header)])
    heads = counts.select("marker").distinct().select(F.col("marker").alias("target"), F.inline(lines))
    rows = counts.where("n > 0").join(labels.select("genome_id", "label"), "genome_id")
    return heads.unionByName(rows.select(F.col("marker").alias("target"), F.lit(len(header)).alias("ord"), F.concat(F.col("label").cast("string"), F.lit(f" branch node {COLORS[color]} 3 normal")).alias("line")))


def itol_colors(ids: DataFrame, what: str = "both", color: str = "blue") -> DataFrame:
    """ord, line: a colour map of labels, branches or both for ids (column id)."""
    if what not in ("labels", "branches", "both") or color not in COLORS:
        raise ValueError("what is labels, branches or both; color is blue, green or red")
    styles = [s for w, s in (("labels", f" label {COLORS[color]} bold"), ("branches", f" branch {COLORS[color]} normal 1.5")) if what in (w, "both")]
    lines = F.array(*[F.struct(F.lit(5 + k).alias("ord"), F.concat(F.col("id").cast("string"), F.lit(s)).alias("line")) for k, s in enumerate(styles)])
    head = ids.sparkSession.createDataFrame([(0, "TREE_COLORS"), (1, "SEPARATOR SPACE"), (2, "DATA")], "ord int, line string")
    return head.unionByName(ids.select(F.inline(lines)))

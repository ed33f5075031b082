"""The user's entry points: operators put together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe.operators import alignment, discovery, filters, ids, labels, report, sequences, taxonomy
from cladeframe.operators import hits as h
from cladeframe.operators.names import listed as listed_names
from cladeframe.operators.names import names
from cladeframe.scratch import stash
from cladeframe.sources import readers, store, writers


def gene_store(raw: DataFrame, buckets: int | None = None, lengths: bool = True) -> DataFrame:
    """Sequences as read (genome_id, gene_ord, seq), without stops and with len (letters are counted one by one, so leave it out
    where the genes' names have it, or nothing asks for it), in a store that joins leave where it is."""
    genes = bare_genes(raw)
    return store.write_store(genes if lengths else genes.drop("len"), buckets)


def bare_genes(raw: DataFrame) -> DataFrame:
    """What a gene_store holds, for plans that take no sequence: of it, only names and lengths are ever made."""
    return sequences.strip_stops(raw).select("genome_id", "gene_ord", "seq", "len")


def marker_sets(
    hits: DataFrame, genes: DataFrame, genomes: DataFrame, markers: Sequence[str], cutoff: float = 0.2, share: float = 0.5, best_hit: bool = False, order: Sequence[str] = ("evalue", "ord"), nucleotides: DataFrame | None = None, named: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """From sequences (genes: genome_id, gene_ord, seq, len, best a gene_store) and hits on them (gene_id <genome>_<n>) to the filtered
    sequences of each marker: quality, flagged, sequences, markers and genomes kept and removed, summary. genomes: genome_id, and taxid
    if it is known. With nucleotides, a table of the same genes, lengths and sequences are those. named: the genes' names, if they are
    known already (sequences.gene_names, written).

    Everything is decided on keys and lengths; sequences are fetched once, at the end, for what stays. The tables of a row a marker
    go to all tasks, as markers is a list that the driver holds. quality, one shuffle on keys, is made where it is asked for."""
    quality = h.genome_quality(h.found_counts(hits, markers), len(markers), genomes)
    wanted = hits.where(F.col("marker").isin(list(markers)))
    chosen = (h.select_best_hit(wanted, order) if best_hit else h.select_single_copy(wanted)).select("genome_id", "gene_id", "marker")
    found = h.place_hits(chosen, sequences.gene_names(genes) if named is None else named)
    if nucleotides is not None:
        found = found.drop("len").join(nucleotides.select("genome_id", "gene_ord", "len"), ["genome_id", "gene_ord"])
    found = stash(found, "chosen")
    listed = hits.sparkSession.range(1).select(F.explode(listed_names(markers)).alias("marker"))
    kept_markers, removed_markers = (stash(df, "markers") for df in filters.retain_markers(found, listed))
    narrow = found.join(F.broadcast(kept_markers.select("marker")), "marker", "left_semi")
    filtered = stash(filters.filter_by_bounds(narrow, F.broadcast(filters.length_bounds(narrow, cutoff))), "filtered")
    kept_markers, removed_markers = filters.drop_emptied(kept_markers, removed_markers, filtered)
    kept, removed = filters.retain_genomes(filtered, genomes, filtered.select("marker").distinct().count(), share)
    known = genomes if "taxid" in genomes.columns else genomes.withColumn("taxid", F.lit(None).cast("string"))
    about = known.groupBy("genome_id").agg(F.coalesce(F.max(F.col("taxid").cast("string")), F.lit("NA")).alias("taxid"))
    source = quality.join(about, "genome_id").select(F.col("genome_id").alias("assembly_id"), "taxid", "num_hits", "uniq_hits", "perc_comp", "perc_redund")
    summary = report.genome_summary([source], kept.unionByName(removed), kept)
    final = h.fetch_hit_seqs(filtered.join(kept.select("genome_id"), "genome_id", "left_semi"), genes if nucleotides is None else nucleotides)
    return {"quality": quality, "flagged": h.flag_redundant(quality), "sequences": final, "kept_markers": kept_markers, "removed_markers": removed_markers, "kept": kept, "removed": removed, "summary": summary}


def genome_labels(
    genomes: DataFrame, user_map: DataFrame, gtdb: DataFrame | None = None, ncbi: DataFrame | None = None, ranks: Sequence[str] = labels.DEFAULT, infra: DataFrame | None = None, tree: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """genome_id, label, label_source from the user's map and lineages (genome_id and ranks), with strains if they are given. With a
    tree (nodes and names of a taxonomy dump), ncbi has genome_id and taxid, and its lineages are looked up there."""
    if tree is not None:
        wanted = [r for r in taxonomy.RANKS if r in {x.lower() for x in ranks}]
        found = taxonomy.resolve_lineage(ncbi.where("taxid is not null").select("taxid"), *tree, wanted)
        known = found.where(" or ".join(f"`{r}` <> 'NA'" for r in wanted))
        ncbi = ncbi.select("genome_id", "taxid").join(known, "taxid").drop("taxid")

    def of(lineage: DataFrame | None) -> DataFrame | None:
        if lineage is None:
            return None
        made = labels.lineage_labels(lineage, ranks)
        return made if infra is None else labels.add_strain(made, infra)

    return labels.final_labels(genomes, user_map, of(gtdb), of(ncbi))


def supermatrix(aln: DataFrame, genomes: DataFrame, labelled: DataFrame | None = None, mode: str = "aa", max_gap: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """From alignments to the concatenation (genome_id, seq), labelled if wanted, and its partitions. Rows of different
    widths in a marker are an error."""
    if uneven := alignment.check_widths(aln).limit(5).collect():
        raise ValueError("rows of different widths in " + ", ".join(r.marker for r in uneven))
    trimmed = alignment.trim_columns(aln, max_gap).where("seq <> ''")
    trimmed = stash(trimmed, "trimmed")
    joined = alignment.concat_complete(trimmed, genomes, mode)
    if labelled is not None:
        joined = labels.apply_labels(joined, labelled)
    return joined, alignment.partition_table(trimmed, mode)


def write_supermatrix(matrix: DataFrame, partitions: DataFrame, folder: str, mode: str = "aa") -> None:
    """The alignment as FASTA and its partitions in both forms, below a folder."""
    writers.write_fasta(matrix, f"{folder}/alignment", header="genome_id")
    for fmt in ("plain", "nexus"):
        writers.write_lines(alignment.partition_lines(partitions, fmt, mode), f"{folder}/partitions-{fmt}")


def catalog_subset(gtdb: DataFrame, taxon: str, rank: str | None, ranks: Sequence[str], reps: str | None = None, seed: int = 1, **downsample: float) -> dict[str, DataFrame]:
    """From release tables (as read; lineages may still be one column, lineage) to a taxon's rows: slim rows, its counts by
    rank, taxa by rank, and the accessions drawn: one for each taxon of a rank, or, without one, classes down-sampled."""
    split = taxonomy.split_lineage(gtdb, "lineage", ranks) if "lineage" in gtdb.columns else gtdb
    rows = taxonomy.taxon_search(split, taxon, reps=reps, ranks=ranks)
    drawn = taxonomy.one_per_rank(rows, rank, seed) if rank else taxonomy.downsample_classes(rows, seed=seed, **downsample)
    return {"rows": readers.slim_gtdb(rows), "counts": taxonomy.taxon_counts(split, taxon, ranks), "taxa": taxonomy.rank_counts(rows, ranks), "drawn": drawn}


def discover_markers(hits: DataFrame, genomes: DataFrame, info: DataFrame, profiles: DataFrame, percent: float = 90.0, coverage: float = 50.0) -> dict[str, DataFrame]:
    """markers: profiles of enough coverage that enough genomes have exactly once (acc, short_name, name, share); profiles: their bodies;
    missed: genomes without a hit. hits: genome_id, marker (an accession with its version)."""
    usable = discovery.coverage_filter(info, coverage)
    counts = hits.join(usable.select(F.col("acc").alias("marker")), "marker", "left_semi").groupBy("genome_id", "marker").agg(F.count("*").alias("n"))
    single = discovery.single_copy_markers(counts, genomes.select("genome_id").distinct().count(), percent)
    markers = stash(usable.join(single.select(F.col("marker").alias("acc"), "share"), "acc"), "discovered")
    silent = ids.unknown_ids(genomes, hits).select(F.col("genome_id").cast("string").alias("id"))
    return {"markers": markers, "profiles": discovery.fetch_profiles(profiles, markers), "missed": ids.missed_report(no_hits=silent)}


def target_presence(
    hits: DataFrame, genomes: DataFrame, targets: DataFrame, profiles: DataFrame, genes: DataFrame, labelled: DataFrame, order: Sequence[str] = ("evalue", "ord"), named: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Wanted profiles (column target) in each genome: matrix of counts with all genes, hits, their sequences (marker, genome_id, gene_id, n,
    seq, named <genome>_<target>_<gene>_<n>, n in the order of a genome's hits of that target), viewer lines for the genomes in labelled
    (genome_id, label), and targets without a profile. hits: genome_id, gene_id (<genome>_<n>), marker; genes and named as in marker_sets."""
    found = stash(ids.resolve_targets(targets, profiles), "targets")
    pulled = names(found, "pulled")
    wanted = stash(h.select_all(hits, found.where("pulled is not null").select(F.col("pulled").alias("marker")).distinct()), "wanted-hits")
    counts = stash(h.found_counts(wanted, pulled), "counts")
    named = stash(sequences.gene_names(genes), "gene-names") if named is None else named
    listed = wanted.select("genome_id", "marker", F.col("gene_id").alias("own"), *order)
    listed = sequences.numbered(listed, ["genome_id", "marker"], order)
    name = F.concat_ws("_", "genome_id", "marker", "own", "n").alias("named")
    placed = h.place_hits(listed.select("genome_id", "marker", F.col("own").alias("gene_id"), name, "n"), named)
    seqs = h.fetch_hit_seqs(placed, genes).select("marker", "genome_id", F.col("named").alias("gene_id"), "n", "seq")
    return {"matrix": h.hit_matrix(counts, pulled, h.gene_counts(named), genomes), "hits": wanted, "sequences": seqs, "viewer": report.itol_dataset(counts, labelled), "missing": found.where("pulled is null").select("requested")}


def write_target_sequences(seqs: DataFrame, folder: str) -> None:
    """target_presence's sequences as one file <target>-hits.faa for each target, by genome and n."""
    writers.write_fasta_files(seqs, folder, "marker", ["genome_id", "n"], suffix="-hits.faa")


def accession_intake(wanted: DataFrame, catalog: DataFrame) -> dict[str, DataFrame]:
    """Faults of the list, its redundant groups, the catalog rows of what is kept, and what the catalog lacks."""
    repaired = ids.repair_ids(wanted)
    kept, redundant = ids.dedupe_accessions(repaired.distinct())
    resolved = ids.resolve_accessions(kept, catalog)
    return {"faults": ids.check_ids(wanted), "redundant": redundant, "resolved": resolved, "not_found": ids.not_found(kept, resolved)}

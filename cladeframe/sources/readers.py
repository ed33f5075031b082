"""Readers of the text formats, each a plan over Spark's own text and CSV sources."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeframe.functions.text import basename, genome_name, plain_path
from cladeframe.scratch import stash

ASSEMBLY = ["assembly_accession", "taxid", "organism_name", "infraspecific_name", "version_status", "assembly_level", "asm_name", "ftp_path"]
ASSEMBLY_PLACES = [0, 5, 7, 8, 10, 11, 15, 19]  # where a table without a header has them
GTDB = [
    "accession", "ncbi_genbank_assembly_accession", "ncbi_taxid", "gtdb_representative", "ncbi_refseq_category", "domain", "phylum", "class", "order", "family", "genus", "species",
    "checkm2_completeness", "checkm2_contamination", "checkm_completeness", "checkm_contamination", "genome_size", "contig_count", "gc_count", "gc_percentage", "ambiguous_bases", "coding_bases", "coding_density",
]


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """id: one a line, trimmed, without blank lines."""
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''")


MOST_BLOCKS = 200_000  # of files: rows of some 200 bytes


def read_records(spark: SparkSession, path: str | Sequence[str], separator: str = "\n", head: str = "") -> DataFrame:
    """file, ord, value: the records of text files with their place in their file, from 0. Files are split as Spark splits them.
    With head, what comes before the first record of a file that begins so is left out.

    Each block of a file knows where it begins, and its records are in order within it. A first pass counts the records of each
    block, the second adds the counts of the blocks before to a record's place in its own. Both passes see the same blocks; a
    record beyond its block's count is an error. The counts, a row a block, go to all tasks while they are few."""
    paths = [path] if isinstance(path, str) else list(path)
    row = F.monotonically_increasing_id()
    raw = spark.read.option("lineSep", separator).text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), row.alias("row"))
    opens = F.min_by(F.col("value").startswith(head), "row").alias("opens")
    blocks = stash(raw.groupBy("file", "start").agg(F.count("*").alias("rows"), F.min("row").alias("first"), opens), "blocks")
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    skipped = F.max(((F.col("start") == 0) & ~F.col("opens")).cast("long")).over(Window.partitionBy("file"))
    blocks = blocks.select("file", "start", "rows", "first", (before - skipped).alias("before"))
    if blocks.limit(MOST_BLOCKS + 1).count() <= MOST_BLOCKS:
        blocks = F.broadcast(blocks)
    within = F.col("row") - F.col("first")
    ordinal = F.when((within >= 0) & (within < F.col("rows")), F.col("before") + within).otherwise(F.raise_error(F.lit("a file was split in another way")).cast("long"))
    return raw.join(blocks, ["file", "start"], "left").select(plain_path("file").alias("file"), ordinal.alias("ord"), "value").where("ord >= 0")


def fasta_records(rows: DataFrame, text: str, ordinal: str | None) -> DataFrame:
    head = F.regexp_replace(F.regexp_extract(text, r"^>?([^\n]*)", 1), "\r$", "")
    seq = F.regexp_replace(F.regexp_replace(text, r"^>?[^\n]*\n?", ""), r"[\r\n]", "")
    genes = rows.select("genome_id", F.col(ordinal).cast("int").alias("gene_ord") if ordinal else F.lit(None).cast("int").alias("gene_ord"), head.alias("header"), seq.alias("seq"))
    return genes.where("header <> ''").select("genome_id", "gene_ord", F.regexp_extract("header", r"^\S+", 0).alias("gene_id"), "header", "seq", F.length("seq").alias("len"))


def read_fasta(spark: SparkSession, path: str | Sequence[str], per_file_order: bool = True) -> DataFrame:
    """genome_id (the file's name), gene_ord (from 0 in the order of the file), gene_id, header, seq, len. Files are split; without
    their order a pass is saved and gene_ord is null. What comes before the first header is left out."""
    paths = [path] if isinstance(path, str) else list(path)
    if not per_file_order:
        parts = spark.read.option("lineSep", "\n>").text(paths).select(genome_name(plain_path(F.input_file_name())).alias("genome_id"), F.col("value").alias("record"))
        return fasta_records(parts, "record", None)
    records = read_records(spark, paths, "\n>", ">")
    return fasta_records(records.select(genome_name("file").alias("genome_id"), "ord", F.col("value").alias("record")), "record", "ord")


def genbank_records(spark: SparkSession, path: str) -> DataFrame:
    """genome_id, ord, record: record blocks with their place in their file."""
    raw = read_records(spark, path, "\n//").select(genome_name("file").alias("genome_id"), "ord", F.col("value").alias("record"))
    return raw.where(F.col("record").rlike(r"\S"))


QUALIFIER = re.compile(r'^\s{21}/(\w+)(?:=("(?:[^"]|"")*"|\S+))?', re.M)
FEATURES = ["genome_id", "contig", "location", "qualifiers"]
FEATURE = re.compile(r"^ {5}(\S+) +(\S[^/]*?)\n(?=\s{21}/|\s{5}\S|\S|$)((?:\s{21}.*\n?)*)", re.M)


def cds_of(record: str) -> Iterator[tuple[str, str, dict[str, list[str]]]]:
    """Contig, location and qualifiers of each CDS in a record block."""
    locus = re.search(r"^LOCUS\s+(\S+)", record, re.M)
    table = record.partition("\nFEATURES")[2]
    table = re.split(r"\n(?=ORIGIN|CONTIG|BASE COUNT)", table)[0].partition("\n")[2] + "\n"
    for kind, location, body in FEATURE.findall(table):
        if kind == "CDS":
            qualifiers: dict[str, list[str]] = {}
            for name, value in QUALIFIER.findall(body):
                text = re.sub(r"\n\s*", "" if name == "translation" else " ", value.strip('"')).replace('""', '"')
                qualifiers.setdefault(name, []).append(text)
            yield locus[1] if locus else "", re.sub(r"\s", "", location), qualifiers


MOST_FEATURES = 1000  # in a frame, give or take a record


def features_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of the coding features of records, each of a bounded number: those of a batch's 10,000 records are many."""
    rows: list[tuple] = []
    for batch in batches:
        for g, r in zip(batch["genome_id"], batch["record"], strict=True):
            rows += [(g, c, loc, q) for c, loc, q in cds_of(r)]
            if len(rows) >= MOST_FEATURES:
                yield pd.DataFrame(rows, columns=FEATURES)
                rows = []
    yield pd.DataFrame(rows, columns=FEATURES)


def read_genbank(spark: SparkSession, path: str) -> DataFrame:
    """genome_id, contig, location, qualifiers of coding features, a record block at a time."""
    return genbank_records(spark, path).select("genome_id", "record").mapInPandas(features_of, "genome_id string, contig string, location string, qualifiers map<string,array<string>>")


def read_genbank_contigs(spark: SparkSession, path: str) -> DataFrame:
    """genome_id, contig, seq: whole contigs, for files without coding features."""
    origin = F.regexp_replace(F.regexp_extract("record", r"(?s)\nORIGIN[^\n]*\n(.*)$", 1), r"[0-9\s/]", "")
    return genbank_records(spark, path).select("genome_id", F.regexp_extract("record", r"LOCUS\s+(\S+)", 1).alias("contig"), origin.alias("seq"))


def genbank_metadata(records: DataFrame) -> DataFrame:
    """genome_id, organism, strain, taxid from genbank_records: the first of each in a file, else NA."""
    found = {"organism": r"ORGANISM[ \t]+([^\n\r]*)", "strain": r'/strain="([^"]*)"', "taxid": r'taxon:(\d+)'}
    rows = records.select("genome_id", "ord", *[F.nullif(F.trim(F.regexp_extract("record", p, 1)), F.lit("")).alias(n) for n, p in found.items()])
    firsts = rows.groupBy("genome_id").agg(*[F.min_by(n, F.when(F.col(n).isNotNull(), F.col("ord"))).alias(n) for n in found])
    organism = F.regexp_replace(F.translate("organism", " ./\\", "____"), "_+", "_")
    return firsts.select("genome_id", F.coalesce(organism, F.lit("NA")).alias("organism"), F.coalesce("strain", F.lit("NA")).alias("strain"), F.coalesce("taxid", F.lit("NA")).alias("taxid"))


def read_assembly_summary(spark: SparkSession, path: str) -> DataFrame:
    """The eight columns by name, or by place in a table without a header; comments and short rows are left out."""
    lines = spark.read.text(path).where(~F.col("value").startswith("##"))
    first = lines.where(F.col("value").rlike(r"^#? ?assembly_accession\t|\tassembly_accession(\t|$)")).limit(1).collect()
    names = first[0].value.lstrip("# ").strip().split("\t") if first else []
    header = bool(names)
    if header and (lacking := [c for c in ASSEMBLY if c not in names]):
        raise ValueError(f"the table lacks {', '.join(lacking)}")
    places = [names.index(c) for c in ASSEMBLY] if header else ASSEMBLY_PLACES
    rows = lines.where(~F.col("value").startswith("#") & ~F.col("value").startswith("assembly_accession\t")).select(F.split("value", "\t").alias("f")).where(F.size("f") > max(places))
    return rows.select(*[F.nullif(F.col("f")[p], F.lit("")).alias(c) for c, p in zip(ASSEMBLY, places, strict=True)])


def read_gtdb(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Release tables together: the first column is accession; malformed rows and rows of nulls are left out."""
    tables = []
    for p in paths:
        t = spark.read.csv(p, sep="\t", header=True, mode="DROPMALFORMED", enforceSchema=False)
        tables.append(t.withColumnRenamed(t.columns[0], "accession").dropna("all"))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def slim_gtdb(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`") for c in GTDB if c in df.columns])


def slim_assembly_summary(genbank: DataFrame, refseq: DataFrame) -> DataFrame:
    """The eight columns of both tables; one that is missing is an error."""
    for df in (genbank, refseq):
        if lacking := [c for c in ASSEMBLY if c not in df.columns]:
            raise ValueError(f"the table lacks {', '.join(lacking)}")
    return genbank.select(ASSEMBLY).unionByName(refseq.select(ASSEMBLY))


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """gene_id, marker, marker_acc, evalue, score, ord of a hit table; ord is the line's place in its file."""
    rows = read_records(spark, path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    f = F.split(F.trim("value"), r"\s+")
    return rows.select(genome_name("file").alias("genome_id"), f[0].alias("gene_id"), f[2].alias("marker"), f[3].alias("marker_acc"), f[4].cast("double").alias("evalue"), f[5].cast("double").alias("score"), "ord")


def read_ko_hits(spark: SparkSession, path: str) -> DataFrame:
    """genome_id, gene_id, marker of a KO mapper's output; genes without a KO are left out."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).select(genome_name(plain_path(F.input_file_name())).alias("genome_id"), f[0].alias("gene_id"), F.get(f, F.lit(1)).alias("marker"))
    return rows.where("marker is not null and marker <> ''")


def ko_targets(ko_list: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows of the KO threshold list (column knum) that are wanted (column target)."""
    return ko_list.join(targets.select(F.col("target").alias("knum")), "knum", "left_semi")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """profile_set (the file's name), ord (the block's place in it), marker, acc, body of profile blocks."""
    raw = read_records(spark, path, "\n//\n").where(F.col("value").rlike(r"(?m)^NAME\s"))
    return raw.select(genome_name("file").alias("profile_set"), "ord", F.regexp_extract("value", r"(?m)^NAME\s+(\S+)", 1).alias("marker"), F.regexp_extract("value", r"(?m)^ACC\s+(\S+)", 1).alias("acc"), F.col("value").alias("body"))


def profile_counts(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy("profile_set").agg(F.count("*").alias("n"))


def read_pfam_info(spark: SparkSession, path: str) -> DataFrame:
    f = F.split("value", "\t")
    return spark.read.text(path).select(f[0].alias("accession"), f[1].alias("short_name"), f[3].alias("name"), f[27].alias("version"), f[33].cast("double").alias("coverage"))


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """genome_id, label, suffix, ord; paths are cut to the file's name, and one extension after .gz goes from those with a folder."""
    f = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    text = lambda k: F.nullif(F.trim(F.get(f, F.lit(k))), F.lit(""))
    rows = read_records(spark, path).where(F.trim("value") != "")
    return rows.select(F.when(f[0].contains("/"), genome_name(f[0])).otherwise(basename(f[0])).alias("genome_id"), text(1).alias("label"), text(2).alias("suffix"), "ord")


def read_taxdump(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """nodes (taxid, parent, rank) and names (taxid, name), scientific names alone."""
    cut = lambda name: spark.read.text(f"{folder}/{name}.dmp").select(F.split("value", r"\t\|\t?").alias("f"))
    f = F.col("f")
    nodes = cut("nodes").select(f[0].cast("long").alias("taxid"), f[1].cast("long").alias("parent"), f[2].alias("rank"))
    return nodes, cut("names").where(f[3] == "scientific name").select(f[0].cast("long").alias("taxid"), f[1].alias("name"))


"""Accessions: checks, redundancy, and matching with catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.functions.text import base_link, clean, root

BASE = "https://ftp.ncbi.nlm.nih.gov/genomes/all"
FORBIDDEN = r"[()*&^#$@!/|\[\]\\]"


def repair_ids(ids: DataFrame) -> DataFrame:
    """Ids without the carriage return at their end."""
    return ids.withColumn("id", F.regexp_replace("id", "\r$", ""))


def check_ids(ids: DataFrame) -> DataFrame:
    """check, id, n: ids that occur more than once, or hold spaces or tabs, or ended in a carriage return."""
    seen = ids.groupBy("id").count()
    faults = F.array_compact(F.array(
        F.when(F.col("id").endswith("\r"), "carriage return"), F.when(F.regexp_replace("id", "\r$", "").contains(" "), "space"),
        F.when(F.col("id").contains("\t"), "tab"), F.when(F.col("count") > 1, "duplicate"),
    ))
    return seen.select(F.explode(faults).alias("check"), "id", F.col("count").alias("n"))


def check_label_map(label_map: DataFrame) -> DataFrame:
    """check, label, suffix, n: forbidden characters in either, and pairs that occur more than once."""
    pairs = label_map.groupBy("label", "suffix").count()
    bad = F.coalesce(F.col("label").rlike(FORBIDDEN), F.lit(False)) | F.coalesce(F.col("suffix").rlike(FORBIDDEN), F.lit(False))
    faults = F.array_compact(F.array(F.when(bad, "forbidden character"), F.when(F.col("count") > 1, "duplicate")))
    return pairs.select(F.explode(faults).alias("check"), "label", "suffix", F.col("count").alias("n"))


def unknown_ids(label_map: DataFrame, genomes: DataFrame) -> DataFrame:
    return label_map.select(F.col("genome_id")).join(genomes.select("genome_id"), "genome_id", "left_anti").distinct()


def missed_report(**missed: DataFrame) -> DataFrame:
    """accession, why_missing: one table of ids (column id) for each reason; underscores of a reason are blanks."""
    parts = [df.select(F.col("id").alias("accession"), F.lit(why.replace("_", " ")).alias("why_missing")) for why, df in missed.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dedupe_accessions(ids: DataFrame, ignore_version: bool = False) -> tuple[DataFrame, DataFrame]:
    """Ids without the GenBank copy of what RefSeq has, and all members of such groups."""
    base = F.regexp_replace("id", "^GC._", "")
    counted = ids.withColumn("base", root(base) if ignore_version else base).withColumn("members", F.count("*").over(Window.partitionBy("base")))
    kept = counted.where((F.col("members") == 1) | F.col("id").startswith("GCF_")).select("id")
    return kept, counted.where("members > 1").select("id", "base")


def resolve_accessions(wanted: DataFrame, catalog: DataFrame, base: str = BASE) -> DataFrame:
    """Each catalog row whose accession, version aside, is wanted, beside the accession as entered. Of two wanted ids of one
    root the later stays, by column ord or, without it, by the id."""
    order = "ord" if "ord" in wanted.columns else "id"
    asked = wanted.groupBy(root("id").alias("root")).agg(F.max_by("id", order).alias("input_accession"))
    found = catalog.withColumn("root", root("assembly_accession")).join(asked, "root")
    return found.select(
        "input_accession", F.col("assembly_accession").alias("found_accession"), clean("asm_name").alias("assembly_name"), clean("taxid").alias("taxid"),
        clean("organism_name").alias("organism"), clean("infraspecific_name").alias("infraspecific"), clean("version_status").alias("version_status"),
        clean("assembly_level").alias("level"), base_link("ftp_path", "assembly_accession", "asm_name", base).alias("base_link"),
    )


def not_found(wanted: DataFrame, resolved: DataFrame) -> DataFrame:
    return wanted.select("id").join(resolved.select(F.col("input_accession").alias("id")), "id", "left_anti")


def match_gtdb(wanted: DataFrame, gtdb: DataFrame, ranks: list[str]) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Ids and release rows that agree after the source prefix, GCA or GCF, and version: the rows, the map of ids found
    (input_searched, gtdb_acc_found, full_gtdb_acc), ids not found, and the taxonomy of those found."""
    asked = wanted.select(F.col("id").alias("input_searched"), root(F.substring("id", 5, 100)).alias("key"))
    rows = gtdb.withColumn("key", root(F.substring("accession", 8, 100))).join(asked, "key")
    rows = rows.withColumns({"gtdb_acc_found": F.substring("accession", 4, 100), "full_gtdb_acc": F.col("accession")})
    found = rows.select("input_searched", "gtdb_acc_found", "full_gtdb_acc")
    missing = asked.join(gtdb.select(root(F.substring("accession", 8, 100)).alias("key")), "key", "left_anti").select("input_searched", F.col("key").alias("searched_as"))
    taxonomy = rows.select(F.col("gtdb_acc_found").alias("base_gtdb_acc"), "full_gtdb_acc", *ranks).distinct()
    return rows.drop("key"), found, missing, taxonomy


def resolve_targets(targets: DataFrame, profiles: DataFrame) -> DataFrame:
    """requested, pulled: each target (column target) with the versioned accession of its profile, null if there is none."""
    have = profiles.select(root("acc").alias("root"), F.col("acc").alias("pulled"))
    return targets.select(F.col("target").alias("requested"), root("target").alias("root")).join(have, "root", "left").select("requested", "pulled")

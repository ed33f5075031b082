"""Discovery of marker sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def single_copy_markers(counts: DataFrame, n_genomes: int, percent: float = 90.0) -> DataFrame:
    """marker, single, share: markers that at least so many percent of all genomes have exactly once."""
    single = counts.groupBy("marker").agg(F.sum((F.col("n") == 1).cast("long")).alias("single"))
    return single.withColumn("share", F.col("single") / F.lit(n_genomes) * 100).where(F.col("share") >= percent)


def coverage_filter(pfam_info: DataFrame, least: float = 50.0) -> DataFrame:
    """acc (with version), short_name, name of profiles whose coverage is above."""
    return pfam_info.where(F.col("coverage") > least).select(F.concat_ws(".", "accession", "version").alias("acc"), "short_name", "name")


def fetch_profiles(profiles: DataFrame, ids: DataFrame) -> DataFrame:
    return profiles.join(ids.select("acc"), "acc", "left_semi")

"""Writers of the text formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeframe.sources import named_files


def write_fasta(df: DataFrame, path: str, by: str | None = None, header: str = "gene_id") -> None:
    """Records of a header column and seq; one folder, or one for each value of a column."""
    text = fasta_text(header).alias("value")
    if by is None:
        df.select(text).write.text(path)
    else:
        df.select(text, by).write.partitionBy(by).text(path)


def fasta_text(header: str) -> Column:
    return F.concat(F.lit(">"), F.col(header).cast("string"), F.lit("\n"), F.col("seq"))


def write_fasta_files(df: DataFrame, folder: str, by: str, order: Sequence[str], header: str = "gene_id", suffix: str = ".faa") -> None:
    """Records in order in one file <value><suffix> for each value of a column, each written by as many tasks as its size asks for."""
    named_files.write_named(df.withColumn("fasta_text", fasta_text(header)), folder, by, "fasta_text", order, suffix)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with a header; null is NA."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NA")).alias(c) for c in df.columns]
    df.select(texts).write.csv(path, sep="\t", header=True, quote="")


def write_lines(df: DataFrame, path: str, by: str | None = None, suffix: str = "") -> None:
    """Lines in the order of ord: a folder with one file (for partition tables, a line a marker), or a file <value><suffix> for each
    value of a column, of any size."""
    if by is None:
        df.coalesce(1).sortWithinPartitions("ord").select(F.col("line").alias("value")).write.text(path)
    else:
        named_files.write_named(df, path, by, "line", ["ord", "line"], suffix)

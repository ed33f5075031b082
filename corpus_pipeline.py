"""A corpus pipeline of five stages, each written as Parquet and read again as the documents of the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cladeframe.llm import decontamination, mixing, simhash, token_files, toxicity
from cladeframe.llm.queries import END_ID, vocabulary_file
from cladeframe.llm.shared import stash


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier than not of grade 1 or more go. The labelled texts are those of the documents."""
    return toxicity.accepted(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that share 0.8 or more of their five-word shingles, the document of the smallest doc_id stays."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their targets: a document is there as often as the mix reads it, in no order."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as files of token ids; one row a document of the mix, read back from them."""
    files = token_files.write_tokens(docs, vocabulary_file("byte_bpe_50k.json"), END_ID)
    return token_files.read_tokens(files).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [("toxicity", reject_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("mixing", mix), ("token_files", tokenize)]

#: Learned scores, fingerprints of XXH64 and a tokenizer cannot be put in SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return stash(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])

"""Sequences in buckets, so that joins bring keys to them and never move them.

A store is a table bucketed and sorted by the keys of a gene, (genome_id, gene_ord): proteins and nucleotides lie alike, so
one choice of genes fetches either. Both keys are hashed, so a large genome is spread over all buckets. Its other columns
(len above all) are read without seq, so all decisions are made before a sequence is touched.

Edge cases: rows with a null key would never be found and are refused; rows that repeat a key are each found.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe.scratch import new_path, shuffles_removed

KEYS = ("genome_id", "gene_ord")
BUCKET = 128 << 20  # bytes of sequences in a bucket, about: what a task sorts in memory
MOST = 10_000  # buckets


def bucket_count(seqs: DataFrame) -> int:
    """As many buckets as the session has shuffle partitions, or more where they would hold more than BUCKET bytes each: a
    bucket is sorted when it is written and when it is joined, which goes to disk if it doesn't fit in memory. The bytes are
    estimated from a row in a hundred; all rows are stored, and nothing but the number of files depends on it."""
    least = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = 100 * (seqs.sample(0.01, seed=1).agg(F.sum(F.octet_length("seq").cast("long"))).first()[0] or 0)
    return max(least, min(MOST, -(-size // BUCKET)))


def write_store(seqs: DataFrame, buckets: int | None = None, keys: Sequence[str] = KEYS, name: str | None = None) -> DataFrame:
    """The store of some sequences, as a table. Making it deals them to the buckets, one file each; with as many buckets as
    the session has shuffle partitions (or more, see bucket_count), no join on the keys moves them again."""
    spark = seqs.sparkSession
    name = name or f"sequences_{uuid.uuid4().hex}"
    whole = seqs.withColumns({k: F.when(F.col(k).isNull(), F.raise_error(F.lit(f"a sequence without {k}")).cast(seqs.schema[k].dataType)).otherwise(F.col(k)) for k in keys})
    with shuffles_removed(spark):
        buckets = buckets or bucket_count(seqs)
        whole.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).options(path=new_path(spark, name), compression="zstd").format("parquet").saveAsTable(name)
    return spark.table(name)


def fetch(store: DataFrame, wanted: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of wanted (the keys and others) with the sequence of each; keys that the store lacks are left out. The store is
    read in place: wanted is dealt to its buckets, or sent to them if it is small."""
    return wanted.join(store.select(*keys, "seq"), list(keys))

"""The shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, as a URI that every executor can open; a folder without a scheme is one of
    the default file system. Where it is unset a temporary folder is made and set on a local master; on a cluster, where
    executors would not share it, that is an error."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if path is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        sc.setCheckpointDir(path)
    return qualified(spark, path)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system."""
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    uri = place.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: it cuts the lineage and outlives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a write are removed as soon as it is done; else they stay until the driver's garbage is
    collected, so that the disk holds those of all writes before."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)

"""One file of a given name for each group of lines, written by many tasks at once.

Lines are ranged by their file and order, and each range packs its lines in pieces of some megabytes, which are written to
the scratch folder. The pieces' sizes say at which byte each begins. A data source of its own then puts every piece in its
place: whichever task has it opens the file and writes there, so a file of any size has as many writers as pieces. Files
have hidden names until all pieces are in place; the commit on the driver, which sees names alone, renames them, and an
abort removes them. A piece that is written twice (a task that is tried again) has the same bytes in the same place.

The folder must be one that all executors share as a file system (a file: URI or a plain path): object stores cannot be
written from the middle, and are refused. Names must be plain; null lines are left out; an empty table gives an empty folder.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from cladeframe.scratch import qualified, stash

PIECE = 4 << 20
TASK = 64 << 20  # bytes that a task puts in place: Spark hands it up to 10,000 pieces at once
HIDDEN = ".unfinished-"


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...]


class PieceWriter(DataSourceArrowWriter):
    """Writes rows (name, start, data): the bytes of a piece at their place in a file."""

    def __init__(self, folder: str, run: str):
        self.folder, self.run = folder, run

    def hidden(self, name: str) -> str:
        return os.path.join(self.folder, f"{HIDDEN}{self.run}-{name}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        names = set()
        for batch in iterator:
            for name, start, data in zip(*(batch.column(c) for c in ("name", "start", "data")), strict=True):
                name, data = name.as_py(), memoryview(data.as_buffer())
                handle = os.open(self.hidden(name), os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    done = 0
                    while done < len(data):
                        done += os.pwrite(handle, data[done:], start.as_py() + done)
                    os.fsync(handle)
                finally:
                    os.close(handle)
                names.add(name)
        return Written(tuple(sorted(names)))

    def commit(self, messages: list[Written | None]) -> None:
        for name in sorted({n for m in messages if m for n in m.names}):
            os.replace(self.hidden(name), os.path.join(self.folder, name))

    def abort(self, messages: list[Written | None]) -> None:
        for name in {n for m in messages if m for n in m.names}:
            if os.path.exists(self.hidden(name)):
                os.remove(self.hidden(name))


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, start long, data binary"

    def writer(self, schema, overwrite: bool) -> PieceWriter:
        return PieceWriter(self.options["folder"], self.options["run"])


def pieces_of(lines: DataFrame, order: Sequence[str], piece: int) -> DataFrame:
    """name, span, nth, size, data: runs of whole lines (name, line and what orders them) of one file."""
    ranged = lines.repartitionByRange("name", *order).sortWithinPartitions("name", *order).select("name", "line")
    schema = pa.schema([("name", pa.string()), ("span", pa.int64()), ("nth", pa.int64()), ("size", pa.int64()), ("data", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, at, held, size = TaskContext.get().partitionId(), 0, None, [], 0

        def close() -> pa.RecordBatch:
            data = b"".join(held)
            return pa.RecordBatch.from_pylist([{"name": at, "span": part, "nth": nth, "size": len(data), "data": data}], schema)

        for batch in batches:
            for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (name != at or size >= piece):
                    yield close()
                    held, size, nth = [], 0, nth + 1
                at = name
                held.append(line.encode() + b"\n")
                size += len(held[-1])
        if held:
            yield close()

    return ranged.mapInArrow(pack, "name string, span long, nth long, size long, data binary")


def write_named(df: DataFrame, folder: str, name: str, line: str, order: Sequence[str], suffix: str = "", piece: int = PIECE) -> None:
    """Lines in order in the files <folder>/<name><suffix>; name, line and order are columns. A line may hold line breaks."""
    spark = df.sparkSession
    place = urlparse(folder if urlparse(folder).scheme else qualified(spark, folder))
    if place.scheme != "file":
        raise ValueError(f"{folder}: named files need a file system that is shared by all executors")
    path = unquote(place.path)
    os.makedirs(path, exist_ok=True)
    spark.dataSource.register(NamedFiles)
    named = F.concat(F.col(name).cast("string"), F.lit(suffix))
    checked = F.when(named.rlike(r"[/\x00]|^\.\.?$") | (named == ""), F.raise_error(F.concat(F.lit("no name of a file: "), named)).cast("string")).otherwise(named)
    keyed = df.where(F.col(line).isNotNull() & F.col(name).isNotNull()).select(checked.alias("name"), F.col(line).alias("line"), *[F.col(c).alias(f"order_{k}") for k, c in enumerate(order)])
    pieces = stash(pieces_of(keyed, [f"order_{k}" for k in range(len(order))], piece), "pieces")
    placed_pieces(pieces).write.format("named_files").option("folder", path).option("run", uuid.uuid4().hex).mode("append").save()


def placed_pieces(pieces: DataFrame) -> DataFrame:
    """name, start, data: pieces with the byte where each begins, dealt in turn to tasks of some TASK bytes."""
    before = Window.partitionBy("name").orderBy("span", "nth").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("name", "span", "nth", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))  # a row for some megabytes
    total = pieces.agg(F.sum("size")).first()[0] or 0
    return pieces.join(starts, ["name", "span", "nth"]).select("name", "start", "data").repartition(1 + total // TASK)

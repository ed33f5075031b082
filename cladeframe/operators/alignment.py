"""Alignments: marker, genome_id, seq, all rows of a marker of one width."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.operators.names import MOST, listed, names

SPACER = {"aa": "XXXXX", "nt": "NNNNNN"}
LETTERS = {"aa": "AA", "nt": "DNA"}


def check_widths(aln: DataFrame) -> DataFrame:
    """marker, narrowest, widest of the markers whose rows differ in width."""
    return aln.groupBy("marker").agg(F.min(F.length("seq")).alias("narrowest"), F.max(F.length("seq")).alias("widest")).where("narrowest <> widest")


def widths(aln: DataFrame) -> DataFrame:
    return aln.groupBy("marker").agg(F.max(F.length("seq")).alias("width"))


def drop_all_gap(aln: DataFrame) -> DataFrame:
    return aln.where(~F.col("seq").rlike("^-*$"))


def complete_with_gaps(aln: DataFrame, genomes: DataFrame, markers: Sequence[str] | None = None) -> DataFrame:
    """A row for each genome and marker, gaps where there was none. Which are lacking is settled on names alone, by the
    difference of two lists a genome; gaps are made where they come out, so none is shuffled."""
    wanted = aln if markers is None else aln.where(F.col("marker").isin(list(markers)))
    width = widths(wanted)
    known = names(width, "marker")
    ids = genomes.select("genome_id").distinct()
    have = ids.join(wanted.groupBy("genome_id").agg(F.collect_set("marker").alias("have")), "genome_id", "left")
    lacking = have.select("genome_id", F.explode(F.array_except(listed(known), F.coalesce("have", F.array().cast("array<string>")))).alias("marker"))
    gaps = lacking.join(width, "marker").select("marker", "genome_id", F.repeat(F.lit("-"), F.col("width")).alias("seq"))
    return wanted.select("marker", "genome_id", "seq").join(ids, "genome_id", "left_semi").unionByName(gaps)


def trim_columns(aln: DataFrame, max_gap: float = 0.5) -> DataFrame:
    """Rows without the columns that have gaps in more than max_gap of the rows.

    Each task adds up vectors of gaps, one for each marker it meets, and only these are shuffled and added again: markers
    times tasks rows, however many rows and columns an alignment has."""
    schema = pa.schema([("marker", pa.string()), ("rows", pa.list_(pa.int64())), ("gaps", pa.list_(pa.int64()))])

    def totals(rows: Iterator[tuple[str, np.ndarray, np.ndarray]]) -> dict[str, list[np.ndarray]]:
        sums: dict[str, list[np.ndarray]] = {}
        for marker, *both in rows:
            old = sums.get(marker)
            sums[marker] = both if old is None else [added(x, y) for x, y in zip(old, both, strict=True)]
        return sums

    def out(sums: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), *(pa.array([s[k] for s in sums.values()], pa.list_(pa.int64())) for k in (0, 1))], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def vectors() -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
            for batch in batches:
                for marker, seq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    letters = np.frombuffer((seq or "").encode("utf-32-le"), dtype="<u4")
                    yield marker, np.ones(len(letters), dtype=np.int64), (letters == ord("-")).astype(np.int64)

        yield out(totals(vectors()))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield out(totals((r["marker"], np.array(r["rows"], dtype=np.int64), np.array(r["gaps"], dtype=np.int64)) for batch in batches for at in range(len(batch)) for r in batch.slice(at, 1).to_pylist()))

    types = "marker string, rows array<long>, gaps array<long>"
    sums = aln.select("marker", "seq").mapInArrow(count, types).repartition("marker").mapInArrow(add, types)
    share = F.transform(F.arrays_zip("rows", "gaps"), lambda c, i: F.when(c["gaps"] / c["rows"] <= max_gap, i))
    kept = sums.select("marker", F.array_compact(share).alias("kept"))
    joined = aln.join(kept, "marker", "left")
    return joined.select("marker", "genome_id", F.array_join(F.transform(F.coalesce("kept", F.array().cast("array<int>")), lambda p: F.substr("seq", p + 1, F.lit(1))), "").alias("seq"))


def added(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sum of two vectors, the shorter one filled up with zeros."""
    if len(x) < len(y):
        x, y = y, x
    out = x.copy()
    out[: len(y)] += y
    return out


def concat_complete(aln: DataFrame, genomes: DataFrame, mode: str = "aa") -> DataFrame:
    """complete_with_gaps and concat_alignments in one aggregate: the rows of each genome are laid on a row of gaps, at the
    places that the partition table gives their markers, so that only rows that exist are shuffled. Rows must be as wide
    as their marker (see check_widths)."""
    parts = partition_table(aln, mode)
    table = sorted((r.start, r.stop) for r in parts.select("start", "stop").limit(MOST + 1).collect())
    if len(table) > MOST:
        raise ValueError(f"more than {MOST} markers")
    blank = SPACER[mode].join("-" * (stop - start + 1) for start, stop in table)
    ids = genomes.select("genome_id").distinct()
    placed = aln.select("marker", "genome_id", "seq").join(parts.select("marker", "start"), "marker")
    rows = placed.groupBy("genome_id").agg(F.array_sort(F.collect_list(F.struct("start", "seq"))).alias("rows"))
    ends = lambda r: r["start"] + F.length(r["seq"])  # noqa: E731  where the next letter comes
    between = lambda at, to: F.substring(F.lit(blank), at, F.greatest(to - at, F.lit(0)))
    piece = lambda r, i: F.concat(between(F.when(i == 0, F.lit(1)).otherwise(ends(F.get("rows", i - 1))).cast("int"), r["start"].cast("int")), r["seq"])
    last = ends(F.element_at("rows", -1)).cast("int")
    seq = F.concat(F.array_join(F.transform("rows", piece), ""), F.substring(F.lit(blank), last, F.lit(len(blank))))
    return ids.join(rows, "genome_id", "left").select("genome_id", F.when(F.col("rows").isNull(), F.lit(blank)).otherwise(seq).alias("seq"))


def concat_alignments(aln: DataFrame, mode: str = "aa") -> DataFrame:
    """genome_id, seq: the rows of each genome in order of marker, a spacer between them."""
    rows = aln.groupBy("genome_id").agg(F.array_sort(F.collect_list(F.struct("marker", "seq"))).alias("rows"))
    return rows.select("genome_id", F.array_join(F.transform("rows", lambda r: r["seq"]), SPACER[mode]).alias("seq"))


def partition_table(aln: DataFrame, mode: str = "aa") -> DataFrame:
    """ord, marker, start, stop of each marker in the concatenation, from 1, ends included; the window is over one row a marker."""
    by_name = Window.orderBy("marker")
    before = F.coalesce(F.sum(F.col("width") + len(SPACER[mode])).over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = widths(aln).select(F.row_number().over(by_name).alias("ord"), "marker", (before + 1).alias("start"), "width")
    return placed.select("ord", "marker", "start", (F.col("start") + F.col("width") - 1).alias("stop"))


def partition_lines(partitions: DataFrame, fmt: str = "plain", mode: str = "aa") -> DataFrame:
    """ord, line: plain (AA, m = 1-16) or nexus (charset m = 1-16; in a block of sets)."""
    if fmt == "plain":
        return partitions.select("ord", F.format_string(f"{LETTERS[mode]}, %s = %d-%d", "marker", "start", "stop").alias("line"))
    sets = partitions.select(F.col("ord").cast("int").alias("ord"), F.format_string("charset %s = %d-%d;", F.translate("marker", " ", "_"), "start", "stop").alias("line"))
    frame = [(-1, "#NEXUS"), (0, "begin sets;"), (2**31 - 1, "end;")]
    return sets.unionByName(partitions.sparkSession.createDataFrame(frame, "ord int, line string"))

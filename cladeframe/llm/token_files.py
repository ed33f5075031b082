"""Token ids as Arrow files of equal-length sequences.

Documents are range-partitioned and sorted by doc_id, a task for each TASK_BYTES of text; each task encodes its range and
writes it in the Arrow IPC file format to the shared folder. A file is closed once it has FILE_TOKENS ids, so that tasks
and files grow in number with the input, and files not in size. A record batch has SEQUENCES rows of two fixed-size lists, `ids` (uint16 while the
vocabulary fits, else uint32) and `mask` (true where there is a token; only the end of a file is padded). Every batch but
the last has the same number of rows, so row r of a file is row r % SEQUENCES of batch r // SEQUENCES: a memory map gives
it without a copy. A second file of the same kind beside it holds the documents (doc_id, start in the file, n_tokens).

A task names its files by its attempt, and only the names of tasks that ended well reach the written index, so attempts
that were lost or ran twice do no harm.

Encoding: a text is cut at single spaces between other characters, where the byte-level pattern cuts as well. Of each
group of texts (some megabytes) every distinct cut is encoded once by the tokenizers library, thousands in one call:
joined by spaces, and parted again at the tokens that begin with a space, of which a cut has one, its first. A bounded
memory keeps the ids of frequent cuts. Texts with other blanks or with special tokens go to the library as they are.
The string of a special token in a text is that token, as is the library's default.

Edge cases: a null text is an empty one and has only the end id; an empty table has no files and no rows; a null doc_id
comes first; rows that share an id are ordered by a hash of their text.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.llm.shared import new_path, stash

LENGTH = 2048
SEQUENCES = 256
GROUP_BYTES = 8 << 20  # of texts that are encoded together
TASK_BYTES = 32 << 20  # of text in a task, while there are fewer than PARTITIONS
FILE_TOKENS = 1 << 24  # ids that close a file
PARTITIONS = 8192
MEMORY = 200_000  # cuts whose ids a worker keeps: the first that occur twice in a group
TOGETHER = 4096  # cuts in one string for the library
WIDE = r"\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD = rf"^$|^[\n{WIDE}]|[\n{WIDE}]$|[\t\v\f\r{WIDE}]"  # blanks, but for newlines inside


def gathered(values: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Runs of values, one after the other."""
    ends = np.cumsum(n)
    return values[np.repeat(starts - ends + n, n) + np.arange(ends[-1] if len(n) else 0)]


class Encoder:
    """Texts to ids, by the tokenizers library."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])  # the byte of a space
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, int] = {}  # a cut's place among those kept
        self.kept = np.zeros(0, dtype=self.dtype), np.zeros(0, dtype=np.int64)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        n = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.concatenate([np.zeros(0, dtype=self.dtype), *(np.array(x, dtype=self.dtype) for x in found)]), n

    def spaced_cuts(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ids, for cuts with a space before each."""
        parts = [cuts[at : at + TOGETHER] for at in range(0, len(cuts), TOGETHER)]
        flat, n = self.ids([" " + " ".join(part) for part in parts])
        first = np.flatnonzero(self.spaced[flat])
        if len(first) == len(cuts) and (not len(flat) or first[0] == 0):
            return flat, np.diff(np.append(first, len(flat)))
        return self.ids([" " + c for c in cuts])

    def odd(self, cuts: pa.Array) -> np.ndarray:
        """Cuts that may not stand alone."""
        found = pc.match_substring_regex(cuts, ODD)
        for special in self.special:
            found = pc.or_(found, pc.match_substring(cuts, special))
        return found.to_numpy(zero_copy_only=False)

    def keep(self, new: list[tuple[str, int]], often: np.ndarray, values: np.ndarray, starts: np.ndarray, n: np.ndarray) -> None:
        """Keep the cuts that occur often, given with their places in values."""
        chosen = [new[k] for k in np.flatnonzero(often)[: MEMORY - len(self.known)]]
        if chosen:
            self.known |= {c: len(self.known) + k for k, (c, _) in enumerate(chosen)}
            places = np.array([s for _, s in chosen])
            self.kept = np.concatenate([self.kept[0], gathered(values, starts[places], n[places])]), np.concatenate([self.kept[1], n[places]])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without nulls, the end id behind each, and how many each has with it."""
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        edges = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        at, begin = coded.indices.to_numpy(), edges[:-1]
        odd = self.odd(coded.dictionary)
        whole = np.add.reduceat(odd[at], begin, dtype=np.int64) > 0
        plain = np.flatnonzero(~odd)
        cuts = coded.dictionary.take(pa.array(plain)).to_pylist()
        slots = np.fromiter(map(self.known.get, cuts, repeat(-1)), dtype=np.int64, count=len(cuts))
        new = np.flatnonzero(slots < 0)
        heads, head_of = np.unique(at[begin[~whole]], return_inverse=True)  # a text's first cut has no space before it
        parts = [self.kept, self.spaced_cuts([cuts[k] for k in new]), self.ids(coded.dictionary.take(pa.array(heads)).to_pylist()), self.ids(texts.filter(pa.array(whole)).to_pylist())]
        values, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        starts = np.cumsum(n) - n
        first_new, first_head, first_whole, _ = np.cumsum([len(x[1]) for x in parts])
        slots[new] = first_new + np.arange(len(new))
        slot = np.zeros(len(odd), dtype=np.int64)
        slot[plain] = slots
        self.keep([(cuts[k], s) for k, s in zip(new.tolist(), slots[new].tolist(), strict=True)], np.bincount(at, minlength=len(odd))[plain[new]] > 1, values, starts, n)
        slot = slot[at]
        slot[begin[~whole]] = first_head + head_of
        slot[begin[whole]] = first_whole + np.arange(int(whole.sum()))
        rest = np.repeat(whole, np.diff(edges))
        rest[begin[whole]] = False
        length = np.where(rest, 0, n[slot])  # a text that went as a whole is in its first place
        flat = gathered(values, starts[slot], length)
        return np.insert(flat, np.cumsum(length)[edges[1:] - 1], self.end_id), np.add.reduceat(length, begin) + 1


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    return Encoder(path, end_id)


def groups(batch: pa.RecordBatch, size: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about so many bytes of text."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
        yield batch.slice(at, to - at)
        at = to


class SequenceFile:
    """Writes a run of ids as batches of fixed-size lists."""

    def __init__(self, sink, dtype: np.dtype, length: int, sequences: int):
        self.length, self.rows, self.dtype, self.left, self.n = length, sequences, dtype, [], 0
        ids, mask = pa.list_(pa.from_numpy_dtype(dtype), length), pa.list_(pa.bool_(), length)
        self.schema = pa.schema([("ids", ids), ("mask", mask)])
        self.writer = pa.ipc.new_file(sink, self.schema)

    def put(self, ids: np.ndarray) -> None:
        self.left.append(ids)
        self.n += len(ids)
        full = self.length * self.rows
        if self.n >= full:
            flat = np.concatenate(self.left)
            for at in range(0, len(flat) - full + 1, full):
                self.batch(flat[at : at + full])
            self.left = [flat[len(flat) - len(flat) % full :].copy()]
            self.n = len(self.left[0])

    def batch(self, flat: np.ndarray) -> None:
        rows = -(-len(flat) // self.length)
        padded = np.zeros(rows * self.length, dtype=self.dtype)
        padded[: len(flat)] = flat
        mask = pa.array(np.arange(len(padded)) < len(flat))
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(padded), self.length), pa.FixedSizeListArray.from_arrays(mask, self.length)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def close(self) -> None:
        if self.n:
            self.batch(np.concatenate(self.left))
        self.writer.close()


class TokenFiles:
    """The ids of one file and the list of its documents beside them."""

    def __init__(self, folder: str, name: str, dtype: np.dtype, length: int, sequences: int):
        fs, place = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(place, recursive=True)
        self.sinks = [fs.open_output_stream(f"{place}/{name}{end}") for end in (".arrow", ".docs.arrow")]
        self.ids = SequenceFile(self.sinks[0], dtype, length, sequences)
        self.docs = pa.ipc.new_file(self.sinks[1], pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]))
        self.name, self.tokens = name, 0

    def put(self, doc_ids: pa.Array, ids: np.ndarray, n: np.ndarray) -> None:
        self.ids.put(ids)
        start = self.tokens + np.cumsum(n) - n
        self.docs.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(start), pa.array(n)], names=["doc_id", "start", "n_tokens"]))
        self.tokens += int(n.sum())

    def close(self) -> None:
        for x in (self.ids, self.docs, *self.sinks):
            x.close()


def write_tokens(docs: DataFrame, path: str, end_id: int, length: int = LENGTH, sequences: int = SEQUENCES, folder: str | None = None, task_bytes: int = TASK_BYTES, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the files and return their list: a row each (file, part, number, tokens, folder), in ascending doc_id order by
    part and number."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()  # the hash lets rows that share an id, or have none, be split
    ordered = rows.repartitionByRange(min(PARTITIONS, max(1, -(-total // task_bytes))), *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, number = TaskContext.get(), None, 0
        coder = encoder(path, end_id)

        def close() -> pa.RecordBatch:
            out.close()
            types = (pa.string(), pa.int32(), pa.int32(), pa.int64())
            values = (out.name, task.partitionId(), number, out.tokens)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=["file", "part", "number", "tokens"])

        for batch in batches:
            for group in groups(batch, min(GROUP_BYTES, file_tokens)):  # a text has at most an id a byte
                if out is None:
                    out = TokenFiles(folder, f"part-{task.partitionId():06d}-{number:05d}-{task.taskAttemptId()}", coder.dtype, length, sequences)
                out.put(group.column(0), *coder.encode(group.column(1)))
                if out.tokens >= file_tokens:
                    yield close()
                    out, number = None, number + 1
        if out is not None:
            yield close()

    files = ordered.mapInArrow(write, "file string, part int, number int, tokens long")
    return stash(files.withColumn("folder", F.lit(folder)), "token-files")


def open_sequences(uri: str) -> pa.ipc.RecordBatchFileReader:
    """A reader with random access to batches; on a local folder it is a memory map, and lists are views of it."""
    fs, place = pa.fs.FileSystem.from_uri(uri)
    source = pa.memory_map(place) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(place)
    return pa.ipc.open_file(source)


def row(reader: pa.ipc.RecordBatchFileReader, r: int, sequences: int = SEQUENCES) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence r: the batch is found by a division, the ids are not copied."""
    batch = reader.get_batch(r // sequences)
    k, width = r % sequences, batch.column(0).type.list_size
    return batch.column(0).values.slice((batch.column(0).offset + k) * width, width).to_numpy(), batch.column(1)[k].values.to_numpy(zero_copy_only=False)


def stream(reader: pa.ipc.RecordBatchFileReader, lengths: list[int]) -> Iterator[np.ndarray]:
    """The ids of consecutive documents of these lengths, a batch at a time in memory."""
    left, b = np.zeros(0, dtype=np.uint16), 0
    for n in lengths:
        parts, have = [], 0
        while have < n:
            if not len(left):
                batch = reader.get_batch(b)
                ids, mask = batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy(zero_copy_only=False)
                left, b = ids[mask] if not mask[-1] else ids, b + 1
            parts.append(left[: n - have])
            left = left[len(parts[-1]) :]
            have += len(parts[-1])
        yield np.concatenate(parts) if len(parts) > 1 else parts[0]


def read_tokens(files: DataFrame) -> DataFrame:
    """Read all files back: doc_id, start (over the whole stream), n_tokens, ids_crc32, file, n_sequences of the file.

    files: as write_tokens returns it, one row a file; the running sum over files is on that small table.
    """
    in_order = Window.orderBy("part", "number")
    before = F.coalesce(F.sum("tokens").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = min(PARTITIONS, max(1, files.count()))
    dealt = (F.row_number().over(in_order) % n).cast("int")
    listed = files.select("folder", "file", before.alias("before"), dealt.alias("dealt")).repartitionById(n, "dealt").select("folder", "file", "before")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, name, offset in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, docs = open_sequences(f"{folder}/{name}.arrow"), open_sequences(f"{folder}/{name}.docs.arrow").read_all()
                crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in stream(ids, docs["n_tokens"].to_pylist())]
                start = docs["start"].to_numpy() + offset
                columns = [docs["doc_id"].combine_chunks(), pa.array(start), docs["n_tokens"].combine_chunks(), pa.array(crc, pa.int64()), pa.array([name] * len(crc), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "file"])

    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, file string")

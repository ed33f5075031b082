"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

A byte goes if it is covered by a string of MATCH bytes that also starts in a document with a smaller doc_id. Strings are
judged on the input, and end with their document.

1. Each task cuts its documents into batches of some megabytes, kept as files in the shared folder, and finds anchors:
   of the GRAM-byte grams inside each string of MATCH bytes (a window) the one with the smallest hash, the first of
   equals. Equal windows have equal anchors, and consecutive windows mostly share theirs: about 1 anchor in 16 bytes.
2. The hashes of each batch's anchors go to shards, 4 bytes each, with how often the batch has them (255 for more); a shard
   answers which of them come from two batches, and which are in HOT places or more. A task sends the anchors of GATHER
   batches in one message to a shard, and these shards are MERGED times as large as those of the records, so that
   messages are few beside what they hold; they and the answers name a batch by its number.
3. Each batch is read again. Anchors that another batch has, or that it has twice, become records: the bytes of the
   windows that share the anchor. Equal records of a batch need one answer, that of their smallest doc_id; the others are
   covered. So a passage that very many documents share is one record for each batch, not for each document. Where it
   begins and ends, windows reach into each document's own text: there, of HOT anchors, each window is a record of its
   own and goes to a shard by a hash of its bytes, so that equal ones meet and no shard gets all of an anchor's.
4. In its shard, records come in order of doc_id, a batch of windows at a time. The batch's windows are sorted as byte
   strings (a suffix array of the records, to MATCH bytes), merge-scanned against the levels of the family for equal
   ones with a smaller doc_id, and those that are new become a level; levels of like size are merged, so that there are
   about log(n) of them.
5. The answers go back to the batches, which are read a last time.

Hashes only choose what is compared; windows are compared by their bytes. Shards and batches grow in number with the
input, not in size, and with them the share of hashes that agree by chance stays as it is.

Edge cases: a null text is an empty one; a document shorter than MATCH keeps all; rows that share a doc_id do not cover
each other; a row with a null doc_id keeps all and covers nothing; long documents are anchored piece by piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cladeframe.llm.shared import new_path, stash

MATCH, GRAM = 50, 20
SPAN = MATCH - GRAM + 1  # grams in a window
BATCH_BYTES = 8 << 20
BLOCK, PIECE = 1 << 20, 4 << 20
WINDOWS = 1 << 17  # in a batch of the family
HOT = 2048
GATHER = 8  # batches whose anchors go to a shard in one message, at most 256
MERGED = 4  # shards of records whose anchors are counted together
PARTITIONS = 8192  # at most, of a shuffle
RNG = np.random.default_rng(50)
TABLE = RNG.integers(1 << 63, size=256, dtype=np.uint64)
ODD = (2 * RNG.integers(1 << 62, size=8, dtype=np.uint64) + 1).astype(np.uint64)
RECORD = np.dtype([("doc", "<i8"), ("row", "<u4"), ("at", "<u4"), ("n", "u1")])
COVER = np.dtype([("row", "<u4"), ("at", "<u4"), ("mask", "<u4")])
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all 20-byte grams, by doubling: 1, 2, 4, 8, 16, then 16 + 4 bytes."""
    h, four = TABLE[data], None
    for k, width in enumerate((1, 2, 4, 8)):
        if width == 4:
            four = h
        h = h[:-width] * ODD[k] + h[width:]
    h = h[: len(data) - GRAM + 1] * ODD[5] + four[16:]
    h ^= h >> np.uint64(32)
    h *= ODD[6]
    return h ^ (h >> np.uint64(29))


def anchors(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that share their anchor: (hash, first window, number of windows). data holds several documents,
    from begin[i] on for size[i] bytes; windows across documents are left out."""
    none = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if len(data) < MATCH:
        return none
    value = gram_hashes(data)
    place = np.arange(len(value), dtype=np.int32)
    for step in (1, 2, 4, 8, SPAN - 16):
        right = value[step:] < value[:-step]
        place = np.where(right, place[step:], place[:-step])
        value = np.minimum(value[step:], value[:-step])
    turns = np.zeros(len(data) + 1, dtype=np.int32)
    long = size >= MATCH
    turns[begin[long]] += 1
    turns[(begin + size - MATCH + 1)[long]] -= 1
    windows = np.flatnonzero(np.cumsum(turns[: len(value)]))
    if not len(windows):
        return none
    at = place[windows]
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)]))
    start = windows[first]
    return value[start], start, np.diff(np.append(first, len(windows)))


def blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents joined to blocks, and long ones in overlapping pieces: bytes, begin, size, row, offset in the row."""
    parts, n = [], 0

    def block():
        sizes = np.array([len(p) for p, _, _ in parts], dtype=np.int64)
        data = np.frombuffer(b"".join(p for p, _, _ in parts), dtype=np.uint8)
        return data, np.cumsum(sizes) - sizes, sizes, np.array([r for _, r, _ in parts]), np.array([o for _, _, o in parts])

    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - MATCH + 1), PIECE):
            piece = text[at : at + PIECE + MATCH - 1]
            parts.append((piece, row, at))
            n += len(piece)
            if n >= BLOCK:
                yield block()
                parts, n = [], 0
    if parts:
        yield block()


def all_anchors(texts: list[bytes], shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, first window, number of windows) of a batch; the key is the shard and 32 bits of the hash."""
    out = []
    for data, begin, size, row, offset in blocks(texts):
        h, start, n = anchors(data, begin, size)
        which = np.searchsorted(begin, start, side="right") - 1
        key = ((h % np.uint64(shards)) << np.uint64(32)) | (h >> np.uint64(32))
        out.append((key, row[which], start - begin[which] + offset[which], n))
    if not out:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def by_shard(key: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Shards and their ranges in sorted keys."""
    if not len(key):
        return
    shard = key >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    for a, b in zip(first, np.append(first[1:], len(key)), strict=True):
        yield int(shard[a]), slice(int(a), int(b))


class Family:
    """Suffix arrays of windows with the smallest doc_id of each, in levels that grow geometrically."""

    def __init__(self, width: int = MATCH):
        self.width, self.levels = width, []

    def add(self, windows: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Add a batch, its docs ascending; which of its windows a smaller doc_id has, in this batch or a level."""
        text = np.ascontiguousarray(windows).view(f"S{self.width}").ravel()
        order = np.argsort(text, kind="stable")
        rows = windows[order]
        first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        rows, strings, least = rows[first], text[order[first]], docs[order[first]]
        new, own = np.ones(len(first), dtype=bool), least.copy()
        for known, known_docs in self.levels:
            at = np.searchsorted(known.view(f"S{self.width}").ravel(), strings)
            at[at == len(known)] = 0
            same = (known[at] == rows).all(axis=1)
            least[same] = np.minimum(least[same], known_docs[at[same]])
            new &= ~same
        covered = np.zeros(len(text), dtype=bool)
        covered[order] = least[group] < docs[order]
        if new.any():
            self.levels.append((rows[new], own[new]))
        while len(self.levels) > 1 and len(self.levels[-1][0]) * 2 > len(self.levels[-2][0]):
            (a, a_docs), (b, b_docs) = self.levels.pop(), self.levels.pop()
            if len(a) < len(b):
                (a, a_docs), (b, b_docs) = (b, b_docs), (a, a_docs)
            places = np.searchsorted(a.view(f"S{self.width}").ravel(), b.view(f"S{self.width}").ravel())
            self.levels.append((np.insert(a, places, b, axis=0), np.insert(a_docs, places, b_docs)))
        return covered


def masks(records: np.ndarray, content: bytes) -> np.ndarray:
    """For each record, of ascending doc, the windows that a smaller doc_id has as well, as bits."""
    n = records["n"].astype(np.int64)
    place = np.cumsum(n + MATCH - 1) - (n + MATCH - 1)
    views = np.lib.stride_tricks.sliding_window_view(np.frombuffer(content, dtype=np.uint8), MATCH)
    family, out, total = Family(), np.zeros(len(records), dtype=np.uint32), np.cumsum(n)
    at = 0
    while at < len(records):
        to = max(at + 1, int(np.searchsorted(total, total[at] - n[at] + WINDOWS, side="right")))
        some = n[at:to]
        owner = np.repeat(np.arange(at, to), some)
        bit = np.arange(len(owner)) - np.repeat(np.cumsum(some) - some, some)
        covered = family.add(views[place[owner] + bit], records["doc"][owner])
        out += np.bincount(owner, weights=covered * (1 << bit), minlength=len(records)).astype(np.uint32)
        at = to
    return out


def combine(records: np.ndarray, contents: list[bytes]) -> np.ndarray:
    """Which records another of equal content and smaller doc_id covers as a whole."""
    least: dict[bytes, int] = {}
    for c, d in zip(contents, records["doc"].tolist(), strict=True):
        if least.get(c, d) >= d:
            least[c] = d
    return np.fromiter((least[c] < d for c, d in zip(contents, records["doc"].tolist(), strict=True)), dtype=bool, count=len(records))


def whole(records: np.ndarray) -> np.ndarray:
    cover = np.zeros(len(records), dtype=COVER)
    cover["row"], cover["at"], cover["mask"] = records["row"], records["at"], (np.int64(1) << records["n"].astype(np.int64)) - 1
    return cover


def load(uri: str) -> tuple[list[int | None], list[bytes]]:
    fs, place = pa.fs.FileSystem.from_uri(uri)
    with fs.open_input_file(place) as f:
        table = pq.read_table(f)
    return table["doc_id"].to_pylist(), table["text"].to_pylist()


def result(doc_ids: list[int | None], texts: list[bytes], covers: np.ndarray) -> pa.Table:
    """What is left of each document of a batch."""
    covers = covers[np.argsort(covers["row"], kind="stable")]
    edges = np.searchsorted(covers["row"], np.arange(len(texts) + 1))
    out = []
    for row, (doc, text) in enumerate(zip(doc_ids, texts, strict=True)):
        mine = covers[edges[row] : edges[row + 1]]
        removed = spans = 0
        if len(mine):
            starts = (mine["at"][:, None].astype(np.int64) + np.arange(SPAN))[(mine["mask"][:, None] >> np.arange(SPAN, dtype=np.uint32)) & 1 == 1]
            turns = np.bincount(starts, minlength=len(text) + 1)[: len(text) + 1] - np.bincount(starts + MATCH, minlength=len(text) + 1)[: len(text) + 1]
            gone = np.cumsum(turns[: len(text)]) > 0
            removed, spans = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
        else:
            kept = text
        out.append((doc, len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
    columns = list(zip(*out, strict=True)) or [()] * 6
    types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, batch_bytes: int = BATCH_BYTES, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row, and the text that is left if asked for."""
    spark = docs.sparkSession
    folder = new_path(spark, "suffix-batches")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    counted = max(1, -(-total // (MERGED * batch_bytes)))
    shards = MERGED * counted

    def path(number: int) -> str:
        return f"{folder}/{number >> 24:06d}-{number & 0xFFFFFF:05d}.parquet"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, n, waiting = TaskContext.get().partitionId() << 24, [], [], 0, []

        def close() -> tuple[int, np.ndarray, np.ndarray]:
            # the name depends on the rows alone: a task that runs again writes the same file
            fs, place = pa.fs.FileSystem.from_uri(path(number))
            parent, _, name = place.rpartition("/")
            fs.create_dir(parent, recursive=True)
            draft = f"{parent}/.{name}-{TaskContext.get().taskAttemptId()}"
            with fs.open_output_stream(draft) as f:
                pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.binary())}), f, compression="zstd")
            fs.move(draft, place)
            key, row, _, _ = all_anchors(texts, counted)
            key, times = np.unique(key[np.array([i is not None for i in ids], dtype=bool)[row]] if len(key) else key, return_counts=True)
            return number, key, np.minimum(times, 255).astype("u1")

        def send() -> pa.RecordBatch:
            key, times = (np.concatenate([w[k] for w in waiting]) for k in (1, 2))
            source = np.repeat(np.arange(len(waiting), dtype="u1"), [len(w[1]) for w in waiting])
            order = np.argsort(key, kind="stable")
            key, source, times = key[order], source[order], times[order]
            base = waiting[0][0]
            found = [(base, s, key[x].astype("<u4").tobytes(), source[x].tobytes(), times[x].tobytes()) for s, x in by_shard(key)]
            found += [(w[0], w[0] % counted, b"", b"", b"") for w in waiting]  # so that each batch has an answer
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=["file", "shard", "keys", "source", "times"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc)
                texts.append(text.as_py())
                n += len(texts[-1])
                if n >= batch_bytes:
                    waiting.append(close())
                    number, ids, texts, n = number + 1, [], [], 0
                    if len(waiting) == GATHER:
                        yield send()
                        waiting = []
        if ids:
            waiting.append(close())
        if waiting:
            yield send()

    def shared(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        value, source, times = (np.frombuffer(b"".join(table[c].to_pylist()), dtype=t) for c, t in (("keys", "<u4"), ("source", "u1"), ("times", "u1")))
        bases = table["file"].to_numpy()
        size = pc.binary_length(table["source"]).to_numpy()
        file = np.repeat(bases, size) + source
        _, number, batches = np.unique(value, return_inverse=True, return_counts=True)
        twice, hot = (batches > 1)[number], (np.bincount(number, weights=times, minlength=len(batches)) >= HOT)[number]
        some = np.flatnonzero(twice | hot)
        some = some[np.argsort(file[some], kind="stable")]
        out = [(f, shard, b"", b"") for f in bases[size == 0].tolist()]
        if len(some):
            for x in np.split(some, np.flatnonzero(np.diff(file[some])) + 1):
                out.append((int(file[x[0]]), shard, value[x[twice[x]]].tobytes(), value[x[hot[x]]].tobytes()))
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "shard", "keys", "hot"])

    def record(table: pa.Table) -> pa.Table:
        file = table["file"][0].as_py()
        ids, texts = load(path(file))
        asked, hot = (np.sort(np.concatenate([(np.uint64(s) << np.uint64(32)) | np.frombuffer(k, dtype="<u4").astype(np.uint64) for s, k in zip(table["shard"].to_pylist(), table[c].to_pylist(), strict=True)])) for c in ("keys", "hot"))
        key, row, at, n = all_anchors(texts, counted)
        numbered = np.array([i is not None for i in ids], dtype=bool)
        order = np.argsort(key, kind="stable")
        key, row, at, n = key[order], row[order], at[order], n[order]
        again = np.concatenate([[False], key[1:] == key[:-1]]) if len(key) else np.zeros(0, dtype=bool)
        again[:-1] |= again[1:]
        wanted = again & numbered[row] if len(key) else again
        if len(asked) and len(key):
            place = np.searchsorted(asked, key)
            place[place == len(asked)] = 0
            wanted |= (asked[place] == key) & numbered[row]
        key, row, at, n = key[wanted], row[wanted], at[wanted], n[wanted]
        single = np.isin(key, hot)
        shard = (key >> np.uint64(32)) * np.uint64(MERGED) + key % np.uint64(MERGED)
        if single.any():
            own = n[single]
            shift = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            rows_, places = np.repeat(row[single], own), np.repeat(at[single], own) + shift
            by_bytes = np.fromiter((xxh64_intdigest(texts[r][a : a + MATCH], 9) for r, a in zip(rows_.tolist(), places.tolist(), strict=True)), dtype=np.uint64, count=len(rows_))
            shard = np.concatenate([shard[~single], by_bytes % np.uint64(shards)])
            row, at, n = np.concatenate([row[~single], rows_]), np.concatenate([at[~single], places]), np.concatenate([n[~single], np.ones(len(rows_), dtype=n.dtype)])
        order = np.argsort(shard, kind="stable")
        shard, row, at, n = shard[order], row[order], at[order], n[order]
        records = np.zeros(len(shard), dtype=RECORD)
        records["doc"] = np.array([i if i is not None else 0 for i in ids], dtype=np.int64)[row] if len(shard) else []
        records["row"], records["at"], records["n"] = row, at, n
        contents = [texts[r][a : a + m + MATCH - 1] for r, a, m in zip(row.tolist(), at.tolist(), n.tolist(), strict=True)]
        covered = combine(records, contents)
        out = []
        for s, x in by_shard(shard << np.uint64(32)):
            left = ~covered[x]
            sent = [c for c, keep in zip(contents[x], left.tolist(), strict=True) if keep]
            out.append((s, file, records[x][left].tobytes(), b"".join(sent), whole(records[x][~left]).tobytes()))
        out = out or [(0, file, b"", b"", b"")]
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["shard", "file", "records", "content", "covers"])

    def scan(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, dtype=RECORD) for x in table["records"].to_pylist()]
        records, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        content = b"".join(table["content"].to_pylist())
        size = records["n"].astype(np.int64) + MATCH - 1
        end = np.cumsum(size)
        contents = [content[a:b] for a, b in zip((end - size).tolist(), end.tolist(), strict=True)]
        covered = combine(records, contents)
        cover = whole(records)
        left = np.flatnonzero(~covered)
        left = left[np.argsort(records["doc"][left], kind="stable")]
        if len(left):
            cover["mask"][left] = masks(records[left], b"".join([contents[i] for i in left.tolist()]))
        useful = cover["mask"] > 0
        cover, owner = cover[useful], owner[useful]
        edges = np.searchsorted(owner, np.arange(len(parts) + 1))
        answers = [known + cover[a:b].tobytes() for known, a, b in zip(table["covers"].to_pylist(), edges[:-1], edges[1:], strict=True)]
        return pa.table({"file": table["file"], "covers": pa.array(answers, pa.binary())})

    def finish(table: pa.Table) -> pa.Table:
        ids, texts = load(path(table["file"][0].as_py()))
        out = result(ids, texts, np.frombuffer(b"".join(table["covers"].to_pylist()), dtype=COVER))
        return out if with_text else out.drop_columns(["kept"])

    def by_shards(df: DataFrame, n: int) -> GroupedData:
        """Shards dealt evenly, each to a task of its own while there are enough of them."""
        parts = min(n, PARTITIONS)
        return df.withColumn("dealt", (F.col("shard") % parts).cast("int")).repartitionById(parts, "dealt").groupBy("dealt", "shard")

    def by_files(df: DataFrame) -> GroupedData:
        return df.repartition(min(shards, PARTITIONS), "file").groupBy("file")  # by number: there is much work for each of the few bytes

    answers = by_shards(rows.mapInArrow(cut, "file long, shard long, keys binary, source binary, times binary"), counted).applyInArrow(shared, "file long, shard long, keys binary, hot binary")
    answers = stash(answers, "shared-anchors")
    records = by_files(answers).applyInArrow(record, "shard long, file long, records binary, content binary, covers binary")
    covers = by_shards(records, shards).applyInArrow(scan, "file long, covers binary")
    return by_files(covers).applyInArrow(finish, RESULT + (", kept binary" if with_text else ""))

"""Words, connected components, and the shared scratch folder."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe.scratch import new_path, shared_dir, stash

__all__ = ["coded_words", "components", "new_path", "remove", "shared_dir", "stash", "words_of"]

MARKS = "".join(re.escape(chr(c)) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == "M")
REST = rf"(?![\x00-\x7f])[{MARKS}][\w{MARKS}]*"
PLAIN, WIDE, MARKED = re.compile(r"\w+"), re.compile(r"[^\x00-\u02ff]"), re.compile(rf"\w++(?:{REST})?|{REST}")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, marks, numbers and underscores, in lower case. (\\w has no combining marks; they begin at U+0300.)"""
    text = text.lower() if text else ""
    return (MARKED if WIDE.search(text) else PLAIN).findall(text)


CODED = 1 << 24
GAP = ord(" ")
BYTES = bytes(ord(chr(c).lower()) if PLAIN.match(chr(c)) else GAP for c in range(128)) + bytes(range(128, 256))
NARROW = np.array([bool(PLAIN.match(chr(c))) for c in range(0x300)])


def coded_words(texts: Iterable[str | None]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """The words of the texts, as words_of gives them, of some CODED bytes of texts at a time: each word once, the place among
    these of every word, and each text's number of words."""

    def coded(parts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        data = np.frombuffer(bytearray(b" ").join([b"", *parts, b""]).translate(BYTES), np.uint8)
        two = np.flatnonzero((data >= 0xC2) & (data < 0xCC))  # first bytes of the characters from U+0080 to U+02FF
        two = two[~NARROW[(data[two] & 0x1F).astype(np.intp) << 6 | data[two + 1] & 0x3F]]
        data[two] = data[two + 1] = GAP
        inside = data != GAP
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[inside])).dictionary_encode()
        bounds = np.cumsum([0, *(len(p) + 1 for p in parts)])
        return words.dictionary, words.indices.to_numpy(), np.diff(np.searchsorted(starts, bounds))

    parts: list[bytes] = []
    waiting = 0
    for text in texts:
        text = text or ""
        lower = text if text.isascii() else text.lower()  # BYTES does so for ASCII
        part = (" ".join(words_of(text)) if not lower.isascii() and WIDE.search(lower) else lower).encode()
        if parts and waiting + len(part) > CODED:
            yield coded(parts)
            parts, waiting = [], 0
        parts.append(part)
        waiting += len(part) + 1
    if parts:
        yield coded(parts)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): (node, root), root being the smallest node of its component.

    Large-star and small-star steps in turn, each a join with a minimum per node, until only stars are left; they need about
    log(n) rounds, whatever the shape of a component, and none if the links are stars already, as those of roots are. The
    links are cut from their lineage by checkpoint().
    """

    def largest(e: DataFrame, small: bool) -> DataFrame:
        both = e.union(e.select("b", "a"))
        around = both.where("b < a") if small else both
        lowest = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # by a key of its own: both sides are shuffled for the join, so that the planner can split the neighbours of a hub
        moved = around.withColumn("key", F.bitwise_not("a")).join(lowest.select(F.bitwise_not("a").alias("key"), "m"), "key").drop("key")
        if small:
            out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", F.col("m").alias("b")))
        else:
            out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.where("a <> b").distinct()

    def stars(e: DataFrame) -> bool:
        """Whether each node has one smaller neighbour, which has none itself, or none."""
        ends = e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("b", F.lit(0), F.lit(1)))
        ups = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return not ups.agg(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]

    shared_dir(edges.sparkSession)
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().checkpoint()
    while not stars(edges):
        edges = largest(largest(edges, small=False), small=True).checkpoint()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())


def remove(table: DataFrame) -> None:
    """Delete a stashed table that nothing is to read any more."""
    session = table.sparkSession
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = session._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)

"""Encoding and decoding with a sentencepiece BPE model, by a table of the last token of each prefix.

A text's encoding is the one row of tokens in which every two neighbours stay as they are when merging runs over the two
of them alone: the first merge across a border would be made between the two as well, as merges of other tokens do not
bear on them. So the encoding of a prefix is that of a shorter prefix and one token, and that token is unique. An
Aho-Corasick automaton lists the tokens that end at each place; the one that goes with the last token of the prefix
before it is put down, a number a place. The ids are read off backwards. Time and memory grow with the length of a text,
whatever it holds.

Whether two tokens go together is found by merging their characters in the model's order (best score first, then from
left to right) until a merge crosses the border; answers are kept, up to a bound. Texts are cut where no piece of the
model reaches across (before a mark that follows other characters, and around characters that are in no longer piece),
and a worker keeps the ids of short cuts, up to a bound.

Normalisation is the library's own, and decoding its decode(ids). Characters that are no pieces become their bytes.

Edge cases: a null text is empty; an empty text has the begin and end ids alone; texts of any length are encoded whole;
rows are encoded each on its own, so rows that repeat, or have no id, give a row each; an empty table gives an empty one.
Models without byte pieces, with unused pieces, or of another kind than BPE are refused (the last when a piece that
merging cannot make occurs, which their scores lead to).
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
KEPT_CUTS, LONGEST_CUT, KEPT_PAIRS = 400_000, 64, 1_000_000


def packed(ids: list[int]) -> bytes:
    made = array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def decoded(path: str, ids: bytes) -> str:
    return processor(path).decode(np.frombuffer(ids, dtype="<u4").tolist())


class Encoder(dict):
    """Ids (as bytes of unsigned 32-bit integers, little end first) by cut; the dict is the memory of short cuts."""

    def __init__(self, path: str):
        super().__init__()
        self.model = model = processor(path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        if any(map(model.is_unused, range(size))) or sum(map(model.is_byte, range(size))) != 256:
            raise ValueError(f"{path} has unused pieces, or no piece for each byte")
        self.text = {i: model.id_to_piece(i) for i in plain}
        self.score = {self.text[i]: model.get_score(i) for i in plain}
        self.token = {p: i for i, p in self.text.items()}
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        joining = {c for p in self.token if len(p) > 1 for c in p}
        for k, c in enumerate(sorted(joining - self.token.keys())):  # characters that occur within pieces only
            self.token[c], self.text[size + k] = size + k, c
        self.pieces = size
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.token.items():
            if len(piece) == 1 or self.merged(piece, 0) == [piece]:  # others are never made
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        letters = "".join(map(re.escape, sorted(joining - {MARK})))
        across = any(b == MARK != a for p in self.token for a, b in zip(p, p[1:], strict=False))
        self.cuts = re.compile(f"[{letters}{MARK}]+|[^{letters}{MARK}]+" if across else f"{MARK}*[{letters}]+|{MARK}+|[^{letters}{MARK}]+")
        self.pairs: dict[int, bool] = {}

    def merged(self, text: str, border: int) -> list[str] | None:
        """The characters of a short text, merged; None once a merge crosses the border (0 for none)."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return parts
            start = sum(map(len, parts[:at]))
            if start < border < start + len(parts[at]) + len(parts[at + 1]):
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def together(self, a: int, b: int) -> bool:
        """Whether token b may follow token a: merging leaves the two of them."""
        left, right = self.text[a], self.text[b]
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        self.pairs[a << 32 | b] = answer = self.merged(left + right, len(left)) is not None
        return answer

    def last_tokens(self, cut: str) -> list[int]:
        """The last token of each prefix of one character or more; -1 is a character that is no piece."""
        last: list[int | None] = [None] * (len(cut) + 1)
        pairs, at = self.pairs, 0
        for end, (length, token) in self.automaton.iter(cut):
            end += 1
            while at < end - 1:  # characters in no piece
                at += 1
                if last[at] is None:
                    last[at] = -1
            if last[end] is not None:
                continue
            start = end - length
            before = last[start] if start else -1
            if before is None:
                continue
            fits = True if before < 0 else pairs.get(before << 32 | token)
            if self.together(before, token) if fits is None else fits:
                last[end], at = token, end
        return [-1 if t is None else t for t in last[1:]]

    def __missing__(self, cut: str) -> bytes:
        last, ids, end = self.last_tokens(cut), [], len(cut)
        while end:
            token = last[end - 1]
            length = len(self.text[token]) if token >= 0 else 1
            if 0 <= token < self.pieces:
                ids.append(token)
            else:
                ids.extend(self.byte[b] for b in reversed(cut[end - 1].encode()))
            end -= length
        ids.reverse()
        out = packed(ids)
        if len(cut) <= LONGEST_CUT:
            if len(self) >= KEPT_CUTS:
                self.clear()
            self[cut] = out
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, with begin and end."""
        cuts = self.cuts.findall(self.model.normalize(text)) if text else []
        return b"".join([packed([self.model.bos_id()]), *map(self.__getitem__, cuts), packed([self.model.eos_id()])])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids) for each row: ids are unsigned 32-bit integers, little end first, with begin and end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(model)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([made.encode(t.as_py()) for t in part.column(1)], pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded) for each row of (doc_id, ids); ids of no bytes, or null, decode to an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([decoded(model, i.as_py() or b"") for i in part.column(1)], pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, ids binary, decoded string")

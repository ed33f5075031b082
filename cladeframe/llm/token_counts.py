"""Token counts of a unigram tokenizer, without making the tokens.

The vocabulary is a list of pieces with scores; the best segmentation of a text is the one of the highest total score.
Only its number of pieces is wanted, so a Viterbi pass carries two numbers per position, the best score and the pieces on
the way there, and no back pointers. An Aho-Corasick automaton lists the pieces that end at each position, longest first.

Rules, those of the tokenizers library's Unigram model behind a Metaspace pre-tokenizer (replacement U+2581, a prefix
always, cut before each):

* of equal scores at one place, the piece that begins first stays (a later one must be strictly better);
* where no single character is a piece, an unknown edge of that character may be used, at the lowest score less 10;
* unknown characters count by their UTF-8 bytes if the vocabulary has all byte pieces, else a run of them counts once.

Words repeat, so a worker keeps the counts of short words, up to a bound.

Edge cases: null and empty texts have 0 tokens; a text of any length is counted whole, word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
PENALTY = 10.0
KEPT, LONGEST = 400_000, 48


class Counter(dict):
    """Counts by word; the dict is the memory of short words."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool):
        super().__init__()
        names = {p for p, _ in pieces}
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in names for b in range(256))
        self.unknown = min(s for _, s in pieces) - PENALTY
        self.single = {p for p in names if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()

    def __missing__(self, word: str) -> int:
        n = self.count(MARK + word)
        if len(word) <= LONGEST:
            if len(self) >= KEPT:
                self.clear()
            self[word] = n
        return n

    def count(self, text: str) -> int:
        """Pieces of the best segmentation of one word. best and pieces are by position; a run of unknown characters is
        told by the sign that the last edge leaves in `open_run`."""
        size = len(text)
        best, pieces, open_run = [0.0] + [None] * size, [0] * (size + 1), [False] * (size + 1)
        single, unknown, as_bytes = self.single, self.unknown, self.bytes
        at = 0

        def close(to: int) -> None:
            # positions up to `to` have all their pieces; the unknown edge into each begins last, so it must be better
            nonlocal at
            while at < to:
                c = text[at]
                if c not in single:
                    score = best[at] + unknown
                    if best[at + 1] is None or score > best[at + 1]:
                        cost = len(c.encode()) if as_bytes else (0 if open_run[at] else 1)
                        best[at + 1], pieces[at + 1], open_run[at + 1] = score, pieces[at] + cost, True
                at += 1

        for end, (length, score) in self.automaton.iter(text):
            end += 1
            close(end - 1)
            start = end - length
            score += best[start]
            if best[end] is None or score > best[end]:
                best[end], pieces[end], open_run[end] = score, pieces[start] + 1, False
        close(size)
        return pieces[size]

    def of_text(self, text: str | None) -> int:
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")
        if words[0] == "":  # the text's own leading space takes the place of the prefix
            words = words[1:]
        return sum(map(self.__getitem__, words))


@lru_cache(maxsize=2)
def counter(pieces: tuple[tuple[str, float], ...], byte_fallback: bool) -> Counter:
    return Counter(list(pieces), byte_fallback)


@lru_cache(maxsize=2)
def read_vocabulary(path: str) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()))


def token_counts(docs: DataFrame, model: str, byte_fallback: bool = True) -> DataFrame:
    """(doc_id, n_tokens) for each row, with the vocabulary of a sentencepiece model file on every executor."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(read_vocabulary(model), byte_fallback)
        for batch in batches:
            n = pa.array([counts.of_text(t.as_py()) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n], names=["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n_tokens long")

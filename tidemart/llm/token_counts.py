"""Token counts under a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton over the vocabulary enumerates every piece that ends at every character;
dynamic programming carries the best score and its number of pieces.  Ties are the tokenizer's:
a segmentation replaces another only with a higher score, and pieces are tried from the earliest
start on.  A character without a piece of its own scores UNKNOWN_PENALTY below the worst piece and
counts as its UTF-8 bytes.  Scores are summed as doubles, as the `tokenizers` library's unigram model
does; 32-bit sums (sentencepiece) lose small differences against the scores of unused marks.

Spaces are word marks that pieces can only begin with, and no piece holds a line end.  Both are
checked when the vocabulary is loaded.  So the best segmentation of a text is that of its words
(spaces before them included), each of which is computed once and remembered.

Defined results: a null text counts as empty and has no tokens; one mark is put before any other
text; repeated rows are answered each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import slices

MARK = "▁"
UNKNOWN_PENALTY = 10.0

#: Words whose counts a worker remembers at once.
REMEMBERED = 500_000


class Counter(dict):
    """Number of tokens by word; computes what it does not know."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        spaced = [(piece.replace(MARK, " "), score) for piece, score in pieces]
        if any(" " in piece.lstrip(" ") or "\n" in piece for piece, _ in spaced):
            raise ValueError("a piece holds a word mark behind other characters, or a line end")
        self.automaton = ahocorasick.Automaton()
        for piece, score in spaced:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in spaced if len(piece) == 1}
        self.unknown = min(score for _, score in spaced) - UNKNOWN_PENALTY
        self.words = re.compile(r" *[^ \n]+| +|\n")

    def __missing__(self, word: str) -> int:
        self[word] = found = self.best(word)[1]
        return found

    def best(self, word: str) -> tuple[float, int]:
        """Best score of a word, and the number of its pieces."""
        size = len(word)
        score: list[float | None] = [0.0] + [None] * size
        count = [0] * (size + 1)
        at = 0  # ends up to here are settled
        for last, (length, value) in self.automaton.iter(word):
            while at < last:
                at += 1
                self._unknown(word, at, score, count)
            before = score[last + 1 - length]
            if before is not None and (score[last + 1] is None or before + value > score[last + 1]):
                score[last + 1] = before + value
                count[last + 1] = count[last + 1 - length] + 1
        while at < size:
            at += 1
            self._unknown(word, at, score, count)
        return score[size], count[size]

    def _unknown(self, word: str, end: int, score: list[float | None], count: list[int]) -> None:
        """Try the last character as unknown; matches that end here, all longer, came first."""
        char = word[end - 1]
        if char not in self.single:
            value = score[end - 1] + self.unknown
            if score[end] is None or value > score[end]:
                score[end] = value
                count[end] = count[end - 1] + len(char.encode())

    def count(self, text: str) -> int:
        if not text:
            return 0
        total, mark = 0, " "
        for part in slices(text):
            if len(self) > REMEMBERED:
                self.clear()
            # A part ends behind a space or line end; its last spaces belong to the next word.
            part = mark + part
            body = part.rstrip(" ")
            mark = part[len(body) :]
            total += sum(map(self.__getitem__, self.words.findall(body)))
        return total + (self[mark] if mark else 0)


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, without control and byte pieces."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return [(piece.piece, piece.score) for piece in model.pieces if piece.type == piece.NORMAL]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(vocabulary(path))


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """Return per row: doc_id, n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in batches:
            found = [known.count(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long")

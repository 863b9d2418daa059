"""Byte-level BPE by monoid tree reduction.

encode() halves a text until the halves are small, encodes those, and joins neighbours.  A join
re-encodes only a window around the boundary.  The window grows until both its ends are *cuts*:
places where the split pattern must end a match whatever stands further left or right.  From a
cut on the pattern starts afresh, so the tokens outside the window are those of the joined text
and stay as they are.  Where a half has no cut, the window takes all of it.

A cut is a place after a letter, number or symbol where a character of another kind follows: no
match of the pattern runs from one kind into another, but for a space before a run and for an
apostrophe before letters, which are therefore no places for a cut.  A match looks ahead only over
white space (never across a cut, which stands behind a visible character) and in contractions
(letters after an apostrophe, never across a change of kind).

decode() concatenates the bytes of tokens up the same kind of tree.

Defined results: a null text counts as empty; an empty text has no tokens; any text decodes to its
own UTF-8 bytes; repeated rows are answered each; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters up to which a text is a leaf of the tree.
LEAF = 2048
#: Characters on either side of a boundary in which the first window ends.
WINDOW = 32

CUT = regex.compile(r"(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})|(?<=[^\s\p{L}\p{N}'])(?=[\s\p{L}\p{N}])")


class TreeCodec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF, window: int = WINDOW):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.leaf, self.window = leaf, window

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, start: int, end: int) -> list[int]:
        if end - start <= self.leaf:
            return self.library.encode_ordinary(text[start:end])
        middle = (start + end) // 2
        left, right = self._encode(text, start, middle), self._encode(text, middle, end)
        return self.join(text, start, middle, end, left, right)

    def join(self, text: str, start: int, middle: int, end: int, left: list[int], right: list[int]) -> list[int]:
        """Tokens of text[start:end] from those of its two parts."""
        a, b = self._cut_before(text, start, middle), self._cut_after(text, middle, end)
        again = self.library.encode_ordinary
        drop, skip = len(again(text[a:middle])), len(again(text[middle:b]))
        del left[len(left) - drop :]
        left += again(text[a:b])
        left += right[skip:] if skip else right
        return left

    def _cut_before(self, text: str, start: int, middle: int) -> int:
        """The last cut of growing windows before middle, else start."""
        size = self.window
        while True:
            low = max(start, middle - size)
            # endpos shows the search no character of the right part: a cut needs the one behind it.
            places = [m.start() for m in CUT.finditer(text, max(low, start + 1), middle) if m.start() < middle]
            if places:
                return places[-1]
            if low == start:
                return start
            size *= 2

    def _cut_after(self, text: str, middle: int, end: int) -> int:
        """The first cut of growing windows behind middle, else end."""
        size = self.window
        while True:
            high = min(end, middle + size)
            for m in CUT.finditer(text, min(middle + 1, high), high):
                if m.start() < high:
                    return m.start()
            if high == end:
                return end
            size *= 2

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return b"".join(map(self.tokens.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str, leaf: int = LEAF, window: int = WINDOW) -> TreeCodec:
    return TreeCodec(path, pattern, leaf, window)


def encode_documents(docs: DataFrame, path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, and the ids of the whole text as packed little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = codec(path, pattern, leaf)
        for batch in batches:
            ids = [np.asarray(encoder.encode(x or ""), "<u4").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_tokens and the decoded bytes of packed ids, with digests of both sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = codec(path, pattern, leaf)
        for batch in batches:
            rows = batch.column(1).to_pylist()
            ids = [np.frombuffer(x or b"", "<u4") for x in rows]
            decoded = [decoder.decode(x.tolist()) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x or b"").hexdigest() for x in rows], pa.string()),
                    pa.array(decoded, pa.binary()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded binary"
    )

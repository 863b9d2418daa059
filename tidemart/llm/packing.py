"""Best-fit decreasing packing of tokenized documents into sequences of bounded length.

A document is its token ids and a closing separator id.  Longer documents than a sequence are
cut into full pieces, which are sequences of their own; only a document's last piece is packed.
Last pieces are dealt evenly over tasks and every task packs its share: lengths decrease, and a
segment tree over the remaining capacities finds the tightest open bin in logarithmic time.  A
share holds at most GROUP_DOCUMENTS last pieces, so the number of shares follows the table and a
task's memory does not; each share leaves at most a few bins unfilled.

Defined results: a null text counts as empty; an empty text is its separator alone; equal lengths
are packed in order of doc_id (null last), piece and ids; repeated rows are separate documents;
an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import emptied, slices

CAPACITY = 2048
SEPARATOR = 0
GROUP_DOCUMENTS = 100_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordTokenizer:
    """Ids of words under a tokenizer that drops white space, so a text's ids are its words' ids.

    Texts are taken in portions of bounded length.  Of a portion's words (parts between spaces and
    line ends) each distinct one is looked at once: plain Latin letters with closing punctuation are
    two parts, their lower-cased letters and the marks, because the tokenizer lower-cases and splits
    letters from punctuation; any other word is one part.  Parts are remembered as packed ids, and
    the ids of all words are gathered by index.
    """

    #: Characters of a portion, and characters of parts that are remembered at once: these bound a worker's memory.
    PORTION, REMEMBERED = 4 << 20, 6 << 20
    WORD_END = "</w>"
    PLAIN = "^(?P<run>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<mark>[.,;:!?]*)$"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        #: Texts in which an added token may stand are encoded whole: it is cut out before words are.
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)", re.IGNORECASE)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(self.WORD_END)]] = True
        self.parts: dict[str, bytes] = {"": b""}
        self.remembered = 0

    def ids(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts, by the library."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, "<u4").tobytes() for x in found]

    def learn_runs(self, runs: list[str]) -> None:
        """Encode letter runs as one text; each ends with the only word-end token of its own."""
        [packed] = self.ids([" ".join(runs)])
        bounds = np.flatnonzero(self.ends[np.frombuffer(packed, "<u4")]) + 1
        if len(bounds) != len(runs):
            self.parts.update(zip(runs, self.ids(runs), strict=True))
            return
        start = 0
        for run, end in zip(runs, (4 * bounds).tolist(), strict=True):
            self.parts[run] = packed[start:end]
            start = end

    def lookup(self, parts: list[str], runs: bool) -> list[bytes]:
        new = [part for part in parts if part not in self.parts]
        for at in range(0, len(new), 2000):
            some = new[at : at + 2000]
            self.remembered += sum(map(len, some))
            if runs:
                self.learn_runs(some)
            else:
                self.parts.update(zip(some, self.ids(some), strict=True))
        return list(map(self.parts.__getitem__, parts))

    def forget(self) -> None:
        self.parts, self.remembered = {"": b""}, 0

    def encode_portion(self, texts: list[str]) -> list[bytes]:
        listed = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        words = listed.values.dictionary_encode()
        split = pc.extract_regex(words.dictionary, self.PLAIN)
        plain = split.is_valid().to_numpy(zero_copy_only=False)
        first = pc.if_else(split.is_valid(), pc.utf8_lower(split.field("run")), words.dictionary).dictionary_encode()
        marks = pc.fill_null(split.field("mark"), "").dictionary_encode()
        if self.remembered > self.REMEMBERED:
            self.forget()
        # A part is a run of letters for all its words or for none.
        firsts, at = first.dictionary.to_pylist(), first.indices.to_numpy()
        is_run = np.zeros(len(firsts), bool)
        is_run[at[plain]] = True
        found: list[bytes] = [b""] * len(firsts)
        for runs in (True, False):
            chosen = np.flatnonzero(is_run == runs).tolist()
            for i, ids in zip(chosen, self.lookup([firsts[i] for i in chosen], runs), strict=True):
                found[i] = ids
        found += self.lookup(marks.dictionary.to_pylist(), runs=False)
        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), "i8", len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        of_word = np.stack([at, marks.indices.to_numpy() + len(firsts)], 1)
        used = of_word[words.indices.to_numpy()].ravel()
        lengths = sizes[used]
        ends = np.cumsum(lengths)
        gathered = ids[np.repeat(starts[used] - (ends - lengths), lengths) + np.arange(lengths.sum())].tobytes()
        bounds = (4 * np.append(0, ends)[2 * listed.offsets.to_numpy()]).tolist()
        return [gathered[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids (little-endian, unsigned, 32 bits) of every text."""
        found: list[list[bytes]] = [[] for _ in texts]
        owners, portion, size = [], [], 0

        def flush():
            for owner, ids in zip(owners, self.encode_portion(portion), strict=True):
                found[owner].append(ids)
            owners.clear()
            portion.clear()

        for i, text in enumerate(texts):
            if self.added.search(text):
                found[i] = self.ids([text])
                continue
            for part in slices(text):
                owners.append(i)
                portion.append(part)
                size += len(part)
                if size > self.PORTION:
                    flush()
                    size = 0
        if portion:
            flush()
        return [b"".join(ids) for ids in found]

    def __reduce__(self):
        raise TypeError("load a tokenizer in the worker")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, separator: int = SEPARATOR, with_ids: bool = False) -> DataFrame:
    """Cut tokenized documents: one row per piece, with its ids where asked for."""
    tail = separator.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)
        try:
            yield from cut_with(encoder, batches)
        finally:
            encoder.forget()

    def cut_with(encoder: WordTokenizer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            encoded = encoder.encode([text or "" for text in batch.column(1).to_pylist()])
            for doc, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids += tail
                for number, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    rows.append((doc, number, start // 4, len(part) // 4, zlib.crc32(part), part))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            n = len(names) - (not with_ids)
            yield pa.RecordBatch.from_arrays(columns[:n], names=names[:n])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(emptied(cut), PIECES + ", ids binary" * with_ids)


class OpenBins:
    """Open bins by remaining capacity, under a segment tree that counts them."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        self._add(room, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take out the open bin with the least room of at least length: (room, bin)."""
        node = length + self.width
        if not self.count[node]:
            # Climb to the first right-hand subtree with an open bin, then go down its left edge.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node + (not self.count[2 * node])
        room = node - self.width
        self._add(room, -1)
        return room, self.bins[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; lengths must not increase."""
    bins, offsets, open_bins, made = np.empty(len(lengths), "i8"), np.empty(len(lengths), "i8"), OpenBins(capacity), 0
    for item, length in enumerate(lengths.tolist()):
        found = open_bins.tightest(length)
        if found is None:
            found = (capacity, made)
            made += 1
        room, number = found
        bins[item], offsets[item] = number, capacity - room
        if room > length:
            open_bins.put(room - length, number)
    return bins, offsets


def pack(cut: DataFrame, shares: int, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces; extra columns of the pieces are kept."""
    schema = cut.schema.simpleString()[len("struct<") : -1].replace(":", " ")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        made, last = 0, []

        def numbered(rows: pa.RecordBatch | pa.Table, bins: np.ndarray, offsets: np.ndarray):
            return rows.append_column("sequence_id", pa.array(first + bins, pa.int64())).append_column(
                "offset", pa.array(offsets, pa.int64())
            )

        for batch in batches:
            full = np.asarray(batch.column("length")) == capacity
            if n := int(full.sum()):
                rows = pa.Table.from_batches([batch]).filter(pa.array(full))
                yield from numbered(rows, made + np.arange(n), np.zeros(n, "i8")).to_batches()
                made += n
            if n < batch.num_rows:
                last.append(batch.filter(pa.array(~full)))
        if last:
            rows = pa.Table.from_batches(last).sort_by(
                [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
            )
            bins, offsets = best_fit_decreasing(np.asarray(rows.column("length")), capacity)
            yield from numbered(rows, made + bins, offsets).to_batches(max_chunksize=10_000)

    # Dealt in turn, not by a key: no document, length or copy can make one share larger.
    return cut.repartition(shares).mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False, group: int = GROUP_DOCUMENTS) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its sequence and place."""
    shares = max(1, -(-docs.count() // group))
    return pack(pieces(docs, path, capacity, with_ids=with_ids), shares, capacity)

"""Online logistic context mixing: how probable a text is, in bits per byte.

A text is the sequence of its lower-cased words and one end.  Every word is coded bit by bit:
frequent words (VOCABULARY at most) by a Huffman code, all others by an escape and their bytes,
which have a code of their own.  Each bit is predicted by several models:

* the share of ones at the code's node (order 0);
* two tables of counts under hashed contexts: the word before, and the two words before; inside a
  spelled word the two, and the three bytes before.

Predictions are mixed in the logistic domain.  A gate picks the set of weights: what is coded, and
how often each hashed context has been seen.  While a text is read, its weights go on learning, one
step after BLOCK words.  A last table (per gate and mixed prediction, learned) corrects what the
mixture still gets wrong.  Eight ninths of the training documents fill the tables of counts, the
other ninth (which the tables have not seen) trains weights and the correction.

Counts come from all training documents: tasks send the slots they have touched, sums are taken by
Spark, and what goes to workers has a fixed size: VOCABULARY words and two tables of 2^SLOT_BITS
16-bit predictions (16 MB).  Tuned weights are means over tasks.  The unigram base needs the counts
of all words; rare ones meet their texts in a join.

Defined results: a null text counts as empty and has its end as only token.  A null id is held
out.  Without training documents all words are spelled and predictions stay at the codes' shares.
Repeated rows are scored each.  Texts may have any length: they are worked on in spans of words.
An empty table gives no rows.  Only the id and the text are read, other columns may have any name.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import staged

#: Words that have a code of their own, at most, and how often they must stand in the training texts.
#: Rarer ones are spelled, which also teaches how new words are spelled.
VOCABULARY = 1 << 17
LEAST = 3
#: Slots of a table of counts, as a power of two.
SLOT_BITS = 22
#: Slots that travel together.
CHUNK = 1 << 16
#: Words after which a text's weights learn; words of texts worked on together; words of one span.
BLOCK = 64
GROUP = 120_000
SPAN = 16_000
#: Distinct words that a task counts before it hands them on.
TASK_WORDS = 300_000
#: Step of the weights while they are tuned, and within a text.
TUNE_RATE, TEXT_RATE = 0.5, 0.02

END = b"\n"  # the end of a text, and of a spelled word: no word holds it
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_HASH = np.uint64(0x9E3779B97F4A7C15)
_NODE = np.uint64(0xC2B2AE3D27D4EB4F)
INPUTS, GATES, STEPS, COARSE = 4, 32, 1024, 64
_BIAS = np.float32(0.3)
START = np.tile(np.array([0.4, 0.5, 0.3, 0.0]), (GATES, 1))


def words_of(text: bytes | None) -> list[bytes]:
    """The lower-cased words of a text, without its end."""
    return (text or b"").translate(_LOWER).split()


class Code:
    """A Huffman code: each symbol's path of (inner node, bit), and the share of ones at each node."""

    def __init__(self, counts: list[int]):
        n = len(counts)
        up, weight, heap = [0] * (2 * n), [*counts, *[0] * n], [(c, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        ones, free = [0.0] * (2 * n), n
        while len(heap) > 1:
            (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
            up[left], up[right] = 2 * free, 2 * free + 1
            weight[free], ones[free] = a + b, (b + 0.5) / (a + b + 1)
            heapq.heappush(heap, (a + b, free))
            free += 1
        steps, self.start = [], np.zeros(n, np.int64)
        self.length = np.zeros(n, np.int64)
        for symbol in range(n):
            path, at = [], symbol
            while at != free - 1:
                path.append(up[at] - 2 * n)
                at = up[at] >> 1
            self.start[symbol], self.length[symbol] = len(steps), len(path)
            steps += path[::-1]
        #: Node and bit of each step as 2 * node + bit.
        self.steps = np.array(steps, np.int32)
        self.stretch = stretch(np.array(ones[n : max(free, n + 1)])).astype(np.float32)

    def events(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For all steps of the symbols: the index of the symbol, and the step."""
        length = self.length[symbols]
        at = np.repeat(np.arange(len(symbols)), length)
        first = np.cumsum(length) - length
        return at, self.steps[np.arange(len(at)) + np.repeat(self.start[symbols] - first, length)]


def stretch(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1 / 4096, 1 - 1 / 4096)
    return np.log(p / (1 - p))


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


#: Steps in which mixed predictions are told apart, per unit of stretch.
UNIT = 64
_SQUASH = squash((np.arange(STEPS) - STEPS // 2 + 0.5) / UNIT).astype(np.float32)


@dataclass
class Model:
    """What workers get: of bounded size."""

    ids: dict[bytes, int]  # word -> symbol; 0 is the escape
    counts: np.ndarray  # training count of each symbol's word
    words: Code
    letters: Code
    tokens: int  # N of the unigram base
    types: int  # V
    #: Two tables of 16-bit predictions: 14 bits of stretch, 2 bits of confidence.
    tables: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=START.copy)
    corrected: np.ndarray | None = None  # probability of a one per gate and mixed prediction

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.types + 1)))


def vocabulary(top: list[tuple[bytes, int]], ends: int, tokens: int, types: int) -> Model:
    """A model without tables, from the most frequent words and their counts."""
    letters = np.ones(256, np.int64)
    for word, _ in top:
        letters += np.bincount(np.frombuffer(word + END, np.uint8), minlength=256)
    spelled = tokens - ends - sum(c for _, c in top)
    model = Model(
        {END: 1, **{w: i for i, (w, _) in enumerate(top, 2)}},  # symbol 0 is the escape
        np.array([0, ends, *(c for _, c in top)], np.float64),
        Code([spelled + 1, ends + 1, *(c for _, c in top)]), Code(letters.tolist()), tokens, types,
    )
    model.tables = [predictions(np.zeros(1 << SLOT_BITS), np.zeros(1 << SLOT_BITS)) for _ in range(2)]
    return model


class Events:
    """The coded bits of a span of words: their slots in the tables, nodes, bits and words."""

    __slots__ = ("at", "bit", "order0", "slots")

    def __init__(self, code: Code, symbols: np.ndarray, contexts: list[np.ndarray]):
        self.at, step = code.events(symbols)
        self.bit = step & 1
        node = step >> 1
        self.order0 = code.stretch[node]
        mixed = node.astype(np.uint64) * _NODE
        shift = np.uint64(64 - SLOT_BITS)
        self.slots = [(((c[self.at] ^ mixed) * _HASH) >> shift).view(np.int64) for c in contexts]


class Texts:
    """A group of texts as symbols, cut into blocks of words."""

    def __init__(self, model: Model, texts: list[list[bytes]]):
        ids = model.ids
        flat: list[bytes] = []
        for words in texts:
            flat += words
            flat.append(END)
        self.sizes = np.array([len(words) + 1 for words in texts])
        n = len(flat)
        symbol = np.fromiter(map(ids.get, flat, repeat(0)), np.int64, n)
        spelled = np.flatnonzero(symbol == 0)
        value = symbol.astype(np.uint64)
        value[spelled] = [zlib.crc32(flat[i]) + (1 << 32) for i in spelled.tolist()]
        text = np.repeat(np.arange(len(texts)), self.sizes)
        place = np.arange(n) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        none = np.uint64(1 << 40)
        before = np.where(place > 0, np.roll(value, 1), none)
        earlier = np.where(place > 1, np.roll(value, 2), none)
        one = (before + np.uint64(1)) * _HASH
        two = (one ^ (earlier + np.uint64(7))) * _HASH
        self.spelled, self.ends = spelled, np.cumsum(self.sizes)
        # Blocks of all texts in turn: first blocks first.
        block = place // BLOCK
        self.order = np.argsort(block, kind="stable")
        self.flat, self.symbol, self.text = flat, symbol[self.order], text[self.order]
        self.contexts = [one[self.order], two[self.order]]
        self.edges = np.append(np.flatnonzero(np.diff(block[self.order], prepend=-1)), n)
        self.bytes = np.array([sum(map(len, words)) + len(words) for words in texts])

    def spans(self) -> Iterator[tuple[int, int]]:
        """Runs of whole blocks of up to SPAN words, where a block does not hold more."""
        low = 0
        for a, b in zip(self.edges[:-1].tolist(), self.edges[1:].tolist()):
            if b - low > SPAN and a > low:
                yield low, a
                low = a
        yield low, int(self.edges[-1])

    def spelled_words(self) -> list[Counter]:
        """Per text how often each of its spelled words stands in it."""
        cuts = np.searchsorted(self.spelled, self.ends).tolist()
        words = [self.flat[i] for i in self.spelled.tolist()]
        return [Counter(words[a:b]) for a, b in zip([0, *cuts], cuts)]

    def word_events(self, model: Model, low: int, high: int) -> Events:
        return Events(model.words, self.symbol[low:high], [c[low:high] for c in self.contexts])

    def letter_events(self, model: Model, low: int, high: int) -> tuple[Events, np.ndarray]:
        """The bits of the spelled words, and the word of each letter (from low)."""
        which = np.flatnonzero(self.symbol[low:high] == 0)
        spelled = [self.flat[i] for i in self.order[low + which].tolist()]
        letters = np.frombuffer(b"".join(w + END for w in spelled), np.uint8).astype(np.uint64)
        sizes = np.array([len(w) + 1 for w in spelled], np.int64)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        near = [np.where(place >= k, np.roll(letters, k), np.uint64(10)) for k in (1, 2, 3)]
        two = (near[0] | (near[1] << np.uint64(8)) | np.uint64(1 << 50)) * _HASH
        three = (near[0] | (near[1] << np.uint64(8)) | (near[2] << np.uint64(16)) | np.uint64(1 << 51)) * _HASH
        return Events(model.letters, letters.astype(np.int64), [two, three]), np.repeat(which, sizes)


def _groups(rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    """Rows whose last member is a list of words, until they hold so many words."""
    group, held = [], 0
    for row in rows:
        group.append(row)
        held += len(row[-1]) + 1
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


# Counting


def count_words(docs: DataFrame) -> DataFrame:
    """word, c: how often each word, and the end (END), stands in a table with a text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "c"]
            )

        for batch in batches:
            for text in batch.column(0):
                found.update(words_of(text.as_py()))
                found[END] += 1
            if len(found) > TASK_WORDS:
                yield rows()
                found.clear()
        yield rows()

    return docs.select(F.col("text").cast("binary")).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _dump(ones: np.ndarray, all_: np.ndarray) -> bytes:
    """Counts of a chunk: which slots are used, and their counts as bytes with a list of larger ones."""
    used = np.flatnonzero(all_)
    both = np.concatenate([ones[used], all_[used]])
    large = both[both >= 255].astype("<u4")
    marks = np.packbits(all_ > 0).tobytes()
    return marks + np.minimum(both, 255).astype(np.uint8).tobytes() + large.tobytes()


def _load(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    used = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, CHUNK // 8)))
    n = len(used)
    both = np.frombuffer(data, np.uint8, 2 * n, CHUNK // 8).astype(np.int64)
    both[both == 255] = np.frombuffer(data, "<u4", -1, CHUNK // 8 + 2 * n)
    return used, both[:n], both[n:]


def predictions(ones: np.ndarray, all_: np.ndarray) -> np.ndarray:
    """Counts as 16-bit predictions with their confidence."""
    s = np.round(stretch((ones + 0.4) / (all_ + 0.8)) * 960).astype(np.int64)
    confidence = np.searchsorted([1, 3, 16], all_, side="right")
    return ((s << 2) | confidence).astype(np.int16)


def count_contexts(docs: DataFrame, model: Model) -> DataFrame:
    """part (table and chunk) and the predictions of its slots, from the counts of all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = shared.value
        counts = np.zeros((2, 1 << SLOT_BITS, 2), np.uint32).reshape(2, -1)
        rows = ((words_of(x.as_py()),) for batch in batches for x in batch.column(0))
        for group in _groups(rows, GROUP):
            texts = Texts(plain, [words for (words,) in group])
            for low, high in texts.spans():
                for events in (texts.word_events(plain, low, high), texts.letter_events(plain, low, high)[0]):
                    for table, slots in zip(counts, events.slots):
                        np.add.at(table, 2 * slots + events.bit, np.uint32(1))
        parts = counts.reshape(-1, CHUNK, 2)
        for part, at in enumerate(parts):
            if at.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int64()), pa.array([_dump(at[:, 1], at[:, 0] + at[:, 1])], pa.binary())],
                    names=["part", "counts"],
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ones, all_ = None, None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int64()), pa.array([predictions(ones, all_).tobytes()], pa.binary())],
                names=["part", "slots"],
            )

        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != current:
                    if current is not None:
                        yield row()
                    current, ones, all_ = part, np.zeros(CHUNK, np.int64), np.zeros(CHUNK, np.int64)
                used, more, seen = _load(data.as_py())
                ones[used] += more
                all_[used] += seen
        if current is not None:
            yield row()

    parts = 2 * (1 << SLOT_BITS) // CHUNK
    sent = docs.select(F.col("text").cast("binary")).mapInArrow(build, "part long, counts binary")
    return sent.repartition(parts // 4, "part").sortWithinPartitions("part").mapInArrow(merge, "part long, slots binary")


# Mixing


class Mixer:
    """Weights per text (or one set for all) and gate, learning block by block."""

    def __init__(self, model: Model, texts: int, rate: float):
        self.model, self.rate, self.texts = model, np.float32(rate), texts
        # Weights are held times UNIT, so that their sum with the inputs counts steps.
        self.weights = [np.tile(UNIT * model.weights[:, i], texts).astype(np.float32) for i in range(INPUTS)]
        self.cost = None
        if model.corrected is not None:
            p = np.clip(model.corrected, 1 / 4096, 1 - 1 / 4096)
            self.cost = -np.log2(np.stack([1 - p, p], axis=2)).reshape(-1)

    def inputs(self, events: Events, kind: int) -> tuple[list[np.ndarray], np.ndarray]:
        found = [table[slots] for table, slots in zip(self.model.tables, events.slots)]
        gate = kind * 16 + 4 * (found[0] & 3).astype(np.int64) + (found[1] & 3)
        return [events.order0, *((x >> 2) * np.float32(1 / 960) for x in found)], gate

    def block(self, inputs: list[np.ndarray], gate: np.ndarray, text: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """Mixed predictions of one block's bits as steps 0..STEPS-1; the weights learn from them."""
        key = text * GATES + gate
        total = self.weights[3][key]
        total *= _BIAS
        total += np.float32(STEPS // 2)
        for w, s in zip(self.weights, inputs):
            total += w[key] * s
        step = np.minimum(np.maximum(total, 0), STEPS - 1).astype(np.int64)
        error = bit - _SQUASH[step]
        cells = self.texts * GATES
        pace = UNIT * self.rate / np.maximum(np.bincount(key, minlength=cells), 16)
        for w, s in zip(self.weights, inputs):
            w += pace * np.bincount(key, error * s, cells)
        self.weights[3] += pace * _BIAS * np.bincount(key, error, cells)
        return step

    def run(self, texts: Texts, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(text, gate, step, bit) of all coded bits, block by block; own: every text has its own weights."""
        for low, high in texts.spans():
            words = texts.word_events(self.model, low, high)
            letters, of_word = texts.letter_events(self.model, low, high)
            inside = texts.edges[(texts.edges >= low) & (texts.edges <= high)] - low
            for kind, events, word in ((0, words, words.at), (1, letters, of_word[letters.at])):
                events.at = texts.text[low + word]
                cuts = np.searchsorted(word, inside)
                inputs, gate = self.inputs(events, kind)
                if kind == 0:
                    first = (inputs, gate, events, cuts)
            for i in range(len(inside) - 1):
                for ins, gates, ev, cut in (first, (inputs, gate, events, cuts)):
                    at = slice(cut[i], cut[i + 1])
                    if at.start == at.stop:
                        continue
                    text = ev.at[at]
                    step = self.block([x[at] for x in ins], gates[at], text if own else 0 * text, ev.bit[at])
                    yield text, gates[at], step, ev.bit[at]


def _tune(docs: DataFrame, model: Model) -> Model:
    """Weights and the correction from texts that the tables have not seen: means and sums over tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = shared.value
        mixer, seen = Mixer(plain, 1, TUNE_RATE), np.zeros((GATES * COARSE, 2))
        rows = ((words_of(x.as_py()),) for batch in batches for x in batch.column(0))
        for group in _groups(rows, GROUP):
            for _, gate, step, bit in mixer.run(Texts(plain, [words for (words,) in group]), own=False):
                cell = gate * COARSE + step // (STEPS // COARSE)
                seen += np.bincount(2 * cell + bit, minlength=2 * GATES * COARSE).reshape(-1, 2)
        per_gate = seen.reshape(GATES, -1).sum(1)
        values = np.concatenate([per_gate, *(w * per_gate / UNIT for w in mixer.weights), seen.reshape(-1)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values))), pa.array(values, pa.float64())], names=["at", "value"]
        )

    rows = docs.select(F.col("text").cast("binary")).mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value")).collect()
    values = np.zeros(GATES * (1 + INPUTS) + 2 * GATES * COARSE)
    for at, value in rows:
        values[at] = value
    per_gate, weights = values[:GATES], values[GATES : GATES * (1 + INPUTS)].reshape(INPUTS, GATES)
    tuned = np.where(per_gate > 0, weights / np.maximum(per_gate, 1), START.T).T
    seen = values[GATES * (1 + INPUTS) :].reshape(GATES, COARSE, 2)
    mixed = np.tile(_SQUASH.astype(float), (GATES, 1))
    centre = mixed.reshape(GATES, COARSE, -1).mean(2)
    cells = (seen[:, :, 1] + 50 * centre) / (seen.sum(2) + 50)
    model.weights, model.corrected = tuned, (mixed + np.repeat(cells, STEPS // COARSE, axis=1)) / 2
    return model


def fit(docs: DataFrame, training: Column, tuning: Column, text: str = "text") -> tuple[Model, DataFrame]:
    """A model, and the counts (word, c) of all words of the training documents.

    `tuning` picks the training documents that train weights; the others fill the tables.
    """
    texts = docs.select(F.col(text).cast("binary").alias("text"), training.alias("training"), tuning.alias("tuning"))
    texts = texts.filter("training")
    counts = staged(count_words(texts), "mixing-words")
    tokens, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    is_end = F.col("word") == F.lit(END)
    ends = counts.filter(is_end).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    frequent = counts.filter(~is_end & (F.col("c") >= LEAST))
    top = frequent.orderBy(F.desc("c"), "word").limit(VOCABULARY).collect()
    model = vocabulary([(bytes(r.word), r.c) for r in top], ends, tokens, types)
    slots = staged(count_contexts(texts.filter(~F.col("tuning")), model), "mixing-slots")
    for row in slots.toLocalIterator():  # two tables of fixed size
        table, chunk = divmod(row.part, (1 << SLOT_BITS) // CHUNK)
        model.tables[table][chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(row.slots, np.int16)
    return _tune(texts.filter("tuning"), model), counts


def score(docs: DataFrame, model: Model, counts: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, total_bits, n_bytes, score (log10) and bits_per_byte of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = (
        "row long, doc_id long, n_tokens long, known long, base double, total_bits double, n_bytes long, "
        "rare array<struct<word:binary,m:long>>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = shared.value
        of_symbol = plain.base(plain.counts)
        rows = (
            (row, doc, words_of(x.as_py()))
            for batch in batches
            for row, doc, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
        )
        for group in _groups(rows, GROUP):
            texts = Texts(plain, [words for _, _, words in group])
            n = len(group)
            mixer, bits = Mixer(plain, n, TEXT_RATE), np.zeros(n)
            for at, gate, step, bit in mixer.run(texts, own=True):
                bits += np.bincount(at, mixer.cost[2 * (gate * STEPS + step) + bit], n)
            has = (texts.symbol > 0) & (plain.counts[texts.symbol] > 0)
            base = np.bincount(texts.text, np.where(texts.symbol > 0, of_symbol[texts.symbol], 0), n)
            rare = texts.spelled_words()
            words = pa.array([w for found in rare for w in found], pa.binary())
            times = pa.array([m for found in rare for m in found.values()], pa.int64())
            edges = pa.array(np.cumsum([0, *map(len, rare)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row for row, _, _ in group], pa.int64()),
                    pa.array([doc for _, doc, _ in group], pa.int64()),
                    pa.array(texts.sizes, pa.int64()),
                    pa.array(np.bincount(texts.text, has, n).astype(np.int64)),
                    pa.array(base, pa.float64()),
                    pa.array(bits, pa.float64()),
                    pa.array(texts.bytes, pa.int64()),
                    pa.ListArray.from_arrays(edges, pa.StructArray.from_arrays([words, times], names=["word", "m"])),
                ],
                names=["row", "doc_id", "n_tokens", "known", "base", "total_bits", "n_bytes", "rare"],
            )

    numbered = docs.select(
        F.monotonically_increasing_id(), F.col("doc_id").cast("long"), F.col(text).cast("binary").alias("text")
    )
    scored = staged(numbered.mapInArrow(run, schema), "mixing-scores")
    wide = F.lit(model.tokens + 0.1 * (model.types + 1))
    rare = scored.select("row", F.inline("rare")).join(counts, "word", "left")
    found = rare.groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("m"))).alias("rare_known"),
        F.sum(F.col("m") * F.log10((F.coalesce("c", F.lit(0)) + 0.1) / wide)).alias("rare_base"),
    )
    bits_to_log10 = -math.log10(2)
    return scored.drop("rare").join(found, "row", "left").select(
        "doc_id", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "total_bits", "n_bytes",
        (F.col("total_bits") * bits_to_log10).alias("score"),
        (F.col("total_bits") / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )

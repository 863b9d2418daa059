"""Phrase collocations, counted in counting quotient filters.

1. Words are counted per language; those that are frequent enough get numbers (one number per
   language and word).  A frequent phrase holds frequent words only.
2. Every text becomes the numbers of its words, 0 where a piece ends or a word is rare; this table
   is staged once and read at every phrase length.
3. Length by length, each task packs the phrases of its texts, permutes them invertibly and keeps
   sorted counting quotient filters, one per range of keys (counting_filter.py).  A range's filters
   of all tasks are merged in one task; keys are spread evenly by the permutation and a phrase is
   one entry per filter however often it stands, so no range is hot.
4. A phrase is counted only if both its parts of one word less may be frequent.  That is asked of
   one bit table per length, a fixed number of bits behind the key's top bits: it never misses a
   frequent phrase; what it lets through in vain is counted and dropped by its exact count.
5. Cuts are scored by joins of the frequent phrases with themselves (every part of a frequent
   phrase is frequent), in decimal arithmetic of 38 digits.

Sizes: a filter, a range and a bit table have fixed limits; ranges grow in number with the words.
The dictionary is broadcast up to BROADCAST_WORDS words, beyond that texts meet it in a shuffle join.

Defined results: a null text has no words; a null language is `und`; repeated rows count again;
languages whose phrases are all too rare, and an empty table, give no rows.  Texts of any length
are cut at Arrow rows only, never inside.  Only the text and the language are read, so other
columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.llm.common import staged
from tidemart.llm.counting_filter import Collector, Layout, dump, invert, load, permute
from tidemart.operators.ranking import with_global_rank

#: Words of a dictionary that is still broadcast (some 100 bytes each in a worker).
BROADCAST_WORDS = 1_000_000
#: Distinct words and distinct phrases that a task holds before it hands them on.
TASK_WORDS = 300_000
TASK_KEYS = 2_000_000
#: Phrases (not distinct) that one range of keys is meant for, and the fewest ranges.
RANGE_KEYS = 1 << 23
LEAST_RANGES = 16
#: Bits of a length's table: so many per frequent phrase, up to 2^TABLE_BITS (16 MB).
BITS_EACH = 64
TABLE_BITS = 27
MARK_BITS = 32

_UPPER = bytes(range(65, 91))
# Where pieces end.  0xFF stands for an end: no UTF-8 text holds that byte.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_END = b"\xff"
_TABLE = bytes.maketrans(_UPPER + _ENDS, _UPPER.lower() + _END * len(_ENDS))


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-cased words, with _END between pieces."""
    return (text or b"").translate(_TABLE).replace(_END, b" \xff ").split()


def _input(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))


def count_words(docs: DataFrame) -> DataFrame:
    """lang, word (binary) and f of a (lang, text) table; word null: all words of the language."""

    def rows(found: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in found.items():
            counts.pop(_END, None)
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * (len(counts) + 1), pa.string()),
                        pa.array([None, *counts], pa.binary()),
                        pa.array([counts.total(), *counts.values()], pa.int64()),
                    ],
                    names=["lang", "word", "f"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found.setdefault(lang, Counter()).update(tokens(text.as_py()))
            if sum(map(len, found.values())) > TASK_WORDS:
                yield from rows(found)
                found = {}
        yield from rows(found)

    partial = docs.mapInArrow(run, "lang string, word binary, f long")
    return partial.groupBy("lang", "word").agg(F.sum("f").alias("f"))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


def encode(docs: DataFrame, dictionary: DataFrame, words: int) -> DataFrame:
    """ids: each text of a (lang, text) table as packed unsigned 32-bit word numbers, 0 for ends and rare words."""
    if words > BROADCAST_WORDS:
        return _encode_by_join(docs, dictionary)
    found: dict[str, _Numbers] = {}
    for row in dictionary.select("lang", "word", "id").toLocalIterator():
        found.setdefault(row.lang, _Numbers())[bytes(row.word)] = row.id
    numbers = docs.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = _Numbers()
        for batch in batches:
            ids = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                number = numbers.value.get(lang, none)
                ids.append(np.fromiter(map(number.__getitem__, tokens(text.as_py())), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    return docs.mapInArrow(run, "ids binary")


def _encode_by_join(docs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Each text sends each distinct word once, with its places, so a word of all texts is one row a text."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                at: dict[bytes, list[int]] = {}
                words = tokens(text)
                for i, word in enumerate(words):
                    at.setdefault(word, []).append(i)
                at.pop(_END, None)
                at[_END] = [len(words)]  # no dictionary word: keeps the length of the text
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row] * len(at), pa.int64()),
                        pa.array([lang] * len(at), pa.string()),
                        pa.array(list(at), pa.binary()),
                        pa.array([np.array(x, "<u8").tobytes() for x in at.values()], pa.binary()),
                    ],
                    names=["row", "lang", "word", "places"],
                )

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for pairs in batch.column(0).to_pylist():
                size = next(int(np.frombuffer(x["places"], "<u8")[0]) for x in pairs if not x["id"])
                text = np.zeros(size, "<u4")
                for x in pairs:
                    if x["id"]:
                        text[np.frombuffer(x["places"], "<u8").astype(np.int64)] = x["id"]
                ids.append(text.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    numbered = staged(docs.select(F.monotonically_increasing_id().alias("row"), "lang", "text"), "collocation-texts")
    sent = numbered.mapInArrow(places, "row long, lang string, word binary, places binary")
    met = sent.join(dictionary.select("lang", "word", "id"), ["lang", "word"], "left").filter(
        F.col("id").isNotNull() | (F.col("word") == F.lit(_END))
    )
    pairs = met.groupBy("row").agg(F.collect_list(F.struct(F.coalesce("id", F.lit(0)).alias("id"), "places")).alias("p"))
    return pairs.select("p").mapInArrow(rebuild, "ids binary")


def _passes(table: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Whether the bit of each 32-bit mark is set in a table of 2^m bits."""
    index = marks >> np.uint64(MARK_BITS - (8 * len(table)).bit_length() + 1)
    return (table[(index >> np.uint64(3)).astype(np.int64)] >> (index & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _phrases(ids: np.ndarray, length: int, bits: int, tables: list[np.ndarray]) -> list[np.ndarray]:
    """The permuted words of the phrases of this length that may be frequent.  tables: of the lengths from 2."""
    near = ids != 0
    starts = np.flatnonzero(near[:-1] & near[1:])  # pairs of frequent words
    for n in range(2, length + 1):
        words = permute([ids[starts + i] for i in range(n)], bits)
        if n == length:
            return words
        layout = Layout(n, bits)
        alive = starts[_passes(tables[n - 2], layout.top(layout.pack(words), MARK_BITS))]
        starts = alive[:-1][alive[1:] == alive[:-1] + 1]
    raise ValueError("phrases have two words at least")


def _range_of(marks: np.ndarray, ranges: int) -> np.ndarray:
    return (marks * np.uint64(ranges)) >> np.uint64(MARK_BITS)


def count_phrases(
    encoded: DataFrame, length: int, bits: int, tables: list[np.ndarray], least: int, ranges: int
) -> DataFrame:
    """ids (array), f and mark of the phrases of one length that stand `least` times or more."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(tables)
    layout = Layout(length, bits)

    def emit(limbs: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(counts):
            return
        place = _range_of(layout.top(limbs, MARK_BITS), ranges)
        cuts = np.flatnonzero(np.diff(place)) + 1
        edges = [0, *cuts.tolist(), len(place)]
        spans = list(zip(edges[:-1], edges[1:]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(place[a]) for a, _ in spans], pa.int64()),
                pa.array([dump(layout, [x[a:b] for x in limbs], counts[a:b]) for a, b in spans], pa.binary()),
            ],
            names=["range", "filter"],
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Collector(layout, TASK_KEYS)
        for batch in batches:
            texts = [x.as_py() + b"\0\0\0\0" for x in batch.column(0)]
            step = max(1, len(texts) * 1_000_000 // (1 + sum(map(len, texts))))  # about a quarter million words
            for at in range(0, len(texts), step):
                ids = np.frombuffer(b"".join(texts[at : at + step]), "<u4").astype(np.uint64)
                words = _phrases(ids, length, bits, shared.value)
                if held.add(layout.pack(words), np.ones(len(words[0]), np.int64)):
                    yield from emit(*held.take())
        yield from emit(*held.take())

    def rows(held: Collector | None) -> Iterator[pa.RecordBatch]:
        if held is None:
            return
        limbs, counts = held.take()
        many = counts >= least
        limbs = [x[many] for x in limbs]
        if many.any():
            ids = np.stack(invert(layout.unpack(limbs), bits), axis=1).astype(np.int64)
            offsets = np.arange(0, ids.size + 1, length, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.reshape(-1))),
                    pa.array(counts[many]),
                    pa.array(layout.top(limbs, MARK_BITS).astype(np.int64)),
                ],
                names=["ids", "f", "mark"],
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = None, None
        for batch in batches:
            for place, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if place != current:
                    yield from rows(held)
                    held, current = Collector(layout, TASK_KEYS), place
                held.add(*load(layout, data.as_py()))
        yield from rows(held)

    filters = encoded.mapInArrow(build, "range long, filter binary")
    dealt = filters.repartition(ranges, "range").sortWithinPartitions("range")
    return dealt.mapInArrow(merge, "ids array<long>, f long, mark long")


def bit_table(phrases: DataFrame, count: int) -> np.ndarray:
    """The marks of a length's frequent phrases as one table of bits, of bounded size."""
    bits = min(TABLE_BITS, max(15, (count * BITS_EACH).bit_length()))
    index = F.shiftright("mark", MARK_BITS - bits)
    parts = (
        phrases.groupBy(F.shiftright(index, 15).alias("part"))
        .agg(F.bitmap_construct_agg(index.bitwiseAND(F.lit(32767))).alias("bits"))
        .collect()
    )
    table = np.zeros((1 << bits) // 8, np.uint8)
    for row in parts:
        table[row.part * 4096 : (row.part + 1) * 4096] = np.frombuffer(row.bits, np.uint8)
    return table


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    wide = [x.cast("decimal(38,0)") for x in (a, n, left, right)]
    return F.call_function("div", (F.lit(1000).cast("decimal(4,0)") * wide[0] * wide[1]).cast("decimal(38,0)"),
                           (wide[2] * wide[3]).cast("decimal(38,0)"))


def mine(docs: DataFrame, least: int = 100, longest: int = 5, lang: str = "lang", text: str = "text") -> "Phrases":
    """Counts the phrases of 1 to `longest` words that stand `least` times or more in their language."""
    texts = _input(docs, lang, text)
    counts = staged(count_words(texts).filter(F.col("word").isNull() | (F.col("f") >= least)), "collocation-counts")
    totals = counts.filter("word is null").select("lang", F.col("f").alias("n"))
    frequent = counts.filter("word is not null")
    dictionary = staged(
        with_global_rank(frequent, [F.col("lang"), F.col("word")], "id").select("id", "lang", "word", "f"),
        "collocation-words",
    )
    words = dictionary.count()
    all_words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    levels = [dictionary.select(F.array("id").alias("ids"), "f")]
    if words:
        encoded = staged(encode(texts, dictionary, words), "collocation-ids")
        bits, tables = words.bit_length(), []
        ranges = max(LEAST_RANGES, -(-all_words // RANGE_KEYS))
        for length in range(2, longest + 1):
            found = staged(count_phrases(encoded, length, bits, tables, least, ranges), f"collocation-{length}")
            levels.append(found.select("ids", "f"))
            many = found.count()
            if not many:
                break
            tables.append(bit_table(found, many))
    return Phrases(levels, dictionary.select("id", "lang", "word"), totals)


class Phrases:
    """Frequent phrases: their counts, scores and texts."""

    def __init__(self, levels: list[DataFrame], words: DataFrame, totals: DataFrame):
        #: ids, f: one frame per length from 1; id, lang, word; lang, n.
        self.levels, self.words, self.totals = levels, words, totals

    def candidates(self) -> DataFrame:
        """ids, a, lang, n, score, l and r of the lowest cut of every phrase that no longer one takes up."""
        counted = reduce(DataFrame.unionByName, self.levels)
        longer = reduce(DataFrame.unionByName, self.levels[1:], self.levels[0].limit(0))
        parts = longer.filter(F.size("ids") > 2).select(
            F.explode(
                F.flatten(
                    F.transform(
                        F.sequence(F.lit(2), F.size("ids") - 1),
                        lambda size: F.transform(
                            F.sequence(F.lit(1), F.size("ids") - size + 1), lambda at: F.slice("ids", at, size)
                        ),
                    )
                )
            ).alias("ids"),
            "f",
        )
        within = parts.groupBy("ids").agg(F.max("f").alias("within"))
        alone = (
            longer.join(within, "ids", "left")
            .filter(F.col("within").isNull() | (F.col("within") < F.col("f")))
            .select("ids", F.col("f").alias("a"), F.element_at("ids", 1).alias("id"))
            .join(self.words.select("id", "lang"), "id")
            .join(self.totals, "lang")
            .drop("id")
        )
        cuts = alone.select("*", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")).select(
            "*",
            F.slice("ids", F.lit(1), F.col("k")).alias("first"),
            F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("rest"),
        )
        scored = (
            cuts.join(counted.select(F.col("ids").alias("first"), F.col("f").alias("l")), "first")
            .join(counted.select(F.col("ids").alias("rest"), F.col("f").alias("r")), "rest")
            .withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
        )
        lowest = F.min_by(F.struct("score", "k", "l", "r"), F.struct("score", "k"))
        best = scored.groupBy("ids", "lang", "a", "n").agg(lowest.alias("cut"))
        return best.select("ids", "lang", "a", "n", "cut.score", "cut.l", "cut.r")

    def top(self, most: int) -> DataFrame:
        """Each language's first phrases by score, count and text."""
        order = [F.desc("score"), F.desc("a")]
        found = self.candidates().withColumn("place", F.rank().over(W.partitionBy("lang").orderBy(*order)))
        # Rows that tie with the last place stay until their texts are known.
        found = found.filter(F.col("place") <= most).drop("place")
        texts = (
            found.select("ids", F.posexplode("ids").alias("at", "id"))
            .join(self.words.select("id", "word"), "id")
            .groupBy("ids")
            .agg(F.sort_array(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word")))).alias("words"))
            .select("ids", F.array_join(F.transform("words", lambda x: x["word"]), " ").alias("phrase"))
        )
        rank = F.row_number().over(W.partitionBy("lang").orderBy(*order, "phrase")).cast("long")
        return (
            found.join(texts, "ids")
            .withColumn("rank", rank)
            .filter(F.col("rank") <= most)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        )

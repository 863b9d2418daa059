"""License scans by an exact set-similarity join of text blocks with templates.

A block is a line.  A template is found in a block when the block holds at least THRESHOLD
percent of the template's distinct words.  Template words are ordered by how many documents of
the whole corpus hold them, rarest first.  A block that meets the threshold must hold one of the
first |T| - ceil(threshold * |T|) + 1 words of that order (prefix), at a place behind which enough
words of the template remain (position), and have that many words itself (length).  Blocks meet
templates in an equi-join on prefix words; candidates are verified on whole word sets.  The
template index is fixed text, so its size is known and it is broadcast.

Beside the templates, fixed phrases are looked for in the words of the whole text.

scan() works on lines, as the SQL of the registered query does, so it misses notices that are
wrapped over lines and takes scattered words of one long line for a notice.  scan_windows() has no
lines: a template is found where a run of consecutive words, so long that the template can be
THRESHOLD percent of it, holds at least THRESHOLD percent of its distinct words.

Defined results: a null text counts as empty and has no words; labels are empty strings where
nothing is found; the score is 1 where a phrase stands, else the largest containment of a found
template, else 0; repeated rows are answered each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import staged

THRESHOLD = 90

#: Phrases and their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: License notices and their labels.
TEMPLATES = (
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("Released under the MIT License.", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("Licensed under CC BY-SA 4.0.", "cc-by-sa"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("All rights reserved.", "reserved"),
)

#: Words of lower-cased text, of text in either case, and what stands between words in either case.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
ANY_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z lower-cased; other letters stay."""
    return F.translate(text, CAPITALS, SMALL)


def words_of(text: Column) -> Column:
    """Words of a text that has been lower-cased."""
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def spread(words: list[str]) -> str:
    """A pattern for words that stand consecutively, whatever is between them."""
    return f"(?:^|{GAP})" + f"{GAP}+".join(words) + f"(?:$|{GAP})"


def template_words(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall("[0-9a-z]+", text.lower())))


def needed(size: int) -> int:
    """Words of a template of this size that a block must hold."""
    return -(-THRESHOLD * size // 100)


def word_order(docs: DataFrame, templates: Sequence[tuple] = TEMPLATES) -> dict[str, int]:
    """Documents of the whole corpus that hold each template word (any case)."""
    vocabulary = sorted({word for text, *_ in templates for word in template_words(text)})
    wanted = F.array(*map(F.lit, vocabulary))
    held = F.array_intersect(F.regexp_extract_all(F.lower("text"), F.lit("([0-9a-z]+)"), F.lit(1)), wanted)
    rows = docs.select(F.explode(held).alias("word")).groupBy("word").count().collect()
    return {word: 0 for word in vocabulary} | {row["word"]: row["count"] for row in rows}


def template_index(docs: DataFrame) -> DataFrame:
    """One row per template and prefix word: word, place, template words, label."""
    order = word_order(docs)
    rows: list[tuple] = []
    for number, (text, label) in enumerate(TEMPLATES):
        words = sorted(template_words(text), key=lambda word: (order[word], word))
        prefix = len(words) - needed(len(words)) + 1
        rows += [(word, place, number, words, needed(len(words)), label) for place, word in enumerate(words[:prefix])]
    return docs.sparkSession.createDataFrame(
        rows, "word string, place int, template int, template_words array<string>, required int, label string"
    )


def find_templates(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """Join blocks (key columns, block) with the templates they hold: key, label, containment."""
    keys = [c for c in blocks.columns if c != "block"]
    held = F.array_distinct(words_of(lowered(F.col("block"))))
    tokens = blocks.select(*keys, held.alias("words")).select(*keys, "words", F.explode("words").alias("word"))
    size, total = F.size("words"), F.size("template_words")
    common = F.size(F.array_intersect("words", "template_words"))
    return (
        tokens.join(F.broadcast(index), "word")
        .filter((size >= F.col("required")) & (total - F.col("place") >= F.col("required")))
        .select(*keys, "label", "required", common.alias("common"), total.alias("total"))
        .filter("common >= required")
        .select(*keys, "label", (F.col("common") / F.col("total")).alias("containment"))
    )


def phrase_places(words: Column) -> Column:
    """(start, label) of every place of a phrase in a word array."""

    def stands(phrase: str) -> Column:
        parts = phrase.split()

        def here(at: Column) -> Column:
            return reduce(Column.__and__, (F.get(words, at + i) == part for i, part in enumerate(parts)))

        return here

    def places(phrase: str, label: str) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), stands(phrase))
        return F.transform(starts, lambda at: F.struct(at.cast("long").alias("start"), F.lit(label).alias("label")))

    return F.concat(*(places(*x) for x in PHRASES))


def scan(docs: DataFrame) -> DataFrame:
    """Return per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    index = template_index(docs)
    prefix = [row["word"] for row in index.select("word").distinct().collect()]
    text = F.coalesce(F.col("text"), F.lit(""))
    any_phrase = "(?i)" + "|".join(spread(phrase.split()) for phrase, _ in PHRASES)
    any_prefix = "(?i)" + spread(["(?:" + "|".join(sorted(prefix)) + ")"])
    bound = F.get(F.transform(F.array(words_of(lowered(text))), phrase_places), F.lit(0))
    none = F.array().cast("array<struct<start:bigint,label:string>>")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("content"),
        F.regexp_count(text, F.lit(ANY_WORD)).cast("long").alias("n_words"),
        F.when(text.rlike(any_phrase), bound).otherwise(none).alias("places"),
    )
    blocks = docs.filter(F.col("text").rlike(any_prefix)).select(
        F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_content"), F.explode(F.split(text, "\n")).alias("block")
    )
    blocks = blocks.filter(F.col("block").rlike(any_prefix))
    found = staged(
        find_templates(blocks, index)
        .groupBy("_id", "_content")
        .agg(F.collect_set("label").alias("found"), F.max("containment").alias("best")),
        "license-blocks",
    )
    base = F.sort_array(F.array_distinct(F.col("places.label")))
    every = F.sort_array(F.array_distinct(F.concat(base, F.coalesce("found", F.array().cast("array<string>")))))
    n_base = F.size("places").cast("long")
    return rows.join(
        found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content")), "left"
    ).select(
        "doc_id", "n_words", n_base.alias("n_base"),
        F.array_min(F.col("places.start")).alias("first_word"), F.array_max(F.col("places.start")).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


class Notices:
    """Templates (text, label, and a phrase that must stand in the run or "") by their words."""

    #: Words of a lower-cased text as in WORD, A-Z lower-cased.
    word = re.compile(WORD)
    lower = str.maketrans(CAPITALS, SMALL)

    def __init__(self, templates: Sequence[tuple], order: dict[str, int]):
        self.labels, self.totals, self.required, self.runs, self.keys = [], [], [], [], []
        self.prefix, self.holders = defaultdict(list), defaultdict(list)
        for number, (text, label, *key) in enumerate(templates):
            words = sorted(template_words(text), key=lambda word: (order[word], word))
            self.labels.append(label)
            self.totals.append(len(words))
            self.required.append(needed(len(words)))
            self.runs.append(100 * len(re.findall("[0-9a-z]+", text.lower())) // THRESHOLD)
            self.keys.append(f" {key[0]} " if key and key[0] else "")
            for word in words:
                self.holders[word].append(number)
            for word in words[: len(words) - self.required[-1] + 1]:
                self.prefix[word].append(number)

    def find(self, text: str) -> dict[str, float]:
        """Labels of the templates in a whole text, with the largest containment of each."""
        words = self.word.findall(text.translate(self.lower))
        candidates = {number for word in self.prefix.keys() & set(words) for number in self.prefix[word]}
        places = defaultdict(list)
        if candidates:
            for at, word in enumerate(words):
                for number in self.holders.get(word, ()):
                    if number in candidates:
                        places[number].append(at)
        found: dict[str, float] = {}
        for number, at in places.items():
            if best := self.most(number, words, at):
                found[self.labels[number]] = max(best / self.totals[number], found.get(self.labels[number], 0.0))
        return found

    def most(self, number: int, words: list[str], places: list[int]) -> int:
        """Distinct template words in the best run, 0 below the threshold; places are those of the words."""
        run, held, first, best = self.runs[number], Counter(), 0, 0
        for place in places:
            held[words[place]] += 1
            while places[first] <= place - run:
                left = words[places[first]]
                held[left] -= 1
                if not held[left]:
                    del held[left]
                first += 1
            if len(held) > best and len(held) >= self.required[number]:
                # Every run that holds these words and so the phrase, if they stand together.
                around = words[max(0, place - run + 1) : places[first] + run]
                if self.keys[number] in f" {' '.join(around)} ":
                    best = len(held)
        return best


def scan_windows(docs: DataFrame, templates: Sequence[tuple] = TEMPLATES) -> DataFrame:
    """Return per row: doc_id, labels, score of the templates in runs of words across line ends."""
    notices = Notices(templates, word_order(docs, templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [notices.find(text or "") for text in batch.column(1).to_pylist()]
            labels = pa.array([",".join(sorted(x)) for x in found], pa.string())
            scores = pa.array([max(x.values(), default=0.0) for x in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), labels, scores], names=["doc_id", "labels", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, labels string, score double")

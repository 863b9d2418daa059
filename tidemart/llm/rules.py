"""Quality rules as a ledger of failure bits.

Every rule is evaluated once for each document.  The ledger keeps the measurements and one bit
per failed rule.  A policy is a version with a mask of the rules that reject; applying one is a
bitwise and, so a new version needs no second pass over the texts.  Ablations count distinct
masks first and then work on those few rows: what each rule rejects, and what it alone rejects.

All of it is DataFrame functions.  Values that several expressions need are bound as lambda
variables, so each is computed once per document.

Measurements: words are runs outside white space; word_chars are their characters; n_symbols
counts the characters of SYMBOLS; n_dup_lines counts lines that hold a word and equal an earlier
line; n_repeat_words counts the words that lie in a three-word window found twice or more in the
text.

Defined results: a null or empty text has no words and fails too_few_words alone; repeated rows
are judged each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import SPACES

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rule by bit.  Whole-number comparisons, so that SQL gives the same.
RULES: tuple[tuple[str, Callable[[], Column]], ...] = (
    ("too_few_words", lambda: F.col("n_words") < 50),
    ("repeated_words", lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    ("many_symbols", lambda: 100 * F.col("n_symbols") > 40 * F.col("n_words")),
    ("repeated_lines", lambda: 100 * F.col("n_dup_lines") > 60 * F.col("n_lines")),
    ("short_words", lambda: (F.col("n_words") > 0) & (F.col("word_chars") < 2 * F.col("n_words"))),
    ("long_words", lambda: F.col("word_chars") > 15 * F.col("n_words")),
)
BITS = {name: 1 << at for at, (name, _) in enumerate(RULES)}

#: Versions of the policy: the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_words"),
    "2": tuple(BITS),
}
CURRENT = "2"

#: Repeated windows up to which each window is looked up in their list; beyond, windows are sorted.
LISTED = 32


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute a value once and use it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def covered(flags: Column, n: Column) -> Column:
    """Words under a flagged window; the window at place i covers words i, i + 1 and i + 2."""

    def under(at: Column) -> Column:
        here = (F.get(flags, at), F.get(flags, at - 1), F.get(flags, at - 2))
        return F.coalesce(here[0], F.lit(False)) | F.coalesce(here[1], F.lit(False)) | F.coalesce(here[2], F.lit(False))

    return F.size(F.filter(F.sequence(F.lit(0), n - 1), under))


def covered_sorted(windows: Column) -> Column:
    """The same from windows sorted by hash and place: no lookup per window."""

    def places(found: Column) -> Column:
        def again(x: Column, at: Column) -> Column:
            return F.coalesce(F.get(found, at - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
                F.get(found, at + 1)["h"] == x["h"], F.lit(False)
            )

        return F.sort_array(F.transform(F.filter(found, again), lambda x: x["at"]))

    def spans(found: Column) -> Column:
        def span(x: Column, at: Column) -> Column:
            return F.least(F.lit(3), F.coalesce(F.get(found, at + 1) - x, F.lit(3)))

        return F.aggregate(F.transform(found, span), F.lit(0), lambda total, x: total + x)

    pairs = F.array_sort(F.transform(windows, lambda x, at: F.struct(x.alias("h"), at.alias("at"))))
    return bind(bind(pairs, places), spans)


def repeat_words(words: Column) -> Column:
    """Words in three-word windows that the text holds twice or more."""

    def hashed(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda at: F.xxhash64(F.get(w, at), F.get(w, at + 1), F.get(w, at + 2)),
        )

    def repeated(found: Column) -> Column:
        return F.array_distinct(F.filter(found, lambda x, at: (at > 0) & (F.get(found, at - 1) == x)))

    def count(windows: Column) -> Column:
        n = F.size(windows) + 2
        return bind(
            bind(F.sort_array(windows), repeated),
            lambda twice: F.when(F.size(twice) == 0, 0)
            .when(
                F.size(twice) <= LISTED,
                bind(F.transform(windows, lambda x: F.array_contains(twice, x)), lambda flags: covered(flags, n)),
            )
            .otherwise(covered_sorted(windows)),
        )

    return bind(words, lambda w: F.when(F.size(w) < 3, 0).otherwise(bind(hashed(w), count)))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = text
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))
    words = F.array_remove(F.split(text, SPACES), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACES[1:]}"))
    measured = F.struct(
        bind(
            words,
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                repeat_words(w).cast("long").alias("n_repeat_words"),
            ),
        ).alias("w"),
        (F.length(text) - F.length(bare)).cast("long").alias("n_symbols"),
        bind(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("l"),
    )
    return (
        docs.select("doc_id", measured.alias("m"))
        .select("doc_id", "m.w.*", "m.n_symbols", "m.l.*")
        .select("doc_id", *MEASURES)
    )


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and failure bits, one row per document."""
    bits = F.lit(0).cast("long")
    for name, fails in RULES:
        bits = bits.bitwiseOR(F.when(fails(), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return measure(docs).withColumn("failed_bits", bits)


def mask(version: str) -> int:
    return sum(BITS[name] for name in POLICIES[version])


def passes(version: str) -> Column:
    """Whether a ledger row passes a version of the policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(version)).cast("long")) == 0


def ablation(book: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a version: documents that fail it, that it alone rejects, and all rejected."""
    wanted = F.lit(mask(version)).cast("long")
    masks = book.groupBy(F.col("failed_bits").bitwiseAND(wanted).alias("bits")).agg(F.count("*").alias("n"))
    rule = F.explode(F.array(*(F.struct(F.lit(x).alias("rule"), F.lit(BITS[x]).cast("long").alias("bit")) for x in POLICIES[version])))
    own = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        masks.select("bits", "n", rule.alias("r"))
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(own, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("rejected_by_it_alone"),
            F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0)).alias("rejected"),
        )
    )

"""Toxicity by a weighted finite-state pattern grammar over clauses.

Lexicon.  An acceptor of weighted stems and words reads every word and gives its class: insult
(with a weight), threat, target, negation, report, or none.  The insult stems and their weights
are learned from labelled documents: a word or word beginning that stands, neither negated nor
reported, in far more toxic than clean documents (a z value of LEAST_Z, so chance hits stay out) is
accepted, however often clean documents negate or quote it.  The closed classes are the fixed lists
below; words of address, negation and report are no insults.

Grammar.  A clause ends at . ! ? ; : or a line end.  Each clause runs through transducers, one
after the other: *negation* rewrites insults and threats within REACH words after a negation word,
*report* those after a verb of saying or inside quotation marks, *target* marks a clause with a
word of address, and *threat* joins a threat verb to a target within REACH words.  What comes out
is a weighted match per clause: a channel (plain, aimed, negated, reported, threat) and a weight.

Score.  A document's features are the log of one plus each channel's summed weights, the strongest
clause, and matches per word; a logistic layer learned on the same labels turns them into a score.
So how much a negation or a report excuses is learned and not set.

Defined results: a null text counts as empty; a text without matches, empty ones too, gets the
score of no match; without labels of both kinds every score is 0; repeated rows are answered each;
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import emptied, staged
from tidemart.llm.minhash import forget, mixed, shingles

#: The closed word classes, in English, German, French and Spanish.
NEGATIONS = (
    "not never no without neither nor cannot nicht nie kein keine ohne weder "
    "ne pas jamais sans ni nunca sin tampoco jamás"
).split()
REPORTS = (
    "said says say saying told tells wrote writes called calls quoted quotes reported claimed "
    "sagte sagt sagten schrieb nannte zitierte behauptete dit disait écrit écrivait appelait déclara "
    "dijo dice decía escribió llamó citó"
).split()
TARGETS = (
    "you your yours yourself u du dich dir dein deine ihr euch tu te toi ton ta vous votre "
    "tú ti vos usted ustedes vuestro"
).split()
THREATS = (
    "kill hurt destroy beat shoot stab burn punch töten umbringen schlagen vernichten tuer frapper "
    "détruire brûler matar golpear destruir quemar"
).split()

#: Labelled documents that are sampled from clean and toxic ones, in the mean; weights undo the ratio.
PER_LABEL = (10_000, 3_000)
STEM_LENGTHS = range(4, 9)
LEAST_Z = 6.5
LEAST_SUPPORT = 5
#: Sketches by which near copies are taken out of the sample, so that none votes many times.
SKETCHES = 3
REACH = 3
CHANNELS = ("plain", "aimed", "negated", "reported", "threat")

WORD = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(WORD.pattern + r"|[.!?;:\n\"“”„«»]")
QUOTES = frozenset('"“”„«»')
ENDS = frozenset(".!?;:\n")

INSULT, THREAT, TARGET, NEGATION, REPORT = range(1, 6)

#: Words whose class a worker remembers at once.
REMEMBERED = 300_000


#: Words of the classes that a lexicon leaves alone.
CLOSED = {word: kind for kind, words in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS)) for word in words}


def unexcused(text: str) -> set[str]:
    """Words of a lower-cased text that stand somewhere neither negated nor reported, as in transduce()."""
    found, negated, reported, quoted = set(), 0, False, False
    for token in TOKEN.findall(text):
        if token in ENDS:
            negated, reported, quoted = 0, False, False
            continue
        if token in QUOTES:
            quoted = not quoted
            continue
        kind = CLOSED.get(token)
        if kind == NEGATION:
            negated = REACH + 1
        elif kind == REPORT:
            reported = True
        elif kind is None and not (negated or reported or quoted):
            found.add(token)
        negated = max(0, negated - 1)
    return found


def features_of(word: str) -> Iterator[str]:
    """The word itself (closed by $) and its beginnings."""
    yield word + "$"
    for length in STEM_LENGTHS:
        if len(word) < length:
            break
        yield word[:length]


@dataclass
class Grammar:
    """Learned insult stems with weights, and the layer over the channels."""

    insults: dict[str, float]
    layer: np.ndarray
    bias: float
    scale: np.ndarray
    classes: dict[str, tuple[int, float]] = field(default_factory=dict, repr=False)

    def classify(self, word: str) -> tuple[int, float]:
        """Class and weight of a lower-cased word."""
        weight = max((self.insults.get(x, 0.0) for x in features_of(word)), default=0.0)
        if weight > 0:
            return INSULT, weight
        for kind, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
            if word in words:
                return kind, 1.0
        return 0, 0.0

    def remember(self, words: list[str]) -> None:
        if len(self.classes) > REMEMBERED:
            self.classes.clear()
        for word in set(words).difference(self.classes):
            self.classes[word] = self.classify(word)

    def clauses(self, text: str) -> Iterator[list[tuple[int, float]]]:
        """Classes of each clause's tokens; quotation marks stand as toggles of class -1."""
        clause: list[tuple[int, float]] = []
        for token in TOKEN.findall(text):
            if token in ENDS:
                if clause:
                    yield clause
                clause = []
            elif token in QUOTES:
                clause.append((-1, 0.0))
            else:
                clause.append(self.classes[token])
        if clause:
            yield clause

    def matches(self, text: str) -> tuple[np.ndarray, int, float]:
        """Weights by channel, clauses with a match, and the strongest clause."""
        totals, matched, strongest = np.zeros(len(CHANNELS)), 0, 0.0
        for clause in self.clauses(text):
            if not any(kind in (INSULT, THREAT) for kind, _ in clause):
                continue
            found = transduce(clause)
            total = sum(found)
            if total > 0:
                matched += 1
                strongest = max(strongest, total)
                totals += found
        return totals, matched, strongest

    def describe(self, text: str) -> np.ndarray | None:
        """Features of a whole text; None where nothing matches."""
        text = text.lower()
        words = WORD.findall(text)
        self.remember(words)
        kinds = {kind for kind, _ in set(map(self.classes.__getitem__, words))}
        if INSULT not in kinds and not {THREAT, TARGET} <= kinds:
            return None
        totals, matched, strongest = self.matches(text)
        if not matched:
            return None
        return np.array([*np.log1p(totals), strongest, matched, 100 * totals.sum() / len(words), 1.0])

    def score(self, described: list[np.ndarray | None]) -> np.ndarray:
        none = np.zeros(len(CHANNELS) + 4)
        x = np.stack([none if d is None else d for d in described]) / self.scale
        return 1 / (1 + np.exp(-(x @ self.layer + self.bias)))


def transduce(clause: list[tuple[int, float]]) -> list[float]:
    """Compose the transducers over one clause: summed weight per channel.

    States: words since a negation, words since a threat verb, whether a report or a quotation
    is open.  The target transducer reads the clause ahead, as address may follow the insult.
    """
    out = [0.0] * len(CHANNELS)
    aimed = any(kind == TARGET for kind, _ in clause)
    negated = threat = 0
    reported = quoted = False
    for kind, weight in clause:
        if kind == -1:
            quoted = not quoted
            continue
        if kind == NEGATION:
            negated = REACH + 1
        elif kind == REPORT:
            reported = True
        elif kind == INSULT:
            channel = 2 if negated else 3 if reported or quoted else 1 if aimed else 0
            out[channel] += weight
        elif kind == THREAT:
            if not (negated or reported or quoted):
                threat = REACH + 1
        elif kind == TARGET and threat:
            out[4] += 1.0
            threat = 0
        negated, threat = max(0, negated - 1), max(0, threat - 1)
    return out


def without_near_copies(rows: DataFrame) -> DataFrame:
    """Of (text, toxic) rows that share one of a few minima over their shingles, one each."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                hashes = shingles(text)
                least = [mixed(hashes ^ np.uint64(seed)).min() if len(hashes) else np.uint64(0) for seed in range(SKETCHES)]
                found.append(np.array(least).view("i8").tolist())
            yield batch.append_column("sketches", pa.array(found, pa.list_(pa.int64())))

    left = rows.mapInArrow(emptied(sketched, forget), "text string, toxic int, sketches array<long>")
    for at in range(SKETCHES):
        left = left.groupBy(F.get("sketches", F.lit(at))).agg(F.min(F.struct("text", "toxic", "sketches")).alias("row")).select("row.*")
    return left.select("text", "toxic")


def sample(
    docs: DataFrame, labels: DataFrame, learn: Column, per_label: tuple[int, int]
) -> tuple[DataFrame, dict[int, float]]:
    """(text, toxic) of labelled documents for which learn holds: texts that differ, both labels.

    With it, for each label, how many texts one of the sample stands for.
    """
    marked = labels.filter(F.col("toxic").isin(0, 1)).select(F.col("doc_id").alias("_id"), "toxic").distinct()
    marked = marked.groupBy("_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.filter(learn & F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("_digest"))
    # Shares are taken of the texts that differ, so copies take no place in the sample.
    different = staged(
        texts.select("doc_id", "_digest")
        .join(marked, F.col("doc_id") == F.col("_id"))
        .groupBy("_digest", "toxic")
        .agg(F.min("_id").alias("_id")),
        "toxic-texts",
    )
    sizes = {row["toxic"]: row["count"] for row in different.groupBy("toxic").count().collect()}
    if not sizes:
        return docs.select("text", F.lit(0).alias("toxic")).limit(0), {}
    shares = {k: min(1.0, per_label[k] / n) for k, n in sizes.items()}
    share = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))
    draw = F.pmod(F.col("_digest"), F.lit(1 << 20)) / (1 << 20)
    chosen = different.filter(draw < share[F.col("toxic")]).withColumnRenamed("_digest", "_chosen")
    found = texts.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("_digest") == F.col("_chosen")))
    rows = without_near_copies(found.select("text", F.col("toxic").cast("int").alias("toxic")))
    return rows, {k: 1 / x for k, x in shares.items()}


def learn_insults(
    rows: DataFrame, toxic: int, clean: int, weights: tuple[float, float] = (1.0, 1.0)
) -> dict[str, float]:
    """Stems and words by the log odds of the documents that hold them neither negated nor reported.

    weights: what a clean and a toxic document count in the z value.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = sorted({x for word in unexcused(text.lower()) for x in features_of(word)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array([label] * len(found), pa.int32())], names=["feature", "toxic"]
                )

    p = weights[1] * toxic / (weights[1] * toxic + weights[0] * clean)
    counted = rows.mapInArrow(listed, "feature string, toxic int").groupBy("feature")
    counted = counted.agg(F.sum("toxic").alias("hits"), F.count("*").alias("n"))
    hits = weights[1] * F.col("hits")
    n = hits + weights[0] * (F.col("n") - F.col("hits"))
    z = (hits - n * p) / F.sqrt(n * p * (1 - p))
    odds = F.log((F.col("hits") + 0.5) / (toxic + 1)) - F.log((F.col("n") - F.col("hits") + 0.5) / (clean + 1))
    best = (
        counted.filter((F.col("hits") >= LEAST_SUPPORT) & (z >= LEAST_Z))
        .select("feature", odds.alias("weight"), z.alias("z"))
        .orderBy(F.desc("z"), "feature")
    )
    # Each has LEAST_SUPPORT hits in the sample, which bounds them.
    return {row["feature"]: row["weight"] for row in best.collect()}


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_label: tuple[int, int] = PER_LABEL) -> Grammar | None:
    """Learn lexicon and layer from labelled documents for which learn holds."""
    rows, stands_for = sample(docs, labels, learn, per_label)
    rows = rows.cache()
    try:
        sizes = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
        if not (sizes.get(0) and sizes.get(1)):
            return None
        # The sample has its own shares of labels; weights give it those of all documents.
        mean = sum(sizes[k] * stands_for[k] for k in (0, 1)) / (sizes[0] + sizes[1])
        weights = (stands_for[0] / mean, stands_for[1] / mean)
        insults = learn_insults(rows, sizes[1], sizes[0], weights)
        size = len(CHANNELS) + 4
        untrained = Grammar(insults, np.zeros(size), 0.0, np.ones(size))

        def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [untrained.describe(text) for text in batch.column(0).to_pylist()]
                x = [None if d is None else d.tolist() for d in found]
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x, pa.list_(pa.float64()))], names=["toxic", "x"])

        got = rows.mapInArrow(described, "toxic int, x array<double>").collect()
    finally:
        rows.unpersist()
    x = np.array([row["x"] or [0.0] * size for row in got])
    y = np.array([row["toxic"] for row in got], float)
    order = np.lexsort([*x.T, y])
    return logistic(untrained, x[order], y[order], np.array(weights)[y[order].astype(int)])


def logistic(grammar: Grammar, x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60) -> Grammar:
    """Fit the layer by Newton steps on standardised features, with a small ridge.

    Weighted, the labels have their shares of all documents, so a text without any match scores as
    low as such texts do, whatever the size of the table.
    """
    mean = np.average(x, axis=0, weights=weight)
    grammar.scale = np.maximum(np.sqrt(np.average((x - mean) ** 2, axis=0, weights=weight)), 1e-3)
    x = np.column_stack([x / grammar.scale, np.ones(len(x))])
    w, ridge = np.zeros(x.shape[1]), 1e-2 * len(x) * np.append(np.full(x.shape[1] - 1, 0.1), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curve = (x.T * (weight * p * (1 - p) + 1e-9)) @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    grammar.layer, grammar.bias = w[:-1], float(w[-1])
    grammar.classes = {}
    return grammar


def scored(grammar: Grammar | None, texts: list[str | None]) -> np.ndarray:
    if grammar is None:
        return np.zeros(len(texts))
    return grammar.score([grammar.describe(text or "") for text in texts])


def score_documents(docs: DataFrame, grammar: Grammar | None) -> DataFrame:
    """Return per row: doc_id, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = scored(grammar, batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype("i4"))],
                    names=["doc_id", "score", "predicted"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, grammar: Grammar | None) -> DataFrame:
    """The documents that are not predicted toxic; all columns stay."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(scored(grammar, batch.column(at).to_pylist()) < 0.5))

    return docs.mapInArrow(run, docs.schema)


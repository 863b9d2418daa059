"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are the 3- and 4-byte windows of the UTF-8 text with A-Z lower-cased and other ASCII
characters that are no letters turned into spaces, so windows show where words begin and end.
Each is hashed into BUCKETS embeddings; a text is the mean of its embeddings, and one linear
layer with softmax scores the languages.  Embeddings and layer are trained together by stochastic
gradient descent in numpy on a bounded sample, about PER_LANGUAGE labelled texts of each language
(whole texts, which reach the driver as hashed counts).  A fifth of the sample is kept out of the
training: a temperature is fitted to it, which calibrates the scores, and then the score below
which a prediction is rejected: at most REJECT, and lower where sound texts would fall under it.

Defined results: null texts and texts without a letter are `und` with score 0 and are rejected;
without any labelled text all are `und`; the smaller language name wins a tie; every row is
answered once, repeated rows alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import has_letter

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
GRAMS = (3, 4)
DIMENSION = 16
#: Passes over the sample, and steps that a small sample gets at least.
EPOCHS, STEPS = 12, 1500
RATE = 2.0
BATCH = 16

#: Labelled texts that are sampled from each language, in the mean.
PER_LANGUAGE = 600
#: Labelled texts of all languages together, in the mean: bounds what reaches the driver.
SAMPLE = 60_000

#: Calibrated score below which a prediction is rejected, at most.
REJECT = 0.4
#: Share of correctly answered calibration texts that may be rejected.
LOST = 0.001

#: Bytes of texts that are hashed at once.
WINDOW = 1 << 20

_LETTERS = bytes(
    i | 0x20 if 0x41 <= i <= 0x5A else i if 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256)
)


def spaced(text: str) -> bytes:
    """The bytes that windows are taken from, between two spaces."""
    return b" " + text.encode().translate(_LETTERS) + b" "


def windows(data: bytes) -> list[np.ndarray]:
    """Buckets of all windows, by size of window; the n-th window starts at byte n."""
    x = np.frombuffer(data, np.uint8).astype(np.uint32)
    found, key = [], x
    for width in range(2, max(GRAMS) + 1):
        key = (key[:-1] << np.uint32(8)) | x[width - 1 :]
        if width in GRAMS:
            hashed = (key ^ (key >> np.uint32(15))) * np.uint32(2654435761 + 2 * width)
            found.append((hashed >> np.uint32(32 - BUCKET_BITS)).astype(np.intp))
    return found


def parts(data: bytes) -> Iterator[bytes]:
    """Overlapping parts whose windows are those of the whole."""
    overlap = max(GRAMS) - 1
    for at in range(0, max(1, len(data) - overlap), WINDOW):
        yield data[at : at + WINDOW + overlap]


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text and how often each occurs."""
    total = np.zeros(BUCKETS, np.int64)
    for part in parts(spaced(text)):
        for buckets in windows(part):
            total += np.bincount(buckets, minlength=BUCKETS)
    used = np.flatnonzero(total)
    return used, total[used]


@dataclass
class Model:
    """Scores of the buckets for each language (embedding times layer), and the calibration."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def logits(self, texts: list[str]) -> np.ndarray:
        """Mean score of each text's windows plus the bias, one row per text."""
        totals = np.zeros((len(texts), len(self.languages)))
        number = np.zeros(len(texts))
        owner, pending, size = [], [], 0
        for i, text in enumerate(texts):
            for part in parts(spaced(text)):
                owner.append(i)
                pending.append(part)
                size += len(part)
                if size >= WINDOW:
                    self._add(totals, number, owner, pending)
                    owner, pending, size = [], [], 0
        if pending:
            self._add(totals, number, owner, pending)
        return totals / np.maximum(number, 1)[:, None] + self.bias

    def _add(self, totals: np.ndarray, number: np.ndarray, owner: list[int], pending: list[bytes]) -> None:
        lengths = np.array([len(x) for x in pending])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        owner = np.array(owner)
        for width, buckets in zip(GRAMS, windows(b"".join(pending)), strict=True):
            # Windows that run into the next text are not counted for either.
            own = np.maximum(lengths - width + 1, 0)
            ends = starts + own
            cuts = np.stack([starts, ends], 1).ravel()
            some = own > 0
            np.add.at(number, owner, own)
            for language in range(len(self.languages)):
                values = np.append(self.table[language][buckets], np.float32(0))
                sums = np.add.reduceat(values, np.minimum(cuts, len(values) - 1), dtype=np.float64)[::2]
                np.add.at(totals[:, language], owner[some], sums[some])

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language and its calibrated probability."""
        p = softmax(self.logits(texts) / self.temperature)
        best = p.argmax(1)
        return best, p[np.arange(len(p)), best]


def lettered(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model | None:
    """rows: language, buckets and counts of a text each."""
    languages = sorted({row[0] for row in rows})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    kept_out, used = order[: len(rows) // 5], order[len(rows) // 5 :]
    place = {language: i for i, language in enumerate(languages)}
    label = np.array([place[row[0]] for row in rows])
    weight = [(row[1], (row[2] / row[2].sum()).astype("f4")) for row in rows]
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSION)).astype("f4")
    layer = rng.normal(0, 0.1, (DIMENSION, len(languages))).astype("f4")
    bias = np.zeros(len(languages), "f4")
    epochs = max(EPOCHS, -(-STEPS * BATCH // max(1, len(used))))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for at in range(0, len(used), BATCH):
            chosen = used[at : at + BATCH]
            means = np.stack([w @ embedding[b] for b, w in (weight[i] for i in chosen)])
            error = softmax(means @ layer + bias)
            error[np.arange(len(chosen)), label[chosen]] -= 1
            error /= len(chosen)
            back = error @ layer.T
            layer -= rate * means.T @ error
            bias -= 0.1 * rate * error.sum(0)
            for i, gradient in zip(chosen, back, strict=True):
                b, w = weight[i]
                embedding[b] -= np.minimum(20 * rate * w, 1)[:, None] * gradient
    model = Model(languages, np.ascontiguousarray((embedding @ layer).T), bias, 1.0, REJECT)
    if not len(kept_out):
        return model
    logits = np.stack([model.table[:, weight[i][0]] @ weight[i][1] + bias for i in kept_out])
    truth = label[kept_out]

    def loss(temperature: float) -> float:
        return -np.log(softmax(logits / temperature)[np.arange(len(truth)), truth] + 1e-9).mean()

    model.temperature = float(min(np.geomspace(0.25, 16, 49), key=loss))
    p = softmax(logits / model.temperature)
    right = p.max(1)[p.argmax(1) == truth]
    if len(right):
        model.reject_below = float(min(REJECT, np.quantile(right, LOST)))
    return model


def fit(docs: DataFrame, labelled: Column, per_language: int = PER_LANGUAGE) -> Model | None:
    """Train on a sample of the rows for which labelled holds and lang is given.

    A language's share is taken of the texts that differ, so copies take no place in the sample.
    The sample has at most about SAMPLE texts: where there are many languages, fewer of each.
    """
    rows = docs.filter(labelled & F.col("lang").isNotNull() & has_letter(F.col("text")))
    different = rows.select("lang", F.xxhash64("text").alias("digest")).distinct()
    found = different.groupBy("lang").count().collect()
    if not found:
        return None
    per_language = max(1, min(per_language, SAMPLE // len(found)))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / (1 << 20)
    share = F.create_map(*(F.lit(x) for row in found for x in (row["lang"], per_language / row["count"])))
    sample = rows.filter(draw < share[F.col("lang")]).select("lang", "text").distinct()

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [counts(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([b.astype("<i4").tobytes() for b, _ in pairs], pa.binary()),
                    pa.array([c.astype("<i4").tobytes() for _, c in pairs], pa.binary()),
                ],
                names=["lang", "buckets", "counts"],
            )

    got = sample.mapInArrow(featured, "lang string, buckets binary, counts binary").collect()
    got.sort(key=lambda row: (row["lang"], row["buckets"], row["counts"]))
    return train([(r["lang"], np.frombuffer(r["buckets"], "<i4"), np.frombuffer(r["counts"], "<i4")) for r in got])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Return per row: doc_id, lang_pred, score, rejected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            answered = np.array([model is not None and lettered(text) for text in texts], bool)
            names, scores = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            rejected = np.ones(batch.num_rows, bool)
            if answered.any():
                best, p = model.predict([text for text, yes in zip(texts, answered, strict=True) if yes])
                names[answered] = np.array(model.languages, object)[best]
                scores[answered] = p
                rejected[answered] = p < model.reject_below
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean"
    )


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents whose language is not rejected; all columns stay."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            kept = np.array([model is not None and lettered(text) for text in texts], bool)
            if kept.any():
                _, p = model.predict([text for text, yes in zip(texts, kept, strict=True) if yes])
                kept[kept] = p >= model.reject_below
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)

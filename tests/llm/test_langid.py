import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import table
from tidemart.llm import langid
from tidemart.llm.common import crc_bucket, documents


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return langid.fit(docs, crc_bucket("doc_id", 3) != 1)


def test_held_out_accuracy(spark, sf_dir, model):
    docs = documents(spark, sf_dir).filter((crc_bucket("doc_id", 3) == 1) & F.col("lang").isNotNull())
    found = langid.identify(docs, model).join(docs, "doc_id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97
    assert found.filter("rejected").count() <= 0.02 * found.count()


def test_documents(spark, model):
    rows = [(1, None), (2, ""), (3, "12 34 !"), (4, "the thing was here and there"), (4, "the thing was here and there"),
            (None, "le monde est dans la maison"), (5, "x"), (6, "the and of " * 400_000)]
    docs = table(spark, rows, extra=("lang_pred", "score", "letter", "_letter"))
    found = langid.identify(docs, model).collect()
    assert len(found) == len(rows)
    for row in found:
        none = row.doc_id in (1, 2, 3)
        assert (row.lang_pred == "und") == none and (row.score == 0) == none
        assert 0 <= row.score <= 1 and (row.rejected or not none)
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert not {1, 2, 3} & {row.doc_id for row in kept.collect()}
    assert langid.identify(docs.limit(0), model).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.fit(docs, F.lit(True)) is None


def test_prediction_takes_the_text_alone(spark, model):
    docs = table(spark, [(i, "the thing was here") for i in range(5)])
    docs = docs.withColumn("lang", F.lit("de")).withColumn("source", F.lit("x"))
    assert len({(r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}) == 1


def test_windows_of_parts_are_those_of_the_whole(model, monkeypatch):
    dice = random.Random(2)
    texts = ["".join(dice.choices("abc dé日 XY\n", k=n)) for n in (0, 1, 2, 3, 5, 40, 500, 3000)]
    whole = model.logits(texts)
    one_by_one = np.stack([model.logits([text])[0] for text in texts])
    assert np.allclose(whole, one_by_one)
    for text, row in zip(texts, whole, strict=True):
        used, n = langid.counts(text)
        assert np.allclose(model.table[:, used] @ n / max(1, n.sum()) + model.bias, row)


def test_no_ambiguity_in_ties():
    rows = [(x, np.array([1, 5]), np.array([1, 1])) for x in "ba"]
    model = langid.train(rows * 5)
    assert model.languages == ["a", "b"] and np.isfinite(model.table).all()
    assert langid.train([]) is None


def test_copies_and_many_languages_leave_no_language_out(spark):
    dice = random.Random(8)

    def text(letters):
        return " ".join("".join(dice.choices(letters, k=5)) for _ in range(8))

    rows = [("en", text("abcdefg")) for _ in range(100)] + [("xx", text("qrstuvw")) for _ in range(30)]
    rows += [("xx", rows[-1][1])] * 6000 + [(f"l{i:03}", text("hijklmn")) for i in range(210)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = langid.fit(docs, F.lit(True), per_language=50)
    assert set(model.languages) == {lang for lang, _ in rows}
    assert {r.lang_pred for r in langid.identify(docs.filter("lang = 'xx'"), model).collect()} == {"xx"}


def naive_scores(model, text):
    """Language scores window by window, in plain Python."""
    data = " " + "".join(c.lower() if "A" <= c <= "Z" else c if c >= "\x80" or "a" <= c <= "z" else " " for c in text) + " "
    data = data.encode()
    sums, n = [0.0] * len(model.languages), 0
    for width in langid.GRAMS:
        for at in range(len(data) - width + 1):
            key = int.from_bytes(data[at : at + width], "big")
            hashed = (key ^ key >> 15) * (2654435761 + 2 * width) % 2**32
            bucket = hashed >> (32 - langid.BUCKET_BITS)
            sums = [s + float(model.table[i][bucket]) for i, s in enumerate(sums)]
            n += 1
    logits = [(s / max(n, 1) + float(b)) / model.temperature for s, b in zip(sums, model.bias, strict=True)]
    weights = [np.exp(x - max(logits)) for x in logits]
    return [w / sum(weights) for w in weights]


def test_scores_against_brute_force(spark, sf_dir, model):
    docs = documents(spark, sf_dir).select("doc_id", "text").filter(F.col("text").rlike("\\p{L}") & (F.length("text") < 6000))
    texts = {row.doc_id: row.text for row in docs.orderBy(F.xxhash64("doc_id")).limit(60).collect()}
    texts |= {-1: "é", -2: "Straße 12, ÄÖ!", -3: "a" * 5000, -4: "\n\tThe  End\x00"}
    found = langid.identify(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()
    assert len(found) == len(texts)
    for row in found:
        p = naive_scores(model, texts[row.doc_id])
        assert row.score == pytest.approx(max(p), abs=1e-6)
        assert p[model.languages.index(row.lang_pred)] == pytest.approx(max(p), abs=1e-6)


def test_sample_is_bounded_over_all_languages(spark, monkeypatch):
    rows = [(i, f"word{i} of text number {i} in tongue {i % 20}", f"l{i % 20}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(langid, "train", lambda sample: seen.append(sample))
    monkeypatch.setattr(langid, "SAMPLE", 400)
    langid.fit(docs, F.lit(True))
    assert 200 < len(seen[0]) < 600 and len({language for language, _, _ in seen[0]}) == 20

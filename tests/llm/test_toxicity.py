import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import table
from tidemart.llm import toxicity
from tidemart.llm.common import crc_bucket


@pytest.fixture(scope="module")
def made():
    """Documents of random words; toxic ones hold a few of the insults, or words on a stem."""
    dice = random.Random(9)
    vocabulary = ["".join(dice.choices("abcdefghij", k=dice.randint(2, 8))) for _ in range(900)]
    insults = ["fluzzer", "grombit"]
    stems = ["zwick" + x for x in vocabulary[:200]]
    rows, labels = [], []
    for doc in range(1500):
        words = dice.choices(vocabulary, k=dice.randint(5, 60))
        toxic = doc % 6 == 0
        if toxic:
            for _ in range(dice.randint(1, 4)):
                words.insert(dice.randrange(len(words)), dice.choice(insults) if doc % 12 else dice.choice(stems))
        rows.append((doc, " ".join(words).capitalize() + "."))
        labels.append((doc, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def grammar(spark, made):
    rows, labels = made
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return toxicity.fit(table(spark, rows), labels, crc_bucket("doc_id", 5) != 0)


def test_held_out_accuracy(spark, made, grammar):
    rows, labels = made
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = toxicity.score_documents(table(spark, rows), grammar).join(marked, "doc_id")
    held_out = found.filter(crc_bucket("doc_id", 5) == 0)
    assert held_out.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("int"))).first()[0] >= 0.98


def test_learned_words_and_stems(grammar):
    for word in ("fluzzer", "grombit", "zwickabcdef", "zwickunseen"):
        assert grammar.classify(word)[0] == toxicity.INSULT
    assert grammar.classify("abc")[0] == 0


def test_transducers():
    insult, you, never, said, kill = ((toxicity.INSULT, 2.0), (toxicity.TARGET, 1.0), (toxicity.NEGATION, 1.0),
                                      (toxicity.REPORT, 1.0), (toxicity.THREAT, 1.0))
    none, quote = (0, 0.0), (-1, 0.0)

    def channel(*clause):
        out = toxicity.transduce(list(clause))
        return {name: weight for name, weight in zip(toxicity.CHANNELS, out, strict=True) if weight}

    assert channel(none, insult) == {"plain": 2.0}
    assert channel(insult, none, you) == {"aimed": 2.0}
    assert channel(never, none, insult, you) == {"negated": 2.0}
    assert channel(never, none, none, none, insult) == {"plain": 2.0}
    assert channel(said, none, insult) == {"reported": 2.0}
    assert channel(quote, insult, quote, insult) == {"reported": 2.0, "plain": 2.0}
    assert channel(kill, none, you) == {"threat": 1.0}
    assert channel(kill, none, none, none, you) == {}
    assert channel(never, kill, you) == {}
    assert channel() == {}


def test_clauses_end_at_marks(grammar):
    text = "not this. fluzzer here"
    grammar.remember(toxicity.WORD.findall(text))
    assert [len(x) for x in grammar.clauses(text)] == [2, 2]
    assert grammar.matches(text)[0][0] > 0  # the negation stands in another clause


def test_documents(spark, grammar):
    rows = [(1, None), (2, ""), (3, "..."), (4, "fluzzer"), (4, "fluzzer"), (None, "clean"), (5, "clean words " * 100_000)]
    docs = table(spark, rows, extra=("score", "predicted", "toxic"))
    found = toxicity.score_documents(docs, grammar).collect()
    assert len(found) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) == (r.doc_id == 4) for r in found)
    kept = toxicity.keep_clean(docs, grammar)
    assert kept.columns == docs.columns and 4 not in {r.doc_id for r in kept.collect()} and kept.count() == 5
    assert toxicity.score_documents(docs.limit(0), grammar).count() == 0
    assert {r.score for r in toxicity.score_documents(docs, None).collect()} == {0.0}
    labels = spark.createDataFrame([(1, 1, None), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, labels, F.lit(True)) is None
    assert np.isfinite(toxicity.scored(grammar, ["", None, "x"])).all()


def test_insults_that_clean_documents_quote_or_negate(spark):
    """Learned and told apart by the layer, though half as many clean documents hold them as toxic ones."""
    dice = random.Random(4)
    vocabulary = ["".join(dice.choices("abcdefghij", k=dice.randint(3, 8))) for _ in range(600)]
    rows, labels = [], []
    for doc in range(1200):
        words = dice.choices(vocabulary, k=dice.randint(10, 40))
        toxic = doc % 6 == 0
        if toxic:
            words.insert(dice.randrange(len(words)), "fluzzer")
        elif doc % 12 == 1:
            words += dice.choice([["; he", "is", "not", "a", "fluzzer"], ["; she", "said", "fluzzer", "once"], ['; "fluzzer"', "stood", "there"]])
        rows.append((doc, " ".join(words) + "."))
        labels.append((doc, 1, int(toxic)))
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    grammar = toxicity.fit(table(spark, rows), marked, crc_bucket("doc_id", 5) != 0)
    assert grammar.classify("fluzzer")[0] == toxicity.INSULT
    held_out = table(spark, rows).filter(crc_bucket("doc_id", 5) == 0)
    found = toxicity.score_documents(held_out, grammar).join(marked, "doc_id").collect()
    assert np.mean([r.toxic == r.predicted for r in found]) >= 0.98
    clear, excused = toxicity.scored(grammar, ["abc fluzzer here", "abc is not a fluzzer here"])
    assert clear > 0.5 > excused


def test_scores_mean_the_same_when_labels_are_sampled(spark):
    """A word of all toxic and a tenth of the clean documents is a weak match at a share of 5%."""
    dice = random.Random(5)
    vocabulary = ["".join(dice.choices("abcdefghij", k=dice.randint(3, 8))) for _ in range(600)]
    rows, labels = [], []
    for doc in range(4000):
        words = dice.choices(vocabulary, k=30)
        toxic = doc % 20 == 0
        if toxic or dice.random() < 0.1:
            words[dice.randrange(30)] = "grombit"
        rows.append((doc, " ".join(words) + "."))
        labels.append((doc, 1, int(toxic)))
    docs, marked = table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    text = " ".join([*vocabulary[:29], "grombit"]) + "."
    scores = []
    for per_label in ((10_000, 3_000), (300, 3_000)):
        grammar = toxicity.fit(docs, marked, F.lit(True), per_label)
        assert grammar.classify("grombit")[0] == toxicity.INSULT
        scores.append(toxicity.scored(grammar, [text, "abc def"]))
    assert (np.array(scores) < 0.5).all()
    assert abs(scores[0] - scores[1]).max() < 0.12


def test_copies_take_no_place_in_the_sample(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(80)]
    rows += [(1000 + i, "copied many times " * 5) for i in range(3000)]
    labels = spark.createDataFrame([(i, 1, int(i >= 40)) for i, _ in rows], "doc_id long, quality int, toxic int")
    found, stands_for = toxicity.sample(table(spark, rows), labels, F.lit(True), (20, 60))
    assert found.filter("toxic = 1").count() == 41
    assert stands_for == {0: 2.0, 1: 1.0}

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import table
from tidemart.llm import collocations
from tidemart.llm.counting_filter import Collector, Layout, combine, dump, invert, load, permute

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, least, longest, most):
    """rows: (lang, text)."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LETTERS)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    frequent = {g: f for g, f in counts.items() if f >= least}
    found = {}
    for (lang, *words), a in frequent.items():
        if len(words) < 2:
            continue
        if any(
            other[0] == lang and len(other) > len(words) + 1 and 100 * f >= 100 * a
            and any(list(other[i : i + len(words)]) == words for i in range(1, len(other)))
            for other, f in frequent.items()
        ):
            continue
        n = totals[lang]
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, *words[:k]], counts[lang, *words[k:]]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right, n))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n, -score)
        for lang, all_ in found.items()
        for rank, (score, a, phrase, left, right, n) in enumerate(sorted(all_)[:most], 1)
    )


def texts(seed):
    rng = random.Random(seed)
    words = ["The", "the", "cat", "sat", "on", "a", "mat", "é", "Éa", "ta\x0bb", "x\x00y", "ok."]
    for i in range(200):
        lang = rng.choice(["en", "de", None, "und"])
        parts = [rng.choice(words) for _ in range(rng.randrange(40))]
        if i % 3 == 0:
            parts[5:5] = ["new", "york", "city", "hall"]
        if i % 4 == 0:
            parts += ["york", "City"]
        yield lang, rng.choice([" ", "\t", "  "]).join(parts)


def frame(spark, rows):
    docs = table(spark, [(i, t) for i, (_, t) in enumerate(rows)], extra=("word", "ids", "f"))
    langs = spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id long, lang string")
    return docs.drop("lang").join(langs, "doc_id")


def result(phrases, most):
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in columns) for r in phrases.top(most).collect())


ROWS = [*texts(1), ("en", None), (None, ""), ("en", " ,.;\n"), ("en", "cat sat " * 3000), ("fr", "rare words only")]


@pytest.mark.parametrize("by_join", [False, True])
def test_against_brute_force(spark, monkeypatch, by_join):
    # Small limits: several filters a task, several ranges, several filters a range.
    monkeypatch.setattr(collocations, "TASK_KEYS", 50)
    monkeypatch.setattr(collocations, "TASK_WORDS", 5)
    if by_join:
        monkeypatch.setattr(collocations, "BROADCAST_WORDS", 0)
    docs = frame(spark, ROWS).repartition(3)
    expected = brute_force(ROWS, 12, 5, 10**6)
    assert {len(row[2].split(" ")) for row in expected} >= {2, 3, 4}
    found = collocations.mine(docs, least=12, longest=5)
    assert result(found, 10**6) == expected
    assert result(found, 7) == brute_force(ROWS, 12, 5, 7)


def test_nothing_frequent_and_nothing_at_all(spark):
    docs = frame(spark, ROWS)
    assert result(collocations.mine(docs, least=10**6), 10) == []
    assert result(collocations.mine(docs.limit(0)), 10) == []


@pytest.mark.parametrize("words,bits", [(2, 7), (2, 17), (3, 17), (4, 17), (5, 17), (5, 25), (5, 32), (2, 1)])
def test_filters_lose_nothing(words, bits):
    rng = np.random.default_rng(words * bits)
    layout = Layout(words, bits)
    keys = [rng.integers(0, 1 << bits, 3000, dtype=np.uint64) for _ in range(words)]
    for key in keys:
        key[1000:2000] = key[0]  # a hot key
    mixed = permute(keys, bits)
    assert all((x == y).all() for x, y in zip(invert(mixed, bits), keys))
    assert all((x == y).all() for x, y in zip(layout.unpack(layout.pack(mixed)), mixed))
    held, shards = Collector(layout, 100), []
    for at in range(0, 3000, 250):
        if held.add([x[at : at + 250] for x in layout.pack(mixed)], np.ones(250, np.int64)):
            shards.append(dump(layout, *held.take()))
    shards.append(dump(layout, *held.take()))
    parts = [load(layout, x) for x in shards]
    limbs, counts = combine(
        [np.concatenate([p[0][i] for p in parts]) for i in range(len(layout.widths))],
        np.concatenate([p[1] for p in parts]),
    )
    again = zip(*(x.tolist() for x in invert(layout.unpack(limbs), bits)))
    assert dict(zip(again, counts.tolist())) == Counter(zip(*(x.tolist() for x in keys)))


def test_filters_are_compact():
    """About two bits, the remainder's bytes and one byte of count an entry: less than the eight bytes of a key."""
    rng = np.random.default_rng(5)
    layout = Layout(2, 17)
    keys = permute([rng.integers(0, 1 << 17, 200_000, dtype=np.uint64) for _ in range(2)], 17)
    limbs, counts = combine(layout.pack(keys), np.ones(200_000, np.int64))
    assert len(dump(layout, limbs, counts)) < 4 * len(counts)


def test_empty_filter():
    layout = Layout(2, 9)
    limbs, counts = load(layout, dump(layout, [np.zeros(0, np.uint64)], np.zeros(0, np.int64)))
    assert len(limbs[0]) == len(counts) == 0

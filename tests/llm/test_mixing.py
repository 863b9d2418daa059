import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import table, written
from tidemart.llm import mixing
from tidemart.llm.mixing import GATES, START, STEPS, Code, Mixer, Texts
from tidemart.llm.queries import op12_lm_scoring

MASK = (1 << 64) - 1


def bucket(doc):
    return 0 if doc is None else zlib.crc32(str(doc).encode()) % 10


def lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()


def rows():
    rng = random.Random(11)
    common = ["the", "The", "cat", "sat", "on", "a", "mat", "é", "x\x1cy"]
    found = []
    for i in range(260):
        words = [rng.choice(common) for _ in range(rng.randrange(60))]
        words += ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(4))]
        found.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    return [*found, (300, None), (301, ""), (302, " \n"), (None, "the cat unseenword"), (3, found[3][1]), (303, "the " * 9000)]


ROWS = rows()


def expected_base():
    training = [lower(t) + [b"\n"] for i, t in ROWS if bucket(i) != 0]
    c = Counter(w for words in training for w in words)
    n, v = c.total(), len(c)
    for i, t in ROWS:
        words = lower(t) + [b"\n"]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        yield i, bucket(i) == 0, len(words), sum(c[w] > 0 for w in words), n, base


def key(row):
    return (row[0] is None, row[0] or 0, row[2], round(row[5], 6))


def naive_bits(model, words):
    """The bits of one text, step by step: plain Python, one coded bit after the other."""

    def slot(context, node):
        mixed = (context ^ (node * 0xC2B2AE3D27D4EB4F & MASK)) * 0x9E3779B97F4A7C15 & MASK
        return mixed >> (64 - mixing.SLOT_BITS)

    def path(code, symbol):
        steps = code.steps[code.start[symbol] : code.start[symbol] + code.length[symbol]]
        return [(int(s) >> 1, int(s) & 1) for s in steps]

    golden, words, total = 0x9E3779B97F4A7C15, [*words, b"\n"], 0.0
    weights = model.weights.astype(np.float32).copy()

    def learn(coded):
        nonlocal total
        step_of = []
        for code, node, bit, contexts, kind in coded:
            values = [int(t[slot(c, node)]) for t, c in zip(model.tables, contexts)]
            gate = kind * 16 + 4 * (values[0] & 3) + (values[1] & 3)
            s = [float(code.stretch[node]), *((v >> 2) / 960 for v in values), 0.3]
            step = min(max(int(float(weights[gate] @ np.array(s, np.float32)) * 64 + STEPS // 2), 0), STEPS - 1)
            step_of.append((gate, s, bit - float(mixing._SQUASH[step])))
            p = min(max(model.corrected[gate, step], 1 / 4096), 1 - 1 / 4096)
            total -= math.log2(p if bit else 1 - p)
        seen = Counter(g for g, _, _ in step_of)
        for gate in seen:
            gradient = sum(np.array(s) * e for g, s, e in step_of if g == gate)
            weights[gate] += mixing.TEXT_RATE / max(seen[gate], 16) * gradient

    def value(i):
        if i < 0:
            return 1 << 40
        return model.ids.get(words[i]) or zlib.crc32(words[i]) + (1 << 32)

    for low in range(0, len(words), mixing.BLOCK):
        coded, letters = [], []
        for i in range(low, min(low + mixing.BLOCK, len(words))):
            symbol = model.ids.get(words[i], 0)
            one = (value(i - 1) + 1) * golden & MASK
            two = (one ^ (value(i - 2) + 7)) * golden & MASK
            coded += [(model.words, n, b, (one, two), 0) for n, b in path(model.words, symbol)]
            if symbol == 0:
                spelled = words[i] + b"\n"
                for at in range(len(spelled)):
                    near = [spelled[at - k] if at >= k else 10 for k in (1, 2, 3)]
                    a = (near[0] | near[1] << 8 | 1 << 50) * golden & MASK
                    b3 = (near[0] | near[1] << 8 | near[2] << 16 | 1 << 51) * golden & MASK
                    letters += [(model.letters, n, b, (a, b3), 1) for n, b in path(model.letters, spelled[at])]
        learn(coded)
        learn(letters)
    return total


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    docs = table(spark, ROWS, extra=("word", "score", "training"))
    return op12_lm_scoring(spark, written(tmp_path_factory.mktemp("docs"), docs.repartition(3))).collect()


def test_counts_and_base(scored):
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    found = sorted((tuple(r[c] for c in columns) for r in scored), key=key)
    for ours, theirs in zip(found, sorted(expected_base(), key=key), strict=True):
        assert ours[:5] == theirs[:5]
        assert ours[5] == pytest.approx(theirs[5], rel=1e-9)


def test_scores_are_log_probabilities(scored):
    for r in scored:
        assert r.score < 0 and r.score == pytest.approx(-r.total_bits * math.log10(2))
    held = [r for r in scored if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_against_bit_by_bit(spark, monkeypatch):
    """The whole model is fitted by Spark; texts are then coded one bit after the other."""
    docs = table(spark, ROWS[:260])
    bucket_ = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    model, counts = mixing.fit(docs, bucket_ != 0, bucket_ == 9)
    some = [r for r in ROWS if r[0] in (0, 1, 2, 17, 300, 301)] + [(400, "new wörds " * 50), (401, "the cat sat " * 40)]
    found = {r.doc_id: r.total_bits for r in mixing.score(table(spark, some), model, counts).collect()}
    for doc, text in some:
        assert found[doc] == pytest.approx(naive_bits(model, lower(text)), rel=2e-3)
    # Spans and groups bound memory; they change nothing.
    texts = [lower(t) for _, t in some]

    def bits(group):
        mixer, total = Mixer(model, len(group), mixing.TEXT_RATE), np.zeros(len(group))
        for at, gate, step, bit in mixer.run(Texts(model, group), own=True):
            total += np.bincount(at, mixer.cost[2 * (gate * STEPS + step) + bit], len(group))
        return total

    together = bits(texts)
    monkeypatch.setattr(mixing, "SPAN", 100)
    assert np.allclose(bits(texts), together, rtol=1e-5)
    assert np.allclose([bits([t])[0] for t in texts], together, rtol=1e-5)


def test_tables_hold_the_counts(spark):
    docs = table(spark, ROWS[:100]).repartition(4)
    model = mixing.vocabulary([(b"the", 50), (b"cat", 20)], 100, 500, 40)
    ones, all_ = np.zeros(2 << mixing.SLOT_BITS, int), np.zeros(2 << mixing.SLOT_BITS, int)
    texts = Texts(model, [lower(t) for _, t in ROWS[:100]])
    for low, high in texts.spans():
        for events in (texts.word_events(model, low, high), texts.letter_events(model, low, high)[0]):
            for i, slots in enumerate(events.slots):
                np.add.at(all_, (i << mixing.SLOT_BITS) + slots, 1)
                np.add.at(ones, (i << mixing.SLOT_BITS) + slots, events.bit)
    wanted = mixing.predictions(ones, all_).reshape(-1, mixing.CHUNK)
    found = mixing.count_contexts(docs, model).collect()
    assert len(found) == len({r.part for r in found})
    for r in found:
        assert (np.frombuffer(r.slots, np.int16) == wanted[r.part]).all()
    missing = set(range(len(wanted))) - {r.part for r in found}
    assert all(not all_.reshape(-1, mixing.CHUNK)[p].any() for p in missing)


def test_codes_are_prefix_free_and_short():
    counts = [1, 1, 2, 3, 5, 8, 13, 1000]
    code = Code(counts)
    paths = [tuple(code.steps[s : s + n] & 1) for s, n in zip(code.start, code.length)]
    assert sum(2.0 ** -len(p) for p in paths) == 1
    assert len(paths[-1]) == 1 and len(set(paths)) == len(paths)


def test_nothing_to_learn_from(spark):
    docs = table(spark, [(None, "some text here"), (None, None)])
    model, counts = mixing.fit(docs, F.lit(False), F.lit(False))
    assert model.tokens == 0 and np.allclose(model.weights, START) and len(model.weights) == GATES
    found = mixing.score(docs, model, counts).collect()
    assert sorted((r.n_tokens, r.n_known) for r in found) == [(1, 0), (4, 0)] and all(r.total_bits > 0 for r in found)
    assert mixing.score(docs.limit(0), model, counts).count() == 0

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tests.llm.helpers import table, written
from tidemart.llm.periodic_runs import Condition, collapse, find_runs, runs_of, strongest
from tidemart.llm.queries import op13_periodic_runs


def every_run(words, shortest=6, times=4):
    """All runs by trying every period and every stretch."""
    found, n = {}, len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, times * q):
                found.setdefault((i, j - i + q), q)  # the smallest period of the stretch comes first
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def text_of(rng):
    """Random words of a small alphabet with repeated blocks of any size planted in them."""
    words = []
    for _ in range(rng.randrange(6)):
        block = [rng.choice("abc") for _ in range(rng.randrange(1, 7))]
        words += block * rng.randrange(1, 9) + block[: rng.randrange(len(block) + 1)]
        words += [rng.choice("abcdefgh") for _ in range(rng.randrange(5))]
    return [w.encode() for w in words]


def test_against_every_period_and_stretch():
    rng = random.Random(7)
    for shortest, times in ((6, 4), (1, 2), (10, 2), (4, 3)):
        texts = [text_of(rng) for _ in range(400)]
        texts += [[b"a"] * n for n in range(12)] + [[b"a", b"b"] * n for n in range(9)] + [[]]
        found = runs_of(texts, Condition(shortest, times))
        for words, runs in zip(texts, found):
            assert runs == every_run(words, shortest, times), words
            assert collapse(words, runs) == kept(words, runs)


def test_texts_of_a_block_do_not_meet():
    words = [b"x", b"y"] * 10
    assert runs_of([words[:5], words[5:9], words], Condition()) == [[], [], [(0, 20, 2)]]


def test_long_runs_are_linear():
    one, two = [b"a"] * 60_000, [b"p", b"q", b"r"] * 20_000
    found = runs_of([one, two], Condition())
    assert found == [[(0, 60_000, 1)], [(0, 60_000, 3)]]


def test_rows(spark):
    many = " ".join(["x y"] * 6)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, many), (4, many), (None, many), (5, "é " * 7), (6, "word " * 30_000)]
    docs = table(spark, rows, extra=("runs", "collapsed", "n_words"))
    found = find_runs(docs).withColumn("top", strongest(F.col("runs"))).collect()
    result = sorted((r.doc_id or 0, r.n_words, len(r.runs), tuple(r.top or ()), bytes(r.collapsed).decode()) for r in found)
    assert result == [
        (0, 12, 1, (0, 12, 2), "x y"), (1, 0, 0, (), ""), (2, 0, 0, (), ""), (3, 0, 0, (), ""),
        (4, 12, 1, (0, 12, 2), "x y"), (4, 12, 1, (0, 12, 2), "x y"), (5, 7, 1, (0, 7, 1), "é"),
        (6, 30_000, 1, (0, 30_000, 1), "word"),
    ]
    assert find_runs(docs.limit(0)).count() == 0


def planted(doc, words):
    h = zlib.crc32(str(doc).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def row(doc, text):
    words = planted(doc, (text or "").encode().split())
    runs = every_run(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc, len(runs), *best, best[1] and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept(words, runs)).hexdigest(),
    )


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(x.decode() for x in text_of(rng))) for i in range(300)]
    rows += [(i, " ".join(rng.choice("lorem ipsum dolor sit amet".split()) for _ in range(150))) for i in range(300, 400)]
    rows += [(400, None), (401, ""), (402, "one"), (7, "a " * 50)]
    found = op13_periodic_runs(spark, written(tmp_path, table(spark, rows, extra=("runs",)))).collect()
    columns = (
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    )
    assert sorted((tuple(r[c] for c in columns) for r in found), key=str) == sorted((row(*r) for r in rows), key=str)

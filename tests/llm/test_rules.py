import re

from tests.llm.helpers import table
from tidemart.llm.rules import BITS, CURRENT, POLICIES, ablation, ledger, mask, passes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = [
    (1, None), (2, ""), (3, " \n "), (4, "a b c"), (5, "a a a a"), (6, "x y z x y z x y"), (7, "l\nl\n\nl\r\n l"),
    (8, "## **$ %&|<>"), (9, "é 日本\x85語  x\x0by"), (None, "no id"), (10, "twice"), (10, "twice"),
    (11, " ".join(f"w{i % 700}" for i in range(5000))), (12, " ".join(f"w{i}" for i in range(3000))),
    (13, "tick tock " * 400), (14, " ".join(f"w{i % 60}" for i in range(200))), (15, "clean words stand here " + " ".join(f"q{i}" for i in range(90))),
]


def measured(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for x in windows:
        seen[x] = seen.get(x, 0) + 1
    under = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(x in "#*$%&|<>" for x in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(under),
    }


def failed(m):
    return (
        BITS["too_few_words"] * (m["n_words"] < 50)
        | BITS["repeated_words"] * (100 * m["n_repeat_words"] > 50 * m["n_words"])
        | BITS["many_symbols"] * (100 * m["n_symbols"] > 40 * m["n_words"])
        | BITS["repeated_lines"] * (100 * m["n_dup_lines"] > 60 * m["n_lines"])
        | BITS["short_words"] * (m["n_words"] > 0 and m["word_chars"] < 2 * m["n_words"])
        | BITS["long_words"] * (m["word_chars"] > 15 * m["n_words"])
    )


def test_measurements_and_bits(spark):
    docs = table(spark, ROWS, extra=("n_words", "failed_bits", "w"))
    found = ledger(docs).collect()
    wanted = [{"doc_id": doc, **measured(text), "failed_bits": failed(measured(text))} for doc, text in ROWS]
    assert sorted(str(sorted(r.asDict().items())) for r in found) == sorted(str(sorted(x.items())) for x in wanted)
    assert ledger(docs.limit(0)).count() == 0


def test_policies_and_ablation(spark):
    book = ledger(table(spark, ROWS))
    bits = [row.failed_bits for row in book.collect()]
    for version in POLICIES:
        kept = book.filter(passes(version)).count()
        assert kept == sum(not b & mask(version) for b in bits)
    found = {row.rule: row for row in ablation(book, CURRENT).collect()}
    for rule, bit in BITS.items():
        assert found[rule].failed == sum(bool(b & bit) for b in bits)
        assert found[rule].rejected_by_it_alone == sum(b == bit for b in bits)
        assert found[rule].rejected == sum(b > 0 for b in bits)


def test_no_python_in_the_plan(spark):
    plan = ledger(table(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan

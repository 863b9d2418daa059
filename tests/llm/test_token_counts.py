import random

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from tests.llm.helpers import table
from tidemart.llm.token_counts import MARK, Counter, count_tokens, vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    pieces = [("<unk>", 0.0), *((f"<0x{i:02X}>", -2e9) for i in range(256)), *vocabulary(PATH)]
    return Tokenizer(models.Unigram(pieces, 0, byte_fallback=True))


def wanted(library, text):
    return len(library.encode(MARK + text.replace(" ", MARK)).ids) if text else 0


def test_same_as_the_library(library, sf_dir):
    counter, dice = Counter(vocabulary(PATH)), random.Random(5)
    letters = "ab thes  inon\n\té日🙂ingre.▁"
    texts = ["".join(dice.choices(letters.replace("▁", ""), k=dice.randint(0, 60))) for _ in range(1500)]
    texts += ["", " ", "  ", "   a", "a   ", "\n", "a\n b", " \n ", " " * 70, "x" * 200]
    texts += [x[0] or "" for x in duckdb.sql(f"select text from '{sf_dir}/documents.parquet'").fetchall()]
    for text in texts:
        assert counter.count(text) == wanted(library, text), repr(text[:80])


def test_ties_go_to_the_earliest_start():
    pieces = [("a", -1.0), ("b", -1.0), ("c", -1.0), ("ab", -2.0), ("bc", -2.0), ("abc", -3.0), (MARK, -1.0)]
    counter = Counter(pieces)
    assert counter.best("abc") == (-3.0, 1)
    assert counter.best("ab") == (-2.0, 1)
    assert counter.best("az") == (-1.0 - 3.0 - 10.0, 2)


def test_pieces_across_words_are_refused():
    with pytest.raises(ValueError):
        Counter([(f"a{MARK}b", -1.0)])


def test_documents(spark, library):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "twice"), (3, "twice"), (4, "two  marks " * 120_000)]
    docs = table(spark, rows, extra=("n_tokens",))
    found = sorted(str(tuple(x)) for x in count_tokens(docs, PATH).collect())
    short = [str((doc, wanted(library, text or ""))) for doc, text in rows[:-1]]
    long = 120_000 * (wanted(library, "two  marks ") - 1) + 1
    assert found == sorted([*short, str((4, long))])
    assert count_tokens(docs.limit(0), PATH).count() == 0

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import table
from tidemart.llm.packing import OpenBins, WordTokenizer, best_fit_decreasing, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", "Hello, World!!", "it's ONE two\tthree\x1cfour", "İstanbul ΑΣ ας ǅ ﬁ x² ½ 3¼", "é a ́b", "日本 語",
    "<|endoftext|> a<|startoftext|>", "A <|ENDOFTEXT|> b<|endoftext|>c", "dot.com... end.,;", "a b c​d", "🙂 👍🏽", "don't we're'll",
    "café CAFÉ Öl_x __", "  two  spaces \n\n lines ", "ªº µ ß ẞ ŉ", "x" * 500,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return np.asarray([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def test_words_as_the_library(library, sf_dir):
    import duckdb

    texts = TEXTS + [x[0] or "" for x in duckdb.sql(f"select text from '{sf_dir}/documents.parquet'").fetchall()]
    words = WordTokenizer(PATH)
    words.PORTION, words.REMEMBERED = 5000, 500
    for at in range(0, len(texts), 40):
        for text, ids in zip(texts[at : at + 40], words.encode(texts[at : at + 40]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(library, text)[:-1].tolist(), text[:80]


def check(rows, found, library, capacity):
    """Pieces cover every document, and sequences are gapless and within the capacity."""
    rest, sequences = {}, {}
    for doc, text in rows:
        ids = ids_of(library, text)
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            key = (doc, n, at, len(part), zlib.crc32(part.tobytes()))
            rest[key] = rest.get(key, 0) + 1
    for row in found:
        key = (row.doc_id, row.piece, row.start, row.length, row.ids_crc32)
        rest[key] -= 1
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    assert not any(rest.values())
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_documents(spark, library):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "twice"), (3, "twice"), (4, "word " * 3000)]
    rows += [(10 + i, "some words here " * (i % 37)) for i in range(300)]
    docs = table(spark, rows, extra=("length", "sequence_id", "offset"))
    for group in (50, 100_000):
        found = pack_documents(docs, PATH, capacity=64, group=group).collect()
        check(rows, found, library, 64)
    assert pack_documents(docs.limit(0), PATH).count() == 0
    with_ids = pack_documents(docs, PATH, with_ids=True).collect()
    assert all(len(row.ids) == 4 * row.length and zlib.crc32(row.ids) == row.ids_crc32 for row in with_ids)


def test_tightest_bin_against_a_search():
    rng = np.random.default_rng(3)
    for capacity in (1, 2, 7, 64, 100):
        lengths = np.sort(rng.integers(1, capacity + 1, 400))[::-1]
        bins, offsets = best_fit_decreasing(lengths, capacity)
        rooms = []
        for length, number, offset in zip(lengths, bins, offsets, strict=True):
            fitting = [room for room in rooms if room >= length]
            room = min(fitting, default=capacity)
            if not fitting:
                rooms.append(capacity)
            assert capacity - offset == room == rooms[number]
            rooms[number] -= length
    assert OpenBins(5).tightest(3) is None

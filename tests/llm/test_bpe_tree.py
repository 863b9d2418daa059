import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from tests.llm.helpers import table
from tidemart.llm.bpe_tree import TreeCodec, decode_documents, encode_documents

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
HARD = [
    "", " ", "\n", "  \n  a", "a" * 300, "'re" * 40, "it's we're I'll they'd" * 9, "x'" * 50, "1 2 33 ''' s'" * 12,
    "日本語の文章" * 40, "שלום עולם " * 20, "é" * 60, "🙂👍🏽" * 40, "   　x" * 20, "a  b   c    d" * 20,
    "\x00\x1c\x1d\x85​" * 20, "don't'stop'll'" * 12, "٣٤ ½ ² x²" * 20, "\t\r\n \t" * 40 + "'s",
]


@pytest.mark.parametrize(("leaf", "window"), [(1, 1), (2, 1), (3, 2), (7, 4), (64, 8), (2048, 32)])
def test_same_as_library(leaf, window):
    codec = TreeCodec(PATH, public_tokenizers.PATTERN, leaf, window)
    dice = random.Random(leaf)
    letters = "ab'sret lldvm  \n\t12.,!é語🙂́ "
    texts = HARD + ["".join(dice.choices(letters, k=dice.randint(0, 90))) for _ in range(400)]
    for text in texts:
        ids = codec.encode(text)
        assert ids == codec.library.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_documents(spark):
    rows = [(1, None), (2, ""), (3, "one word"), (3, "one word"), (None, "no id"), (4, "long text, " * 3000)]
    docs = table(spark, rows, extra=("n_tokens", "ids", "decoded"))
    encoded = encode_documents(docs, PATH, public_tokenizers.PATTERN)
    found = decode_documents(encoded, PATH, public_tokenizers.PATTERN).collect()
    library = TreeCodec(PATH, public_tokenizers.PATTERN).library

    def wanted(doc, text):
        ids = np.asarray(library.encode_ordinary(text or ""), "<u4").tobytes()
        return doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), (text or "").encode()

    assert sorted(map(str, (tuple(x) for x in found))) == sorted(
        str((a, b, c, d)) for a, b, c, d in (wanted(*row) for row in rows)
    )
    assert decode_documents(encode_documents(docs.limit(0), PATH, "x"), PATH, "x").count() == 0

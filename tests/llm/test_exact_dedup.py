import hashlib

from pyspark.sql import functions as F

from tests.llm.helpers import table
from tidemart.llm.exact_dedup import find_copies, keep_one_each
from tidemart.session import fresh_dir

ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "A"), (7, "a "), (3, "a"), (None, "b"), (8, "long " * 20000)]


def groups(rows):
    texts = {}
    for doc, text in rows:
        texts.setdefault(text or "", []).append(doc)
    return texts


def expected(rows):
    found = []
    for text, ids in groups(rows).items():
        keep = max(ids, key=lambda x: (x is not None, x or 0))
        for n, doc in enumerate(sorted(ids, key=lambda x: (x != keep, str(x)))):
            found.append((doc, keep, len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(str, found))


def result(df):
    columns = ("doc_id", "keep_id", "group_size", "kept", "digest")
    return sorted(str(tuple(row[c] for c in columns)) for row in df.collect())


def test_groups(spark):
    docs = table(spark, ROWS, extra=("digest", "kept", "group_size", "seq"))
    assert result(find_copies(docs)) == expected(ROWS)
    # Small micro-batches: the state carries on from one to the next.
    assert result(find_copies(docs.repartition(6), files_per_trigger=2)) == expected(ROWS)
    assert find_copies(docs.limit(0)).count() == 0


def test_clashing_digests_are_told_apart_by_their_texts(spark):
    docs = table(spark, ROWS)
    found = find_copies(docs, digest=lambda text: F.length(text).cast("string"))
    kept = {text: row.keep_id for row in found.collect() for text in [row.digest]}
    assert set(kept) == {str(len(text)) for text in groups(ROWS)}
    sizes = sorted(row.group_size for row in found.collect())
    assert sizes == sorted(len(ids) for ids in groups(ROWS).values() for _ in ids)


def test_kept_documents(spark):
    docs = table(spark, ROWS, extra=("digest", "kept", "seq"))
    found = keep_one_each(docs)
    assert found.columns == docs.columns
    assert sorted(str((row.doc_id, row.text or "")) for row in found.collect()) == sorted(
        str((max(ids, key=lambda x: (x is not None, x or 0)), text)) for text, ids in groups(ROWS).items()
    )


def test_copies_across_deliveries(spark):
    """A second delivery meets the first one's state, a repeated call adds nothing, and no digest decides alone."""
    parts = [ROWS[:5], [], ROWS[5:], [(None, None), (99, "a")]]
    for digest in ({}, {"digest": lambda text: F.length(text).cast("string")}):
        state, seen = fresh_dir(spark, "t-deliveries"), []
        for number, part in enumerate(parts):
            seen += part
            docs = table(spark, part or ROWS).limit(len(part))
            for _ in range(2):
                found = find_copies(docs, state=state, delivery=number, **digest).collect()
                texts = groups(seen)
                keep = {text: max(ids, key=lambda x: (x is not None, x or 0)) for text, ids in texts.items()}
                wanted = sorted((str(doc), str(keep[text or ""]), len(texts[text or ""])) for doc, text in part)
                assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in found) == wanted
        # Over all deliveries one row of each text stays, as it stands after the last.
        kept = []
        for number, part in enumerate(parts):
            docs = table(spark, part or ROWS).limit(len(part))
            kept += [r.keep_id for r in find_copies(docs, state=state, delivery=number, **digest).collect() if r.kept]
        assert sorted(map(str, kept)) == sorted(str(x) for x in keep.values())

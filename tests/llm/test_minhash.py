import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import table
from tidemart.llm import minhash
from tidemart.llm.minhash import Signer, components, keep_one_each, near_duplicates, shingles


def shingle_set(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_force(rows, percent):
    """(doc_id, n_shingles, component_id, kept) with every pair of sets compared."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, mine in enumerate(sets):
        common = Counter(j for x in mine for j in holders[x])
        for x in mine:
            holders[x].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(mine) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    found = []
    for i, (doc, _) in enumerate(rows):
        component = least.get(find(i)) if sets[i] else doc
        found.append((doc, len(sets[i]), component, doc == component))
    return sorted(map(str, found))


def result(df):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    dice = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]

    def text(n):
        return dice.choices(vocabulary, k=n)

    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One  TWO"), (6, "a b c d e"), (7, "a b c d E"), (7, "a b c d E")]
    rows += [(None, "x y z u v w q r s t"), (8, "x y z u v w q r s t"), (None, "lonely without id and long enough")]
    number = 100
    for size in (8, 12, 20, 60, 200, 900):
        for _ in range(6):
            base = text(size)
            for _ in range(8):
                copy = list(base)
                for _ in range(dice.randint(0, max(1, size // 50))):
                    copy[dice.randrange(size)] = dice.choice(vocabulary)
                rows.append((number, " ".join(copy)))
                number += 1
    # A chain: neighbours are linked, the ends are not, and one centre sees few of the others.
    chain = text(120)
    for step in range(40):
        rows.append((number, " ".join(chain)))
        number += 1
        chain = [*chain[4:], *text(4)]
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [85, 80])
def test_against_all_pairs(spark, rows, percent):
    docs = table(spark, rows, extra=("component_id", "node", "kept", "size"))
    assert result(near_duplicates(docs, percent)) == brute_force(rows, percent)


def test_kept_documents(spark, rows):
    docs = table(spark, rows, extra=("kept", "component"))
    found = keep_one_each(docs, 80)
    assert found.columns == docs.columns
    gone = {row[0] for row in map(eval, brute_force(rows, 80)) if not row[3]}
    # Rows go by their own text: one without an id stays where only another row without an id is a copy.
    alone = {text for doc, text in rows if doc is None and not any(x is not None and t == text for x, t in rows)}
    kept = [x for x in rows if x[0] not in gone or x[1] in alone]
    assert sorted(str((r.doc_id, r.text)) for r in found.collect()) == sorted(map(str, kept))


def test_kept_rows_with_shared_or_missing_ids(spark):
    """Of each component of rows one stays, whatever ids its rows and other rows have."""
    base = [" ".join(f"{name}{i}" for i in range(60)) for name in "abcde"]
    near = [text.replace(text.split()[-1], "edited") for text in base]
    rows = [(None, base[0]), (1, near[0]), (None, "alone and without any id at all"), (None, "another one without an id here")]
    rows += [(2, base[1]), (2, "another text under the same id"), (1, near[1]), (3, base[2]), (3, near[2]), (None, base[3])]
    rows += [(None, near[3]), (4, base[4]), (4, base[4]), (None, None), (None, ""), (5, None)]
    sets = [shingle_set(text) for _, text in rows]
    component = list(range(len(rows)))
    for i, mine in enumerate(sets):
        for j in range(i):
            if mine and 100 * len(mine & sets[j]) >= 80 * len(mine | sets[j]):
                component = [component[j] if x == component[i] else x for x in component]
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        groups[component[i]].append((doc is None, doc or 0, i))
    docs = table(spark, rows)
    found = Counter((r.doc_id, r.text) for r in keep_one_each(docs, 80).collect())
    least = [{rows[i] for none, doc, i in group if (none, doc) == min(group)[:2]} for group in groups.values()]
    assert found.total() == len(groups) == 11
    assert all(sum(found[row] for row in rows_) >= 1 for rows_ in least)
    for row in [(None, "alone and without any id at all"), (2, "another text under the same id"), (1, near[0])]:
        assert found[row] == 1


def test_empty_table(spark):
    docs = table(spark, [(1, "x")]).limit(0)
    assert near_duplicates(docs, 85).count() == 0
    assert keep_one_each(docs).count() == 0


def test_shingles_of_long_and_short_texts():
    words = [f"v{i % 977}" for i in range(300_000)]
    assert len(shingles(" ".join(words))) == len(shingle_set(" ".join(words)))
    assert len(shingles("")) == 0 and len(shingles(None)) == 0
    assert (shingles("a b") == shingles(" A\tB\n")).all()
    assert set(shingles("a b c")) != set(shingles("a b c d"))


def test_empty_bins_copy_filled_ones():
    signer = Signer(24, 5)
    hashes = np.sort(np.random.default_rng(1).integers(0, 2**63, 7).astype("u8") * 2)
    assert set(signer.signature(hashes)) <= set(hashes)
    assert len(set(signer.signature(hashes))) > 3
    full = np.unique(np.random.default_rng(1).integers(0, 2**63, 9000).astype("u8") * 2)
    starts = [full[np.searchsorted(full, edge)] for edge in signer.edges]
    assert (signer.signature(full) == np.array(starts)).all()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 30)] + [(60, 50), (61, 51), (51, 60)]
    labels = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(labels[i] == 100 for i in range(100, 141))
    assert all(labels[i] == 0 for i in range(30))
    assert {labels[i] for i in (50, 51, 60, 61)} == {50}


def test_columns_of_the_caller_stay(spark):
    docs = table(spark, [(1, "a b c d e f"), (2, "a b c d e f")], extra=("_near_row", "_near_row_"))
    found = keep_one_each(docs).collect()
    assert [(r.doc_id, r["_near_row"], r["_near_row_"]) for r in found] == [(1, "x", "x")]


def test_sketches_never_differ_in_more_bits_than_sets():
    rng = np.random.default_rng(5)
    for size, own in ((8, 0), (8, 3), (60, 9), (900, 200)):
        base = rng.integers(0, 1 << 63, size, dtype="u8")
        one, two = (np.unique(np.append(base, rng.integers(0, 1 << 63, own, dtype="u8"))) for _ in range(2))
        bits = int(np.unpackbits((minhash.sketch(one) ^ minhash.sketch(two)).view("u1")).sum())
        assert bits <= len(np.setxor1d(one, two))


def test_stars_leave_out_pairs_whose_sketches_rule_a_link_out(spark):
    """Every shingle is in some other set too, so what sets share at most rules nothing out."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 90, dtype="u8")
    near = [np.append(base, rng.integers(0, 1 << 63, 3, dtype="u8")) for _ in range(2)]
    far = [np.append(base[:80], rng.integers(0, 1 << 63, 30, dtype="u8")) for _ in range(12)]
    sets = [np.unique(x) for x in near + far]
    packed = spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(sets)], "node long, shingles binary")
    sizes = spark.createDataFrame([(1, i, i, len(x), len(x)) for i, x in enumerate(sets)], "bucket long, node long, component long, size long, shared long")
    members = sizes.join(minhash.sketches(packed), "node")
    centres = minhash.centres_of(members, 1000)
    edges = {tuple(r) for r in minhash.stars(members, centres, 85).collect()}
    linked = {
        (i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
    }
    assert linked and linked <= edges
    assert len(edges) <= 2 * len(linked)

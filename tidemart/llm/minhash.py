"""Near duplicates by one-permutation hashing with optimal densification.

Signatures.  Every shingle of a document gets one 64-bit hash.  The hash range is cut into
bands x rows bins, and a bin's value is the smallest hash in it.  An empty bin copies the bin
that a fixed universal hash of (bin, attempt) names, attempt after attempt until it names a
filled one.  Rows are gathered in bands; documents that agree in a band share a bucket.

Candidates.  Equal sets are one node (set digest), however many documents have them.  In each
bucket, edges run from the smallest node to the others, a star, so edges grow with members and
not with pairs.  Every edge is confirmed by the whole sets.

No lost links.  A member that a centre rejects may still be linked to another member.  So, after
the components of the confirmed links are known, buckets that hold more than one component go on
with further centres (some per bucket and round, each once) until every bucket is one component
or each member has been a centre.  Members of one component need no further comparison.  Nor do
sets that cannot reach the similarity: of the shingles of the sets still in question, those that
only one set has are counted, and what two sets have in common is at most what each shares with
any other.  Nor do two sets whose parity sketches differ in more bits than the sets may differ in
shingles.  Both bounds are exact, and in a large group of edited copies they leave few comparisons.

Defined results: words are split at white space after lower-casing A-Z; fewer words than the
shingle length make one shingle; no words (or null text) make an empty set that is linked with
nothing and is its own component; repeated rows have equal sets; a null doc_id takes part, but a
component's id is its smallest non-null doc_id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import emptied, slices, staged

SHINGLE = 5
ROWS = 5
#: Bands by similarity in percent: a pair at the threshold shares no band in one of 100,000 cases or less.
BANDS = {85: 24, 80: 36}

#: Centres of one bucket in a round after the first, at least; and comparisons of sketches up to which a
#: round takes more, so that the last small buckets need no rounds of their own.
CENTRES, COMPARISONS = 64, 20_000_000

#: Columns of a set's parity sketch, 64 bits each.
SKETCH = tuple(f"sketch{i}" for i in range(8))

#: Node ids (8 bytes) that may be broadcast to pick the texts of candidates.
BROADCAST_NODES = 500_000

#: Word hashes that a worker remembers at once.
REMEMBERED = 300_000

FACTOR = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


WORDS = WordHashes()


def forget() -> None:
    WORDS.clear()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (splitmix finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    if len(WORDS) > REMEMBERED:
        WORDS.clear()
    parts = []
    for part in slices(text or ""):
        words = part.encode().lower().split()
        parts.append(np.fromiter(map(WORDS.__getitem__, words), "u8", len(words)))
    words = np.concatenate(parts)
    if not len(words):
        return words
    span = min(width, len(words))
    hashes = np.full(len(words) - span + 1, span, "u8")
    for at in range(span):
        hashes = hashes * FACTOR + words[at : at + len(hashes)]
    return np.unique(mixed(hashes))


class Signer:
    """Band keys of shingle sets."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self.edges = np.array([(i << 64) // self.bins for i in range(self.bins)], "u8")
        self.numbers = np.arange(self.bins, dtype="u8")
        self.seeds = mixed(np.arange(1, bands + 1, dtype="u8") * FACTOR)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        first = np.searchsorted(hashes, self.edges)
        filled = first < np.append(first[1:], len(hashes))
        values = hashes[np.minimum(first, len(hashes) - 1)]
        empty, attempt = np.flatnonzero(~filled), 0
        while len(empty):
            attempt += 1
            named = (mixed(self.numbers[empty] * FACTOR + np.uint64(attempt)) % np.uint64(self.bins)).astype("i8")
            found = filled[named]
            values[empty[found]] = values[named[found]]
            empty = empty[~found]
        return values

    def band_keys(self, hashes: np.ndarray) -> np.ndarray:
        rows = self.signature(hashes).reshape(self.bands, self.rows)
        keys = self.seeds.copy()
        for at in range(self.rows):
            keys = mixed(keys * FACTOR + rows[:, at])
        return keys.view("i8")


def least_linked(percent: int) -> int:
    """The smallest set that can be linked with a different set."""
    return -(-percent // (100 - percent))


def signatures(docs: DataFrame, percent: int, rows: int = ROWS, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, set_key and band keys; sets too small for any link have no bands."""
    bands, least = BANDS[percent], least_linked(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(bands, rows)
        for batch in batches:
            sizes, keys, found = [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingles(text, width)
                sizes.append(len(hashes))
                keys.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                found.append(signer.band_keys(hashes) if len(hashes) >= least else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "bands"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        emptied(run, forget), "doc_id long, n_shingles long, set_key binary, bands array<long>"
    )


def some(frame: DataFrame) -> DataFrame:
    """Broadcast behind a check of size; larger frames are joined by a shuffle."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_NODES else frame


def unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (bucket, node, ...) of the buckets that hold several components, with the component."""
    rest = [c for c in members.columns if c != "component"]
    named = members.select(*rest).join(some(labels.withColumnRenamed("component", "_label")), "node", "left")
    named = named.select(*rest, F.coalesce("_label", "node").alias("component"))
    ends = named.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    several = staged(ends.filter("least < most").select("bucket"), "near-mixed")
    return named.join(some(several), "bucket", "left_semi")


def shared_sizes(sets: DataFrame) -> DataFrame:
    """node, size, and how many of its shingles any other of these sets has.

    A shingle is counted once per set that has it, combined before the shuffle.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.frombuffer(packed, "i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), node)), pa.array(found)], names=["node", "shingle"]
                )

    counts = sets.select("node", "shingles").mapInArrow(listed, "node long, shingle long").groupBy("shingle")
    alone = counts.agg(F.count("*").alias("n"), F.min("node").alias("node")).filter("n = 1").groupBy("node").count()
    return sets.join(alone, "node", "left").select(
        "node", "size", (F.col("size") - F.coalesce("count", F.lit(0))).alias("shared")
    )


def sketch(hashes: np.ndarray) -> np.ndarray:
    """One bit for each of 512 classes of hashes: whether an odd number of the set's hashes is in it.

    A shingle that one of two sets has alone turns one bit, so the sketches differ in no more bits
    than the sets in shingles.
    """
    bits = 64 * len(SKETCH)
    odd = np.bincount((hashes % np.uint64(bits)).astype("i8"), minlength=bits) & 1
    return np.packbits(odd.astype("u1")).view("i8")


def sketches(sets: DataFrame) -> DataFrame:
    """node and the columns of its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(np.frombuffer(packed.as_buffer(), "u8")) for packed in batch.column(1)]
            columns = np.array(found, "i8").reshape(-1, len(SKETCH)).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["node", *SKETCH])

    schema = ", ".join(["node long", *(f"{c} long" for c in SKETCH)])
    return sets.select("node", "shingles").mapInArrow(emptied(run), schema)


def centres_of(members: DataFrame, slots: int) -> DataFrame:
    """Centres of each bucket: the node of the smallest component in each of so many slots.

    A stray node beside a large component is a centre first, and one round settles it.
    """
    weights = members.groupBy("bucket", "component").agg(F.count("*").alias("weight"))
    slot = F.pmod(F.xxhash64("node"), F.lit(slots))
    least = F.min(F.struct("weight", "node", "component", "size", "shared", *SKETCH)).alias("least")
    return (
        members.join(weights, ["bucket", "component"])
        .groupBy("bucket", slot.alias("slot"))
        .agg(least)
        .select(
            "bucket", F.col("least.node").alias("centre"), F.col("least.component").alias("centre_component"),
            F.col("least.size").alias("centre_size"), F.col("least.shared").alias("centre_shared"),
            *(F.col(f"least.{c}").alias(f"centre_{c}") for c in SKETCH),
        )
    )


def stars(members: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) from centres to the members of other components that can be linked.

    Two sets have in common at most what either shares with any other set; a link needs
    percent / (100 + percent) of both sizes, so the shingles that one of them has alone are at most
    (100 - percent) / (100 + percent) of both, and their sketches differ in no more bits.
    """
    both = F.col("size") + F.col("centre_size")
    can = F.least("shared", "centre_shared") * (100 + percent) >= both * percent
    differ = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(f"centre_{c}"))) for c in SKETCH)
    can = can & (differ * (100 + percent) <= both * (100 - percent))
    return (
        members.join(centres, "bucket")
        .filter((F.col("component") != F.col("centre_component")) & can)
        .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
        .distinct()
    )


def first_stars(buckets: DataFrame) -> DataFrame:
    """Edges from the smallest node of each bucket that has two."""
    chosen = buckets.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("most")).filter("a < most")
    return buckets.join(chosen, "bucket").filter("node > a").select("a", F.col("node").alias("b")).distinct()


def sets_of(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """node, n_shingles and the packed shingle set, read again from the texts of these nodes."""
    wanted = nodes.select("node", F.col("first").alias("_first"), "set_key")
    if wanted.count() <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(
        wanted, F.col("_id").eqNullSafe(F.col("_first"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, sets = [], [], []
            for node, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = shingles(text, width)
                # Several rows may have the id; only those with the node's set are the node.
                if len(hashes) and xxhash.xxh3_128_digest(hashes.tobytes()) == key:
                    nodes.append(node)
                    sizes.append(len(hashes))
                    sets.append(hashes.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary())],
                names=["node", "size", "shingles"],
            )

    sets = rows.select("node", "set_key", "text").mapInArrow(emptied(run, forget), "node long, size long, shingles binary")
    return sets.dropDuplicates(["node"])


def confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges with 100 * intersection >= percent * union, by whole sets."""

    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col("shingles").alias(f"set_{name}")
        )

    pairs = (
        edges.join(sets.select(F.col("node").alias("a"), F.col("size").alias("size_a")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("size").alias("size_b")), "b")
        .filter(F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent)
        .select("a", "b")
        .join(side("a"), "a")
        .join(side("b"), "b")
        .select("a", "b", "set_a", "set_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            kept = np.zeros(batch.num_rows, bool)
            for at in range(batch.num_rows):
                a = np.frombuffer(left[at].as_buffer(), "u8")
                b = np.frombuffer(right[at].as_buffer(), "u8")
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                kept[at] = 100 * shared >= percent * (len(both) - shared)
            yield batch.select([0, 1]).filter(pa.array(kept))

    return pairs.mapInArrow(emptied(run), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest linked node) for all nodes with a link.

    Labels fall to the smallest of the neighbours' labels and then to their label's label, so
    the rounds grow with the logarithm of a path's length.
    """
    ends = F.explode(
        F.array(*(F.struct(F.col(x).alias("col1"), F.col(y).alias("col2")) for x, y in ("ab", "ba", "aa", "bb")))
    )
    both = staged(
        links.select(ends.alias("e")).select(F.col("e.col1").alias("node"), F.col("e.col2").alias("other")).distinct(),
        "near-links",
    )
    labels = staged(both.groupBy("node").agg(F.min("other").alias("component")), "near-labels")
    known = labels.count()

    def told(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if known <= BROADCAST_NODES else frame

    while True:
        # Each node is its own neighbour, so its label before the round comes along.
        lower = (
            both.join(told(labels.select(F.col("node").alias("other"), "component")), "other")
            .groupBy("node")
            .agg(
                F.min("component").alias("lower"),
                F.max(F.when(F.col("node") == F.col("other"), F.col("component"))).alias("before"),
            )
        )
        jump = labels.select(F.col("node").alias("lower"), F.col("component").alias("next"))
        after = staged(
            lower.join(told(jump), "lower").select("node", F.least("lower", "next").alias("component"), "before"),
            "near-labels",
        )
        if after.filter("component <> before").isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")


def near_links(docs: DataFrame, nodes: DataFrame, percent: int, width: int = SHINGLE) -> DataFrame:
    """Components of nodes: node, component for every node with a confirmed link."""

    def load(wanted: DataFrame) -> DataFrame:
        chosen = staged(nodes.select("node", "first", "set_key").join(wanted, "node", "left_semi"), "near-candidates")
        return staged(sets_of(docs, chosen, width), "near-sets")

    buckets = staged(
        nodes.filter("bands is not null").select("node", F.explode("bands").alias("bucket")), "near-buckets"
    )
    tested = staged(first_stars(buckets), "near-edges")
    sets = load(tested.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    links = staged(confirmed(tested, sets, percent), "near-confirmed")
    labels = components(links)
    members = staged(unresolved(buckets, labels), "near-open")
    if not members.isEmpty():
        present = staged(members.select("node").distinct(), "near-present")
        sets = sets.unionByName(load(present.join(sets.select("node"), "node", "left_anti")))
        asked = sets.join(some(present), "node", "left_semi")
        sizes = staged(shared_sizes(asked).join(sketches(asked), "node"), "near-sizes")
        linkable = sizes.filter(F.col("shared") * 100 >= F.col("size") * percent)
        members = staged(unresolved(members.join(some(linkable), "node"), labels), "near-open")
    while not members.isEmpty():
        slots = max(CENTRES, COMPARISONS // members.count())
        centres = staged(centres_of(members, slots), "near-centres")
        edges = staged(stars(members, centres, percent).join(tested, ["a", "b"], "left_anti"), "near-edges")
        tested = tested.unionByName(edges)
        found = staged(confirmed(edges, sets, percent), "near-confirmed")
        # A centre has met every member of other components and need not come again.
        used = centres.select("bucket", F.col("centre").alias("node"))
        rest = members.join(used, ["bucket", "node"], "left_anti")
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = components(links)
        members = staged(unresolved(rest, labels), "near-open")
    return labels


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = SHINGLE) -> DataFrame:
    """Return per row: doc_id, n_shingles, component_id, kept."""
    signed = staged(signatures(docs, percent, width=width), "near-signatures")
    nodes = staged(
        signed.filter("n_shingles > 0")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "near-nodes",
    )
    labels = near_links(docs, nodes, percent, width)
    grouped = nodes.select("set_key", "node", "first").join(labels, "node", "left")
    grouped = grouped.select("set_key", "first", F.coalesce("component", "node").alias("component"))
    ids = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    of_sets = staged(grouped.join(ids, "component").select("set_key", "component_id"), "near-ids")
    with_sets = signed.select("doc_id", "n_shingles", "set_key").join(of_sets, "set_key", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return with_sets.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def keep_one_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents without near copies; all columns stay.

    Of each component one row stays: the one with the smallest non-null doc_id, the first stored
    of several.  Rows are told apart by an id of their own, so rows that share a doc_id, or have
    none, go or stay by the set of each.
    """
    row = "_near_row"
    while row in docs.columns:
        row += "_"
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "near-rows")
    found = staged(
        near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), percent).select(
            F.col("doc_id").alias(row), "component_id"
        ),
        "near-components",
    )
    # A row that is its component alone stays without further ado.
    several = found.groupBy("component_id").count().filter("count > 1").select("component_id")
    copies = staged(found.join(several, "component_id").join(rows.select(row, "doc_id"), row), "near-copies")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"), row)
    stays = copies.groupBy("component_id").agg(F.min(order).alias("least")).select(f"least.{row}")
    gone = staged(copies.select(row).join(stays, row, "left_anti"), "near-gone")
    return rows.join(some(gone), row, "left_anti").select(docs.columns)

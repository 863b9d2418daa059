"""Periodic runs of words: stretches that repeat a block of words several times over.

A run with smallest period q is a stretch in which words q apart are identical and which no
neighbouring word extends.  It is wanted from ``shortest`` words and ``times`` periods on.  Runs
are found as maximal pairs.  For a run from word s, the pair (s, s + q) agrees on exactly
length - q words and has different words on its left and behind the agreement.  So a maximal pair
whose distance meets the length condition *is* a run: its start, period and length are read off,
and nothing has to be extended.

1. Suffixes that share too few words with any other suffix of their text to reach the condition
   drop out by ranking windows of words (numpy, exact).  The rest are sorted by prefix doubling,
   and the ranks of all window sizes give the common prefixes (LCP) of neighbours.
2. The LCP intervals are walked bottom-up.  Every interval holds the places of its suffixes,
   classed by the word on their left: places of one class alone give no maximal pair and are only
   merged; otherwise the smaller lists go into the largest.
3. Of an interval's pairs only neighbours in the order of places count.  If a third place lay
   between those of a pair, two periods that together are no longer than the stretch would leave a
   shorter one (Fine and Wilf), so the pair's distance would not be the smallest period.  Each
   run is therefore met once, at the interval of exactly its agreement.

Texts are answered by themselves, in numpy blocks of bounded size inside Arrow tasks: no shuffle.

Defined results: a null text has no words, runs or kept words; so has a text of white space.
Repeated rows are answered each.  Runs that overlap or lie in each other are all listed.  One very
long text is one block of its own; memory grows with its words.  An empty table gives no rows.
Columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of texts that are worked on together.
BLOCK_WORDS = 200_000

Words = list[bytes]
Rewrite = Callable[[int | None, Words], Words]

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Condition:
    """Which runs are wanted: length >= max(shortest, times * period)."""

    def __init__(self, shortest: int = 6, times: int = 4):
        if times < 2 or shortest < 1:
            raise ValueError("a run has two periods at least")
        self.shortest, self.times = shortest, times
        #: No wanted run's pair agrees on fewer words.
        self.least = min(self.agreement(q) for q in range(1, shortest + 1))

    def agreement(self, period: int) -> int:
        """Words on which the pair of a run with this period must agree."""
        return max(self.shortest - period, (self.times - 1) * period)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and for each in that order whether it opens a group of equal keys."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    opens = np.empty(len(keys), bool)
    opens[:1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=opens[1:])
    return order, opens


def _starts(opens: np.ndarray) -> np.ndarray:
    """Per entry the index of its group's first one."""
    return np.maximum.accumulate(np.where(opens, np.arange(len(opens)), 0))


def _alone(opens: np.ndarray) -> np.ndarray:
    return opens & np.append(opens[1:], True)


def _refine(
    suffixes: np.ndarray, opens: np.ndarray, rank: np.ndarray, end: np.ndarray, shift: int, base: np.ndarray | int
) -> None:
    """Order each group by the ranks `shift` words further on; in place.  Texts that end there come first.

    A rank is the index of the group's first suffix, plus base.
    """
    mixed = np.flatnonzero(~_alone(opens))
    places = suffixes[mixed]
    next_ = places + shift
    inside = next_ < end[places]
    behind = np.where(inside, rank[np.where(inside, next_, 0)], -1)
    order, opens[mixed] = _groups(rank[places] * (len(rank) + 1) + behind + 1)
    suffixes[mixed] = places[order]
    rank[suffixes] = _starts(opens) + base


def _sorted_suffixes(key: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share `least` words with another one, in order, and what neighbours share.

    shared[k] belongs to the suffixes k - 1 and k; it is 0 where they share less than `least`.
    """
    n = len(key)
    suffixes, opens = _groups(key)
    rank = np.empty(n, np.int64)
    rank[suffixes] = _starts(opens)
    size = 1
    while size < least:
        shift = min(size, least - size)
        _refine(suffixes, opens, rank, end, shift, 0)
        size += shift
    seeds = ~_alone(opens)
    suffixes, opens = suffixes[seeds], opens[seeds]
    if not len(suffixes):
        return suffixes, suffixes
    # From here on only these are ordered further; ranks of all others are theirs for good.
    base = rank[suffixes] - _starts(opens)
    apart, levels = opens.copy(), []
    while True:
        levels.append((size, np.append(rank, -1)))
        if _alone(opens).all():
            break
        _refine(suffixes, opens, rank, end, size, base)
        size *= 2
    first, second = suffixes[:-1].copy(), suffixes[1:].copy()
    shared = np.zeros(len(first), np.int64)
    for size, at in reversed(levels):
        same = at[np.minimum(first, n)] == at[np.minimum(second, n)]
        shared += size * same
        first += size * same
        second += size * same
    closed = np.append(key, -1)
    going = np.ones(len(first), bool)
    for _ in range(least - 1):
        going &= closed[np.minimum(first, n)] == closed[np.minimum(second, n)]
        shared += going
        first += going
        second += going
    shared = np.concatenate([[0], shared])
    shared[apart] = 0
    return suffixes, shared


def _maximal_pairs(key: list[int], suffixes: list[int], shared: list[int], wanted: Condition) -> Iterator[tuple]:
    """(start, length, period) of the wanted runs; key ends with a value that no word has."""
    agreement = wanted.agreement
    # An open interval: what its suffixes share, and its children.  A child: its places in order,
    # and their class, the word on the left of all of them; None where several classes are mixed.
    stack: list[tuple[int, list]] = []
    for k, place in enumerate(suffixes):
        node = ([place], key[place - 1])
        value = shared[k + 1] if k + 1 < len(suffixes) else 0
        while stack and stack[-1][0] > value:
            common, children = stack.pop()
            children.append(node)
            left = children[0][1]
            mixed = left is None or any(child[1] != left for child in children)
            largest = max(children, key=lambda child: len(child[0]))
            places = largest[0]
            fresh = [x for child in children if child is not largest for x in child[0]]
            if 8 * len(fresh) > len(places):
                places = sorted(places + fresh)
            else:
                for x in fresh:
                    insort(places, x)
            if mixed:
                last = len(places) - 1
                seen = set()
                for x in fresh:
                    at = bisect_left(places, x)
                    for low in (at - 1, at):
                        if low < 0 or low >= last or low in seen:
                            continue
                        seen.add(low)
                        i, j = places[low], places[low + 1]
                        if (
                            common >= agreement(j - i)
                            and key[i - 1] != key[j - 1]
                            and key[i + common] != key[j + common]
                        ):
                            yield i, common + j - i, j - i
                left = None
            node = (places, left)
        if value:
            if stack and stack[-1][0] == value:
                stack[-1][1].append(node)
            else:
                stack.append((value, [node]))


def runs_of(texts: list[Words], wanted: Condition) -> list[list[tuple[int, int, int]]]:
    """Per text the (start, length, period) of its runs, by start, then period."""
    numbers: dict[bytes, int] = {}
    sizes = np.array([len(words) for words in texts], np.int64)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    n = int(sizes.sum())
    if not n:
        return found
    word = np.fromiter((numbers.setdefault(x, len(numbers)) for words in texts for x in words), np.int64, n)
    text = np.repeat(np.arange(len(texts)), sizes)
    ends = np.cumsum(sizes)
    key = text * len(numbers) + word  # words of different texts are never equal
    suffixes, shared = _sorted_suffixes(key, ends[text], wanted.least)
    if not len(suffixes):
        return found
    for start, length, period in _maximal_pairs([*key.tolist(), -1], suffixes.tolist(), shared.tolist(), wanted):
        t = int(text[start])
        found[t].append((start - int(ends[t] - sizes[t]), length, period))
    for runs in found:
        runs.sort(key=lambda run: (run[0], run[2]))
    return found


def collapse(words: Words, runs: list[tuple[int, int, int]]) -> bytes:
    """The words that stay when every run is cut to its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    kept, reached = [], 0
    for low, high in sorted((start + period, start + length) for start, length, period in runs):
        if low > reached:
            kept += words[reached:low]
        reached = max(reached, high)
    return b" ".join(kept + words[reached:])


def _blocks(rows: Iterator[tuple[int | None, Words]]) -> Iterator[list[tuple[int | None, Words]]]:
    block, size = [], 0
    for doc, words in rows:
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((doc, words))
        size += len(words)
    if block:
        yield block


def find_runs(
    docs: DataFrame, shortest: int = 6, times: int = 4, text: str = "text", rewrite: Rewrite | None = None
) -> DataFrame:
    """Per row: doc_id, n_words, runs (array of start, length, period) and collapsed, the text without repeats.

    Words are `[^\\x20\\x09-\\x0D]+`.  `rewrite` may change the words of a row before they are searched.
    """
    wanted = Condition(shortest, times)

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[int | None, Words]]:
        for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = (value.as_py() or b"").split()  # bytes split at the ASCII white space, as the rule says
            yield doc, words if rewrite is None else rewrite(doc, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(rows(batch)):
                found = runs_of([words for _, words in block], wanted)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc for doc, _ in block], pa.int64()),
                        pa.array([len(words) for _, words in block], pa.int64()),
                        pa.array([[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found], _RUNS),
                        pa.array([collapse(words, runs) for (_, words), runs in zip(block, found)], pa.binary()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("binary")).mapInArrow(run, SCHEMA)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties go to the smallest start, then period.  Null for none."""

    def better(best: Column, run: Column) -> Column:
        ours, theirs = run["length"] * best["period"], best["length"] * run["period"]
        earlier = F.struct(run["start"], run["period"]) < F.struct(best["start"], best["period"])
        return F.when((ours > theirs) | ((ours == theirs) & earlier), run).otherwise(best)

    return F.reduce(runs, F.get(runs, F.lit(0)), better)


def listing(runs: Column) -> Column:
    """One `start,length,period` line a run, each ended by LF."""
    return F.array_join(
        F.transform(runs, lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))),
        "",
    )

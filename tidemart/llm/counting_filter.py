"""Counting quotient filters of packed n-grams, in numpy: bulk-built, sorted, lossless.

A key is a tuple of word numbers below 2^bits.  `permute` scrambles it with a Feistel network over
its words, which can be undone for every key; so keys spread evenly over ranges, and nothing is
lost.  The scrambled words are packed into one or more 64-bit limbs.  Of a filter's sorted keys the
top bits of the first limb are the quotient and *all* other bits the remainder:

* quotients are not stored but marked: entry i of quotient q sets bit q + i (occupied slots and
  run ends of a quotient filter in one bit string of about two bits an entry);
* remainders are stored whole, in as few bytes as hold them;
* a count takes one byte, larger ones eight more.

Filters are merged by merging their sorted keys and adding counts.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

ROUNDS = 3
_HEAD = struct.Struct("<QQIII")  # entries, first quotient, quotient bits, large counts, bytes of marks
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)


def _scramble(value: np.ndarray, salt: int) -> np.ndarray:
    value = (value + np.uint64(salt)) * _MIX
    value ^= value >> np.uint64(32)
    value *= _MIX2
    return value >> np.uint64(29)


def _steps(words: int) -> list[tuple[int, int]]:
    return [(r, j) for r in range(ROUNDS) for j in range(words)]


def _step(words: list[np.ndarray], r: int, j: int, mask: np.uint64) -> None:
    """One word is changed by a function of the others, so doing it again undoes it."""
    others = np.zeros_like(words[j])
    for i, word in enumerate(words):
        if i != j:
            others = others * np.uint64(31) + word if len(words) > 2 else word
    words[j] = words[j] ^ (_scramble(others, 1 + r * 8 + j) & mask)


def permute(words: Sequence[np.ndarray], bits: int) -> list[np.ndarray]:
    out = [np.asarray(x, np.uint64) for x in words]
    mask = np.uint64((1 << bits) - 1)
    for r, j in _steps(len(out)):
        _step(out, r, j, mask)
    return out


def invert(words: Sequence[np.ndarray], bits: int) -> list[np.ndarray]:
    out = [np.asarray(x, np.uint64) for x in words]
    mask = np.uint64((1 << bits) - 1)
    for r, j in reversed(_steps(len(out))):
        _step(out, r, j, mask)
    return out


class Layout:
    """How the words of a key lie in its limbs."""

    def __init__(self, words: int, bits: int):
        if not 1 <= bits <= 32:
            raise ValueError("word numbers take 1 to 32 bits")
        self.words, self.bits = words, bits
        per = 64 // bits
        self.parts = [min(per, words - i) for i in range(0, words, per)]
        #: Bits of each limb.
        self.widths = [n * bits for n in self.parts]

    def pack(self, words: Sequence[np.ndarray]) -> list[np.ndarray]:
        limbs, at = [], 0
        for n in self.parts:
            limb = words[at].copy()
            for word in words[at + 1 : at + n]:
                limb = (limb << np.uint64(self.bits)) | word
            limbs.append(limb)
            at += n
        return limbs

    def unpack(self, limbs: Sequence[np.ndarray]) -> list[np.ndarray]:
        mask, words = np.uint64((1 << self.bits) - 1), []
        for n, limb in zip(self.parts, limbs):
            words += [(limb >> np.uint64(self.bits * (n - 1 - i))) & mask for i in range(n)]
        return words

    def top(self, limbs: Sequence[np.ndarray], bits: int) -> np.ndarray:
        """The first bits of the keys as numbers below 2^bits, whatever the width of the limb."""
        shift = self.widths[0] - bits
        return limbs[0] >> np.uint64(shift) if shift >= 0 else limbs[0] << np.uint64(-shift)


def order_of(limbs: Sequence[np.ndarray]) -> np.ndarray:
    return np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])


def combine(limbs: Sequence[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    if not len(counts):
        return list(limbs), counts
    order = order_of(limbs)
    limbs = [limb[order] for limb in limbs]
    new = np.zeros(len(counts), bool)
    new[0] = True
    for limb in limbs:
        new[1:] |= limb[1:] != limb[:-1]
    starts = np.flatnonzero(new)
    return [limb[starts] for limb in limbs], np.add.reduceat(counts[order], starts)


def _bytes(limb: np.ndarray, width: int) -> bytes:
    return limb.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-width // 8)].tobytes()


def _limb(data: bytes, width: int, entries: int) -> np.ndarray:
    size = -(-width // 8)
    out = np.zeros((entries, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8, entries * size).reshape(entries, size)
    return out.view("<u8").reshape(-1)


def dump(layout: Layout, limbs: Sequence[np.ndarray], counts: np.ndarray) -> bytes:
    """A filter of sorted distinct keys as bytes."""
    entries = len(counts)
    if not entries:
        return _HEAD.pack(0, 0, 0, 0, 0)
    span = int(limbs[0][-1]) - int(limbs[0][0]) + 1
    # About one quotient an entry: the keys of a range are evenly spread over its span.
    low = max(0, span.bit_length() - max(1, entries.bit_length()))
    low = min(low, layout.widths[0])
    quotient = limbs[0] >> np.uint64(low)
    first = int(quotient[0])
    slots = (quotient - np.uint64(first)).astype(np.int64) + np.arange(entries)
    marks = np.zeros(int(slots[-1]) + 1, np.uint8)
    marks[slots] = 1
    marks = np.packbits(marks).tobytes()
    parts = [_HEAD.pack(entries, first, low, int((counts >= 255).sum()), len(marks)), marks]
    parts.append(_bytes(limbs[0] & np.uint64((1 << low) - 1), low))
    parts += [_bytes(limb, width) for limb, width in zip(limbs[1:], layout.widths[1:])]
    parts.append(np.minimum(counts, 255).astype(np.uint8).tobytes())
    parts.append(counts[counts >= 255].astype("<u8").tobytes())
    return b"".join(parts)


def load(layout: Layout, data: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    entries, first, low, large, size = _HEAD.unpack_from(data)
    if not entries:
        return [np.zeros(0, np.uint64) for _ in layout.widths], np.zeros(0, np.int64)
    at = _HEAD.size
    slots = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, size, at)))
    at += size
    quotient = (slots - np.arange(entries)).astype(np.uint64) + np.uint64(first)
    limbs = []
    for n, width in enumerate([low, *layout.widths[1:]]):
        length = entries * -(-width // 8)
        limb = _limb(data[at : at + length], width, entries)
        limbs.append(limb if n else (quotient << np.uint64(low)) | limb)
        at += length
    counts = np.frombuffer(data, np.uint8, entries, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", large, at + entries).astype(np.int64)
    return limbs, counts


class Collector:
    """Adds keys and gives back sorted filters; holds no more than about `limit` distinct keys."""

    def __init__(self, layout: Layout, limit: int):
        self.layout, self.limit = layout, limit
        self._clear()

    def _clear(self) -> None:
        self.limbs: list[list[np.ndarray]] = [[] for _ in self.layout.widths]
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, limbs: Sequence[np.ndarray], counts: np.ndarray) -> bool:
        """Whether the collector is full and must be emptied."""
        for held, limb in zip(self.limbs, limbs):
            held.append(limb)
        self.counts.append(counts)
        self.size += len(counts)
        if self.size < 2 * self.limit:
            return False
        found = self.take()
        for held, limb in zip(self.limbs, found[0]):
            held.append(limb)
        self.counts.append(found[1])
        self.size = len(found[1])
        return self.size >= self.limit

    def take(self) -> tuple[list[np.ndarray], np.ndarray]:
        """The sorted distinct keys and their counts; empties the collector."""
        limbs = [np.concatenate([np.zeros(0, np.uint64), *held]) for held in self.limbs]
        counts = np.concatenate([np.zeros(0, np.int64), *self.counts])
        self._clear()
        return combine(limbs, counts)

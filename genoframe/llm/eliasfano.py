"""Elias-Fano sequences and a two-level n-gram trie, in one buffer that can be memory-mapped.

A monotone sequence of n values below u keeps the low log2(u / n) bits of each value packed, and the high parts as a
unary bit vector: a one for each value, a zero at the end of each high part. The places of its ones, or the values before its
zeros, 4 bytes each, are listed when they are first asked for; values are not unpacked to be
read. Levels of the trie are such sequences: contexts, pointers to their successors, and the successors, made monotone by the rank of
their context. A successor is searched in its context's range only, which the pointers give. Probabilities are quantised.
Questions are searched in the order of the sequence, equal ones once, so that what is read of it lies together.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np

#: Steps of quantised -log10 values; code 0 says that there is none.
STEPS = 4000.0
#: Bits of a successor's name within its context: those of the sequence, and those kept beside it.
HEAD_BITS, TAIL_BITS = 40, 16
#: The probability of each code.
_PROBABILITY = np.append(0.0, 10.0 ** (-np.arange(65535.0) / STEPS))


def quantised(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, 1 + np.minimum(np.rint(-np.log10(np.maximum(p, 1e-300)) * STEPS), 65534), 0).astype(np.uint16)


def probability(code: np.ndarray) -> np.ndarray:
    return _PROBABILITY[code]


class EliasFano:
    """Random access and successor search, for whole arrays of queries at once."""

    def __init__(self, words: np.ndarray):
        self.n, self.low_bits, self.high_words = (int(x) for x in words[:3])
        self.high = words[3 : 3 + self.high_words]
        self.low = words[3 + self.high_words :]
        self.mask = np.uint64((1 << self.low_bits) - 1)

    @staticmethod
    def encode(values: np.ndarray) -> np.ndarray:
        """64-bit words of the sequence, values ascending (repeats allowed)."""
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        shift = np.uint64(low_bits)
        high = (values >> shift).astype(np.int64)
        length = (int(high[-1]) if n else 0) + n + 1
        bits = np.zeros(-(-length // 64) * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        unary = np.packbits(bits, bitorder="little").view(np.uint64)
        packed = np.zeros(-(-n * low_bits // 64) + 1, np.uint64)
        if low_bits and n:
            at = np.arange(n, dtype=np.uint64) * shift
            word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            low = values & np.uint64((1 << low_bits) - 1)
            # fields are disjoint, so sums are unions; those that start in one word are contiguous
            first = np.flatnonzero(np.diff(word, prepend=-1))
            packed[word[first]] = np.bitwise_or.reduceat(low << off, first)
            over = off + shift > np.uint64(64)
            packed[word[over] + 1] |= low[over] >> (np.uint64(64) - off[over])
        return np.concatenate([np.array([n, low_bits, len(unary)], np.uint64), unary, packed])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        out = self.low[word] >> off
        over = off + np.uint64(self.low_bits) > np.uint64(64)
        out[over] |= self.low[word[over] + 1] << (np.uint64(64) - off[over])
        return out & self.mask

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i`` (below n): the one number i of the unary vector has as many zeros before it as the high part says."""
        i = np.asarray(i, np.int64)
        return (self._ones[i] - i).astype(np.uint64) << np.uint64(self.low_bits) | self._low(i)

    @cached_property
    def _ones(self) -> np.ndarray:
        """Place of each one of the unary vector; made when the first value is read."""
        return np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little")).astype(np.uint32 if len(self.high) < 1 << 26 else np.int64)

    @cached_property
    def _ends(self) -> np.ndarray:
        """How many values have a high part below 0, 1 and so on; made when the first value is searched."""
        zeros = np.flatnonzero(np.unpackbits(~self.high.view(np.uint8), bitorder="little"))
        return np.append(0, zeros - np.arange(len(zeros))).astype(np.uint32 if len(self.high) < 1 << 26 else np.int64)

    def successor(self, x: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first value of x or more in the range lo to hi, else hi; whether it is x)."""
        x = np.asarray(x, np.uint64)
        high = np.minimum(x >> np.uint64(self.low_bits), np.uint64(len(self._ends) - 1)).astype(np.int64)
        lo = np.int64(0) if lo is None else lo
        hi = np.int64(self.n) if hi is None else hi
        left = np.clip(self._ends[high].astype(np.int64), lo, hi)
        end = np.clip(self._ends[np.minimum(high + 1, len(self._ends) - 1)].astype(np.int64), lo, hi)
        low, hit = x & self.mask, np.zeros(len(x), bool)
        open_ = np.flatnonzero(left < end)
        a, b, wanted = left[open_], end[open_], low[open_]
        while len(open_):  # halves the runs of one high part; they hold a value or two mostly
            mid = (a + b) >> 1
            less = self._low(mid) < wanted
            a, b = np.where(less, mid + 1, a), np.where(less, b, mid)
            left[open_] = a
            more = np.flatnonzero(a < b)
            open_, a, b, wanted = open_[more], a[more], b[more], wanted[more]
        inside = np.flatnonzero(left < end)
        hit[inside] = self._low(left[inside]) == low[inside]
        return left, hit


class NgramTrie:
    """Contexts, each with its successors' probabilities and the weight that it leaves to the lower order."""

    def __init__(self, buffer):
        head = np.frombuffer(buffer, np.uint64, 6)
        at, parts = 48, []
        for words in head.astype(np.int64):
            parts.append(np.frombuffer(buffer, np.uint64, words, at))
            at += int(words) * 8
        self.contexts, self.pointers, self.successors = map(EliasFano, parts[:3])
        self.left, self.codes, self.tails = (x.view(np.uint16) for x in parts[3:])

    @staticmethod
    def build(contexts: np.ndarray, counts: np.ndarray, rank: np.ndarray, names: np.ndarray, p: np.ndarray, left: np.ndarray) -> bytes:
        """``contexts`` ascending; their successors as (rank of context, name) in order, with probabilities ``p``.

        ``counts``: successors of each context; ``left``: each context's weight of the lower order.
        """
        if len(contexts) >> (64 - HEAD_BITS):
            raise ValueError("a trie holds fewer than 2^24 contexts")
        pad = lambda a: np.concatenate([a, np.zeros(-len(a) % 4, np.uint16)]).view(np.uint64)
        parts = [
            EliasFano.encode(contexts),
            EliasFano.encode(np.concatenate([[0], np.cumsum(counts)])),
            EliasFano.encode(rank.astype(np.uint64) << np.uint64(HEAD_BITS) | names >> np.uint64(TAIL_BITS)),
            pad(quantised(left)),
            pad(quantised(p)),
            pad((names & np.uint64((1 << TAIL_BITS) - 1)).astype(np.uint16)),
        ]
        return b"".join([np.array([*map(len, parts)], np.uint64).tobytes(), *(x.tobytes() for x in parts)])

    def lookup(self, context: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code of the successor's probability, code of the context's left weight); 0 where there is none."""
        code, left = np.zeros(len(context), np.uint16), np.zeros(len(context), np.uint16)
        starts = np.flatnonzero(np.diff(context, prepend=~context[:1]) != 0)  # queries come in runs of one context
        distinct, which = np.unique(context[starts], return_inverse=True)
        place, known = self.contexts.successor(distinct)
        run = np.repeat(which, np.diff(np.append(starts, len(context))))
        at = np.flatnonzero(known[run])
        if not len(at):
            return code, left
        rank, asked = place[run[at]], name[at]
        left[at] = self.left[rank]
        # in the order of rank and the name's leading bits, as far as they fit beside the row: the same questions follow each other
        rows, ranks = len(at).bit_length(), int(rank.max()).bit_length()
        heads = max(0, min(HEAD_BITS, 64 - rows - ranks))
        by = rank.astype(np.uint64) << np.uint64(heads) | asked >> np.uint64(HEAD_BITS + TAIL_BITS - heads)
        by = (np.sort(by << np.uint64(rows) | np.arange(len(at), dtype=np.uint64)) & np.uint64((1 << rows) - 1)).astype(np.int64)
        at, rank, asked = at[by], rank[by], asked[by]
        new = np.ones(len(at), bool)
        new[1:] = (rank[1:] != rank[:-1]) | (asked[1:] != asked[:-1])
        code[at] = self._codes(rank[new], asked[new])[np.cumsum(new) - 1]
        return code, left

    def _codes(self, rank: np.ndarray, name: np.ndarray) -> np.ndarray:
        """Codes of the successors of contexts of these ranks; 0 where there is none."""
        code, at = np.zeros(len(rank), np.uint16), np.arange(len(rank))
        lo, hi = self.pointers.get(rank).astype(np.int64), self.pointers.get(rank + 1).astype(np.int64)
        head = name >> np.uint64(TAIL_BITS) | rank.astype(np.uint64) << np.uint64(HEAD_BITS)
        tail = (name & np.uint64((1 << TAIL_BITS) - 1)).astype(np.uint16)
        found, hit = self.successors.successor(head, lo, hi)
        while True:  # names that differ in their tails only follow each other
            at, found, head, tail, hi = at[hit], found[hit], head[hit], tail[hit], hi[hit]
            if not len(at):
                return code
            same = self.tails[found] == tail
            code[at[same]] = self.codes[found[same]]
            at, found, head, tail, hi = at[~same], found[~same] + 1, head[~same], tail[~same], hi[~same]
            hit = found < hi
            hit[hit] = self.successors.get(found[hit]) == head[hit]

"""Merges of many short symbol sequences at once: one queue of ranks over a linked list of all their positions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from heapq import heappop, heappush

import numpy as np

#: Symbols are below 2**SHIFT, so a pair is one integer.
SHIFT = 21
#: Strings that a worker remembers in each of two generations, how long they may be, and characters of text that are looked
#: at together. Results depend on none of them.
CACHE = 1 << 18
LONGEST = 64
SLICE = 1 << 22
NONE = np.iinfo(np.int32).max
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Joined symbol by pair of symbols, as an open-addressing hash table that whole arrays are looked up in."""

    def __init__(self, left, right, joined):
        keys = np.asarray(left, np.int64) << SHIFT | np.asarray(right, np.int64)
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        values, waiting, slot = np.asarray(joined, np.int32), np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = self.keys[slot[waiting]] < 0
            self.keys[slot[waiting[free]]] = keys[waiting[free]]  # of several keys for a slot, the last stays
            placed = self.keys[slot[waiting]] == keys[waiting]
            self.values[slot[waiting[placed]]] = values[waiting[placed]]
            waiting = waiting[~placed]
            slot[waiting] = (slot[waiting] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The joined symbol of each pair, -1 where there is none."""
        keys = left.astype(np.int64) << SHIFT | right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], np.int32(-1))
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


def pair_table(ids: dict, single) -> PairTable:
    """All pairs of symbols whose contents, put together, are a key of ``ids``; ``single`` is the symbol of a unit (a byte or
    a character) or None."""
    left, right, joined = [], [], []
    for whole, number in ids.items():
        for cut in range(1, len(whole)):
            a, b = whole[:cut], whole[cut:]
            a, b = (single(x) if len(x) == 1 else ids.get(x) for x in (a, b))
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                joined.append(number)
    return PairTable(left, right, joined)


class HeapOfRanks:
    """Ranks in use, best first, by a heap."""

    def __init__(self, ranks):
        self.heap = sorted(ranks)

    def add(self, rank: int) -> None:
        heappush(self.heap, rank)

    def take(self) -> int:
        return heappop(self.heap) if self.heap else -1


class BitmapOfRanks:
    """Ranks in use, best first: a bitmap of 256 ranks a word and one of the words in use, read by find-first-set."""

    def __init__(self, ranks):
        self.words: dict[int, int] = {}
        self.top = 0
        for rank in ranks:
            self.add(rank)

    def add(self, rank: int) -> None:
        word = rank >> 8
        self.words[word] = self.words.get(word, 0) | 1 << (rank & 255)
        self.top |= 1 << word

    def take(self) -> int:
        if not self.top:
            return -1
        word = (self.top & -self.top).bit_length() - 1
        bits = self.words[word]
        bit = bits & -bits
        self.words[word] = bits ^ bit
        if bits == bit:
            self.top ^= 1 << word
        return word << 8 | bit.bit_length() - 1


def merge_all(symbols: np.ndarray, starts: np.ndarray, table: PairTable, rank_of: np.ndarray, queue=HeapOfRanks):
    """(symbols, starts, doubtful) after all merges of the sequences that begin at ``starts`` of ``symbols``.

    Every bucket of the queue holds the positions whose pair has that rank, of all sequences. The best rank is taken, its
    stale positions are skipped, and the others are joined together, of overlapping ones the left one first. For each
    sequence this is the order of a queue of its own, unless joining made a pair of a better or equal rank while others of
    the rank taken were still to come: such sequences are listed in ``doubtful`` and their result must not be used.
    """
    n = len(symbols)
    ends = np.append(starts[1:], n)
    used = starts < ends
    if n == 0:
        return symbols, starts, np.zeros(0, np.int64)
    sym = symbols.astype(np.int32)
    after = np.arange(1, n + 1, dtype=np.int32)
    before = np.arange(-1, n - 1, dtype=np.int32)
    after[ends[used] - 1] = -1
    before[starts[used]] = -1
    doubtful: list[np.ndarray] = []
    alive = np.ones(n, bool)
    rank = np.full(n, NONE, np.int32)  # of the pair that begins here
    first = np.flatnonzero(after >= 0)
    made = table.look_up(sym[first], sym[after[first]])
    first, made = first[made >= 0], made[made >= 0]
    rank[first] = rank_of[made]
    buckets: dict[int, list[np.ndarray]] = {}

    def put(where: np.ndarray, ranks: np.ndarray) -> list[int]:
        order = np.argsort(ranks, kind="stable")
        where, ranks = where[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        bounds, new = [0, *cuts.tolist(), len(ranks)], []
        for i, own in enumerate(ranks[bounds[:-1]].tolist() if len(ranks) else []):
            part = where[bounds[i]:bounds[i + 1]]
            held = buckets.get(own)
            if held is None:
                buckets[own] = [part]
                new.append(own)
            else:
                held.append(part)
        return new

    agenda = queue(put(first, rank[first]))
    while (best := agenda.take()) >= 0:
        parts = buckets.pop(best)
        at = parts[0] if len(parts) == 1 else np.concatenate(parts)
        at = at[rank[at] == best]
        if len(parts) > 1:
            at = np.unique(at)
        if not len(at):
            continue
        if len(at) > 1:
            follows = np.zeros(len(at), bool)
            follows[1:] = after[at[:-1]] == at[1:]
            if follows.any():  # a run of overlapping pairs: every second one from its left end
                index = np.arange(len(at))
                begin = np.maximum.accumulate(np.where(follows, 0, index))
                at = at[(index - begin) % 2 == 0]
        gone = after[at]
        sym[at] = table.look_up(sym[at], sym[gone])
        alive[gone] = False
        rank[gone] = NONE
        then = after[gone]
        after[at] = then
        inner = then >= 0
        before[then[inner]] = at[inner]
        left = before[at]
        start = np.concatenate([at[inner], left[left >= 0]])
        rank[at] = NONE
        if not len(start):
            continue
        joined = table.look_up(sym[start], sym[after[start]])
        own = np.where(joined >= 0, rank_of[joined], NONE)
        rank[start] = own
        start, own = start[joined >= 0], own[joined >= 0]
        if len(own):
            early = own <= best
            if early.any():
                doubtful.append(start[early])
            for new in put(start, own):
                agenda.add(new)
    kept = np.flatnonzero(alive)
    if doubtful:
        spots = np.unique(np.searchsorted(starts, np.concatenate(doubtful), side="right") - 1)
    else:
        spots = np.zeros(0, np.int64)
    return sym[kept], np.searchsorted(kept, starts), spots


class Remembered:
    """Results by string, in two generations: a full young one becomes the old one, and what is used again moves back.

    ``make_all`` gives the results of many strings at once. Long strings are forgotten after use.
    """

    def __init__(self, make_all: Callable[[list[str]], Sequence[bytes]], size: int = CACHE):
        self._make_all, self._size = make_all, size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __len__(self) -> int:
        return len(self.young)

    def forget(self) -> None:
        self.young, self.old = {}, {}

    def joined(self, lists: Sequence[list[str]]) -> list[bytes]:
        """The results of the strings of each list, one after the other."""
        young = self.young
        new = set().union(*lists)
        new.difference_update(young)
        again = new.intersection(self.old)
        young.update((x, self.old[x]) for x in again)
        rest = list(new.difference(again))
        young.update(zip(rest, self._make_all(rest)))
        out = [b"".join(map(young.__getitem__, x)) for x in lists]
        for long in (x for x in rest if len(x) > LONGEST):
            del young[long]
        if len(young) >= self._size:
            self.old, self.young = young, {}
        return out


def slices(texts: Sequence[str]) -> Iterator[Sequence[str]]:
    """Runs of texts of about SLICE characters; a longer text comes alone."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > SLICE:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def packed(symbols: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """Each sequence as little-endian unsigned 32-bit integers."""
    raw, bounds = symbols.astype("<u4").tobytes(), [*(starts * 4).tolist(), 4 * len(symbols)]
    return [raw[a:b] for a, b in zip(bounds, bounds[1:])]


class Strings:
    """Byte strings by number, put together for whole arrays of numbers."""

    def __init__(self, strings: Sequence[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.size = np.array([len(x) for x in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def joined(self, numbers: np.ndarray) -> bytes:
        """The strings of ``numbers`` one after the other, a slice at a time."""
        return b"".join(map(self._joined, (numbers[i:i + SLICE] for i in range(0, len(numbers), SLICE))))

    def _joined(self, numbers: np.ndarray) -> bytes:
        size = self.size[numbers]
        end = np.cumsum(size)
        spot = np.repeat(self.start[numbers] - end + size, size)
        spot += np.arange(len(spot))
        return self.flat[spot].tobytes()

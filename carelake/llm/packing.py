"""Packing pieces into sequences of a fixed capacity by swap-based local search."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import TEXT_BATCH_BYTES, drop_others, give_back, materialize

#: Pieces packed together in one task; groups are dealt at random, so each sees all lengths.
GROUP_PIECES = 40_000


def _best_fit(order: list[int], size: list[int], capacity: int) -> tuple[list[list[int]], list[int]]:
    """Largest first, each into the fullest bin with room; an integer's bits mark the free sizes in use."""
    bins: list[list[int]] = []
    free: list[int] = []
    with_free = defaultdict(list)
    marks = 0
    for i in order:
        rest = marks >> size[i]
        if rest:
            f = size[i] + (rest & -rest).bit_length() - 1
            at = with_free[f].pop()
            if not with_free[f]:
                marks &= ~(1 << f)
        else:
            at, f = len(bins), capacity
            bins.append([])
            free.append(capacity)
        bins[at].append(i)
        free[at] = f - size[i]
        if free[at]:
            with_free[free[at]].append(at)
            marks |= 1 << free[at]
    return bins, free


def _bits(marks: int) -> list[int]:
    """Places of the bits that are set."""
    out = []
    while marks:
        low = marks & -marks
        out.append(low.bit_length() - 1)
        marks ^= low
    return out


class _Search:
    """Moves, one-for-one and two-for-one exchanges between underfull bins; each makes the sum of squared fills larger.

    Tokens flow from a source to a target: one or two items for none, one or two of the target's
    (not two for two, nor two for none).  A flow of d <= free raises the squares when the target
    becomes fuller than the source was.  Full bins can take no part.
    """

    def __init__(self, bins: list[list[int]], free: list[int], size: list[int], capacity: int):
        self.bins, self.free, self.size, self.capacity = bins, free, size, capacity
        self.room: dict[int, set[int]] = defaultdict(set)  # free -> bins
        self.holders: dict[tuple, set[int]] = defaultdict(set)  # (free, how many items, their total) -> bins
        self.marks = {1: defaultdict(int), 2: defaultdict(int)}  # free -> bits of the totals that bins hold
        self.clock = 0
        self.stamp: dict[int, int] = defaultdict(int)  # free -> when a bin last came to it
        self.seen: dict[tuple, int] = {}  # (fill, totals) -> when such a bin was last tried in vain
        for at in range(len(bins)):
            self.index(at)

    def _totals(self, at: int) -> tuple[int, int]:
        """Totals of one and of two of a bin's items, as bits of an integer."""
        one = two = 0
        for i in self.bins[at]:
            two |= one << self.size[i]
            one |= 1 << self.size[i]
        return one, two

    def index(self, at: int) -> None:
        f = self.free[at]
        if not f or not self.bins[at]:
            return
        self.room[f].add(at)
        for many, totals in enumerate(self._totals(at), 1):
            self.marks[many][f] |= totals
            for t in _bits(totals):
                self.holders[f, many, t].add(at)

    def unindex(self, at: int) -> None:
        f = self.free[at]
        if at not in self.room[f]:
            return
        self.room[f].discard(at)
        for many, totals in enumerate(self._totals(at), 1):
            for t in _bits(totals):
                held = self.holders[f, many, t]
                held.discard(at)
                if not held:
                    del self.holders[f, many, t]
                    self.marks[many][f] &= ~(1 << t)

    def _items(self, at: int, many: int, total: int) -> list[int]:
        """``many`` items of the bin that make ``total``."""
        if not many:
            return []
        seen: dict[int, int] = {}
        for i in self.bins[at]:
            if many == 1 and self.size[i] == total:
                return [i]
            if many == 2 and total - self.size[i] in seen:
                return [seen[total - self.size[i]], i]
            seen[self.size[i]] = i
        raise AssertionError("index out of date")

    def _exchange(self, source: int, given: list[int], target: int, taken: list[int]) -> None:
        self.unindex(target)
        flow = sum(self.size[i] for i in given) - sum(self.size[i] for i in taken)
        self.bins[source] = [i for i in self.bins[source] if i not in given] + taken
        self.bins[target] = [i for i in self.bins[target] if i not in taken] + given
        self.free[source] += flow
        self.free[target] -= flow
        self.clock += 1
        self.stamp[self.free[target]] = self.clock
        self.index(target)

    def step(self, source: int) -> bool:
        """The largest flow out of ``source`` (not indexed now) into the fullest bin that allows one."""
        fill = self.capacity - self.free[source]
        ones, twos = state = self._totals(source)
        since = self.seen.get((fill, state), -1)
        offers = [(1, a) for a in _bits(ones)] + [(2, a) for a in _bits(twos)]
        for f in sorted(f for f, x in self.room.items() if x and self.stamp[f] > since):
            least = max(1, fill - (self.capacity - f) + 1)
            best = (least - 1,)
            for many, a in offers:
                if many == 1 and best[0] < a <= f:
                    best = (a, many, a, 0, 0)
                low = max(1, a - f)
                for back in (1, 2) if many == 1 else (1,):
                    fitting = self.marks[back][f] >> low
                    if fitting:
                        total = low + (fitting & -fitting).bit_length() - 1
                        if a - total > best[0]:
                            best = (a - total, many, a, back, total)
            if len(best) > 1:
                _, many, a, back, total = best
                target = next(iter(self.holders[f, back, total] if back else self.room[f]))
                self._exchange(source, self._items(source, many, a), target, self._items(target, back, total))
                return True
        self.seen[fill, state] = self.clock
        return False

    def run(self) -> None:
        """Passes over all underfull bins, emptiest first, until one changes nothing."""
        changed = True
        while changed:
            changed = False
            for source in sorted((at for own in self.room.values() for at in own), key=lambda at: (-self.free[at], at)):
                if not self.free[source] or not self.bins[source]:
                    continue
                self.unindex(source)
                moved = False
                while self.bins[source] and self.step(source):
                    moved = True
                self.index(source)
                if moved:
                    changed = True
                    self.clock += 1
                    self.stamp[self.free[source]] = self.clock


def pack_sizes(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in the bin) of each size; bins are numbered from 0 without gaps."""
    size = [int(s) for s in sizes]
    bins, free = _best_fit(sorted(range(len(size)), key=size.__getitem__, reverse=True), size, capacity)
    _Search(bins, free, size, capacity).run()
    bin_of, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    for number, own in enumerate(b for b in bins if b):
        at = 0
        for i in own:
            bin_of[i], offset[i] = number, at
            at += size[i]
    return bin_of, offset


def pack(pieces: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """``pieces`` plus sequence_id and offset (place in the sequence, gapless from 0).

    Lengths lie between 1 and ``capacity``.  A piece that fills a sequence alone passes
    straight through; the others are dealt at random into groups of about GROUP_PIECES,
    written once, and each group is packed in one task: best fit first, then moves and
    exchanges until none raises the squared fill.  An empty table gives no rows.
    """
    pieces = pieces.select([c for c in pieces.columns if c.lower() not in ("sequence_id", "offset", "_group", "_id")])
    stored = materialize(pieces, "pieces", TEXT_BATCH_BYTES)
    part = stored.filter(F.col(length) < capacity)
    groups = max(1, -(-part.count() // GROUP_PIECES))
    names = pieces.columns

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        drop_others("packing")
        bin_of, offset = pack_sizes(pdf[length].to_numpy(), capacity)
        give_back()
        pdf = pdf.assign(sequence_id=pdf["_group"].astype("int64") * (1 << 32) + bin_of, offset=offset)
        return pdf[[*names, "sequence_id", "offset"]]

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    dealt = part.withColumn("_group", (F.rand(3) * groups).cast("int"))
    packed = dealt.groupBy("_group").applyInPandas(run, f"{kinds}, sequence_id long, offset long")
    full = stored.filter(F.col(length) >= capacity).select(
        *names, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full)

"""Bin completion: packing a histogram of sizes into as few bins as can be found.

The largest size left gets a bin, and the bin its fillings, of any number of
items: those that waste least first, and of equal waste those with the largest
items.  A filling is passed over if another dominates it: if items of it could
be exchanged for one larger item, or several for one of their sum, that is left.
A filling is used as often as the counts allow, and then less often.  The search
goes depth first; a branch ends when its waste or the lower bound of what is
left can't beat the incumbent any more, and what is left is never searched twice.
The first incumbent is best-fit decreasing.  Without the limit of NODES fillings
the result is optimal.

The work depends on the number of different sizes, at most ``capacity``, and not
on the number of items.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np

Pattern = tuple[tuple[int, ...], int]  # sizes in one bin, and the number of such bins

NODES = 50_000


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: by volume, and by items that can't share a bin.

    For a threshold k the items over capacity - k need a bin each, those over
    half of it too, and the items of k and more fill what the latter leave.
    """
    sizes = np.arange(capacity + 1)
    n, volume = np.cumsum(counts), np.cumsum(counts * sizes)
    k = np.arange(capacity // 2 + 1)
    alone = n[capacity] - n[capacity - k]
    middle_n = n[capacity - k] - n[capacity // 2]
    middle = volume[capacity - k] - volume[capacity // 2]
    small = volume[capacity // 2] - np.where(k > 0, volume[np.maximum(k - 1, 0)], 0)
    rest = small - (middle_n * capacity - middle)
    return max(-(-int(volume[-1]) // capacity), int((alone + middle_n + np.maximum(0, -(-rest // capacity))).max()))


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing, many equal items at a time."""
    room: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]
    open_ = np.zeros(capacity + 1, bool)
    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            fits = np.flatnonzero(open_[size:])
            if len(fits):
                rest = size + int(fits[0])
                pattern, bins = room[rest].popitem()
                used = min(left, bins)
                if bins > used:
                    room[rest][pattern] = bins - used
                open_[rest] = bool(room[rest])
            else:
                each = capacity // size
                pattern, rest, used = (), capacity, max(1, left // each)
                items = min(left, each) if used == 1 else each
                pattern, rest = (size,) * (items - 1), capacity - size * (items - 1)
                left -= used * (items - 1)
            grown, rest = pattern + (size,), rest - size
            room[rest][grown] = room[rest].get(grown, 0) + used
            open_[rest] = True
            left -= used
    return [(pattern, bins) for held in room for pattern, bins in held.items()]


class Sums:
    """Sizes in rising order, and the sums that the items up to each of them make, as bits.

    Counts change little from one look to the next: what smaller sizes than the
    first changed one make is taken over.
    """

    def __init__(self, capacity: int) -> None:
        self.most = capacity // np.maximum(np.arange(capacity + 1), 1)
        self.useful = np.zeros(capacity + 1, np.int64)
        self.sizes, self.made, self.there = array("i"), [], 0

    def of(self, counts: np.ndarray) -> tuple[array, list[int], int]:
        """The sizes; the sums, which end where all are made; and the set of sizes as bits."""
        useful = np.minimum(counts, self.most)
        changed = np.flatnonzero(useful != self.useful)
        if len(changed):
            made = self.made[: bisect_left(self.sizes, int(changed[0]))]
            sizes, numbers = array("i", np.flatnonzero(useful).tolist()), useful.tolist()
            sums, all_sums = made[-1] if made else 1, (1 << len(useful)) - 1
            for size in sizes[len(made) :]:
                if sums == all_sums:
                    break
                left, step = numbers[size], 1
                while left:
                    some = min(step, left)
                    sums |= sums << some * size & all_sums
                    left, step = left - some, 2 * step
                made.append(sums)
            there = int.from_bytes(np.packbits(useful > 0, bitorder="little").tobytes(), "little")
            self.useful, self.sizes, self.made, self.there = useful, sizes, made, there
        return self.sizes, self.made, self.there

    def makes(self, counts: np.ndarray, total: int) -> bool:
        _, made, _ = self.of(counts)
        return bool(made and made[-1] >> total & 1)


def dominated(items: tuple[int, ...], waste: int, others: int) -> bool:
    """Whether an item of ``others``, a set of sizes as bits, can take the place of some of ``items``.

    It must be larger than the one item it replaces, or as large as several
    together, and fit with the waste.
    """
    none, one, several = 1, 0, 0
    for size in items:
        several |= (one | several) << size
        one |= none << size
    fewer = none | one

    def raised(sums: int, by: int) -> int:
        """The sums with 0 to ``by`` more."""
        done = 0
        while done < by:
            step = min(done + 1, by - done)
            sums |= sums << step
            done += step
        return sums

    larger = raised(fewer, waste - 1) << 1 if waste else 0
    return bool((larger | raised(several, waste)) & others)


def fillings(counts: np.ndarray, room: int, sums: Sums | None = None) -> Iterator[tuple[tuple[int, ...], bool]]:
    """All fillings of ``room``, least waste first, of equal waste the largest items first.

    With each, whether it is dominated.  ``counts`` must be the same whenever the
    next one is asked for.
    """
    sums = sums or Sums(len(counts) - 1)
    fitting = bisect_right(sums.of(counts)[0], room)
    there = sums.there & (1 << room + 1) - 1

    def exactly(last: int, total: int) -> Iterator[tuple[int, ...]]:
        if not total:
            yield ()
            return
        sizes, made, _ = sums.of(counts)
        first = bisect_left(made, 1, key=lambda some: some >> total & 1)
        for i in range(last, first - 1, -1):
            size = sizes[i]
            for n in range(min(int(counts[size]), total // size), 0, -1):
                smaller = made[min(i, len(made)) - 1] if i else 1
                if smaller >> total - n * size & 1:
                    # A search that waits holds no sums: there may be thousands of them.
                    sizes = made = smaller = None
                    for rest in exactly(i - 1, total - n * size):
                        yield (size,) * n + rest
                    sizes, made, _ = sums.of(counts)

    for waste in range(room + 1):
        if waste == room or sums.makes(counts, room - waste):
            for items in exactly(fitting - 1, room - waste):
                gone = sum(1 << size for size in set(items) if items.count(size) == counts[size])
                yield items, dominated(items, waste, there & ~gone)


def pack(counts: np.ndarray, capacity: int, nodes: int = NODES) -> list[Pattern]:
    """Patterns that together hold ``counts[size]`` items of every size up to capacity.

    At most ``nodes`` fillings are looked at.
    """
    counts = counts.astype(np.int64)
    total = int((counts * np.arange(capacity + 1)).sum())
    best = best_fit(counts, capacity)
    fewest, bound = sum(n for _, n in best), lower_bound(counts, capacity)
    left, trail, bins, waste = counts.copy(), [], 0, 0
    searched: set[bytes] = set()
    sums = Sums(capacity)

    def children() -> Iterator[tuple[Pattern, bool]]:
        """Patterns of the largest size left and how often to use each, most often first;
        and whether only the look at it counts.  ``left`` is the same at each step."""
        largest = int(np.flatnonzero(left)[-1])
        others = left.copy()
        others[largest] -= 1
        for items, worse in fillings(others, capacity - largest, sums):
            pattern = (largest, *items)
            if worse:
                yield (pattern, 0), True
                continue
            sizes, uses = np.unique(pattern, return_counts=True)
            times, spare = int((left[sizes] // uses).min()), capacity - sum(pattern)
            if spare:
                times = max(1, min(times, ((fewest - 1) * capacity - total - waste) // spare))
            for n in range(times, 0, -1):
                yield (pattern, n), False

    frames = [children()] if total else []
    while frames and fewest > bound and nodes > 0:
        nodes -= 1
        (pattern, times), passed = next(frames[-1], (((), 0), False))
        spare = capacity - sum(pattern)
        # Later fillings waste as much or more, so too much waste ends the frame.
        over = waste + max(times, 1) * spare > (fewest - 1) * capacity - total
        if not pattern or (over and times <= 1):
            frames.pop()
            if trail:
                pattern, times = trail.pop()
                np.add.at(left, list(pattern), times)
                bins, waste = bins - times, waste - times * (capacity - sum(pattern))
            continue
        if passed or over:
            continue
        np.subtract.at(left, list(pattern), times)
        state = hashlib.blake2b(left.tobytes(), digest_size=16).digest()
        if not left.any():
            best, fewest = [*trail, (pattern, times)], bins + times
        elif state not in searched and bins + times + lower_bound(left, capacity) < fewest:
            searched.add(state)
            trail.append((pattern, times))
            bins, waste = bins + times, waste + times * spare
            frames.append(children())
            continue
        np.add.at(left, list(pattern), times)
    return best

"""Suffix arrays of short byte strings, to a fixed depth.

The strings lie end to end.  A suffix counts if ``depth`` bytes of its string
are left.  Sorting follows Larsson and Sadakane: suffixes are sorted by eight
bytes, then groups that are still together are refined by the ranks of the
suffixes further on, which doubles the depth each time; suffixes that stand alone
are left as they are.  Common prefixes follow Kasai, for all strings at once.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


def packed(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one big-endian number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(U64)
    out = np.zeros(len(data), U64)
    for k in range(8):
        out = out << U64(8) | padded[k : k + len(data)]
    return out


def remaining(sizes: np.ndarray) -> np.ndarray:
    """Bytes from every place to the end of its string."""
    ends = np.cumsum(sizes)
    return np.repeat(ends, sizes) - np.arange(ends[-1] if len(ends) else 0)


def suffix_array(keys: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Places with ``depth`` bytes left, sorted by these bytes."""
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    begins = np.empty(n, bool)
    begins[:1] = True
    begins[1:] = sorted_keys[1:] != sorted_keys[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    reached = 8
    while reached < depth:
        step = min(reached, depth - reached)
        # Slots of groups of two and more, of which only suffixes that are long enough matter.
        alone = begins & np.append(begins[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        places = order[slots]
        long = left[places] >= reached + step
        group = rank[places]
        second = np.where(long, rank[np.minimum(places + step, n - 1)], -1)
        again = np.lexsort((second, group))
        places, group, second = places[again], group[again], second[again]
        order[slots] = places
        fresh = np.empty(len(slots), bool)
        fresh[:1] = True
        fresh[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        begins[slots] = fresh
        rank[places] = np.maximum.accumulate(np.where(fresh, slots, 0))
        reached += step
    return order[left[order] >= depth]


def common_prefixes(data: np.ndarray, keys: np.ndarray, sizes: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For every suffix of ``order``, the bytes it shares with the one before, at most ``depth``.

    A string's suffixes follow each other, and the length carries over less one
    byte, where the suffix after the neighbour is sorted before the next one.
    """
    slot = np.full(len(data) + 1, -1, np.int64)
    slot[order] = np.arange(len(order))
    out = np.zeros(len(order), np.int64)
    keys = np.concatenate([keys, np.zeros(8, U64)])
    counts = np.maximum(sizes - depth + 1, 0)
    starts = np.cumsum(sizes) - sizes
    lanes = np.flatnonzero(counts)
    shared = np.zeros(len(sizes), np.int64)
    neighbour = np.full(len(sizes), -1, np.int64)
    t = 0
    while len(lanes):
        here = starts[lanes] + t
        at = slot[here]
        carried = slot[neighbour[lanes] + 1]
        keep = (neighbour[lanes] >= 0) & (carried >= 0) & (carried < at)
        h = np.where(keep, np.maximum(shared[lanes] - 1, 0), 0)
        other = np.where(at > 0, order[np.maximum(at - 1, 0)], -1)
        going = np.flatnonzero(other >= 0)
        while len(going):
            a, b, reach = here[going], other[going], h[going]
            differ = keys[a + reach] ^ keys[b + reach]
            more = np.where(differ == 0, 8, 0)
            for k in (4, 2, 1):
                part = (differ != 0) & (differ >> U64(64 - 8 * k) == 0)
                more += np.where(part, k, 0)
                differ = np.where(part, differ << U64(8 * k), differ)
            h[going] = np.minimum(reach + more, depth)
            going = going[(more == 8) & (h[going] < depth)]
        h[other < 0] = 0
        out[at] = h
        shared[lanes], neighbour[lanes] = h, other
        t += 1
        lanes = lanes[counts[lanes] > t]
    return out

"""One probe set against many: a prefix tree over globally ordered sets.

A set is an ascending array of 64-bit order keys. Sorting the sets makes
every subtree of their prefix tree a range, and the edge below a node the
stretch its first and last set have in common; so the tree is walked as
ranges, without building nodes. The probe's overlap with an edge is computed
once for all sets below it. A subtree is left as soon as the overlap so far
plus what can still come - from the longest set below, or from the rest of
the probe - is less than the least overlap a link needs.
"""

from __future__ import annotations

import numpy as np


def least_overlap(n: int, m: int, part: int, whole: int) -> int:
    """Smallest intersection of sets of sizes n and m with whole * intersection >= part * union."""
    return -(-part * (n + m) // (part + whole))


class PrefixTree:
    """Sets in lexicographic order of their keys."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.members = order
        self.sets = [sets[i] for i in order]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)

    def linked(self, probe: np.ndarray, part: int = 75, whole: int = 100) -> list[int]:
        """Indexes, in the list given, of the sets with whole * |intersection| >= part * |union|."""
        found: list[int] = []
        n = len(probe)
        todo = [(0, len(self.sets), 0, 0)] if self.sets and n else []
        while todo:
            low, high, depth, overlap = todo.pop()
            first, last = self.sets[low], self.sets[high - 1]
            end = depth + common(first[depth:], last[depth:])
            if end > depth:
                edge = first[depth:end]
                at = np.searchsorted(probe, edge)
                overlap += int((probe[np.minimum(at, n - 1)] == edge).sum())
                left = n - int(np.searchsorted(probe, edge[-1], "right"))
            else:
                left = n - int(np.searchsorted(probe, first[depth - 1], "right")) if depth else n
            sizes = self.sizes[low:high]
            longest, shortest = int(sizes.max()), int(sizes.min())
            # n - least_overlap(., n) never falls as n grows, so the longest set decides
            if overlap + longest - end < least_overlap(n, longest, part, whole) or overlap + left < least_overlap(n, shortest, part, whole):
                continue
            while low < high and self.sizes[low] == end:  # sets that end here come first
                if overlap >= least_overlap(n, end, part, whole):
                    found.append(self.members[low])
                low += 1
            if low < high:
                keys = np.array([s[end] for s in self.sets[low:high]], np.uint64)
                edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), high - low]
                todo.extend((low + a, low + b, end, overlap) for a, b in zip(edges[:-1], edges[1:]))
        return found


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix."""
    k = min(len(a), len(b))
    differ = a[:k] != b[:k]
    return int(differ.argmax()) if differ.any() else k

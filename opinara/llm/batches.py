"""Helpers for sequence models inside a task: numbered words, and texts laid side by side in lanes."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from itertools import chain

import numpy as np


class Codes(dict):
    """Numbers words in the order of their first look-up."""

    def __missing__(self, word) -> int:
        self[word] = code = len(self)
        return code

    def of(self, texts: Sequence[Sequence]) -> np.ndarray:
        """The numbers of all words of the texts, one after the other."""
        return np.fromiter(chain.from_iterable(map(self.__getitem__, t) for t in texts), np.int32,
                           sum(map(len, texts)))


class Lanes:
    """Whole sequences, one after another in parallel lanes of about equal length.

    ``place[t, lane]`` is the flat position read at step t (-1: none), ``first``
    and ``last`` mark a sequence's ends, and only the first ``active[t]`` lanes
    still run at step t. The longest sequence bounds the number of lanes, so no
    more steps are made than it needs.
    """

    def __init__(self, lengths: np.ndarray, most: int = 1024):
        lengths = np.asarray(lengths, np.int64)
        total = int(lengths.sum())
        n_lanes = int(min(most, max(1, -(-total // max(1, int(lengths.max(initial=1)))), 1)))
        begin = np.cumsum(lengths) - lengths
        heap = [(0, lane) for lane in range(n_lanes)]
        lane_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for s in np.argsort(-lengths, kind="stable").tolist():
            used, lane = heap[0]
            lane_of[s], offset[s] = lane, used
            heapq.heapreplace(heap, (used + int(lengths[s]), lane))
        ends = np.zeros(n_lanes, np.int64)
        for used, lane in heap:
            ends[lane] = used
        order = np.argsort(-ends, kind="stable")
        new = np.empty(n_lanes, np.int64)
        new[order] = np.arange(n_lanes)
        ends, lane_of = ends[order], new[lane_of]
        steps = int(ends.max(initial=0))
        self.place = np.full((steps, n_lanes), -1, np.int64)
        inner = np.arange(total) - np.repeat(begin, lengths)
        self.place[inner + np.repeat(offset, lengths), np.repeat(lane_of, lengths)] = np.arange(total)
        some = lengths > 0
        self.first = np.zeros(self.place.shape, bool)
        self.first[offset[some], lane_of[some]] = True
        self.last = np.zeros(self.place.shape, bool)
        self.last[offset[some] + lengths[some] - 1, lane_of[some]] = True
        self.active = np.searchsorted(-ends, -np.arange(steps), side="left")


def groups(lengths: np.ndarray, most: int) -> list[np.ndarray]:
    """Sequences of like length together, about ``most`` elements in a group (a longer one stands alone)."""
    order = np.argsort(lengths, kind="stable")
    number = (np.cumsum(lengths[order]) - 1) // most
    return np.split(order, np.flatnonzero(np.diff(number)) + 1) if len(order) else []

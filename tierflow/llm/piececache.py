"""A bounded per-process cache from byte pieces to token ids, looked up and assembled with array operations.

A piece is known by two independent 64-bit hashes: the first finds its place, by an open table with linear probing, the
second must agree with the one kept there. A span whose second hash differs is encoded by itself.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class PieceCache:
    """``encode``: pieces (bytes) to (ids of all in order, number of ids of each). At ``most`` pieces it starts anew."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = 1_000_000, kind=np.uint16):
        self.encode, self.most, self.kind = encode, most, kind
        self._clear()

    def _clear(self) -> None:
        self._table(1 << 16)
        self.ids, self.used = np.zeros(1 << 16, self.kind), 0
        self.starts, self.lens, self.check, self.n = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.uint64), 0

    def _table(self, slots: int) -> None:
        self.slots, self.keys, self.places, self.held = slots, np.zeros(slots, np.uint64), np.full(slots, -1, np.int32), 0

    def _find(self, u: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 for one that is not kept."""
        at = (u & np.uint64(self.slots - 1)).view(np.int64)
        found = self.places[at]
        left = ((found >= 0) & (self.keys[at] != u)).nonzero()[0]  # another hash is there: on to the next slots
        at = at[left]
        while len(left):
            at = (at + 1) & (self.slots - 1)
            found[left] = self.places[at]
            other = ((found[left] >= 0) & (self.keys[at] != u[left])).nonzero()[0]
            left, at = left[other], at[other]
        return found

    def _keep(self, u: np.ndarray, place: np.ndarray) -> None:
        """Takes up distinct hashes that are not kept yet, with their distinct places."""
        if 2 * (self.held + len(u)) > self.slots:
            used = self.places >= 0
            u, place = np.concatenate((self.keys[used], u)), np.concatenate((self.places[used], place))
            self._table(1 << (4 * len(u) - 1).bit_length())
        self.held += len(u)
        at, place = (u & np.uint64(self.slots - 1)).view(np.int64), place.astype(np.int32)
        while len(u):
            free = self.places[at] < 0
            self.places[at[free]] = place[free]
            lost = self.places[at] != place  # taken before, or by another of these
            self.keys[at[~lost]] = u[~lost]
            u, place, at = u[lost], place[lost], (at[lost] + 1) & (self.slots - 1)

    def _add(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, check: np.ndarray) -> np.ndarray:
        ids, lens = self.encode([raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while self.n + len(lens) > len(self.lens):
            self.starts, self.lens, self.check = (np.concatenate((x, np.zeros_like(x))) for x in (self.starts, self.lens, self.check))
        self.ids[self.used : self.used + len(ids)] = ids
        places = np.arange(self.n, self.n + len(lens))
        self.lens[places] = lens
        self.check[places] = check
        self.starts[places] = self.used + np.cumsum(lens) - lens
        self.used, self.n = self.used + len(ids), self.n + len(lens)
        return places

    def tokens(self, raw: bytes, keys: list[np.ndarray], starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in order, number of ids of each piece) of the spans of ``raw``; ``keys``: both hashes of each."""
        hashes, check = keys
        if not len(hashes):
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        if self.n > self.most:
            self._clear()
        place = self._find(hashes)
        miss = (place < 0).nonzero()[0]
        if len(miss):
            u, first, back = np.unique(hashes[miss], return_index=True, return_inverse=True)
            at = miss[first]
            new = self._add(raw, starts[at], ends[at], check[at])
            self._keep(u, new)
            place[miss] = new[back]
        other = np.flatnonzero(self.check[place] != check)
        if len(other):
            place[other] = self._add(raw, starts[other], ends[other], check[other])
        lens = self.lens[place].astype(np.int64)
        ends_out = np.cumsum(lens)
        return self.ids[np.repeat(self.starts[place] - (ends_out - lens), lens) + np.arange(ends_out[-1])], lens

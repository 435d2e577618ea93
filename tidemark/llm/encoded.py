"""Tokens of pre-tokens, kept for the pre-tokens that come again.

A worker keeps the tokens of the pre-tokens it has met, so a frequent one is merged once.
What is kept is bounded: beyond KEPT entries the store starts anew, which costs time but
changes no result.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

from tidemark.llm.arrays import ranges

KEPT = 400_000
LONGEST = 64  # longer pre-tokens are not kept beyond their slice


class Store:
    """Token ids by pre-token. `encode(pieces)` gives flat ids and starts (n + 1)."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def set(self, piece: str, ids: list[int]) -> None:
        self.place[piece] = len(self.starts)
        self._append(np.array(ids, np.int32), np.array([0, len(ids)]))

    def _append(self, ids: np.ndarray, starts: np.ndarray) -> None:
        self.starts = np.append(self.starts, starts[:-1] + len(self.ids))
        self.counts = np.append(self.counts, np.diff(starts))
        self.ids = np.append(self.ids, ids)

    def places(self, texts: list[list[str]]) -> np.ndarray:
        """Entry of each pre-token of all texts, one after the other."""
        new = list(set().union(*texts).difference(self.place))
        if new:
            ids, starts = self.encode([p.encode("utf-8", "surrogatepass") for p in new])
            base = len(self.starts)
            self._append(ids, starts)
            self.place.update(zip(new, range(base, base + len(new)), strict=True))
        find = self.place.__getitem__
        return np.fromiter(map(find, chain.from_iterable(texts)), np.int64, sum(map(len, texts)))

    def tokens(self, places: np.ndarray) -> np.ndarray:
        """Token ids of the entries, one after the other."""
        return self.ids[ranges(self.starts[places], self.counts[places])]

    def trim(self) -> None:
        """After a slice: drop what is too long to keep, or all beyond the bound."""
        if len(self.place) > KEPT or len(self.ids) > 8 * KEPT:
            self.clear()
        else:
            for piece in [p for p in self.place if len(p) > LONGEST] if self._long() else []:
                del self.place[piece]

    def _long(self) -> bool:
        return bool(len(self.counts)) and int(self.counts[-min(len(self.counts), 4096) :].max()) > LONGEST // 4

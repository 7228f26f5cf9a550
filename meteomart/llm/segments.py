"""Flat runs of numbers for strings seen before, kept by a worker within a bound.

A text is cut into segments that can be encoded apart; equal segments are encoded
once.  The memo only saves time: what it forgets is encoded again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

MOST_CHARS = 4 << 20
MOST_SEGMENTS = 1 << 19


class Memo:
    """``learn`` turns new segments into rows: one or more lists of equal length a segment."""

    def __init__(self, learn: Callable[[list[str]], list[tuple[list[int], ...]]], columns: int):
        self.learn, self.columns = learn, columns
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.chars = 0
        self.flat = [np.zeros(0, np.int32) for _ in range(self.columns)]
        self.counts = np.zeros(0, np.int64)

    def gather(self, segments: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """The rows of all segments one after the other, column by column, and their lengths."""
        if self.chars > MOST_CHARS or len(self.place) > MOST_SEGMENTS:
            self.forget()
        place = self.place
        codes = list(map(place.get, segments))
        if None in codes:
            new = list(dict.fromkeys(s for s, c in zip(segments, codes, strict=True) if c is None))
            place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
            self.chars += sum(map(len, new))
            rows = self.learn(new)
            self.counts = np.concatenate([self.counts, [len(r[0]) for r in rows]]).astype(np.int64)
            for i in range(self.columns):
                self.flat[i] = np.concatenate([self.flat[i], np.array([x for r in rows for x in r[i]], np.int32)])
            codes = list(map(place.get, segments))
        codes = np.array(codes, np.int64)
        many = self.counts[codes]
        starts = np.concatenate([[0], np.cumsum(self.counts)])[codes]
        off = np.concatenate([[0], np.cumsum(many)])
        take = np.arange(off[-1]) + np.repeat(starts - off[:-1], many)
        return [f[take] for f in self.flat], many


def slices(whole: str, edges: np.ndarray) -> list[str]:
    at = edges.tolist()
    return [whole[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]

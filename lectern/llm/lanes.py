"""Running a byte automaton over many texts at once.

An automaton step depends on the step before, so one text can't be vectorised along its length.  Texts
are cut into blocks, every block is a lane, and one numpy step advances all lanes by one byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class Lanes:
    """Blocks of the texts in a buffer, the longest first."""

    def __init__(self, ends: np.ndarray, block: int):
        sizes = np.diff(ends)
        per_text = -(-sizes // block)
        self.text = np.repeat(np.arange(len(sizes)), per_text)
        within = np.arange(len(self.text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        self.begin = ends[:-1][self.text] + within * block
        size = np.minimum(block, ends[1:][self.text] - self.begin)
        self.first, self.last = within == 0, within == per_text[self.text] - 1
        order = np.argsort(-size, kind="stable")
        self.text, self.begin, self.size = self.text[order], self.begin[order], size[order]
        self.first, self.last = self.first[order], self.last[order]

    def __len__(self) -> int:
        return len(self.text)

    def steps(self, data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each position in a block: how many lanes are that long, and their bytes there."""
        if not len(self):
            return
        longer = np.searchsorted(-self.size, -np.arange(int(self.size[0])), "left")
        at = self.begin.copy()
        for n in longer:
            yield int(n), data[at[:n]]
            at[:n] += 1

"""Logarithmic family of sparse suffix arrays: finds windows that occur in more than one of the pieces it was given."""

from __future__ import annotations

import numpy as np


class Level:
    """Pieces, with their suffixes from the anchor on in order (`right`), their prefixes before it, read backward, in
    order (`left`), and the common lengths of neighbours in either order. Pieces of different groups share nothing."""

    def __init__(self, ids: list[int], right: list[int], left: list[int]):
        self.ids, self.right, self.left = ids, right, left


class SuffixLevels:
    """Takes pieces in batches. Each batch gets suffix arrays and is scanned for equal windows; levels of about one
    size are merged, and a merged level is scanned anew, which finds what its parts have in common. `finish` merges
    what is left, so in the end every two pieces have met in a scan.

    A piece holds `counts` windows of `window` bytes, the first at its start; its anchor, `offsets` bytes in, lies in
    all of them, and windows can be equal only if their anchors stand at the same place.
    """

    def __init__(self, window: int):
        self.window = window
        self.levels: list[Level] = []
        self.groups: list[int] = []
        self.texts: list[bytes] = []
        self.offsets: list[int] = []
        self.counts: list[int] = []
        self.found: list[np.ndarray] = []

    def add(self, groups: list[int], texts: list[bytes], offsets: list[int], counts: list[int]) -> None:
        ids = list(range(len(self.texts), len(self.texts) + len(texts)))
        self.groups += groups
        self.texts += texts
        self.offsets += offsets
        self.counts += counts
        self.found += [np.zeros(n, bool) for n in counts]
        self._push(Level(ids, self._sorted(ids, self._right), self._sorted(ids, self._left)))

    def _right(self, k: int) -> bytes:
        return self.groups[k].to_bytes(8, "big", signed=True) + self.texts[k][self.offsets[k] :]

    def _left(self, k: int) -> bytes:
        return self.groups[k].to_bytes(8, "big", signed=True) + self.texts[k][: self.offsets[k]][::-1]

    @staticmethod
    def _sorted(ids: list[int], key) -> list[int]:
        return sorted(ids, key=key)  # sorted runs are merged, not sorted again

    def _push(self, level: Level) -> None:
        self._scan(level)
        self.levels.append(level)
        while len(self.levels) > 1 and 2 * len(self.levels[-1].ids) > len(self.levels[-2].ids):
            self._merge()

    def _merge(self) -> None:
        b, a = self.levels.pop(), self.levels.pop()
        level = Level(a.ids + b.ids, self._sorted(a.right + b.right, self._right), self._sorted(a.left + b.left, self._left))
        self._scan(level)
        self.levels.append(level)

    def finish(self) -> list[np.ndarray]:
        """For each piece, flags of the windows that another piece has."""
        while len(self.levels) > 1:
            self._merge()
        return self.found

    @staticmethod
    def _common(order: list[int], key, size: int) -> np.ndarray:
        """Common bytes after the group of each of the ordered strings with the one before it; -1 across groups."""
        strings = [key(k) for k in order]
        lengths = np.array([len(s) - 8 for s in strings])
        grid = np.frombuffer(b"".join(s[: size + 8].ljust(size + 8, b"\0") for s in strings), np.uint8).reshape(len(strings), size + 8)
        differ = grid[1:] != grid[:-1]
        first = np.where(differ.any(1), differ.argmax(1), size + 8) - 8
        out = np.full(len(strings), -1, np.int64)
        out[1:] = np.where(first < 0, -1, np.minimum(first, np.minimum(lengths[1:], lengths[:-1])))
        return out

    def _scan(self, level: Level) -> None:
        ids = np.array(level.ids)
        n = len(ids)
        if n < 2:
            return
        row = {k: r for r, k in enumerate(level.ids)}
        offsets = np.array([self.offsets[k] for k in level.ids])
        counts = np.array([self.counts[k] for k in level.ids])
        depth = int(offsets.max()) + 1
        # class of each piece for each count of bytes before the anchor: equal classes, equal bytes
        left = np.zeros((n, depth), np.int64)
        left[[row[k] for k in level.left]] = np.cumsum(self._common(level.left, self._left, depth)[:, None] < np.arange(depth), 0)
        right = np.zeros((n, depth), np.int64)
        right[[row[k] for k in level.right]] = np.cumsum(self._common(level.right, self._right, self.window)[:, None] < self.window - np.arange(depth), 0)
        piece = np.repeat(np.arange(n), counts)
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        before = offsets[piece] - nth  # bytes of the window before the anchor
        key = (right[piece, before] * (n + 1) + left[piece, before]) * depth + before
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        flags = np.zeros(len(key), bool)
        flags[order[1:][same]] = True
        flags[order[:-1][same]] = True
        for k, own in zip(level.ids, np.split(flags, np.cumsum(counts)[:-1]), strict=True):
            self.found[k] |= own

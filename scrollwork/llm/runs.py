"""Log-structured index of 64-bit fingerprints: sorted immutable runs, merge-joined with each batch, then compacted."""

from __future__ import annotations

import numpy as np


class RunIndex:
    """Runs of sorted keys, each with a row of numbers. A batch is looked up in every run by a merge of sorted keys and
    then becomes a run; runs of about one size are merged, so there are as many as the logarithm of the keys.

    Keys of a batch must be new and distinct. Rows can be changed in place (`put`), keys never.
    """

    def __init__(self, width: int):
        self.width = width
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def __len__(self) -> int:
        return sum(len(k) for k, _ in self.runs)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Run and place of each key; run -1 where there is none."""
        run, place = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for k, (own, _) in enumerate(self.runs):
            at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
            hit = own[at] == keys
            run[hit], place[hit] = k, at[hit]
        return run, place

    def rows(self, run: np.ndarray, place: np.ndarray) -> np.ndarray:
        out = np.zeros((len(run), self.width), np.int64)
        for k in np.unique(run[run >= 0]).tolist():
            out[run == k] = self.runs[k][1][place[run == k]]
        return out

    def put(self, run: np.ndarray, place: np.ndarray, column: int, value: int) -> None:
        for k in np.unique(run[run >= 0]).tolist():
            self.runs[k][1][place[run == k], column] = value

    def add(self, keys: np.ndarray, rows: np.ndarray) -> None:
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        self.runs.append((keys[order], rows[order]))
        while len(self.runs) > 1 and 2 * len(self.runs[-1][0]) >= len(self.runs[-2][0]):
            self.compact(2)

    def compact(self, count: int | None = None) -> None:
        """Merges the last `count` runs (all by default) into one."""
        count = count or len(self.runs)
        last = self.runs[-count:]
        if not last:
            return
        keys = np.concatenate([k for k, _ in last])
        order = np.argsort(keys, kind="stable")
        self.runs[-count:] = [(keys[order], np.concatenate([r for _, r in last])[order])]

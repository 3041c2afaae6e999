"""A priority queue of summable messages that keeps a bounded number in memory, for time-forward processing inside one task."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Messages kept in memory (40 bytes each) before the rest goes to a file.
MOST_HELD = 1 << 20


class SpillingQueue:
    """Messages to (level, node) with three summable values, given back by level and in the order of nodes.

    Messages are kept as runs in the order of their nodes, by level; beyond
    ``most`` messages the runs are merged and written to an unnamed file of
    the task's own temporary folder, which goes with the task.
    """

    def __init__(self, most: int = MOST_HELD) -> None:
        self.most, self.held, self.file, self.written = most, 0, None, 0
        self.runs: dict[int, list[np.ndarray]] = {}  # rows (node, children, leaves, saved)
        self.spilled: dict[int, list[np.ndarray]] = {}

    def push(self, level: np.ndarray, node: np.ndarray, values: np.ndarray) -> None:
        if not len(level):
            return
        order = np.lexsort((node, level))
        level, rows = level[order], np.column_stack([node, values])[order]
        for own, lv in zip(np.split(rows, np.flatnonzero(np.diff(level)) + 1), np.unique(level).tolist()):
            run = _summed(own)
            self.runs.setdefault(lv, []).append(run)
            self.held += len(run)
        if self.held > self.most:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for level, runs in self.runs.items():
            run = _merged(runs)
            self.file.seek(self.written)
            self.file.write(run.tobytes())
            self.file.flush()
            self.spilled.setdefault(level, []).append(np.memmap(self.file, np.int64, "r", self.written, run.shape))
            self.written += run.nbytes
        self.runs, self.held = {}, 0

    def pop(self, level: int, upto: int) -> np.ndarray:
        """The messages to nodes of ``level`` up to ``upto``, one row (node, children, leaves, saved) for each node."""
        taken = []
        for store in (self.runs, self.spilled):
            left = []
            for run in store.pop(level, ()):
                at = int(np.searchsorted(run[:, 0], upto, "right"))
                taken.append(np.array(run[:at]))
                self.held -= at if store is self.runs else 0
                if at < len(run):
                    left.append(run[at:])
            if left:
                store[level] = left
        return _merged(taken)

    def __len__(self) -> int:
        return sum(len(run) for store in (self.runs, self.spilled) for runs in store.values() for run in runs)


def _merged(runs: list[np.ndarray]) -> np.ndarray:
    if not runs:
        return np.zeros((0, 4), np.int64)
    rows = np.concatenate(runs)
    return _summed(rows[np.argsort(rows[:, 0], kind="stable")])


def _summed(rows: np.ndarray) -> np.ndarray:
    """Rows in the order of nodes, one for each node."""
    if not len(rows):
        return rows
    first = np.flatnonzero(np.append(True, np.diff(rows[:, 0]) != 0))
    return np.column_stack([rows[first, 0], *(np.add.reduceat(rows[:, i], first) for i in (1, 2, 3))])


# Columns that ``forward`` reads and replaces, as they stand in its rows.
FIELDS = ("level", "node", "up_level", "up_node", "top", "children", "leaves", "saved")


def forward(batches: Iterator[pa.RecordBatch], most: int = MOST_HELD) -> Iterator[pa.RecordBatch]:
    """Totals of subtrees, time forward: rows come by falling level, then node, and every row sends its totals to the one above it.

    A row is a node with values of its own; those without any child are
    leaves.  Rows marked ``top`` have what is above them in another shard and
    send nothing.  The rows come back with children, leaves and saved summed
    over their subtrees within the shard.
    """
    queue = SpillingQueue(most)
    for batch in batches:
        column = {name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False) for name in FIELDS}
        totals = np.column_stack([column["children"], column["leaves"], column["saved"]])
        level, node = column["level"], column["node"]
        cuts = np.flatnonzero(np.diff(level)) + 1
        for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(level)]):
            if first == last:
                continue
            got = queue.pop(int(level[first]), int(node[last - 1]))
            at = first + np.searchsorted(node[first:last], got[:, 0])
            if len(got) and not (at < last).all() or (node[at] != got[:, 0]).any():
                raise ValueError("a message has no node to go to")
            totals[at] += got[:, 1:]
            own = slice(first, last)
            totals[own, 1] += totals[own, 0] == 0
            send = first + np.flatnonzero(~column["top"][own])
            queue.push(column["up_level"][send], column["up_node"][send], np.column_stack([np.ones(len(send), np.int64), totals[send, 1], totals[send, 2]]))
        out = batch
        for i, name in enumerate(("children", "leaves", "saved")):
            out = out.set_column(out.schema.get_field_index(name), name, pa.array(totals[:, i]))
        yield out
    if len(queue):
        raise ValueError("messages are left over")

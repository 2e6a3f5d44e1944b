"""Ordered folds: what a window function cannot say because each row's answer decides what the next one sees.

Rows of a key lie together and in order after one shuffle; a task goes through them once and keeps one small state,
so a key of any length needs no memory and no group is ever gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


def dealt(rows: DataFrame, *key: str) -> DataFrame:
    """All rows of a key in one task, for work in Python that needs them there and cannot tell Spark so.

    By a hash of the key: a repartition by the key itself is left out where the rows already lie by it, and AQE, which
    knows of no need, may then read the branches of a union apart or split a large partition of a join.
    """
    return rows.repartition(F.xxhash64(*key))


def fold(rows: DataFrame, key: list[str], order: list[str], inputs: list[str], step: Callable, out: str, kind: str = "long") -> DataFrame:
    """`rows` with a column more: what `step(state, *inputs)` says for each row in order.

    `step` gets None as the state at the first row of a key and returns (state, value).
    """
    schema = rows.withColumn(out, F.lit(None).cast(kind)).schema
    arrow = to_arrow_type(schema[out].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            said = []
            keys = zip(*(batch.column(c).to_pylist() for c in key), strict=True)
            for k, values in zip(keys, zip(*(batch.column(c).to_pylist() for c in inputs), strict=True), strict=True):
                if k != last:
                    last, state = k, None
                state, value = step(state, *values)
                said.append(value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said, arrow)], names=[*batch.schema.names, out])

    return dealt(rows, *key).sortWithinPartitions(*key, *order).mapInArrow(run, schema)


def by_document(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[pa.Scalar, list[tuple]]]:
    """Each doc_id with its rows, which lie together."""
    doc, rows, kind = None, [], None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for d, *row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", *columns)), strict=True):
            if d != doc:
                if rows:
                    yield pa.scalar(doc, kind), rows
                doc, rows = d, []
            rows.append(tuple(row))
    if rows:
        yield pa.scalar(doc, kind), rows


def expanded(children: dict[str, list], root: str, paths: bool) -> Iterator[tuple]:
    """item, parent, path (if `paths`), depth, is_container, reading order and list of all that `root` holds, depth first and
    each once. `children`: for each parent its children in order, each with whether it is a list.

    One trail of open containers is shared by all, so memory grows with the edges and not with depth times edges.
    """
    leaves, met = 0, {root}
    trail, lists, rest = [root], [None], [iter(children.get(root, ()))]
    while rest:
        for child, is_list in rest[-1]:
            if child in met:
                continue
            met.add(child)
            path = trail.copy() if paths else None
            if child.startswith("#/groups/"):
                inner = lists[-1] or (child if is_list else None)
                yield child, trail[-1], path, len(trail), True, None, inner
                trail.append(child)
                lists.append(inner)
                rest.append(iter(children.get(child, ())))
                break
            yield child, trail[-1], path, len(trail), False, leaves, lists[-1]
            leaves += 1
        else:
            for stack in (trail, lists, rest):
                stack.pop()


def heading_step(state, level, pos):
    """Headings above an item: one closes those of its level and deeper ones."""
    above = state or []
    if level is not None:
        while above and above[-1][0] >= level:
            above.pop()
        above.append((level, pos))
    return above, [p for _, p in above]


def paged_step(target: int) -> Callable:
    """Chunk number: a unit with pages starts a chunk where its first page is another than the chunk's, or where the
    chunk would grow beyond `target`; one without pages never does."""

    def step(state, page, length):
        if state is None:
            return (page, length, 0), 0
        anchor, size, chunk = state
        joined = size + length + (1 if size and length else 0)
        if page is not None and anchor is not None and (page != anchor or joined > target):
            joined, chunk = length, chunk + 1
        return (anchor if page is None else page, joined, chunk), chunk

    return step


def pageless_step(target: int) -> Callable:
    """Chunk number: whole blocks are packed up to `target`; a larger block is split by itself, its larger units alone."""

    def step(state, starts, ends, block, length):
        size, chunk, is_open = state or (0, -1, False)
        if block > target:
            apart = starts or not is_open or size + length + (1 if size and length else 0) > target
            now_open = not (length > target or ends)
        else:
            apart = not is_open or (starts and size + block + (1 if size and block else 0) > target)
            now_open = True
        size = length if apart else size + length + (1 if size and length else 0)
        chunk += apart
        return (size, chunk, now_open), chunk

    return step


def batch_step(most: int, most_characters: int) -> Callable:
    """Batch number: a batch is closed when it is full or would grow beyond `most_characters`."""

    def step(state, length):
        count, size, batch = state or (0, 0, 0)
        if count and (count >= most or size + length > most_characters):
            count, size, batch = 0, 0, batch + 1
        return (count + 1, size + length, batch), batch

    return step

"""Whole groups of rows out of sorted Arrow batches, with bounded memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def dealt(df: DataFrame, key: str = "group") -> DataFrame:
    """The rows of a key side by side in one partition; keys are spread by hash."""
    return df.repartition(key).sortWithinPartitions(key)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str = "group") -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, starts of the groups in them): a group is never cut between two yields.

    Holds one batch and the unfinished group; the callers bound the size of a group.
    """
    held: list[pa.RecordBatch] = []
    last = None

    def ready() -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        return table, np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        if held and keys[0] != last:
            yield ready()
            held = []
        last = keys[-1]
        cut = int(np.searchsorted(keys, last, side="left")) if (np.diff(keys) >= 0).all() else int(np.flatnonzero(keys != last)[-1]) + 1
        if cut:
            held.append(batch.slice(0, cut))
            yield ready()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield ready()


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of n rows with links a-b: the least row that each row is connected with."""
    root = np.arange(n)
    while len(a):
        before = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        np.minimum.at(root, before, root)
        root = root[root]
        if (root == before).all():
            break
    return root

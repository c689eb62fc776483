"""Deduplication and group sizes kept up to date with arriving rows.

The state is one row per item, the one that ``dedup.priority`` would keep of all
rows so far, and one row per (parent, child) with how many items it holds. A batch
is reduced first; then only its items meet the state. Earlier batches are never
read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import col, folded
from . import dedup
from .rules import Levels


def kept_rows(state: DataFrame | None, batch: DataFrame, levels: Levels = Levels(), row_id: str = "row_id", ignore_case: bool = False) -> DataFrame:
    """The state after a batch: equal to ``dedup.priority`` over all rows of all batches.

    The winner of a key is the least row in one order, and the least of two
    parts' least rows is the least of all, so batches may come in any order and
    one may come twice.
    """
    names = [levels.parent, levels.child, levels.item, row_id]
    fresh = dedup.priority(batch.select(*names), levels, row_id, ignore_case)
    return fresh if state is None else dedup.priority(state.select(*names).unionByName(fresh), levels, row_id, ignore_case)


def kept_sizes(
    sizes: DataFrame | None, before: DataFrame | None, after: DataFrame, batch: DataFrame,
    levels: Levels = Levels(), ignore_case: bool = False,
) -> DataFrame:
    """``n`` items per (parent, child) after a batch, from the sizes before it and the rows that changed.

    ``before`` and ``after`` are the states around the batch. Only items of the
    batch can have changed, so only they are counted off and on.
    """
    key = folded(levels.item) if ignore_case else col(levels.item)
    groups = [levels.parent, levels.child]
    touched = batch.select(key.alias("_item")).distinct()

    def part(state: DataFrame, sign: int) -> DataFrame:
        chosen = state.join(touched, key.eqNullSafe(F.col("_item")), "left_semi").dropna(subset=groups)
        return chosen.groupBy(*groups).agg((F.count(F.lit(1)) * sign).alias("n"))

    change = part(after, 1)
    if before is not None:
        change = change.unionByName(part(before, -1))
    if sizes is not None:
        change = change.unionByName(sizes.select(*groups, "n"))
    return change.groupBy(*groups).agg(F.sum("n").alias("n")).where(F.col("n") > 0)

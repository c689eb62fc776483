"""Distinct, keep-first and priority deduplication.

``row_number() = 1`` is pruned inside every map task before the shuffle (the
planner's window group limit), so a key that holds a third of all rows sends
one row per task, not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import col, folded, strip_ws
from .rules import Levels

_RANK = "dedup_rank"


def keep_first(
    df: DataFrame, keys: Sequence[Column | str], order_by: Sequence[Column | str]
) -> DataFrame:
    """First row per key in an explicit order; NULL keys form one group."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def priority(
    df: DataFrame,
    levels: Levels = Levels(),
    row_id: str = "row_id",
    ignore_case: bool = False,
) -> DataFrame:
    """One row per item: the longest child label wins.

    Ties go to the alphabetically first child, then parent, then item text, then
    ``row_id``. This one window equals the chain "exact duplicates, then one row
    per (parent, item), then one row per item".

    Without other columns, copies are first reduced to their smallest ``row_id``
    by a hash aggregate, so only distinct rows are ever sorted.
    """
    names = [levels.parent, levels.child, levels.item]
    if set(df.columns) == {*names, row_id}:
        columns = df.columns
        df = df.groupBy(*names).agg(F.min(row_id).alias(row_id)).select(*columns)
    key = folded(levels.item) if ignore_case else col(levels.item)
    order = [
        F.length(levels.child).desc(), F.col(levels.child), F.col(levels.parent),
        F.col(levels.item), F.col(row_id),
    ]
    return keep_first(df, [key], order)


def drop_missing(df: DataFrame, subset: Sequence[str], text: Sequence[str] = ()):
    """Drop rows with a NULL in ``subset`` or only whitespace in ``text``."""
    out = df.dropna(subset=list(subset))
    for c in text:
        out = out.where(strip_ws(c) != "")
    return out


def losses(df: DataFrame, levels: Levels = Levels()) -> DataFrame:
    """Rows each dedup step removes, in one pass.

    The three distinct counts nest, so each level is grouped from the one below;
    nothing is expanded and every step combines before it shuffles.
    """
    triples = df.groupBy(levels.parent, levels.item, levels.child).agg(
        F.count(F.lit(1)).alias("n")
    )
    pairs = triples.groupBy(levels.parent, levels.item).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("t")
    )
    items = pairs.groupBy(levels.item).agg(
        F.sum("n").alias("n"), F.sum("t").alias("t"), F.count(F.lit(1)).alias("p")
    )
    total = items.agg(
        F.sum("n").alias("n"), F.sum("t").alias("t"), F.sum("p").alias("p"),
        F.count(F.lit(1)).alias("i"),
    )
    return total.select(
        F.coalesce("n", F.lit(0)).alias("input_rows"),
        F.coalesce(F.col("n") - F.col("t"), F.lit(0)).alias("exact_duplicates"),
        F.coalesce(F.col("t") - F.col("p"), F.lit(0)).alias("cross_child_duplicates"),
        F.coalesce(F.col("p") - F.col("i"), F.lit(0)).alias("cross_parent_duplicates"),
        F.col("i").alias("output_rows"),
    )

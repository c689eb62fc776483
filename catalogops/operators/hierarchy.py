"""Group sizes, thin-group collapse and hierarchy quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import word_prefix
from ..sources.stages import stage
from .rules import Levels
from .tables import small_table

# Fixed value: groups with fewer items than this are thin.
MIN_ITEMS = 8


# Rows that one row stands for, in tables already grouped by (parent, child).
WEIGHT = "n_rows"


def _rows(df: DataFrame) -> Column:
    return F.sum(WEIGHT) if WEIGHT in df.columns else F.count(F.lit(1))


def group_sizes(df: DataFrame, levels: Levels = Levels()) -> DataFrame:
    """``n`` rows per (parent, child); NULL groups are left out."""
    present = df.dropna(subset=[levels.parent, levels.child])
    return present.groupBy(levels.parent, levels.child).agg(_rows(df).alias("n"))


def rollup(df: DataFrame, min_items: int = MIN_ITEMS, levels: Levels = Levels()) -> DataFrame:
    """``(parent, child, level, n, n_children, n_thin)`` of every pair, every parent and the whole.

    ``level`` is the grouping id: 0 for a pair, 1 for a parent, 3 for the whole, so
    a NULL value stays apart from a level that is summed up. ``n_thin`` counts
    children below ``min_items`` rows. Rows are counted by pair first; one expand
    and one shuffle then work on group sizes only.
    """
    pairs = df.groupBy(levels.parent, levels.child).agg(_rows(df).alias("n"))
    return pairs.rollup(levels.parent, levels.child).agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("n_children"),
        F.count_if(F.col("n") < min_items).alias("n_thin"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.dropna(subset=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column)


def thin_groups(
    df: DataFrame, min_items: int = MIN_ITEMS, levels: Levels = Levels()
) -> DataFrame:
    return group_sizes(df, levels).where(F.col("n") < min_items)


def largest_child(sizes: DataFrame, levels: Levels = Levels()) -> DataFrame:
    """Largest child per parent, ties to the alphabetically first."""
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col(levels.child).alias("c")))
    return sizes.groupBy(levels.parent).agg(best.alias("best")).select(
        levels.parent,
        F.col("best.c").alias(levels.child),
        (-F.col("best.m")).alias("n"),
    )


def collapse_targets(
    sizes: DataFrame, min_items: int = MIN_ITEMS, levels: Levels = Levels()
) -> DataFrame:
    """``(parent, child, moved_to)`` for every group that collapses.

    Closed form of the pass-by-pass procedure: with a fat sibling, thin groups
    join the largest fat one; without, all end in the alphabetically last child;
    a single child stays. Works on group sizes only.
    """
    fat = F.when(
        F.col("n") >= min_items,
        F.struct((-F.col("n")).alias("m"), F.col(levels.child).alias("c")),
    )
    per_parent = sizes.groupBy(levels.parent).agg(
        F.min(fat).alias("fat"), F.max(levels.child).alias("last")
    ).select(levels.parent, F.coalesce("fat.c", "last").alias("moved_to"))
    thin = sizes.where(F.col("n") < min_items).select(levels.parent, levels.child)
    return thin.join(per_parent, levels.parent).where(
        F.col(levels.child) != F.col("moved_to")
    )


def collapse_thin(
    df: DataFrame, min_items: int = MIN_ITEMS, levels: Levels = Levels()
) -> DataFrame:
    """Move the rows of thin groups into a sibling; see :func:`collapse_targets`.

    The moves are staged, so the planner sees their size: a small table is
    broadcast and the data is not shuffled; a large one is joined by key.
    """
    sizes = stage(group_sizes(df, levels), "group-sizes")
    moves = stage(collapse_targets(sizes, min_items, levels), "collapse-moves")
    columns = df.columns
    joined = df.join(moves, [levels.parent, levels.child], "left")
    child = F.coalesce("moved_to", levels.child).alias(levels.child)
    return joined.select(*[child if c == levels.child else F.col(c) for c in columns])


def _violations(df: DataFrame, check: str, key: Column, sample: Column) -> DataFrame:
    return df.groupBy(key.alias("key")).agg(
        _rows(df).alias("n"), F.min(sample).alias("sample")
    ).select(F.lit(check).alias("check"), "key", "n", "sample")


def outside_closed_set(df: DataFrame, allowed: DataFrame, levels: Levels = Levels()):
    """Parents that the closed list ``allowed(value)`` does not hold."""
    bad = df.dropna(subset=[levels.parent]).join(
        allowed, F.col(levels.parent) == allowed["value"], "left_anti"
    )
    return _violations(bad, "closed_set", F.col(levels.parent), F.col(levels.child))


def child_under_many_parents(df: DataFrame, levels: Levels = Levels()) -> DataFrame:
    return _spread(df, "unique_child", F.col(levels.child), levels.parent)


def item_under_many_parents(df: DataFrame, levels: Levels = Levels()) -> DataFrame:
    """Items placed under more than one (parent, child)."""
    place = F.concat_ws(" > ", levels.parent, levels.child)
    return _spread(df.withColumn("place", place), "multi_parent", F.col(levels.item), "place")


def format_duplicates(df: DataFrame, levels: Levels = Levels()) -> DataFrame:
    """Child names equal up to case and ``And`` / ``&``."""
    return _spread(df, "format_dups", format_key(levels.child), levels.child)


def format_key(c: str) -> Column:
    return F.regexp_replace(F.lower(F.col(c)), r"\band\b", "&")


def _spread(df: DataFrame, check: str, key: Column, value: str) -> DataFrame:
    """Keys with more than one distinct ``value``.

    Distinct (key, value) first: a hot key shrinks to its distinct values
    inside the map tasks.
    """
    distinct = df.select(key.alias("key"), F.col(value).alias("v")).dropna().distinct()
    return distinct.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("sample")
    ).where("n > 1").select(F.lit(check).alias("check"), "key", "n", "sample")


def forbidden_children(df: DataFrame, names: DataFrame, levels: Levels = Levels()):
    """Children carrying a forbidden name, such as that of a parent."""
    bad = df.join(names, F.col(levels.child) == names["value"], "left_semi")
    return _violations(bad, "forbidden_child", F.col(levels.child), F.col(levels.parent))


def entity_children(df: DataFrame, words: Sequence[str], levels: Levels = Levels()):
    """Children named after a kind of business rather than a kind of item."""
    bad = df.where(word_prefix(levels.child, words))
    return _violations(bad, "entity_child", F.col(levels.child), F.col(levels.parent))


def service_children(
    df: DataFrame, service_parents: Sequence[str], word: str = "services?", levels: Levels = Levels()
) -> DataFrame:
    """Service children outside the parents meant for services."""
    bad = df.where(
        F.lower(levels.child).rlike(rf"{word}\b") & ~F.col(levels.parent).isin(*service_parents)
    )
    return _violations(bad, "service_child", F.col(levels.child), F.col(levels.parent))


def forbidden_pairs(df: DataFrame, pairs: DataFrame, levels: Levels = Levels()):
    """Rows under a (parent, child) pair listed in ``pairs(parent, child)``."""
    bad = df.join(
        pairs,
        (F.col(levels.parent) == pairs["parent"]) & (F.col(levels.child) == pairs["child"]),
        "left_semi",
    )
    key = F.concat_ws(" > ", levels.parent, levels.child)
    return _violations(bad, "forbidden_pairs", key, F.col(levels.item))


def thin_violations(df: DataFrame, min_items: int = MIN_ITEMS, levels: Levels = Levels()):
    thin = thin_groups(df, min_items, levels)
    key = F.concat_ws(" > ", levels.parent, levels.child)
    return thin.select(
        F.lit("thin_group").alias("check"), key.alias("key"), "n", F.col(levels.child).alias("sample")
    )


def check(
    df: DataFrame,
    closed_set: Sequence[str],
    forbidden: Sequence[str],
    pairs: Sequence[tuple[str, str]],
    entity_words: Sequence[str],
    service_parents: Sequence[str],
    min_items: int = MIN_ITEMS,
    levels: Levels = Levels(),
) -> DataFrame:
    """All checks as one ``(check, key, n, sample)`` table.

    The data is read twice: once grouped by (parent, child), which serves every
    check but the one on items.
    """
    spark = df.sparkSession
    items = df.select(levels.parent, levels.child, levels.item)
    groups = items.groupBy(levels.parent, levels.child).agg(
        F.count(F.lit(1)).alias(WEIGHT), F.min(levels.item).alias(levels.item)
    )
    df = stage(groups, "check-groups")
    parts = [
        outside_closed_set(df, small_table(spark, ["value"], [[v] for v in closed_set]), levels),
        child_under_many_parents(df, levels),
        forbidden_children(df, small_table(spark, ["value"], [[v] for v in forbidden]), levels),
        entity_children(df, entity_words, levels),
        thin_violations(df, min_items, levels),
        format_duplicates(df, levels),
        service_children(df, service_parents, levels=levels),
        forbidden_pairs(df, small_table(spark, ["parent", "child"], pairs), levels),
        item_under_many_parents(items, levels),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

"""Rule operators: lookups, classifiers and conditional moves.

Every operator computes all the columns it changes in one ``select`` over the
same input row, never shuffles the data (rule tables are broadcast), and takes
an optional ``mark``: the name of a boolean column telling which rows it hit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import MATCHERS, any_substring, folded, sql_list
from .tables import found, probe, small_table

# Fixed value: the child name used where a parent has no fallback of its own.
LAST_RESORT = "General Products"


@dataclass(frozen=True)
class Levels:
    """Names of the three hierarchy columns."""

    parent: str = "category"
    child: str = "subcategory"
    item: str = "product_category"


@dataclass(frozen=True)
class Group:
    """One arm of an ordered keyword classifier."""

    keywords: tuple[str, ...]
    child: str
    parent: str | None = None


def assign(
    df: DataFrame,
    where: Column,
    values: Mapping[str, Column],
    mark: str | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Set several columns at once on the rows where the condition holds."""
    hit = F.coalesce(where, F.lit(False))
    kept = [c for c in df.columns if c not in drop]
    out = [
        F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in kept
    ]
    return df.select(*out, *([hit.alias(mark)] if mark else []))


def first_match(arms: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """``CASE WHEN`` over ordered ``(condition, value)`` arms."""
    out = default
    for condition, value in reversed(arms):
        out = F.when(condition, value).otherwise(out)
    return out


def member_of(column: str, names: Sequence[str]) -> Column:
    """``column IN (names)``, false for NULL; one expression however long the list."""
    return F.expr(f"coalesce(`{column}` IN ({sql_list(names)}), false)")


def replace_value(
    df: DataFrame,
    table: DataFrame,
    column: str,
    key: Column | None = None,
    where: Column | None = None,
    default: Column | None = None,
    mark: str | None = None,
) -> DataFrame:
    """``column`` becomes the value looked up for ``key``.

    Absent keys keep the old value, or take ``default`` where one is given.
    ``where`` limits the rows the rule may touch.
    """
    joined = probe(df, table, {"key": F.col(column) if key is None else key}, "rule_v")
    scope = F.lit(True) if where is None else where
    value = F.col("rule_v.value")
    if default is None:
        return assign(joined, scope & found("rule_v"), {column: value}, mark, ["rule_v"])
    return assign(joined, scope, {column: F.coalesce(value, default)}, mark, ["rule_v"])


def canonical_value(
    df: DataFrame, table: DataFrame, column: str, mark: str | None = None
) -> DataFrame:
    """Case- and padding-insensitive lookup; keys of ``table`` are lower case."""
    return replace_value(df, table, column, key=folded(column), mark=mark)


def _with_fallback(df: DataFrame, fallback: DataFrame, parent: str, last: str):
    joined = probe(df, fallback, {"key": F.col(parent)}, "rule_f")
    return joined, F.coalesce(F.col("rule_f.value"), F.lit(last))


def replace_or_fallback(
    df: DataFrame,
    table: DataFrame,
    fallback: DataFrame,
    levels: Levels = Levels(),
    last: str = LAST_RESORT,
    mark: str | None = None,
) -> DataFrame:
    """Exact lookup on the child; a NULL value means "use the parent's fallback"."""
    joined = probe(df, table, {"key": F.col(levels.child)}, "rule_v")
    joined, spare = _with_fallback(joined, fallback, levels.parent, last)
    return assign(
        joined,
        found("rule_v"),
        {levels.child: F.coalesce(F.col("rule_v.value"), spare)},
        mark,
        ["rule_v", "rule_f"],
    )


def fallback_where(
    df: DataFrame,
    where: Column,
    fallback: DataFrame,
    levels: Levels = Levels(),
    last: str = LAST_RESORT,
    mark: str | None = None,
) -> DataFrame:
    """Replace the child by its parent's fallback on the rows that match."""
    joined, spare = _with_fallback(df, fallback, levels.parent, last)
    return assign(joined, where, {levels.child: spare}, mark, ["rule_f"])


def move_out(
    df: DataFrame,
    table: DataFrame,
    scope: str | Sequence[str],
    to_parent: str,
    targets: DataFrame,
    groups: Sequence[Group],
    default: str,
    levels: Levels = Levels(),
    mark: str | None = None,
) -> DataFrame:
    """Lookup inside some parents; a NULL value moves the row to ``to_parent``.

    A moved row takes the child that ``targets`` holds for ``(child, to_parent)``,
    else the first keyword group hit by the old child, else ``default``.
    """
    child, parent = F.col(levels.child), F.col(levels.parent)
    joined = probe(df, table, {"key": child}, "rule_v")
    joined = probe(joined, targets, {"key": child, "parent": F.lit(to_parent)}, "rule_t")
    leaves = F.col("rule_v.value").isNull()
    landing = F.coalesce(F.col("rule_t.value"), classify(child, groups, default))
    return assign(
        joined,
        parent.isin([scope] if isinstance(scope, str) else list(scope)) & found("rule_v"),
        {
            levels.parent: F.when(leaves, F.lit(to_parent)).otherwise(parent),
            levels.child: F.when(leaves, landing).otherwise(F.col("rule_v.value")),
        },
        mark,
        ["rule_v", "rule_t"],
    )


def reparent(
    df: DataFrame,
    moves: DataFrame,
    targets: DataFrame,
    levels: Levels = Levels(),
    mark: str | None = None,
) -> DataFrame:
    """Move a child to another parent and rename it by ``(child, new parent)``.

    One hop: the new name is not looked up again.
    """
    child = F.col(levels.child)
    joined = probe(df, moves, {"key": child}, "rule_m")
    joined = probe(
        joined, targets, {"key": child, "parent": F.col("rule_m.value")}, "rule_t"
    )
    return assign(
        joined,
        found("rule_m"),
        {
            levels.parent: F.col("rule_m.value"),
            levels.child: F.coalesce(F.col("rule_t.value"), child),
        },
        mark,
        ["rule_m", "rule_t"],
    )


def assign_pair(
    df: DataFrame,
    table: DataFrame,
    on: Mapping[str, Column],
    where: Column | None = None,
    levels: Levels = Levels(),
    deleted: str | None = None,
    mark: str | None = None,
) -> DataFrame:
    """Look up a ``(parent, child)`` pair; with ``deleted``, some keys delete.

    ``table`` holds the key columns, ``parent``, ``child`` and ``action``; the
    action ``delete`` sets the ``deleted`` flag instead of moving the row.
    """
    joined = probe(df, table, on, "rule_p")
    scope = found("rule_p") if where is None else found("rule_p") & where
    gone = F.coalesce(F.col("rule_p.action") == "delete", F.lit(False))
    values = {
        levels.parent: F.when(gone, F.col(levels.parent)).otherwise(F.col("rule_p.parent")),
        levels.child: F.when(gone, F.col(levels.child)).otherwise(F.col("rule_p.child")),
    }
    if deleted:
        values[deleted] = F.col(deleted) | gone
        scope = scope & ~F.col(deleted)
    return assign(joined, scope, values, mark, ["rule_p"])


def classify(
    c: Column | str, groups: Sequence[Group], default: str, match: str = "substring"
) -> Column:
    """Label of the first keyword group that hits, else ``default``."""
    arms = [(MATCHERS[match](c, g.keywords), F.lit(g.child)) for g in groups]
    return first_match(arms, F.lit(default))


def keyword_move(
    df: DataFrame,
    gate: Sequence[str],
    exclude: Sequence[str],
    to_parent: str,
    groups: Sequence[Group],
    default: str,
    where: Column | None = None,
    match: str = "substring",
    levels: Levels = Levels(),
    mark: str | None = None,
) -> DataFrame:
    """Items hitting the gate leave their parent, unless it is excluded."""
    hit = MATCHERS[match](levels.item, gate)
    if exclude:
        hit = hit & ~member_of(levels.parent, exclude)
    values = {
        levels.parent: F.lit(to_parent),
        levels.child: classify(levels.item, groups, default, match),
    }
    return assign(df, hit if where is None else hit & where, values, mark)


def split_by_keywords(
    df: DataFrame,
    where: Column,
    groups: Sequence[Group],
    levels: Levels = Levels(),
    mark: str | None = None,
) -> DataFrame:
    """Ordered keyword groups inside a scope; a group may also change the parent."""
    hits = [any_substring(levels.item, g.keywords) for g in groups]
    landings = [
        F.struct(
            (F.lit(g.parent) if g.parent else F.col(levels.parent)).alias("parent"),
            F.lit(g.child).alias("child"),
        )
        for g in groups
    ]
    arm = first_match(list(zip(hits, landings)), F.lit(None))
    # One struct, so the keywords are matched once for both columns.
    tagged = df.withColumn("rule_arm", F.when(where, arm))
    values = {
        levels.parent: F.col("rule_arm.parent"),
        levels.child: F.col("rule_arm.child"),
    }
    return assign(tagged, found("rule_arm"), values, mark, ["rule_arm"])


def priority_sets(
    df: DataFrame,
    sets: Sequence[tuple[str, Sequence[str]]],
    where: Column,
    levels: Levels = Levels(),
    mark: str | None = None,
) -> DataFrame:
    """Give an item the label of the first set that holds it: one keyed lookup."""
    first: dict[str, str] = {}
    for label, members in sets:
        for m in members:
            first.setdefault(m, label)
    table = small_table(df.sparkSession, ["key", "value"], first.items(), keys=1)
    return replace_value(
        df, table, levels.child, key=F.col(levels.item), where=where, mark=mark
    )

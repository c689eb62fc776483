"""Run a rule pack over a table: rules in ``seq`` order, one ``select`` each."""

from __future__ import annotations

from functools import reduce
from itertools import groupby
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import padded_or_suffix, strip_ws, word_prefix
from ..sources.packs import Rule, RulePack, entry_table
from ..sources.stages import stage
from . import rules as R
from .tables import found, probe, small_table

DELETED = "rule_deleted"
_FLAG = "rule_flag"


def _groups(rule: Rule) -> list[R.Group]:
    return [
        R.Group(tuple(g.keywords), g.subcategory, g.category) for g in rule.groups or []
    ]


def _limits(rule: Rule, lv: R.Levels) -> list[tuple[str, list[str]]]:
    """The value lists that scope a rule, narrowest level first."""
    lists = [
        (lv.item, rule.scope_item),
        (lv.child, rule.scope_subcategory),
        (lv.parent, rule.scope_category),
    ]
    return [(column, names) for column, names in lists if names]


def _all(tests: list[Column]) -> Column:
    return reduce(and_, tests) if tests else F.lit(True)


def _flagged(df: DataFrame, column: str, names: list[str]) -> tuple[DataFrame, Column]:
    """Membership as a broadcast flag join instead of ``IN``.

    A filter placed after the cascade is pushed down and rewritten through every
    projection, and its text multiplies at each one; a condition that needs a
    joined flag stops it at that join, so plans stay linear in the rules.
    """
    table = small_table(df.sparkSession, ["key"], [[n] for n in names])
    return probe(df, table, {"key": F.col(column)}, _FLAG), found(_FLAG)


def _apply(df: DataFrame, rule: Rule, pack: RulePack, lv: R.Levels, mark: str | None):
    spark = df.sparkSession
    limits, tests = _limits(rule, lv), []
    if limits and rule.kind in ("set_move", "split", "reassign"):
        df, flag = _flagged(df, *limits.pop(0))
        tests = [flag]
    scope = _all(tests + [R.member_of(c, names) for c, names in limits])

    def keyed(rows, columns=("key", "value"), keys=1):
        return small_table(spark, columns, rows, keys)

    def lookup():
        if rule.table:
            return entry_table(spark, rule.table, ["key"]).select("key", "value")
        return keyed([(e.key, e.value) for e in rule.entries])

    def fallback():
        return keyed([(e.key, e.value) for e in pack.entries("fallback")])

    def targets():
        return keyed(
            [(e.key, e.key2, e.value) for e in pack.entries("target")],
            ("key", "parent", "value"),
            keys=2,
        )

    def pairs(*keys):
        values = {"category": "parent", "subcategory": "child", "action": "action"}
        if rule.table:
            named = [F.col(v).alias(name) for v, name in values.items()]
            return entry_table(spark, rule.table, keys).select(*keys, *named)
        return keyed(
            [[getattr(e, k) for k in (*keys, *values)] for e in rule.entries],
            (*keys, *values.values()),
            keys=len(keys),
        )

    match rule.kind:
        case "fallback" | "target":
            return df
        case "canonical":
            return R.canonical_value(df, lookup(), rule.column, mark)
        case "rename" if rule.column == lv.child:
            return R.replace_or_fallback(df, lookup(), fallback(), lv, mark=mark)
        case "rename":
            return R.replace_value(df, lookup(), rule.column, mark=mark)
        case "move_out":
            return R.move_out(
                df, lookup(), rule.scope_category, rule.set_category, targets(),
                _groups(rule), rule.default_value, lv, mark,
            )
        case "reparent":
            return R.reparent(df, lookup(), targets(), lv, mark)
        case "forbid":
            return R.fallback_where(
                df, R.member_of(lv.child, rule.keywords), fallback(), lv, mark=mark
            )
        case "forbid_words":
            return R.fallback_where(
                df, word_prefix(lv.child, rule.keywords), fallback(), lv, mark=mark
            )
        case "keyword_move":
            open_rows = ~F.col(DELETED)
            if rule.exclude_category:
                df, excluded = _flagged(df, lv.parent, rule.exclude_category)
                open_rows = open_rows & ~excluded
            return R.keyword_move(
                df, rule.keywords, [], rule.set_category, _groups(rule),
                rule.default_value, open_rows, rule.match or "substring", lv, mark,
            )
        case "set_move":
            values = {DELETED: F.lit(True)} if rule.delete else {}
            if rule.set_category is not None:
                values[lv.parent] = F.lit(rule.set_category)
            if rule.set_subcategory is not None:
                values[lv.child] = F.lit(rule.set_subcategory)
            return R.assign(df, scope, values, mark)
        case "pair":
            return R.assign_pair(
                df, pairs("key"), {"key": F.col(rule.column)}, scope, lv, mark=mark
            )
        case "item_default":
            return R.replace_value(
                df, lookup(), lv.child, F.col(lv.item), scope, F.lit(rule.default_value), mark
            )
        case "priority_sets":
            # Entries keep their order, also where a label returns after another one.
            sets = [
                (label, [e.key for e in run])
                for label, run in groupby(rule.entries, key=lambda e: e.value)
            ]
            return R.priority_sets(df, sets, scope, lv, mark)
        case "fix_delete":
            on = {"key": F.col(lv.parent), "key2": F.col(lv.child)}
            return R.assign_pair(
                df, pairs("key", "key2"), on, None, lv, DELETED, mark
            )
        case "split":
            return R.split_by_keywords(df, scope, _groups(rule), lv, mark)
        case "reassign":
            test = padded_or_suffix(lv.item, rule.keywords, rule.veto or [])
            values = {
                lv.parent: F.lit(rule.set_category),
                lv.child: F.lit(rule.set_subcategory),
            }
            return R.assign(df, scope & test, values, mark)
    raise ValueError(f"rule {rule.rule_id}: kind {rule.kind} has no operator")


def _run(df: DataFrame, pack: RulePack, levels: R.Levels, strip: bool, trace: bool):
    columns = (levels.parent, levels.child, levels.item) if strip else ()
    out = df.select(
        *[strip_ws(c).alias(c) if c in columns else F.col(c) for c in df.columns],
        F.lit(False).alias(DELETED),
    )
    for rule in pack.rules:
        out = _apply(out, rule, pack, levels, f"rule_hit_{rule.seq}" if trace else None)
        out = out.drop(_FLAG)
    return out


def apply_rules(
    df: DataFrame, pack: RulePack, levels: R.Levels = R.Levels(), strip: bool = True
) -> DataFrame:
    """Strip the three columns, run every rule, drop the rows that rules deleted.

    No shuffle: the whole cascade is one scan with broadcast lookups.
    """
    return _run(df, pack, levels, strip, False).where(~F.col(DELETED)).drop(DELETED)


def reads_items(pack: RulePack) -> bool:
    return any(
        r.scope_item
        or r.kind in ("keyword_move", "item_default", "priority_sets", "split", "reassign")
        or (r.kind == "pair" and r.column not in ("category", "subcategory"))
        for r in pack.rules
    )


def apply_rules_by_pair(
    df: DataFrame, pack: RulePack, levels: R.Levels = R.Levels()
) -> DataFrame:
    """:func:`apply_rules` for packs that look at (parent, child) only.

    The pack runs on the distinct pairs, and the data joins its outcome: one
    lookup per row instead of one per rule, for a first pass over two columns.
    Worth it when ``df`` is cheap to read twice, such as a stored table.
    """
    if reads_items(pack):
        raise ValueError("the pack reads items; use apply_rules")
    parent, child, item = levels.parent, levels.child, levels.item
    pairs = stage(df.select(parent, child).distinct(), "rule-pairs").select(
        F.col(parent).alias("raw_parent"), F.col(child).alias("raw_child"),
        parent, child, F.lit(None).cast("string").alias(item),
    )
    done = _run(pairs, pack, levels, True, False).select(
        "raw_parent", "raw_child", F.col(parent).alias("new_parent"),
        F.col(child).alias("new_child"), F.col(DELETED).alias("gone"),
    )
    outcome = stage(done, "rule-outcome")  # known size: the planner may broadcast it
    same = F.col(parent).eqNullSafe(F.col("raw_parent")) & F.col(child).eqNullSafe(
        F.col("raw_child")
    )
    new = {parent: F.col("new_parent"), child: F.col("new_child"), item: strip_ws(item)}
    return df.join(outcome, same).where("NOT gone").select(
        *[new[c].alias(c) if c in new else F.col(c) for c in df.columns]
    )


def rule_hits(
    df: DataFrame, pack: RulePack, levels: R.Levels = R.Levels(), strip: bool = True
) -> DataFrame:
    """``(seq, rule_id, hits)``: how many rows each rule touched; 0 = dead rule.

    One pass over the data and one aggregate row, whatever the number of rules.
    """
    active = [r for r in pack.rules if r.kind not in ("fallback", "target")]
    traced = _run(df, pack, levels, strip, True)
    counts = traced.agg(
        *[F.count_if(F.col(f"rule_hit_{r.seq}")).alias(f"n_{r.seq}") for r in active]
    )
    lines = [
        F.struct(
            F.lit(r.seq).alias("seq"), F.lit(r.rule_id).alias("rule_id"),
            F.col(f"n_{r.seq}").alias("hits"),
        )
        for r in active
    ]
    return counts.select(F.inline(F.array(*lines)))

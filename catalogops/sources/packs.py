"""Rule packs: the rule tables as external JSON, read with a fixed schema."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = """
  seq INT, rule_id STRING, kind STRING, column STRING, match STRING, table STRING,
  scope_category ARRAY<STRING>, scope_subcategory ARRAY<STRING>, scope_item ARRAY<STRING>,
  exclude_category ARRAY<STRING>, keywords ARRAY<STRING>, veto ARRAY<STRING>,
  entries ARRAY<STRUCT<key STRING, key2 STRING, value STRING,
                       category STRING, subcategory STRING, action STRING>>,
  groups ARRAY<STRUCT<keywords ARRAY<STRING>, category STRING, subcategory STRING>>,
  set_category STRING, set_subcategory STRING, default_value STRING, delete BOOLEAN
"""

KINDS = (
    "fallback", "canonical", "move_out", "rename", "reparent", "target", "forbid",
    "forbid_words", "keyword_move", "set_move", "pair", "item_default",
    "priority_sets", "fix_delete", "split", "reassign",
)


# What each kind reads besides ``seq``, ``rule_id`` and ``kind``; other fields are refused.
_SCOPES = "scope_category scope_subcategory scope_item"
FIELDS = {
    "fallback": "entries",
    "target": "entries",
    "canonical": "column entries table",
    "rename": "column entries table",
    "move_out": "scope_category set_category default_value groups entries table",
    "reparent": "entries table",
    "forbid": "keywords",
    "forbid_words": "keywords",
    "keyword_move": "keywords exclude_category set_category default_value groups match",
    "set_move": f"{_SCOPES} set_category set_subcategory delete",
    "pair": f"{_SCOPES} column entries table",
    "item_default": f"{_SCOPES} default_value entries table",
    "priority_sets": f"{_SCOPES} entries",
    "fix_delete": "entries table",
    "split": f"{_SCOPES} groups",
    "reassign": f"{_SCOPES} keywords veto set_category set_subcategory",
}


@dataclass(frozen=True)
class Entry:
    key: str
    key2: str | None = None
    value: str | None = None
    category: str | None = None
    subcategory: str | None = None
    action: str | None = None


@dataclass(frozen=True)
class Arm:
    """One group of an ordered keyword classifier."""

    keywords: list[str]
    category: str | None = None
    subcategory: str | None = None


@dataclass(frozen=True)
class Rule:
    seq: int
    rule_id: str
    kind: str
    column: str | None = None
    match: str | None = None
    table: str | None = None
    scope_category: list[str] | None = None
    scope_subcategory: list[str] | None = None
    scope_item: list[str] | None = None
    exclude_category: list[str] | None = None
    keywords: list[str] | None = None
    veto: list[str] | None = None
    entries: list[Entry] | None = None
    groups: list[Arm] | None = None
    set_category: str | None = None
    set_subcategory: str | None = None
    default_value: str | None = None
    delete: bool | None = None


@dataclass(frozen=True)
class RulePack:
    """Rules in ``seq`` order: known kinds, unique ids, unique keys per table."""

    rules: tuple[Rule, ...]

    def __post_init__(self):
        ids = {r.rule_id for r in self.rules} | {r.seq for r in self.rules}
        if len(ids) != 2 * len(self.rules):
            raise ValueError("rule_id and seq must be unique within a pack")
        for r in self.rules:
            if r.kind not in KINDS:
                raise ValueError(f"rule {r.rule_id}: unknown kind {r.kind}")
            reads = {"seq", "rule_id", "kind", *FIELDS[r.kind].split()}
            unread = [f.name for f in fields(r) if getattr(r, f.name) and f.name not in reads]
            if unread:
                raise ValueError(f"rule {r.rule_id}: kind {r.kind} does not read {unread}")
            if r.kind == "set_move" and not (r.scope_category or r.scope_subcategory or r.scope_item):
                raise ValueError(f"rule {r.rule_id}: a set_move without scope would hit every row")
            if r.kind == "move_out" and not r.scope_category:
                raise ValueError(f"rule {r.rule_id}: a move_out needs scope_category")
            if r.table and r.entries:
                raise ValueError(f"rule {r.rule_id}: entries and a table at once")
            keys = [(e.key, e.key2) for e in r.entries or []]
            if r.kind != "priority_sets" and len(set(keys)) != len(keys):
                raise ValueError(f"rule {r.rule_id}: repeated key")

    def entries(self, kind: str) -> list[Entry]:
        return [e for r in self.rules if r.kind == kind for e in r.entries or []]


def from_dicts(rules: Iterable[dict]) -> RulePack:
    built = []
    for rule in rules:
        entries = [Entry(**e) for e in rule.get("entries") or []]
        groups = [Arm(**g) for g in rule.get("groups") or []]
        built.append(Rule(**{**rule, "entries": entries, "groups": groups}))
    return RulePack(tuple(sorted(built, key=lambda r: r.seq)))


def from_json(text: str) -> RulePack:
    """A pack kept beside the driver program."""
    return from_dicts(json.loads(text))


def table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path, multiLine=True)


def load(spark: SparkSession, path: str) -> RulePack:
    """A pack from any path Spark reads.

    Its rules come to the driver, as configuration does; a rule with many
    entries names a ``table`` instead, which stays on the cluster.
    """
    return from_dicts(r.asDict(recursive=True) for r in table(spark, path).collect())


def entry_table(spark: SparkSession, path: str, keys: Iterable[str]) -> DataFrame:
    """The entries of a rule kept as a Parquet table with the columns of an entry.

    A key may occur once only, else rows would multiply: the least entry of
    repeated keys is taken, whatever the order of the files. No broadcast hint:
    the planner knows the table's size.
    """
    names = ["key", "key2", "value", "category", "subcategory", "action"]
    stored = spark.read.parquet(path)
    known = [F.col(c) if c in stored.columns else F.lit(None).cast("string").alias(c) for c in names]
    rest = [c for c in names if c not in set(keys)]
    best = stored.select(*known).groupBy(*keys).agg(F.min(F.struct(*rest)).alias("e"))
    return best.select(*keys, "e.*")


def dead_keys(pack_table: DataFrame) -> DataFrame:
    """Child keys that no row can reach: an earlier rename takes them away and
    nothing between produces them again."""
    lookups = ["rename", "move_out", "reparent", "target"]
    entries = pack_table.where(F.col("kind").isin(*lookups)).select(
        "seq", "rule_id", "kind", F.explode("entries").alias("e")
    ).select("seq", "rule_id", "kind", "e.key", "e.value")
    renames = entries.where("kind = 'rename'").select(
        F.col("seq").alias("taken_at"), "key", F.col("value").alias("to")
    ).where(F.col("to").isNull() | (F.col("to") != F.col("key")))
    made = entries.where(F.col("kind").isin("rename", "move_out", "target")).select(
        F.col("seq").alias("made_at"), F.col("value").alias("key")
    ).where("key IS NOT NULL").distinct()
    later = entries.join(renames, "key").where(F.col("taken_at") < F.col("seq"))
    alive = (
        later.join(made, "key")
        .where((F.col("made_at") >= F.col("taken_at")) & (F.col("made_at") < F.col("seq")))
        .select("rule_id", "key")
        .distinct()
    )
    return later.select("rule_id", "key").distinct().join(alive, ["rule_id", "key"], "left_anti")

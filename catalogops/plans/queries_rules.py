"""Queries for predicates, lookups, classifiers and rule cascades."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from ..functions import text
from ..operators import cascade, keywords, rules as R
from ..operators.tables import mapping_table, small_table
from ..sources import packs
from ..sources.stages import stage
from .registry import (
    LISTINGS_DIRTY, TAX, TAX_DIRTY, listings_dirty, query, read, strip_sql, tax, tax_dirty,
)

DEMO = Path(__file__).resolve().parents[2] / "packs" / "demo"
COLS = "row_id, category, subcategory, product_category"


def demo_pack(name):
    return packs.from_json(DEMO.joinpath(f"{name}.json").read_text())


# --- predicates over whole texts

WORDS = ["license", "http", "tion", "ü", "password", "und d"]
ENTITY = ["the", "license", "der", "est", "buying house"]
SUFFIX = ["the", "with", "und", "license", "tion."]
VETO = ["http", "copyright"]
GROUPS = [
    R.Group(("license", "copyright"), "legal"),
    R.Group(("http", "@"), "contact"),
    R.Group(("ä", "ö", "ü", "ß"), "umlaut"),
    R.Group(("é", "è"), "accent"),
]


def documents(spark, sf):
    return read(spark, sf, "documents").select("doc_id", "text")


def _any(column, words, shape):
    return "(" + " OR ".join(shape.format(c=column, w=w) for w in words) + ")"


_LOW = "lower(text)"
_STRIPPED = f"lower({strip_sql('text')})"


@query("kw_any_substring", f"SELECT doc_id, {_any(_LOW, WORDS, 'contains({c}, {w!r})')} AS hit FROM documents")
def kw_any_substring(spark, sf):
    return documents(spark, sf).select("doc_id", text.any_substring("text", WORDS).alias("hit"))


@query(
    "kw_word_prefix",
    f"SELECT doc_id, {_any(_LOW, ENTITY, '''contains(' ' || {c}, ' {w}')''')} AS hit FROM documents",
)
def kw_word_prefix(spark, sf):
    return documents(spark, sf).select("doc_id", text.word_prefix("text", ENTITY).alias("hit"))


_PADDED = "(contains(' ' || {c} || ' ', ' {w} ') OR ends_with({c}, '{w}'))"


@query(
    "kw_padded_veto",
    f"""SELECT doc_id, {_any(_STRIPPED, SUFFIX, _PADDED)}
          AND NOT {_any(_STRIPPED, VETO, 'contains({c}, {w!r})')} AS hit FROM documents""",
)
def kw_padded_veto(spark, sf):
    hit = text.padded_or_suffix("text", SUFFIX, VETO)
    return documents(spark, sf).select("doc_id", hit.alias("hit"))


_ARMS = " ".join(
    f"WHEN {_any(_LOW, g.keywords, 'contains({c}, {w!r})')} THEN '{g.child}'" for g in GROUPS
)


@query("kw_classify", f"SELECT doc_id, CASE {_ARMS} ELSE 'plain' END AS label FROM documents")
def kw_classify(spark, sf):
    return documents(spark, sf).select(
        "doc_id", R.classify("text", GROUPS, "plain").alias("label")
    )


@query(
    "member_filter",
    f"""WITH {TAX} SELECT * FROM tax
        WHERE product_category IN ('red bolt', 'cold rod', 'hot gear') AND subcategory NOT IN ('Brand#1')""",
)
def member_filter(spark, sf):
    df = tax(spark, sf)
    keep = R.member_of("product_category", ["red bolt", "cold rod", "hot gear"])
    return df.where(keep & ~R.member_of("subcategory", ["Brand#1"]))


@query(
    "member_join",
    f"""WITH {LISTINGS_DIRTY}
        SELECT l.* FROM listings_dirty l
        WHERE EXISTS (SELECT 1 FROM tax t WHERE t.category = 'SMALL' AND t.product_category = l.product_category
                      AND t.subcategory = l.subcategory)
          AND NOT EXISTS (SELECT 1 FROM tax t WHERE t.category = 'PROMO' AND t.row_id = l.row_id)""",
)
def member_join(spark, sf):
    """Membership against a set that is itself data: semi and anti join."""
    small = tax(spark, sf).where("category = 'SMALL'").select("subcategory", "product_category")
    promo = tax(spark, sf).where("category = 'PROMO'").select("row_id")
    kept = listings_dirty(spark, sf).join(small.distinct(), ["subcategory", "product_category"], "left_semi")
    return kept.join(promo, "row_id", "left_anti").select(*COLS.split(", "))


# --- single rules


@query(
    "conditional_update",
    f"""WITH {TAX} SELECT row_id, CASE WHEN subcategory = 'Brand#3' THEN 'X' ELSE category END AS category,
          CASE WHEN subcategory = 'Brand#3' THEN category ELSE subcategory END AS subcategory,
          product_category FROM tax""",
)
def conditional_update(spark, sf):
    values = {"category": F.lit("X"), "subcategory": F.col("category")}
    return R.assign(tax(spark, sf), F.col("subcategory") == "Brand#3", values)


_CONJ = "category = 'LARGE' AND subcategory = 'Brand#2' AND product_category IN ('red bolt', 'red rod', 'new ring')"


@query(
    "conjunctive_move",
    f"""WITH {TAX} SELECT row_id, CASE WHEN {_CONJ} THEN 'METAL' ELSE category END AS category,
          CASE WHEN {_CONJ} THEN 'Rods' ELSE subcategory END AS subcategory, product_category FROM tax""",
)
def conjunctive_move(spark, sf):
    where = (
        (F.col("category") == "LARGE") & (F.col("subcategory") == "Brand#2")
        & R.member_of("product_category", ["red bolt", "red rod", "new ring"])
    )
    return R.assign(
        tax(spark, sf), where, {"category": F.lit("METAL"), "subcategory": F.lit("Rods")}
    )


@query(
    "soft_delete",
    f"""WITH {TAX} SELECT {COLS} FROM tax
        WHERE NOT (subcategory = 'Brand#14' OR product_category IN ('old anvil', 'cold rod'))""",
)
def soft_delete(spark, sf):
    df = tax(spark, sf).withColumn("deleted", F.lit(False))
    df = R.assign(df, F.col("subcategory") == "Brand#14", {"deleted": F.lit(True)})
    df = R.assign(
        df, R.member_of("product_category", ["old anvil", "cold rod"]), {"deleted": F.lit(True)}
    )
    return df.where(~F.col("deleted")).drop("deleted")


@query(
    "rename_value",
    f"""WITH {TAX} SELECT row_id, CASE category WHEN 'LARGE' THEN 'BULK' ELSE category END AS category,
          subcategory, product_category FROM tax""",
)
def rename_value(spark, sf):
    return R.replace_value(tax(spark, sf), mapping_table(spark, {"LARGE": "BULK"}), "category")


_SOFT = (
    "category IN ('STANDARD', 'SMALL') AND NOT contains(product_category, 'red')"
    " AND (contains(' ' || product_category || ' ', ' small ') OR ends_with(product_category, 'dget'))"
)


@query(
    "misplaced_reassign",
    f"""WITH {TAX} SELECT row_id, CASE WHEN {_SOFT} THEN 'SW' ELSE category END AS category,
          CASE WHEN {_SOFT} THEN 'Other' ELSE subcategory END AS subcategory, product_category FROM tax""",
)
def misplaced_reassign(spark, sf):
    where = R.member_of("category", ["STANDARD", "SMALL"]) & text.padded_or_suffix(
        "product_category", ["small", "dget"], ["red"]
    )
    return R.assign(
        tax(spark, sf), where, {"category": F.lit("SW"), "subcategory": F.lit("Other")}
    )


@query(
    "lookup_ci",
    f"""WITH {TAX_DIRTY} SELECT row_id, CASE lower({strip_sql('category')}) WHEN 'small' THEN 'COMPACT'
          WHEN 'economy' THEN 'ECONOMY' WHEN 'promo' THEN 'PROMO' ELSE category END AS category,
          subcategory, product_category FROM tax_dirty""",
)
def lookup_ci(spark, sf):
    table = mapping_table(spark, {"small": "COMPACT", "economy": "ECONOMY", "promo": "PROMO"})
    return R.canonical_value(tax_dirty(spark, sf), table, "category")


@query(
    "lookup_scoped_move",
    f"""WITH {TAX_DIRTY} SELECT row_id,
          CASE WHEN category = 'ECONOMY' AND subcategory IN ('Brand#3', 'Brand#4', 'Brand#13')
            THEN 'SERVICE' ELSE category END AS category,
          CASE WHEN category <> 'ECONOMY' THEN subcategory
            WHEN subcategory = 'Brand#2' THEN 'Budget Line' WHEN subcategory = 'Brand#4' THEN 'Repair'
            WHEN subcategory = 'Brand#13' THEN 'Tens' WHEN subcategory = 'Brand#3' THEN 'General'
            ELSE subcategory END AS subcategory, product_category FROM tax_dirty""",
)
def lookup_scoped_move(spark, sf):
    names = mapping_table(
        spark, {"Brand#2": "Budget Line", "Brand#3": None, "Brand#4": None, "Brand#13": None}
    )
    targets = small_table(spark, ["key", "parent", "value"], [("Brand#4", "SERVICE", "Repair")])
    return R.move_out(
        tax_dirty(spark, sf), names, "ECONOMY", "SERVICE", targets,
        [R.Group(("#1",), "Tens")], "General",
    )


_SPARE = "CASE category WHEN 'SMALL' THEN 'Small Goods' WHEN 'PROMO' THEN 'Offers' ELSE 'General Products' END"
FALLBACK = {"SMALL": "Small Goods", "PROMO": "Offers"}


@query(
    "lookup_fallback",
    f"""WITH {TAX_DIRTY} SELECT row_id, category, CASE subcategory WHEN 'Brand#5' THEN 'Core'
          WHEN 'Brand#7' THEN {_SPARE} ELSE subcategory END AS subcategory, product_category FROM tax_dirty""",
)
def lookup_fallback(spark, sf):
    table = mapping_table(spark, {"Brand#5": "Core", "Brand#7": None})
    return R.replace_or_fallback(tax_dirty(spark, sf), table, mapping_table(spark, FALLBACK))


@query(
    "reparent",
    f"""WITH {TAX} SELECT row_id, CASE WHEN subcategory IN ('Brand#8', 'Brand#9') THEN 'INDUSTRIAL'
          ELSE category END AS category,
          CASE subcategory WHEN 'Brand#8' THEN 'Brand#9' ELSE subcategory END AS subcategory,
          product_category FROM tax""",
)
def reparent(spark, sf):
    moves = mapping_table(spark, {"Brand#8": "INDUSTRIAL", "Brand#9": "INDUSTRIAL"})
    targets = small_table(
        spark, ["key", "parent", "value"],
        [("Brand#8", "INDUSTRIAL", "Brand#9"), ("Brand#9", "SMALL", "never")],
    )
    return R.reparent(tax(spark, sf), moves, targets)


@query(
    "forbidden_to_fallback",
    f"""WITH {TAX_DIRTY} SELECT row_id, category, CASE WHEN subcategory IN ('Brand#10', 'Brand#11')
          OR starts_with(lower(subcategory), 'brand#2') THEN {_SPARE} ELSE subcategory END AS subcategory,
          product_category FROM tax_dirty""",
)
def forbidden_to_fallback(spark, sf):
    spare = mapping_table(spark, FALLBACK)
    df = R.fallback_where(
        tax_dirty(spark, sf), R.member_of("subcategory", ["Brand#10", "Brand#11"]), spare
    )
    return R.fallback_where(df, text.word_prefix("subcategory", ["brand#2"]), spare)


@query(
    "lookup_pair",
    f"""WITH {TAX} SELECT row_id, CASE WHEN category = 'ECONOMY' AND subcategory = 'Brand#18' THEN 'STANDARD'
            WHEN category = 'ECONOMY' AND subcategory = 'Brand#19' THEN 'BULK' ELSE category END AS category,
          CASE WHEN category = 'ECONOMY' AND subcategory = 'Brand#19' THEN 'Hardware'
            ELSE subcategory END AS subcategory, product_category FROM tax""",
)
def lookup_pair(spark, sf):
    table = small_table(
        spark, ["key", "parent", "child", "action"],
        [("Brand#18", "STANDARD", "Brand#18", None), ("Brand#19", "BULK", "Hardware", None)],
    )
    return R.assign_pair(
        tax(spark, sf), table, {"key": F.col("subcategory")}, F.col("category") == "ECONOMY"
    )


@query(
    "lookup_default_masked",
    f"""WITH {TAX} SELECT row_id, category, CASE WHEN subcategory <> 'Brand#20' THEN subcategory
          WHEN product_category IN ('red widget', 'blue widget') THEN 'Widget Makers'
          ELSE 'Other Makers' END AS subcategory, product_category FROM tax""",
)
def lookup_default_masked(spark, sf):
    table = mapping_table(spark, {"red widget": "Widget Makers", "blue widget": "Widget Makers"})
    return R.replace_value(
        tax(spark, sf), table, "subcategory", key=F.col("product_category"),
        where=F.col("subcategory") == "Brand#20", default=F.lit("Other Makers"),
    )


@query(
    "priority_sets",
    f"""WITH {TAX} SELECT row_id, category, CASE WHEN category <> 'ECONOMY' THEN subcategory
          WHEN product_category IN ('red rod', 'old rod') THEN 'Set One'
          WHEN product_category IN ('old rod', 'new rod') THEN 'Set Two' ELSE subcategory END AS subcategory,
          product_category FROM tax""",
)
def priority_sets(spark, sf):
    sets = [("Set One", ["red rod", "old rod"]), ("Set Two", ["old rod", "new rod"])]
    return R.priority_sets(tax(spark, sf), sets, F.col("category") == "ECONOMY")


@query(
    "reparent_by_item",
    f"""WITH {TAX} SELECT row_id, CASE WHEN category = 'MEDIUM' AND product_category = 'old widget' THEN 'BULK'
            WHEN category = 'MEDIUM' AND product_category = 'new widget' THEN 'SMALL' ELSE category END AS category,
          CASE WHEN category = 'MEDIUM' AND product_category IN ('old widget', 'new widget') THEN 'Widgets'
            ELSE subcategory END AS subcategory, product_category FROM tax""",
)
def reparent_by_item(spark, sf):
    table = small_table(
        spark, ["key", "parent", "child", "action"],
        [("old widget", "BULK", "Widgets", None), ("new widget", "SMALL", "Widgets", None)],
    )
    return R.assign_pair(
        tax(spark, sf), table, {"key": F.col("product_category")}, F.col("category") == "MEDIUM"
    )


@query(
    "composite_fix_delete",
    f"""WITH {TAX} SELECT row_id, CASE WHEN category = 'PROMO' AND subcategory = 'Brand#23' THEN 'SMALL'
          ELSE category END AS category, subcategory, product_category FROM tax
        WHERE NOT (category = 'PROMO' AND subcategory = 'Brand#24')""",
)
def composite_fix_delete(spark, sf):
    table = small_table(
        spark, ["key", "key2", "parent", "child", "action"],
        [("PROMO", "Brand#23", "SMALL", "Brand#23", None), ("PROMO", "Brand#24", None, None, "delete")],
    )
    on = {"key": F.col("category"), "key2": F.col("subcategory")}
    df = tax(spark, sf).withColumn("gone", F.lit(False))
    return R.assign_pair(df, table, on, deleted="gone").where("NOT gone").drop("gone")


_HOT = "(contains(lower(product_category), 'hot') OR contains(lower(product_category), 'gear')) AND category NOT IN ('LARGE', 'PROMO')"


@query(
    "kw_gate_move",
    f"""WITH {TAX} SELECT row_id, CASE WHEN {_HOT} THEN 'THERMAL' ELSE category END AS category,
          CASE WHEN NOT ({_HOT}) THEN subcategory WHEN contains(product_category, 'ring') THEN 'Hot Rings'
            WHEN contains(product_category, 'gear') THEN 'Gears' ELSE 'Hot Goods' END AS subcategory,
          product_category FROM tax""",
)
def kw_gate_move(spark, sf):
    groups = [R.Group(("ring",), "Hot Rings"), R.Group(("gear", "hot ring"), "Gears")]
    return R.keyword_move(
        tax(spark, sf), ["hot", "gear"], ["LARGE", "PROMO"], "THERMAL", groups, "Hot Goods"
    )


@query(
    "kw_split",
    f"""WITH {TAX} SELECT row_id, CASE WHEN category = 'MEDIUM' AND NOT contains(product_category, 'new ')
            AND (contains(product_category, 'rod') OR contains(product_category, 'bolt')) THEN 'BULK'
            ELSE category END AS category,
          CASE WHEN category <> 'MEDIUM' THEN subcategory WHEN contains(product_category, 'new ') THEN 'New Things'
            WHEN contains(product_category, 'rod') OR contains(product_category, 'bolt') THEN 'Rods'
            ELSE subcategory END AS subcategory, product_category FROM tax""",
)
def kw_split(spark, sf):
    groups = [R.Group(("new ",), "New Things"), R.Group(("rod", "bolt"), "Rods", "BULK")]
    return R.split_by_keywords(tax(spark, sf), F.col("category") == "MEDIUM", groups)


# --- whole packs

_FB = """CASE c WHEN 'STANDARD' THEN 'General Standard' WHEN 'ECONOMY' THEN 'General Economy'
  WHEN 'COMPACT' THEN 'General Compact' WHEN 'INDUSTRIAL' THEN 'Brand#12' ELSE 'General Products' END"""


def correct_sql(source: str) -> str:
    """The demo correction pack as chained CTEs; the last is ``c6``."""
    return f"""
c0 AS (SELECT row_id, {strip_sql('category')} AS c, {strip_sql('subcategory')} AS s,
              {strip_sql('product_category')} AS p FROM {source}),
c1 AS (SELECT row_id, CASE lower(c) WHEN 'standard' THEN 'STANDARD' WHEN 'economy' THEN 'ECONOMY'
  WHEN 'medium' THEN 'MEDIUM' WHEN 'large' THEN 'LARGE' WHEN 'small' THEN 'COMPACT'
  WHEN 'promo' THEN 'PROMO' ELSE c END AS c, s, p FROM c0),
c2 AS (SELECT row_id, CASE WHEN c = 'ECONOMY' AND s IN ('Brand#3', 'Brand#4', 'Brand#13') THEN 'SERVICE' ELSE c END AS c,
  CASE WHEN c = 'ECONOMY' AND s = 'Brand#2' THEN 'Budget Line' WHEN c = 'ECONOMY' AND s = 'Brand#3' THEN 'General Services'
    WHEN c = 'ECONOMY' AND s = 'Brand#4' THEN 'Repair' WHEN c = 'ECONOMY' AND s = 'Brand#13' THEN 'Tens Services'
    ELSE s END AS s, p FROM c1),
c3 AS (SELECT row_id, c, CASE WHEN s IN ('Brand#5', 'Brand#6') THEN 'Core Brand' WHEN s = 'Budget Line' THEN 'Value Line'
    WHEN s = 'Brand#7' THEN {_FB} ELSE s END AS s, p FROM c2),
c4 AS (SELECT row_id, CASE WHEN s IN ('Brand#8', 'Brand#9') THEN 'INDUSTRIAL' WHEN s = 'Brand#5' THEN 'PROMO'
    WHEN s = 'Core Brand' THEN 'STANDARD' ELSE c END AS c,
  CASE WHEN s = 'Brand#8' THEN 'Heavy Brand' ELSE s END AS s, p FROM c3),
c5 AS (SELECT row_id, c, CASE WHEN s IN ('Brand#10', 'STANDARD', 'Repair') THEN {_FB} ELSE s END AS s, p FROM c4),
c6 AS (SELECT row_id, c, CASE WHEN contains(' ' || lower(s), ' brand#2') OR contains(' ' || lower(s), ' dealer')
    THEN {_FB} ELSE s END AS s, p FROM c5)"""


_CORRECTED = f"""WITH {LISTINGS_DIRTY}, {correct_sql('listings_dirty')}
        SELECT row_id, c AS category, s AS subcategory, p AS product_category FROM c6"""


@query("rule_cascade_pairs", _CORRECTED)
def rule_cascade_pairs(spark, sf):
    return cascade.apply_rules_by_pair(listings_dirty(spark, sf), demo_pack("correct"))


@query("rule_cascade", _CORRECTED)
def rule_cascade(spark, sf):
    return cascade.apply_rules(listings_dirty(spark, sf), demo_pack("correct"))


_G = "(contains(lower(p), 'hot') OR contains(lower(p), 'gear') OR contains(lower(p), 'blue p')) AND NOT d AND coalesce(c NOT IN ('BULK', 'PROMO'), TRUE)"
_SW = """c IN ('STANDARD', 'MEDIUM', 'BULK', 'SMALL') AND NOT contains(lower(p), 'small p') AND NOT contains(lower(p), 'red')
  AND (contains(' ' || lower(p) || ' ', ' small ') OR ends_with(lower(p), 'small')
       OR contains(' ' || lower(p) || ' ', ' dget ') OR ends_with(lower(p), 'dget'))"""


def validate_sql(source: str, flag: bool = False) -> str:
    """The demo validation pack as chained CTEs; the last is ``vf``."""
    return f"""
v1 AS MATERIALIZED (SELECT row_id, CASE category WHEN 'LARGE' THEN 'BULK' ELSE category END AS c, subcategory AS s,
  product_category AS p, coalesce(subcategory = 'Brand#14', FALSE)
    OR coalesce(product_category IN ('old anvil', 'cold rod'), FALSE) AS d,
  CAST(category = 'LARGE' AS INT) AS h10, CAST(subcategory = 'Brand#14' AS INT) AS h20,
  CAST(product_category IN ('old anvil', 'cold rod') AS INT) AS h30 FROM {source}),
v4 AS MATERIALIZED (SELECT *, CAST({_G} AS INT) AS h40 FROM v1),
v4b AS MATERIALIZED (SELECT * REPLACE (CASE WHEN h40 = 1 THEN 'THERMAL' ELSE c END AS c,
  CASE WHEN coalesce(h40, 0) = 0 THEN s WHEN contains(lower(p), 'hot gear') OR contains(lower(p), 'hot ring') THEN 'Hot Parts'
    WHEN contains(lower(p), 'plate') THEN 'Hot Plates' ELSE 'Hot Goods' END AS s) FROM v4),
v5 AS MATERIALIZED (SELECT *, CAST(c = 'STANDARD' AND s IN ('Brand#15', 'Brand#16') AS INT) AS h50 FROM v4b),
v5b AS MATERIALIZED (SELECT * REPLACE (CASE WHEN h50 = 1 THEN 'THERMAL' ELSE c END AS c) FROM v5),
v6 AS MATERIALIZED (SELECT *, CAST(c = 'STANDARD' AND s = 'Brand#17' AND p IN ('red bolt', 'red rod', 'old ring') AS INT) AS h60 FROM v5b),
v6b AS MATERIALIZED (SELECT * REPLACE (CASE WHEN h60 = 1 THEN 'BULK' ELSE c END AS c, CASE WHEN h60 = 1 THEN 'Metals' ELSE s END AS s) FROM v6),
v7 AS MATERIALIZED (SELECT *, CAST(c = 'ECONOMY' AND s IN ('Brand#18', 'Brand#19') AS INT) AS h70 FROM v6b),
v7b AS MATERIALIZED (SELECT * REPLACE (CASE WHEN h70 = 1 AND s = 'Brand#18' THEN 'STANDARD' WHEN h70 = 1 THEN 'BULK' ELSE c END AS c,
  CASE WHEN h70 = 1 AND s = 'Brand#19' THEN 'Hardware' ELSE s END AS s) FROM v7),
v8 AS MATERIALIZED (SELECT *, CAST(s = 'Brand#20' AS INT) AS h80 FROM v7b),
v8b AS MATERIALIZED (SELECT * REPLACE (CASE WHEN h80 = 1 THEN CASE WHEN p IN ('red widget', 'blue widget') THEN 'Widget Makers'
  WHEN p = 'cold bolt' THEN 'Bolt Makers' ELSE 'Other Makers' END ELSE s END AS s) FROM v8),
v9 AS MATERIALIZED (SELECT *, CAST(c = 'ECONOMY' AND s = 'Brand#21' AND p IN ('red rod', 'old rod', 'new rod', 'small plate') AS INT) AS h90 FROM v8b),
v9b AS MATERIALIZED (SELECT * REPLACE (CASE WHEN h90 = 1 THEN CASE WHEN p IN ('red rod', 'old rod') THEN 'Set One'
  WHEN p = 'new rod' THEN 'Set Two' ELSE 'Set Three' END ELSE s END AS s) FROM v9),
v10 AS MATERIALIZED (SELECT *, CAST(c = 'MEDIUM' AND s = 'Brand#22' AND p IN ('old widget', 'new widget') AS INT) AS h100 FROM v9b),
v10b AS MATERIALIZED (SELECT * REPLACE (CASE WHEN h100 = 1 AND p = 'old widget' THEN 'BULK' WHEN h100 = 1 THEN 'SMALL' ELSE c END AS c,
  CASE WHEN h100 = 1 THEN 'Widgets' ELSE s END AS s) FROM v10),
v11 AS MATERIALIZED (SELECT *, CAST(NOT d AND ((c = 'PROMO' AND s IN ('Brand#23', 'Brand#24')) OR (c = 'LARGE' AND s = 'Brand#1')) AS INT) AS h110 FROM v10b),
v11b AS MATERIALIZED (SELECT * REPLACE (CASE WHEN h110 = 1 AND s = 'Brand#23' THEN 'SMALL' ELSE c END AS c,
  d OR coalesce(h110 = 1 AND s IN ('Brand#24', 'Brand#1'), FALSE) AS d) FROM v11),
v12 AS MATERIALIZED (SELECT *, CASE WHEN coalesce(c = 'MEDIUM' AND s IN ('Brand#25', 'Brand#11'), FALSE) THEN
    CASE WHEN contains(lower(p), 'new ') OR contains(lower(p), 'ring') THEN 1
         WHEN contains(lower(p), 'rod') OR contains(lower(p), 'bolt') THEN 2
         WHEN contains(lower(p), 'gizmo') THEN 3 END END AS arm FROM v11b),
v12b AS MATERIALIZED (SELECT * REPLACE (CASE WHEN arm = 2 THEN 'BULK' ELSE c END AS c,
  CASE arm WHEN 1 THEN 'New Things' WHEN 2 THEN 'Rods' WHEN 3 THEN 'Gizmos' ELSE s END AS s),
  CAST(arm IS NOT NULL AS INT) AS h120 FROM v12),
v13 AS MATERIALIZED (SELECT *, CAST({_SW} AS INT) AS h130 FROM v12b),
vf AS MATERIALIZED (SELECT * REPLACE (CASE WHEN h130 = 1 THEN 'SMALLWARE' ELSE c END AS c,
  CASE WHEN h130 = 1 THEN 'Small Items' ELSE s END AS s) FROM v13)"""


@query(
    "validate_cascade",
    f"""WITH {LISTINGS_DIRTY}, {validate_sql('listings_dirty')}
        SELECT row_id, c AS category, s AS subcategory, p AS product_category FROM vf WHERE NOT d""",
)
def validate_cascade(spark, sf):
    return cascade.apply_rules(listings_dirty(spark, sf), demo_pack("validate"), strip=False)


_HIT_NAMES = {
    10: "rename_large", 20: "drop_surplus", 30: "drop_items", 40: "thermal_items",
    50: "standard_to_thermal", 60: "standard_additives", 70: "economy_hardware", 80: "makers",
    90: "split_software", 100: "engineering", 110: "pair_fixes", 120: "tools_split",
    130: "software_items",
}
_HIT_ROWS = " UNION ALL ".join(
    f"SELECT CAST({n} AS INTEGER) AS seq, '{name}' AS rule_id, CAST(coalesce(sum(h{n}), 0) AS BIGINT) AS hits FROM vf"
    for n, name in _HIT_NAMES.items()
)


@query("rule_hits", f"WITH {LISTINGS_DIRTY}, {validate_sql('listings_dirty')} {_HIT_ROWS}")
def rule_hits(spark, sf):
    return cascade.rule_hits(listings_dirty(spark, sf), demo_pack("validate"), strip=False)


# --- keywords in a table: the words of one table, looked up in the texts of another

KEYWORD_TABLE = """kw AS (SELECT w AS keyword, min(item_id) AS priority, 'item ' || min(item_id) % 7 AS label
    FROM (SELECT item_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM benchmark)
    WHERE length(w) >= 4 GROUP BY 1)"""


def word_table(spark, sf):
    """(keyword, priority, label), stored: every word of the benchmark, the first item's number as priority."""
    split = F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("keyword")
    words = read(spark, sf, "benchmark").select("item_id", split).where(F.length("keyword") >= 4)
    first = words.groupBy("keyword").agg(F.min("item_id").alias("priority"))
    label = F.concat(F.lit("item "), (F.col("priority") % 7).cast("string"))
    return stage(first.withColumn("label", label), "keywords")


@query(
    "kw_table_hits",
    f"""WITH {KEYWORD_TABLE} SELECT doc_id, count(*) AS n FROM documents JOIN kw ON contains(lower(text), keyword) GROUP BY 1""",
)
def kw_table_hits(spark, sf):
    """How many different words of the table each document holds anywhere in its text."""
    docs = documents(spark, sf)
    held = keywords.hits(docs, "text", word_table(spark, sf), digests=True)
    found = held.groupBy("text_digest").agg(F.count(F.lit(1)).alias("n"))
    return docs.select("doc_id", keywords.digest("text").alias("text_digest")).join(found, "text_digest").select("doc_id", "n")


@query(
    "kw_table_classify",
    f"""WITH {KEYWORD_TABLE}, h AS (SELECT doc_id, min(struct_pack(priority := priority, label := label)) AS best
          FROM documents JOIN kw ON contains(' ' || lower({strip_sql('text')}) || ' ', ' ' || keyword || ' ')
            OR ends_with(lower({strip_sql('text')}), keyword) GROUP BY 1)
        SELECT doc_id, coalesce(best.label, 'none') AS label FROM documents LEFT JOIN h USING (doc_id)""",
)
def kw_table_classify(spark, sf):
    labelled = keywords.classify(documents(spark, sf), "text", word_table(spark, sf), "none", "label", "padded_suffix")
    return labelled.select("doc_id", "label")

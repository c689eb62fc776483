"""Queries for aggregation, deduplication, collapse, reports and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, hierarchy as H, quality, upkeep
from ..operators.rules import member_of
from ..operators.tables import small_table
from ..sources.stages import stage
from .registry import (
    LISTINGS, LISTINGS_DIRTY, TAX, TAX_DIRTY, listings, listings_dirty, query, strip_sql, tax,
    tax_dirty,
)

COLS = "category, subcategory, product_category"
MIN_ITEMS = 13


@query(
    "group_count",
    f"WITH {LISTINGS} SELECT category, subcategory, count(*) AS n FROM listings GROUP BY ALL",
)
def group_count(spark, sf):
    return H.group_sizes(listings(spark, sf))


@query(
    "value_counts",
    f"WITH {LISTINGS_DIRTY} SELECT subcategory, count(*) AS n FROM listings_dirty"
    " WHERE subcategory IS NOT NULL GROUP BY 1",
)
def value_counts(spark, sf):
    return H.value_counts(listings_dirty(spark, sf), "subcategory")


@query(
    "distinct_counts",
    f"""WITH {LISTINGS_DIRTY} SELECT count(DISTINCT category) AS n_category,
          count(DISTINCT subcategory) AS n_subcategory,
          count(DISTINCT product_category) AS n_product_category FROM listings_dirty""",
)
def distinct_counts(spark, sf):
    return quality.distinct_counts(listings_dirty(spark, sf), COLS.split(", "))


@query(
    "thin_groups",
    f"""WITH {TAX} SELECT category, subcategory, count(*) AS n FROM tax GROUP BY ALL
        HAVING count(*) < {MIN_ITEMS}""",
)
def thin_groups(spark, sf):
    return H.thin_groups(tax(spark, sf), MIN_ITEMS)


@query(
    "largest_sibling",
    f"""WITH {LISTINGS}, g AS (SELECT category, subcategory, count(*) AS n FROM listings GROUP BY ALL)
        SELECT category, subcategory, n FROM (SELECT *, row_number() OVER
          (PARTITION BY category ORDER BY n DESC, subcategory) AS rn FROM g) WHERE rn = 1""",
)
def largest_sibling(spark, sf):
    return H.largest_child(H.group_sizes(listings(spark, sf)))


@query("exact_dedup", f"WITH {LISTINGS_DIRTY} SELECT DISTINCT {COLS} FROM listings_dirty")
def exact_dedup(spark, sf):
    return listings_dirty(spark, sf).select(*COLS.split(", ")).distinct()


@query(
    "dedup_subset",
    f"""WITH {TAX_DIRTY} SELECT row_id, {COLS} FROM (SELECT *, row_number() OVER
          (PARTITION BY {COLS} ORDER BY row_id) AS rn FROM tax_dirty) WHERE rn = 1""",
)
def dedup_subset(spark, sf):
    return dedup.keep_first(tax_dirty(spark, sf), COLS.split(", "), ["row_id"])


@query(
    "priority_dedup",
    f"""WITH {LISTINGS}, u AS (SELECT DISTINCT {COLS} FROM listings),
        a AS (SELECT *, row_number() OVER (PARTITION BY category, product_category
              ORDER BY length(subcategory) DESC, subcategory) AS rn FROM u),
        b AS (SELECT *, row_number() OVER (PARTITION BY product_category
              ORDER BY length(subcategory) DESC, subcategory, category) AS rn2 FROM a WHERE rn = 1)
        SELECT {COLS} FROM b WHERE rn2 = 1""",
)
def priority_dedup(spark, sf):
    return dedup.priority(listings(spark, sf)).select(*COLS.split(", "))


@query(
    "priority_dedup_ci",
    f"""WITH {LISTINGS_DIRTY}, u AS (SELECT DISTINCT {COLS} FROM listings_dirty
          WHERE category IS NOT NULL AND subcategory IS NOT NULL AND {strip_sql('product_category')} <> ''),
        b AS (SELECT *, row_number() OVER (PARTITION BY lower({strip_sql('product_category')})
              ORDER BY length(subcategory) DESC, subcategory, category, product_category) AS rn FROM u)
        SELECT {COLS} FROM b WHERE rn = 1""",
)
def priority_dedup_ci(spark, sf):
    clean = dedup.drop_missing(listings_dirty(spark, sf), COLS.split(", "), ["product_category"])
    return dedup.priority(clean, ignore_case=True).select(*COLS.split(", "))


@query(
    "dedup_losses",
    f"""WITH {LISTINGS}, c AS (SELECT count(*) AS n,
          (SELECT count(*) FROM (SELECT DISTINCT {COLS} FROM listings)) AS t,
          (SELECT count(*) FROM (SELECT DISTINCT category, product_category FROM listings)) AS p,
          (SELECT count(DISTINCT product_category) FROM listings) AS i FROM listings)
        SELECT n AS input_rows, n - t AS exact_duplicates, t - p AS cross_child_duplicates,
          p - i AS cross_parent_duplicates, i AS output_rows FROM c""",
)
def dedup_losses(spark, sf):
    return dedup.losses(listings(spark, sf))


_COLLAPSE = f"""g AS (SELECT category, subcategory, count(*) AS n FROM src
    WHERE category IS NOT NULL AND subcategory IS NOT NULL GROUP BY ALL),
  fat AS (SELECT category, subcategory AS big FROM (SELECT *, row_number() OVER
    (PARTITION BY category ORDER BY n DESC, subcategory) AS rn FROM g WHERE n >= {MIN_ITEMS}) WHERE rn = 1),
  last AS (SELECT category, max(subcategory) AS last_sub FROM g GROUP BY 1),
  m AS (SELECT g.category, g.subcategory, CASE WHEN n >= {MIN_ITEMS} THEN g.subcategory
    ELSE coalesce(big, last_sub) END AS new_sub
    FROM g LEFT JOIN fat USING (category) JOIN last USING (category))"""


@query(
    "collapse_thin",
    f"""WITH {TAX}, src AS (FROM tax), {_COLLAPSE}
        SELECT row_id, category, new_sub AS subcategory, product_category
        FROM tax JOIN m USING (category, subcategory)""",
)
def collapse_thin(spark, sf):
    return H.collapse_thin(tax(spark, sf), MIN_ITEMS)


@query(
    "collapse_thin_nulls",
    f"""WITH {TAX_DIRTY}, src AS (FROM tax_dirty), {_COLLAPSE}
        SELECT row_id, t.category, coalesce(new_sub, t.subcategory) AS subcategory, product_category
        FROM tax_dirty t LEFT JOIN m ON t.category = m.category AND t.subcategory = m.subcategory""",
)
def collapse_thin_nulls(spark, sf):
    return H.collapse_thin(tax_dirty(spark, sf), MIN_ITEMS)


_METRICS = {
    "small_rows": ("category = 'SMALL'", None),
    "brand_3_remaining": ("subcategory = 'Brand#3'", 0),
    "red_bolts": ("category = 'SMALL' AND product_category IN ('red bolt', 'red rod')", 100000000),
}
_MEASURES = [
    ("final_products", "count(*)", None),
    ("final_subcategories", "count(DISTINCT subcategory)", None),
    ("final_categories", "count(DISTINCT category)", None),
    *[(name, f"count(*) FILTER ({cond})", limit) for name, (cond, limit) in _METRICS.items()],
]
_REPORT = " UNION ALL ".join(
    f"""SELECT '{name}' AS metric, {expr} AS value,
    CAST({'NULL' if limit is None else limit} AS BIGINT) AS target,
    {expr} <= CAST({'NULL' if limit is None else limit} AS BIGINT) AS ok FROM listings_dirty"""
    for name, expr, limit in _MEASURES
)


@query("validation_report", f"WITH {LISTINGS_DIRTY} {_REPORT}")
def validation_report(spark, sf):
    conditions = {name: F.expr(cond) for name, (cond, _) in _METRICS.items()}
    targets = {name: limit for name, (_, limit) in _METRICS.items() if limit is not None}
    return quality.report(listings_dirty(spark, sf), conditions, targets)


# --- checks; each gives (check, key, n, sample)


def _grouped(check, source, where, key, sample):
    return f"""SELECT '{check}' AS "check", {key} AS key, count(*) AS n, min({sample}) AS sample
        FROM {source} WHERE {where} GROUP BY 2"""


def _spread(check, source, key, value):
    return f"""SELECT '{check}' AS "check", {key} AS key, count(DISTINCT {value}) AS n, min({value}) AS sample
        FROM {source} WHERE {key} IS NOT NULL GROUP BY 2 HAVING count(DISTINCT {value}) > 1"""


def _one(spark, values):
    return small_table(spark, ["value"], [[v] for v in values])


CLOSED = ["STANDARD", "ECONOMY", "MEDIUM", "LARGE", "SMALL", "PROMO"]


@query(
    "chk_closed_set",
    f"WITH {TAX_DIRTY} " + _grouped(
        "closed_set", "tax_dirty", "category NOT IN ('STANDARD','ECONOMY','MEDIUM','LARGE','SMALL','PROMO')",
        "category", "subcategory"),
)
def chk_closed_set(spark, sf):
    return H.outside_closed_set(tax_dirty(spark, sf), _one(spark, CLOSED))


@query("chk_unique_child", f"WITH {LISTINGS} " + _spread("unique_child", "listings", "subcategory", "category"))
def chk_unique_child(spark, sf):
    return H.child_under_many_parents(listings(spark, sf))


@query(
    "chk_forbidden_child",
    f"WITH {LISTINGS} " + _grouped(
        "forbidden_child", "listings", "subcategory IN ('Brand#1', 'Brand#25', 'SMALL')", "subcategory", "category"),
)
def chk_forbidden_child(spark, sf):
    return H.forbidden_children(listings(spark, sf), _one(spark, ["Brand#1", "Brand#25", "SMALL"]))


@query(
    "chk_entity_child",
    f"WITH {LISTINGS} " + _grouped(
        "entity_child", "listings",
        "contains(' ' || lower(subcategory), ' brand#1') OR contains(' ' || lower(subcategory), ' agent')",
        "subcategory", "category"),
)
def chk_entity_child(spark, sf):
    return H.entity_children(listings(spark, sf), ["brand#1", "agent"])


def _variants(df):
    """Item names as child names in several spellings."""
    item = F.col("product_category")
    kind = F.col("row_id") % 4
    name = (
        F.when(kind == 0, item).when(kind == 1, F.upper(item))
        .when(kind == 2, F.concat(item, F.lit(" And Service")))
        .otherwise(F.concat(item, F.lit(" & Service")))
    )
    return df.withColumn("subcategory", name)


VARIANTS = f"""{TAX}, variants AS (SELECT row_id, category, CASE row_id % 4 WHEN 0 THEN product_category
    WHEN 1 THEN upper(product_category) WHEN 2 THEN product_category || ' And Service'
    ELSE product_category || ' & Service' END AS subcategory, product_category FROM tax)"""


@query(
    "chk_format_dups",
    f"WITH {VARIANTS} " + _spread(
        "format_dups", "variants", r"regexp_replace(lower(subcategory), '\band\b', '&', 'g')", "subcategory"),
)
def chk_format_dups(spark, sf):
    return H.format_duplicates(_variants(tax(spark, sf)))


@query(
    "chk_service_child",
    f"WITH {VARIANTS} " + _grouped(
        "service_child", "variants",
        r"regexp_matches(lower(subcategory), 'services?\b') AND category NOT IN ('PROMO', 'LARGE')",
        "subcategory", "category"),
)
def chk_service_child(spark, sf):
    return H.service_children(_variants(tax(spark, sf)), ["PROMO", "LARGE"])


@query(
    "chk_forbidden_pairs",
    f"WITH {LISTINGS} " + _grouped(
        "forbidden_pairs", "listings",
        "(category, subcategory) IN (('SMALL', 'Brand#1'), ('PROMO', 'Brand#2'), ('LARGE', 'none'))",
        "category || ' > ' || subcategory", "product_category"),
)
def chk_forbidden_pairs(spark, sf):
    pairs = [("SMALL", "Brand#1"), ("PROMO", "Brand#2"), ("LARGE", "none")]
    return H.forbidden_pairs(listings(spark, sf), small_table(spark, ["parent", "child"], pairs))


@query(
    "chk_multi_parent",
    f"WITH {LISTINGS} " + _spread(
        "multi_parent", "listings", "product_category", "category || ' > ' || subcategory"),
)
def chk_multi_parent(spark, sf):
    return H.item_under_many_parents(listings(spark, sf))


@query(
    "chk_thin_group",
    f"""WITH {TAX} SELECT 'thin_group' AS "check", category || ' > ' || subcategory AS key,
          count(*) AS n, subcategory AS sample FROM tax GROUP BY category, subcategory
        HAVING count(*) < {MIN_ITEMS}""",
)
def chk_thin_group(spark, sf):
    return H.thin_violations(tax(spark, sf), MIN_ITEMS)


_ALL = " UNION ALL ".join(
    [
        _grouped("closed_set", "listings_dirty", "category NOT IN ('STANDARD','ECONOMY','MEDIUM','LARGE','SMALL','PROMO')",
                 "category", "subcategory"),
        _spread("unique_child", "listings_dirty", "subcategory", "category"),
        _grouped("forbidden_child", "listings_dirty", "subcategory = 'Brand#1'", "subcategory", "category"),
        _grouped("entity_child", "listings_dirty", "contains(' ' || lower(subcategory), ' brand#2')",
                 "subcategory", "category"),
        f"""SELECT 'thin_group' AS "check", category || ' > ' || subcategory AS key, count(*) AS n, subcategory AS sample
            FROM listings_dirty WHERE subcategory IS NOT NULL GROUP BY category, subcategory HAVING count(*) < 40""",
        _spread("format_dups", "listings_dirty", "lower(subcategory)", "subcategory"),
        _grouped("service_child", "listings_dirty", "regexp_matches(lower(subcategory), 'services?\\b') AND category NOT IN ('PROMO')",
                 "subcategory", "category"),
        _grouped("forbidden_pairs", "listings_dirty", "category = 'SMALL' AND subcategory = 'Brand#1'",
                 "category || ' > ' || subcategory", "product_category"),
        _spread("multi_parent", "listings_dirty", "product_category", "concat_ws(' > ', category, subcategory)"),
    ]
)


@query("hierarchy_check", f"WITH {LISTINGS_DIRTY} {_ALL}")
def hierarchy_check(spark, sf):
    """Every check at once over the grouped data."""
    return H.check(
        listings_dirty(spark, sf), CLOSED, ["Brand#1"], [("SMALL", "Brand#1")], ["brand#2"],
        ["PROMO"], min_items=40,
    )


@query(
    "chk_scoped_members",
    f"""WITH {LISTINGS} SELECT category, count(*) AS n, count(*) FILTER (subcategory IN ('Brand#1', 'Brand#2')) AS hits
        FROM listings GROUP BY 1""",
)
def chk_scoped_members(spark, sf):
    """Conditional counts per parent, many conditions in one aggregate."""
    hits = F.count_if(member_of("subcategory", ["Brand#1", "Brand#2"])).alias("hits")
    return listings(spark, sf).groupBy("category").agg(F.count(F.lit(1)).alias("n"), hits)


# --- kept up to date, rolled up, sketched

def arrivals(spark, sf, n=3):
    """The listings with a value and an item, once a batch, as batches that arrive one after another."""
    names = COLS.split(", ")
    clean = dedup.drop_missing(listings_dirty(spark, sf), names, ["product_category"])
    dealt = clean.withColumn("batch", F.pmod(F.xxhash64("row_id"), F.lit(n)))
    # Stored: the parts meet the lines once, not once for each step and batch.
    stored = stage(dealt.dropDuplicates([*names, "batch"]), "kept-arrivals")
    return [stored.where(F.col("batch") == k).drop("batch") for k in range(n)]


def kept_up(spark, sf):
    """State and sizes after all batches; each batch meets only the state before it."""
    state = sizes = None
    for batch in arrivals(spark, sf):
        after = stage(upkeep.kept_rows(state, batch, ignore_case=True), "kept-rows")
        sizes = stage(upkeep.kept_sizes(sizes, state, after, batch, ignore_case=True), "kept-sizes")
        state = after
    return state, sizes


KEPT = f"""{LISTINGS_DIRTY}, u AS (SELECT DISTINCT {COLS} FROM listings_dirty
          WHERE category IS NOT NULL AND subcategory IS NOT NULL AND {strip_sql('product_category')} <> ''),
        b AS (SELECT *, row_number() OVER (PARTITION BY lower({strip_sql('product_category')})
              ORDER BY length(subcategory) DESC, subcategory, category, product_category) AS rn FROM u)"""


@query("priority_dedup_kept", f"WITH {KEPT} SELECT {COLS} FROM b WHERE rn = 1")
def priority_dedup_kept(spark, sf):
    return kept_up(spark, sf)[0].select(*COLS.split(", "))


@query(
    "group_sizes_kept",
    f"WITH {KEPT} SELECT category, subcategory, count(*) AS n FROM b WHERE rn = 1 GROUP BY ALL",
)
def group_sizes_kept(spark, sf):
    return kept_up(spark, sf)[1]


@query(
    "hierarchy_rollup",
    f"""WITH {LISTINGS_DIRTY}, p AS (SELECT category, subcategory, count(*) AS n FROM listings_dirty GROUP BY ALL)
        SELECT category, subcategory, CAST(grouping(category, subcategory) AS INTEGER) AS level,
          CAST(sum(n) AS BIGINT) AS n, count(*) AS n_children, count(*) FILTER (n < {MIN_ITEMS}) AS n_thin
        FROM p GROUP BY ROLLUP (category, subcategory)""",
)
def hierarchy_rollup(spark, sf):
    return H.rollup(listings_dirty(spark, sf), MIN_ITEMS)


@query(
    "distinct_sketches",
    f"""WITH {LISTINGS_DIRTY} SELECT category, count(DISTINCT product_category) AS n_distinct FROM listings_dirty GROUP BY 1""",
)
def distinct_sketches(spark, sf):
    """Sketches of two halves per (category, subcategory), stored, and united to the categories."""
    rows = listings_dirty(spark, sf)
    half = F.pmod(F.xxhash64("row_id"), F.lit(2))
    made = [
        stage(quality.distinct_sketches(rows.where(half == k), ["category", "subcategory"], "product_category"), "sketches")
        for k in (0, 1)
    ]
    pairs = quality.merge_sketches(*made, by=["category", "subcategory"])
    return quality.estimates(quality.merge_sketches(pairs, by=["category"]))

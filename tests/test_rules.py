"""Lookups, moves and packs on small tables; null versus absent keys."""

import pytest
from pyspark.sql import functions as F

from catalogops.operators import cascade, rules as R
from catalogops.operators.tables import mapping_table, probe, small_table
from catalogops.sources import packs

SCHEMA = "row_id long, category string, subcategory string, product_category string"


def frame(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


def pairs(df):
    return [(r.category, r.subcategory) for r in df.orderBy("row_id").collect()]


def test_probe_tells_null_value_from_absent_key(spark):
    df = frame(spark, ("c", "a", "p"), ("c", "b", "p"), ("c", "z", "p"), ("c", None, "p"))
    out = probe(df, mapping_table(spark, {"a": "v", "b": None}), {"key": F.col("subcategory")}, "t")
    got = [(r.t is not None, r.t and r.t.value) for r in out.orderBy("row_id").collect()]
    assert got == [(True, "v"), (True, None), (False, None), (False, None)]


def test_canonical_value(spark):
    df = frame(spark, (" BOOKS\t", "a", "p"), ("Toys", "a", "p"), (None, "a", "p"))
    out = R.canonical_value(df, mapping_table(spark, {"books": "Books"}), "category")
    assert pairs(out) == [("Books", "a"), ("Toys", "a"), (None, "a")]


def test_move_out_and_fallback(spark):
    df = frame(
        spark, ("S", "x", "p"), ("S", "gone", "p"), ("S", "Market Gone", "p"), ("S", "told", "p"),
        ("O", "gone", "p"), ("S", "other", "p"),
    )
    names = mapping_table(spark, {"x": "y", "gone": None, "Market Gone": None, "told": None})
    targets = small_table(spark, ["key", "parent", "value"], [("told", "V", "named")])
    out = R.move_out(df, names, "S", "V", targets, [R.Group(("market",), "ads")], "web")
    assert pairs(out) == [
        ("S", "y"), ("V", "web"), ("V", "ads"), ("V", "named"), ("O", "gone"), ("S", "other")
    ]
    spare = mapping_table(spark, {"S": "spare"})
    out = R.replace_or_fallback(df, mapping_table(spark, {"gone": None, "x": "y"}), spare)
    assert pairs(out)[:2] == [("S", "y"), ("S", "spare")]
    assert pairs(out)[4] == ("O", "General Products")


def test_reparent_is_one_hop(spark):
    df = frame(spark, ("a", "k", "p"), ("a", "m", "p"))
    moves = mapping_table(spark, {"k": "b", "m": "c"})
    targets = small_table(spark, ["key", "parent", "value"], [("k", "b", "m")])
    assert pairs(R.reparent(df, moves, targets)) == [("b", "m"), ("c", "m")]


def test_assign_reads_the_same_input_row(spark):
    df = frame(spark, ("a", "b", "p"))
    out = R.assign(
        df, F.lit(True), {"category": F.col("subcategory"), "subcategory": F.col("category")}
    )
    assert pairs(out) == [("b", "a")]


def test_member_of_quotes_names(spark):
    df = frame(spark, ("Men's \\ x", "b", "p"), (None, "b", "p"))
    got = df.select(R.member_of("category", ["Men's \\ x", "y"]).alias("m")).collect()
    assert [r.m for r in got] == [True, False]


def test_priority_sets_first_set_wins(spark):
    df = frame(spark, ("c", "s", "p"), ("c", "s", "q"), ("c", "s", "r"), ("d", "s", "p"))
    out = R.priority_sets(df, [("one", ["p"]), ("two", ["p", "q"])], F.col("category") == "c")
    assert pairs(out) == [("c", "one"), ("c", "two"), ("c", "s"), ("d", "s")]


def test_fix_or_delete(spark):
    df = frame(spark, ("a", "x", "p"), ("a", "y", "p"), ("a", "z", "p")).withColumn("gone", F.lit(False))
    table = small_table(
        spark, ["key", "key2", "parent", "child", "action"],
        [("a", "x", "b", "x2", None), ("a", "y", None, None, "delete")],
    )
    on = {"key": F.col("category"), "key2": F.col("subcategory")}
    out = R.assign_pair(df, table, on, deleted="gone")
    assert [(r.category, r.subcategory, r.gone) for r in out.orderBy("row_id").collect()] == [
        ("b", "x2", False), ("a", "y", True), ("a", "z", False)
    ]


def test_split_keeps_order_and_scope(spark):
    df = frame(spark, ("m", "t", "steel rod wrap"), ("m", "t", "rod"), ("m", "t", "nut"), ("n", "t", "rod"))
    groups = [R.Group(("wrap",), "packing"), R.Group(("rod",), "metal", "raw")]
    out = R.split_by_keywords(df, F.col("category") == "m", groups)
    assert pairs(out) == [("m", "packing"), ("raw", "metal"), ("m", "t"), ("n", "t")]


PACK = [
    {"seq": 1, "rule_id": "fallback", "kind": "fallback", "entries": [{"key": "A", "value": "spare"}]},
    {"seq": 2, "rule_id": "names", "kind": "rename", "column": "subcategory",
     "entries": [{"key": "old", "value": "new"}, {"key": "bad", "value": None}]},
    {"seq": 3, "rule_id": "moves", "kind": "reparent",
     "entries": [{"key": "old", "value": "B"}, {"key": "new", "value": "B"}]},
    {"seq": 4, "rule_id": "never", "kind": "set_move", "scope_item": ["nothing"], "set_category": "X"},
]


def test_pack_runs_in_order_and_counts_hits(spark):
    df = frame(spark, ("A", " old ", "p"), ("A", "bad", "p"), ("A", "new", "p"), ("C", None, "p"))
    pack = packs.from_dicts(PACK)
    assert pairs(cascade.apply_rules(df, pack)) == [("B", "new"), ("A", "spare"), ("B", "new"), ("C", None)]
    hits = {r.rule_id: r.hits for r in cascade.rule_hits(df, pack).collect()}
    assert hits == {"names": 2, "moves": 2, "never": 0}


def test_result_does_not_depend_on_partitioning(spark, sf):
    from catalogops.plans import queries_rules, registry

    pack = queries_rules.demo_pack("correct")
    rows = registry.tax_dirty(spark, sf)
    one = sorted(map(str, cascade.apply_rules(rows.repartition(1), pack).collect()))
    many = sorted(map(str, cascade.apply_rules(rows.repartition(7), pack).collect()))
    assert one == many


def test_cascade_on_distinct_pairs_gives_the_same(spark, sf):
    """The correction pack depends on (category, subcategory) only."""
    from catalogops.plans import queries_rules, registry

    pack = queries_rules.demo_pack("correct")
    rows = registry.tax_dirty(spark, sf)
    direct = {(r.category, r.subcategory) for r in cascade.apply_rules(rows, pack).collect()}
    distinct = rows.select("category", "subcategory").distinct().withColumn("product_category", F.lit("p"))
    assert direct == {(r.category, r.subcategory) for r in cascade.apply_rules(distinct, pack).collect()}


def test_pack_from_file_equals_pack_from_text(spark):
    from catalogops.plans.queries_rules import DEMO

    for name in ("correct", "validate"):
        path = DEMO / f"{name}.json"
        assert packs.load(spark, f"file://{path}") == packs.from_json(path.read_text())


@pytest.mark.parametrize(
    "rules",
    [
        [{"seq": 1, "rule_id": "a", "kind": "no such kind"}],
        [{"seq": 1, "rule_id": "a", "kind": "split"}, {"seq": 1, "rule_id": "b", "kind": "split"}],
        [{"seq": 1, "rule_id": "a", "kind": "rename", "entries": [{"key": "k"}, {"key": "k"}]}],
    ],
)
def test_bad_packs_are_refused(rules):
    with pytest.raises(ValueError):
        packs.from_dicts(rules)


def test_dead_keys(spark, tmp_path):
    import json

    path = tmp_path / "pack.json"
    path.write_text(json.dumps(PACK))
    dead = packs.dead_keys(packs.table(spark, f"file://{path}")).collect()
    assert [(r.rule_id, r.key) for r in dead] == [("moves", "old")]


def test_filters_after_a_long_pack_keep_the_plan_small(spark, sf):
    from catalogops.plans import registry

    rules = [
        {"seq": i, "rule_id": f"r{i}", "kind": "set_move", "scope_category": [f"c{i}"],
         "scope_subcategory": [f"s{i}"], "set_category": f"c{i + 1}", "set_subcategory": f"s{i + 1}"}
        for i in range(15)
    ]
    out = cascade.apply_rules(registry.tax(spark, sf), packs.from_dicts(rules)).where("category = 'x'")
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 50_000


# --- packs: nothing is ignored, nothing multiplies rows

def _row(category, subcategory, item):
    return (category, subcategory, item)


def test_repeated_names_scopes_and_labels(spark):
    pack = packs.from_dicts([
        {"seq": 1, "rule_id": "f1", "kind": "fallback", "entries": [{"key": "A", "value": "old"}, {"key": "B", "value": "b"}]},
        {"seq": 2, "rule_id": "f2", "kind": "fallback", "entries": [{"key": "A", "value": "new"}]},
        {"seq": 3, "rule_id": "out", "kind": "move_out", "scope_category": ["A", "B", "A"], "set_category": "S",
         "default_value": "d", "entries": [{"key": "x", "value": None}]},
        {"seq": 4, "rule_id": "bad", "kind": "forbid", "keywords": ["y", "y"]},
        {"seq": 5, "rule_id": "move", "kind": "set_move", "scope_subcategory": ["z", "z"], "set_category": "M"},
        {"seq": 6, "rule_id": "sets", "kind": "priority_sets", "scope_category": ["A"], "entries": [
            {"key": "i1", "value": "one"}, {"key": "i2", "value": "two"}, {"key": "i2", "value": "one"}]},
    ])
    rows = [_row("A", "x", "p"), _row("B", "x", "p"), _row("C", "x", "p"), _row("A", "y", "p"), _row("A", "z", "p"),
            _row("A", "q", "i2")]
    df = spark.createDataFrame(rows, "category string, subcategory string, product_category string")
    got = sorted(tuple(r) for r in cascade.apply_rules(df, pack).collect())
    assert got == sorted([("S", "d", "p"), ("S", "d", "p"), ("C", "x", "p"), ("A", "new", "p"), ("M", "z", "p"), ("A", "two", "i2")])


@pytest.mark.parametrize("rule", [
    {"kind": "rename", "column": "subcategory", "scope_category": ["A"], "entries": [{"key": "a", "value": "b"}]},
    {"kind": "forbid", "keywords": ["a"], "match": "word"},
    {"kind": "set_move", "set_category": "M"},
    {"kind": "move_out", "set_category": "M", "default_value": "d", "entries": [{"key": "a", "value": None}]},
    {"kind": "rename", "column": "category", "table": "/t", "entries": [{"key": "a", "value": "b"}]},
])
def test_fields_that_a_kind_does_not_read_are_refused(rule):
    with pytest.raises(ValueError):
        packs.from_dicts([{"seq": 1, "rule_id": "r", **rule}])


def test_rule_on_a_table_of_its_own(spark, tmp_path):
    path = str(tmp_path / "entries")
    entries = [(f"k{i}", f"v{i}") for i in range(500)] + [("k1", "v0")]
    spark.createDataFrame(entries, "key string, value string").write.parquet(path)
    pack = packs.from_dicts([{"seq": 1, "rule_id": "r", "kind": "rename", "column": "category", "table": path}])
    df = spark.createDataFrame([("k7", "s", "p"), ("none", "s", "p"), ("k1", "s", "p")],
                               "category string, subcategory string, product_category string")
    assert sorted(r.category for r in cascade.apply_rules(df, pack).collect()) == ["none", "v0", "v7"]

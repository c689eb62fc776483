"""Deduplication, collapse and batching against short sequential versions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalogops.operators import batching, dedup, hierarchy as H
from catalogops.plans import queries_groups, registry

SCHEMA = "row_id long, category string, subcategory string, product_category string"


def random_rows(seed, n=300):
    rng = random.Random(seed)
    subs = ["a", "bb", "cc", "ddd", "eee"]
    items = ["x", "X", " x", "y", "z z", "Z z", "w"]
    return [
        (i, rng.choice("PQR"), rng.choice(subs), rng.choice(items)) for i in range(n)
    ]


def sequential_priority(rows, fold):
    seen, unique = set(), []
    for r in rows:
        if r[1:] not in seen:
            seen.add(r[1:])
            unique.append(r)
    unique.sort(key=lambda r: (-len(r[2]), r[2], r[1], r[3], r[0]))
    for key in (lambda r: (r[1], r[3]), lambda r: r[3].strip().lower() if fold else r[3]):
        kept, used = [], set()
        for r in unique:
            if key(r) not in used:
                used.add(key(r))
                kept.append(r)
        unique = kept
    return sorted(unique)


@pytest.mark.parametrize("fold", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_priority_equals_the_three_step_chain(spark, seed, fold):
    rows = random_rows(seed, 40 if seed == 3 else 300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = dedup.priority(df, ignore_case=fold).collect()
    assert sorted(tuple(r) for r in got) == sequential_priority(rows, fold)


def sequential_collapse(rows, least):
    rows = [list(r) for r in rows]
    for _ in range(5):
        sizes = Counter((c, s) for _, c, s, _ in rows)
        thin = sorted(k for k, n in sizes.items() if n < least)
        if not thin:
            break
        for c, s in thin:
            now = Counter(r[2] for r in rows if r[1] == c and r[2] != s)
            if not now:
                continue
            best = min(now, key=lambda k: (-now[k], k))
            for r in rows:
                if r[1] == c and r[2] == s:
                    r[2] = best
    return sorted(map(tuple, rows))


@pytest.mark.parametrize("seed", range(6))
def test_collapse_equals_the_pass_by_pass_procedure(spark, seed):
    rng = random.Random(seed)
    rows = [
        (i, rng.choice("PQRS"), rng.choice("abcdefg"[: 2 + seed]), "x")
        for i in range(rng.choice([6, 25, 60]))
    ]
    got = H.collapse_thin(spark.createDataFrame(rows, SCHEMA), 8).select("row_id", "category", "subcategory", "product_category")
    assert sorted(tuple(r) for r in got.collect()) == sequential_collapse(rows, 8)


def test_collapse_edge_cases(spark):
    rows = [("fat", "big")] * 9 + [("fat", "tiny")] + [("thin", "a"), ("thin", "b"), ("thin", "b"), ("thin", "c")]
    rows += [("one", "only")] + [("tie", "x")] * 8 + [("tie", "y")] * 8 + [("tie", "z")]
    df = spark.createDataFrame([(i, c, s, "p") for i, (c, s) in enumerate(rows)], SCHEMA)
    sizes = {(r.category, r.subcategory): r.n for r in H.group_sizes(H.collapse_thin(df, 8)).collect()}
    assert sizes == {
        ("fat", "big"): 10, ("thin", "c"): 4, ("one", "only"): 1, ("tie", "x"): 9, ("tie", "y"): 8
    }


def test_losses_sum_up(spark):
    rows = random_rows(9)
    r = dedup.losses(spark.createDataFrame(rows, SCHEMA)).first()
    assert r.input_rows == len(rows)
    assert r.output_rows == len({x[3] for x in rows})
    assert r.exact_duplicates == len(rows) - len({x[1:] for x in rows})
    assert r.input_rows == r.output_rows + r.exact_duplicates + r.cross_child_duplicates + r.cross_parent_duplicates


def test_losses_of_nothing(spark):
    r = dedup.losses(spark.createDataFrame([], SCHEMA)).first()
    assert tuple(r) == (0, 0, 0, 0, 0)


@pytest.mark.parametrize("partitions", [1, 6])
def test_positions_are_dense_and_ordered(spark, partitions):
    keys = [(k,) for k in random.Random(3).sample(range(10_000), 501)]
    df = spark.createDataFrame(keys, "k long").repartition(partitions)
    got = {r.pos: r.k for r in batching.positions(df, ["k"]).collect()}
    assert [got[i] for i in range(501)] == sorted(k for k, in keys)


def test_positions_of_nothing(spark):
    assert batching.positions(spark.createDataFrame([], "k long"), ["k"]).count() == 0


def test_batches_round_trip(spark):
    df = spark.range(53).withColumn("v", F.concat(F.lit("v"), "id"))
    batched = batching.fixed_batches(df, 10, ["id"])
    packed = batching.pack_batches(batched, ["id", "v"])
    assert sorted((r.batch_id, len(r["items"])) for r in packed.collect()) == [
        (1, 10), (2, 10), (3, 10), (4, 10), (5, 10), (6, 3)
    ]
    back = batching.unpack_batches(packed).orderBy("batch_id", "idx").collect()
    assert [r.id for r in back] == list(range(53))


def test_check_reports_every_kind(spark):
    rows = [
        ("A", "s1", "p1"), ("B", "s1", "p1"), ("A", "A", "p2"), ("A", "Steel Dealers", "p3"),
        ("A", "Hand And Foot", "p4"), ("A", "hand & foot", "p5"), ("A", "Repair Services", "p6"),
        ("Z", "s9", "p7"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    out = H.check(df, ["A", "B"], ["A", "B"], [("Z", "s9")], ["dealer"], ["B"], min_items=2)
    kinds = {r.check for r in out.collect()}
    twice = H.check(df.unionByName(df), ["A", "B"], ["A", "B"], [("Z", "s9")], ["dealer"], ["B"], min_items=2)
    found = {(r.check, r.key): (r.n, r["sample"]) for r in twice.collect()}
    assert found["closed_set", "Z"] == (2, "s9")
    assert found["forbidden_child", "A"] == (2, "A")
    assert found["unique_child", "s1"] == (2, "A")
    assert found["forbidden_pairs", "Z > s9"] == (2, "p7")
    assert ("thin_group", "Z > s9") not in found
    assert kinds == {
        "closed_set", "unique_child", "forbidden_child", "entity_child", "thin_group",
        "format_dups", "service_child", "forbidden_pairs", "multi_parent",
    }


def test_batches_are_joined_once(spark, tmp_path):
    """The batches hold every line's listing, once a batch, and read what is stored: no join is run again for them."""
    parts = [(i, f"item {i}", f"Brand#{i % 3}", f"TYPE {i % 2}") for i in range(20)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    lines = [(i, i % 21 or None) for i in range(400)] * 2
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    batches = queries_groups.arrivals(spark, str(tmp_path))
    assert all("Join" not in b._jdf.queryExecution().executedPlan().toString() for b in batches)
    names = ["category", "subcategory", "product_category"]
    rows = registry.listings_dirty(spark, str(tmp_path))
    for k, batch in enumerate(batches):
        there = {(r.category, r.subcategory, r.product_category) for r in rows.where(F.pmod(F.xxhash64("row_id"), F.lit(3)) == k).collect()}
        expected = {x for x in there if None not in x and x[2].strip()}
        got = [(r.category, r.subcategory, r.product_category) for r in batch.select(*names).collect()]
        assert len(got) == len(set(got)) and set(got) == expected and got

"""Every registered query against its SQL, plus the shape of every plan."""

import pytest

import __spark_entry__ as E
from catalogops.operators import cascade
from catalogops.plans import queries_rules, registry
from compare import compare, connect

QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, sf, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], sf) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    rows = {r.metric: r.value for r in E.entry(spark).collect()}
    assert rows["final_products"] > 0 and rows["final_categories"] > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_needs_one_task_or_all_pairs(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert all("], [" in line for line in windows), "a window without partition keys"


def test_keep_first_is_pruned_before_the_shuffle(spark, sf):
    text = plan(QUERIES["priority_dedup"](spark, sf))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_cascade_is_one_pass(spark, sf):
    rows = registry.listings_dirty(spark, sf)
    text = plan(cascade.apply_rules(rows, queries_rules.demo_pack("correct")))
    assert "hashpartitioning" not in text and "RoundRobin" not in text
    assert "Python" not in text


def test_scan_reads_only_needed_columns(spark, sf):
    text = plan(QUERIES["group_count"](spark, sf))
    assert "l_extendedprice" not in text and "p_retailprice" not in text

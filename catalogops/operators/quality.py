"""Run metrics and residual counts: one aggregate, whatever their number."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .rules import Levels


def report(
    df: DataFrame,
    conditions: Mapping[str, Column],
    targets: Mapping[str, int] | None = None,
    levels: Levels = Levels(),
) -> DataFrame:
    """Long ``(metric, value, target, ok)``: sizes plus one count per condition.

    A target is the largest value that is still fine.
    """
    targets = targets or {}
    # Combine per (parent, child) first: few groups, so the distinct counts and
    # the totals are taken over a small table instead of expanded data.
    sums = {"final_products": F.count(F.lit(1))}
    sums.update({name: F.count_if(c) for name, c in conditions.items()})
    groups = df.groupBy(levels.parent, levels.child).agg(
        *[m.alias(name) for name, m in sums.items()]
    )
    row = groups.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums],
        F.count_distinct(levels.child).alias("final_subcategories"),
        F.count_distinct(levels.parent).alias("final_categories"),
    )
    measures = row.columns
    lines = [
        F.struct(
            F.lit(name).alias("metric"),
            F.col(name).alias("value"),
            F.lit(targets.get(name)).cast("long").alias("target"),
            (F.col(name) <= F.lit(targets.get(name)).cast("long")).alias("ok"),
        )
        for name in measures
    ]
    return row.select(F.inline(F.array(*lines)))


def metrics_row(report_df: DataFrame, **extra: object) -> DataFrame:
    """One row per run for a JSON sink: the metrics as a map, plus run facts."""
    return report_df.agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics")
    ).select("metrics", *[F.lit(v).alias(k) for k, v in extra.items()])


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False):
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(f"n_{c}") for c in columns])


# log2 of the buckets of a distinct-count sketch; the relative error is about 1.04 / sqrt(2 ** SKETCH_BITS).
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, by: list[str], column: str, bits: int = SKETCH_BITS) -> DataFrame:
    """``(by…, sketch)``: one mergeable sketch of the distinct values of ``column`` per group; NULLs are no value.

    Store it, and add later rows with :func:`merge_sketches`: the values
    themselves are not needed again.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, bits).alias("sketch"))


def merge_sketches(*tables: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of all tables, united per group: of later batches, or of any coarser level."""
    merged = tables[0].select(*by, "sketch")
    for t in tables[1:]:
        merged = merged.unionByName(t.select(*by, "sketch"))
    return merged.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimates(sketches: DataFrame, out: str = "n_distinct") -> DataFrame:
    """The number of distinct values that each sketch stands for."""
    return sketches.withColumn(out, F.hll_sketch_estimate("sketch")).drop("sketch")

"""Weighted rendezvous hashing of stable record keys.

Every (key, shard) pair gets a score that depends on nothing else, and a record
goes to the shard with the least score. Adding a shard therefore moves records
into the new shard only, and removing one moves only its own records.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Hash values are cut to 53 bits, what a double holds exactly.
_MANTISSA = 53


def _score(key: Column, shard: Column, weight: Column, seed: int) -> Column:
    """Exponential variate with rate ``weight``: the least of several is won in proportion to weight."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, shard), 64 - _MANTISSA)
    uniform = (bits.cast("double") + 0.5) / float(2**_MANTISSA)
    return -F.ln(uniform) / weight


def best_shard(key: Column, weights: Mapping[int, float], seed: int = 0) -> Column:
    """struct(score, shard) of the winning shard; equal scores go to the smaller shard number."""
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive, and there must be at least one")
    shards = F.array(*[
        F.struct(F.lit(int(s)).alias("shard"), F.lit(float(w)).alias("weight"))
        for s, w in sorted(weights.items())
    ])
    return F.array_min(F.transform(
        shards,
        lambda s: F.struct(_score(key, s["shard"], s["weight"], seed).alias("score"), s["shard"].alias("shard")),
    ))


def assign(
    df: DataFrame, key: str, weights: Mapping[int, float],
    grown: Mapping[int, float] | None = None, seed: int = 0,
) -> DataFrame:
    """Add ``shard`` and, when ``grown`` names the shards after a change, ``grown_shard``.

    The key's type and value decide, never its place or the other columns. A
    NULL key is a key like any other, so all rows with NULL share a shard; rows
    with equal keys share a shard. Columns of those names in ``df`` are
    replaced. An empty table gives an empty table.
    """
    out = df.withColumn("shard", best_shard(F.col(key), weights, seed)["shard"])
    if grown is not None:
        out = out.withColumn("grown_shard", best_shard(F.col(key), grown, seed)["shard"])
    return out


def number_slots(df: DataFrame, key: str, order: list[str], slices: int = 64) -> DataFrame:
    """Add ``slot``: 0, 1, 2 … without gaps inside each ``shard``.

    A shard is never sorted in one task. Its rows are cut into ``slices`` by a
    second hash of the key; slices are counted (one small table of shards x
    slices rows), and a row's slot is its place in its slice plus the sizes of
    the slices before it. Ties in ``order`` are rows that agree in every column
    named there, so which of them comes first makes no difference.
    """
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(F.lit("slice"), F.col(key)), F.lit(slices)).cast("int"))
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("_rows"))
        .select("shard", "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    place = Window.partitionBy("shard", "_slice").orderBy(*order)
    return (
        sliced.withColumn("_place", F.row_number().over(place))
        .join(offsets, ["shard", "_slice"])
        .withColumn("slot", (F.col("_place") - 1 + F.col("_offset")).cast("long"))
        .drop("_slice", "_place", "_offset")
    )

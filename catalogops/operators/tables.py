"""Small rule tables and the left-join probe used by every lookup."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A rule table built on the driver is broadcast up to this many rows; a larger
# one is joined without a hint and the planner decides from its size.
BROADCAST_ROWS = 200_000


# Bytes of text up to which such a table is broadcast; both bounds are checked.
BROADCAST_BYTES = 32 << 20


def small_table(
    spark: SparkSession,
    columns: Sequence[str],
    rows: Iterable[Sequence[str | None]],
    keys: int | None = None,
) -> DataFrame:
    """String table from driver-side rows; a repeated key keeps its last row.

    The first ``keys`` columns are the key; by default all columns are.
    """
    rows = list({tuple(r)[:keys]: tuple(r) for r in rows}.values())
    size = sum(len(v or "") for r in rows for v in r)
    arrays = [pa.array([r[i] for r in rows], pa.string()) for i in range(len(columns))]
    table = spark.createDataFrame(pa.table(arrays, names=list(columns)))
    small = len(rows) <= BROADCAST_ROWS and size <= BROADCAST_BYTES
    return F.broadcast(table) if small else table


def mapping_table(spark: SparkSession, mapping: Mapping[str, str | None]) -> DataFrame:
    """``(key, value)`` table from a dictionary; a None value stays a null value."""
    return small_table(spark, ["key", "value"], mapping.items(), keys=1)


def probe(
    df: DataFrame, table: DataFrame, on: Mapping[str, Column], tag: str
) -> DataFrame:
    """Left join that adds the matching row of ``table`` as the struct ``tag``.

    The struct is NULL when the key is absent and non-NULL when it is present,
    even if its value is NULL. Keys of ``table`` must be unique.
    """
    keys = {k: f"__{tag}_{k}" for k in on}
    packed = table.select(
        *[F.col(k).alias(name) for k, name in keys.items()],
        F.struct(*table.columns).alias(tag),
    )
    matches = reduce(and_, [expr == F.col(keys[k]) for k, expr in on.items()])
    return df.join(packed, matches, "left").drop(*keys.values())


def found(tag: str) -> Column:
    return F.col(tag).isNotNull()

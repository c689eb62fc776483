"""Global positions and fixed-size batches without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from ..sources.stages import stage

# Layout of monotonically_increasing_id(): partition number above 33 row bits.
_ROW_BITS = 33


def dealt(df: DataFrame, partitions: int | None) -> DataFrame:
    """The rows over so many partitions before a costly per-row step; as they are without a number.

    The caller knows the cluster and whether its files are split finely enough;
    the plan does not change with the size of the input.
    """
    return df.repartition(partitions) if partitions else df


def positions(df: DataFrame, order_by: Sequence[str], name: str = "pos") -> DataFrame:
    """Add the 0-based global position of each row in a total order.

    Range-partition, sort inside partitions and stage the result, so that the
    two passes (rows per partition, then offset + row number) see the same
    partitions even if executors are lost. Only one number per partition
    reaches the driver.
    """
    spark = df.sparkSession
    ordered = stage(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("pos_raw", F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftright("pos_raw", _ROW_BITS)
    counts = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    rows = sorted(counts.collect())
    starts = [0, *accumulate(r.n for r in rows)]
    offsets = spark.createDataFrame(
        [(r.part, start) for r, start in zip(rows, starts)], "part LONG, start LONG"
    )
    row_number = F.col("pos_raw").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ordered.join(F.broadcast(offsets), part == F.col("part"))
        .withColumn(name, F.col("start") + row_number)
        .drop("pos_raw", "part", "start")
    )


def fixed_batches(df: DataFrame, size: int, order_by: Sequence[str]) -> DataFrame:
    """Contiguous batches: adds ``pos`` (0-based) and ``batch_id`` (from 1)."""
    batch = (F.floor(F.col("pos") / size) + 1).alias("batch_id")
    return positions(df, order_by).select("*", batch)


def pack_batches(batched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(batch_id, items)``: the records of each batch in order.

    Groups hold at most one batch of rows.
    """
    record = F.struct("pos", F.struct(*columns).alias("item"))
    packed = batched.groupBy("batch_id").agg(F.sort_array(F.collect_list(record)).alias("r"))
    return packed.select("batch_id", F.col("r.item").alias("items"))


def unpack_batches(packed: DataFrame) -> DataFrame:
    """Records of all batches with their place: ``batch_id, idx`` and the fields."""
    return packed.select("batch_id", F.posexplode("items").alias("idx", "item")).select(
        "batch_id", "idx", "item.*"
    )

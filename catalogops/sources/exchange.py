"""JSON exchange: record batches, cluster maps and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.batching import unpack_batches


def record_type(columns: Sequence[str]) -> str:
    return "struct<" + ",".join(f"{c}: string" for c in columns) + ">"


def write_batches(packed: DataFrame, path: str) -> None:
    """One JSON line per batch ``(batch_id, items)``; a file per task, not per batch."""
    packed.write.option("ignoreNullFields", False).json(path)


def read_batches(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Records of the batches written by :func:`write_batches`."""
    schema = f"batch_id LONG, items ARRAY<{record_type(columns)}>"
    return unpack_batches(spark.read.schema(schema).json(path))


def read_batch_files(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Records of ``batch_NNNN.json`` files, each one JSON array."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="batch_*.json")
    number = F.regexp_extract(F.input_file_name(), r"batch_(\d+)\.json$", 1).cast("long")
    items = F.from_json("value", f"array<{record_type(columns)}>")
    return unpack_batches(files.select(number.alias("batch_id"), items.alias("items")))


def explode_cluster_maps(df: DataFrame, json_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(cluster_id, pos, member)`` from JSON objects ``{id: [members]}``."""
    parsed = F.from_json(json_col, "map<string,array<string>>")
    pairs = df.select(*keep, F.explode(parsed).alias("cluster_id", "members"))
    return pairs.select(*keep, "cluster_id", F.posexplode("members").alias("pos", "member"))


def read_cluster_map(spark: SparkSession, path: str) -> DataFrame:
    """A cluster map kept as one JSON object per file."""
    return explode_cluster_maps(spark.read.text(path, wholetext=True), "value")


def write_clusters(lists: DataFrame, path: str) -> None:
    """One JSON line ``{cluster_id, members}`` per cluster."""
    lists.write.json(path)


def read_cluster_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(cluster_id, members)`` as :func:`write_clusters` wrote them; files are split by lines."""
    return spark.read.schema("cluster_id STRING, members ARRAY<STRING>").json(path)


def read_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_metrics(row: DataFrame, path: str) -> None:
    row.write.mode("overwrite").json(path)

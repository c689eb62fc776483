"""Registered queries: a Spark plan and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def cores(spark: SparkSession) -> int:
    """Partitions for costly per-row work on a table kept in one file."""
    return spark.sparkContext.defaultParallelism


def tax(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as a three-level hierarchy."""
    return read(spark, sf, "part").select(
        F.col("p_partkey").alias("row_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_name").alias("product_category"),
    )


TAX = """tax AS (
  SELECT p_partkey AS row_id, p_type AS category, p_brand AS subcategory,
         p_name AS product_category FROM part)"""


def listings(spark: SparkSession, sf: str) -> DataFrame:
    """The hierarchy value of every order line: the large input."""
    lines = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    parts = tax(spark, sf).withColumnRenamed("row_id", "l_partkey")
    return lines.join(parts, "l_partkey").select(
        F.col("l_orderkey").alias("row_id"), "category", "subcategory", "product_category"
    )


LISTINGS = f"""{TAX}, listings AS (
  SELECT l_orderkey AS row_id, category, subcategory, product_category
  FROM lineitem JOIN tax ON l_partkey = tax.row_id)"""


def soil(df: DataFrame) -> DataFrame:
    """Case changes, padding, blanks and NULLs, spread by ``row_id``."""
    kind = F.col("row_id") % 10
    category, sub, item = F.col("category"), F.col("subcategory"), F.col("product_category")
    return df.select(
        "row_id",
        F.when(kind == 0, F.lower(category))
        .when(kind == 1, F.concat(F.lit("\t"), category, F.lit("  ")))
        .otherwise(category).alias("category"),
        F.when(kind == 5, F.lit(None)).otherwise(sub).alias("subcategory"),
        F.when(kind == 2, F.lit(None)).when(kind == 3, F.lit("   "))
        .when(kind == 4, F.upper(item)).otherwise(item).alias("product_category"),
    )


def dirty_sql(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT row_id,
    CASE row_id % 10 WHEN 0 THEN lower(category) WHEN 1 THEN chr(9) || category || '  '
      ELSE category END AS category,
    CASE row_id % 10 WHEN 5 THEN NULL ELSE subcategory END AS subcategory,
    CASE row_id % 10 WHEN 2 THEN NULL WHEN 3 THEN '   ' WHEN 4 THEN upper(product_category)
      ELSE product_category END AS product_category
  FROM {source})"""


TAX_DIRTY = f"{TAX}, {dirty_sql('tax', 'tax_dirty')}"
LISTINGS_DIRTY = f"{LISTINGS}, {dirty_sql('listings', 'listings_dirty')}"


def strip_sql(column: str) -> str:
    return f"trim({column}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def tax_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return soil(tax(spark, sf))


def listings_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return soil(listings(spark, sf))

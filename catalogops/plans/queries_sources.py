"""Queries for sources, sinks, batching and plain row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import strip_ws
from ..operators import batching, dedup
from ..operators.inference import chunk_prompts
from ..sources import delimited, exchange, stages
from . import curate
from .registry import TAX, TAX_DIRTY, query, read, strip_sql, tax, tax_dirty

COLUMNS = ["category", "subcategory", "product_category"]
TEMPLATE = "Reorganise the records below."


@query(
    "csv_scan_autosep",
    "SELECT p_type AS category, p_brand AS subcategory, p_name AS product_category FROM part",
)
def csv_scan_autosep(spark, sf):
    path = stages.new_path(spark, "csv")
    headed = read(spark, sf, "part").select(
        F.col("p_name").alias("Product Category"), F.col("p_brand").alias("Sub-Category"),
        F.col("p_type").alias(" Category "), "p_size",
    )
    delimited.write_delimited(headed, path, sep="\t")
    return delimited.read_delimited(spark, path)


@query(
    "header_alias",
    """SELECT p_type AS category, p_brand AS subcategory, p_name AS product_category
       FROM part""",
)
def header_alias(spark, sf):
    headed = read(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_type").alias("Main Cat"),
        F.col("p_name").alias("Product Category"), F.col("p_brand").alias("SUB-category"),
    )
    return delimited.alias_columns(headed)


@query(
    "json_batches_roundtrip",
    f"""WITH {TAX}, p AS (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS pos FROM tax)
        SELECT CAST(pos // 100 + 1 AS BIGINT) AS batch_id, CAST(pos % 100 AS INTEGER) AS idx,
               category, subcategory, product_category FROM p""",
)
def json_batches_roundtrip(spark, sf):
    path = stages.new_path(spark, "batches")
    batched = batching.fixed_batches(tax(spark, sf), 100, ["row_id"])
    exchange.write_batches(batching.pack_batches(batched, COLUMNS), path)
    return exchange.read_batches(spark, path, COLUMNS)


@query(
    "fixed_batches",
    f"""WITH {TAX}, p AS (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS pos FROM tax)
        SELECT row_id, pos, CAST(pos // 25 + 1 AS BIGINT) AS batch_id FROM p""",
)
def fixed_batches(spark, sf):
    batched = batching.fixed_batches(tax(spark, sf), 25, ["row_id"])
    return batched.select("row_id", "pos", "batch_id")


@query(
    "chunk_prompts",
    f"""WITH {TAX}, p AS (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS pos FROM tax)
        SELECT CAST(pos // 25 + 1 AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) AS n,
               min_by(product_category, pos) AS first_item, max_by(category, pos) AS last_category,
               '{TEMPLATE}' AS head
        FROM p GROUP BY 1""",
)
def prompts(spark, sf):
    made = chunk_prompts(tax(spark, sf), TEMPLATE, COLUMNS, ["row_id"])
    body = F.from_json(
        F.substring_index("prompt", "\n\nINPUT:\n", -1), f"array<{exchange.record_type(COLUMNS)}>"
    )
    return made.withColumn("body", body).select(
        "batch_id", "n",
        F.element_at("body", 1)["product_category"].alias("first_item"),
        F.element_at("body", -1)["category"].alias("last_category"),
        F.substring_index("prompt", "\n\nINPUT:\n", 1).alias("head"),
    )


@query(
    "cluster_map_explode",
    """SELECT p_partkey, p_brand AS cluster_id,
              CAST(unnest([0, 1]) AS INTEGER) AS pos, unnest(string_split(p_name, ' ')) AS member
       FROM part
       UNION ALL
       SELECT p_partkey, p_type, 0, p_name FROM part""",
)
def cluster_map_explode(spark, sf):
    clusters = F.map_from_arrays(
        F.array("p_brand", "p_type"), F.array(F.split("p_name", " "), F.array("p_name"))
    )
    maps = read(spark, sf, "part").select("p_partkey", F.to_json(clusters).alias("clusters"))
    return exchange.explode_cluster_maps(maps, "clusters", ["p_partkey"])


@query("drop_if_present", f"WITH {TAX_DIRTY} SELECT * FROM tax_dirty")
def drop_if_present(spark, sf):
    wide = tax_dirty(spark, sf).withColumn("attributes", F.lit("{}"))
    return wide.drop("attributes", "not_there")


@query(
    "drop_null_blank",
    f"""WITH {TAX_DIRTY} SELECT * FROM tax_dirty
        WHERE category IS NOT NULL AND subcategory IS NOT NULL AND product_category IS NOT NULL
          AND {strip_sql('product_category')} <> ''""",
)
def drop_null_blank(spark, sf):
    return dedup.drop_missing(tax_dirty(spark, sf), COLUMNS, ["product_category"])


@query(
    "drop_null_any",
    f"""WITH {TAX_DIRTY} SELECT DISTINCT category, subcategory, product_category FROM tax_dirty
        WHERE category IS NOT NULL AND subcategory IS NOT NULL AND product_category IS NOT NULL""",
)
def drop_null_any(spark, sf):
    return tax_dirty(spark, sf).select(*COLUMNS).dropna("any").distinct()


@query(
    "strip_ws",
    f"""WITH {TAX_DIRTY}
        SELECT row_id, '[' || {strip_sql('category')} || ']' AS category,
               '[' || {strip_sql('product_category')} || ']' AS product_category
        FROM tax_dirty""",
)
def stripped(spark, sf):
    def boxed(c):
        return F.concat(F.lit("["), strip_ws(c), F.lit("]")).alias(c)

    return tax_dirty(spark, sf).select("row_id", boxed("category"), boxed("product_category"))


@query(
    "union_all",
    f"WITH {TAX_DIRTY} SELECT * FROM tax UNION ALL SELECT * FROM tax_dirty",
)
def union_all(spark, sf):
    return tax(spark, sf).unionByName(tax_dirty(spark, sf))


@query(
    "sorted_output",
    f"""WITH {TAX} SELECT row_id, category, subcategory, product_category,
          row_number() OVER (ORDER BY category, subcategory, product_category, row_id) - 1 AS pos
        FROM tax""",
)
def sorted_output(spark, sf):
    return batching.positions(tax(spark, sf), [*COLUMNS, "row_id"])


@query(
    "csv_folder_mixed_headers",
    """SELECT p_type AS category, p_brand AS subcategory, p_name AS product_category FROM part""",
)
def csv_folder_mixed_headers(spark, sf):
    """Half of the rows as comma files, half as TAB files with another order of columns."""
    path = stages.new_path(spark, "csv-folder")
    names = {"category": "p_type", "sub": "p_brand", "product": "p_name"}
    part = read(spark, sf, "part")
    for kind, (sep, order) in enumerate(((",", list(names)), ("\t", ["product", "category", "sub"]))):
        half = part.where(F.col("p_partkey") % 2 == kind).select(*[F.col(names[n]).alias(n) for n in order])
        half.write.mode("append").options(header=True, sep=sep, quote='"', escape='"').csv(path)
    return delimited.read_delimited(spark, path)


@query(
    "metrics_roundtrip",
    "SELECT count(*) AS input_rows, count(DISTINCT p_name) AS final_products, 'part' AS input_file FROM part",
)
def metrics_roundtrip(spark, sf):
    path = stages.new_path(spark, "metrics")
    exchange.write_metrics(
        read(spark, sf, "part").agg(
            F.count(F.lit(1)).alias("input_rows"), F.count_distinct("p_name").alias("final_products"),
            F.lit("part").alias("input_file"),
        ), path,
    )
    return exchange.read_metrics(spark, path, "input_rows LONG, final_products LONG, input_file STRING")


@query("resume_step", "SELECT p_type AS category, count(*) AS n FROM part GROUP BY 1")
def resume_step(spark, sf):
    """The second run of a step reads what the first one committed; another key builds anew."""
    counts = tax(spark, sf).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    base = stages.new_path(spark, "steps")

    def step(key, build):
        return stages.materialize(spark, f"{base}/{stages.fingerprint(key)}", build)

    step("one", lambda: counts)
    step("two", lambda: counts.limit(0))
    return step("one", lambda: counts.limit(0))


@query(
    "reorganise",
    f"""WITH {TAX_DIRTY}, p AS (SELECT *, (row_number() OVER (ORDER BY row_id) - 1) // 25 + 1 AS batch_id FROM tax_dirty)
        SELECT DISTINCT upper(category) AS category, subcategory, product_category FROM p
        WHERE batch_id % 5 <> 0 AND category IS NOT NULL AND subcategory IS NOT NULL
          AND {strip_sql('product_category')} <> ''""",
)
def reorganise(spark, sf):
    """A recorded model that upper-cases categories and fails on every fifth chunk."""

    def ask(prompts):
        items = F.from_json(
            F.substring_index("prompt", "\n\nINPUT:\n", -1), f"array<{exchange.record_type(COLUMNS)}>"
        )
        changed = F.transform(items, lambda r: r.withField("category", F.upper(r["category"])))
        reply = F.concat(F.lit("```json\n"), F.to_json(changed), F.lit("\n```"))
        answered = F.when(F.col("batch_id") % 5 != 0, reply).otherwise(F.lit("I am sorry."))
        return prompts.select("batch_id", answered.alias("reply"))

    return curate.reorganise(tax_dirty(spark, sf), TEMPLATE, ask, ["row_id"])[0]

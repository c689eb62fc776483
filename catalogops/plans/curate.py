"""The whole curation job as composed, separately resumable steps."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators import canonical, clusters, dedup, hierarchy, inference, quality, vectors
from ..operators.batching import positions
from ..operators.cascade import apply_rules
from ..operators.rules import Levels
from ..sources.exchange import write_metrics
from ..sources.packs import RulePack
from ..sources.stages import fingerprint, is_complete, materialize, stage

LEVELS = Levels()
COLUMNS = (LEVELS.parent, LEVELS.child, LEVELS.item)


def clean(df: DataFrame) -> DataFrame:
    """Rows with all three values and an item that is not blank."""
    return dedup.drop_missing(df, COLUMNS, [LEVELS.item])


def correct(
    df: DataFrame, pack: RulePack, min_items: int = hierarchy.MIN_ITEMS
) -> DataFrame:
    """Cascade, one row per item, thin groups collapsed; keeps ``row_id``."""
    fixed = dedup.priority(apply_rules(clean(df), pack))
    # Read twice below, for the sizes of the groups and for their rows.
    return hierarchy.collapse_thin(stage(fixed, "corrected-rows"), min_items)


def reorganise(
    df: DataFrame,
    template: str,
    ask: Callable[[DataFrame], DataFrame],
    order_by: Sequence[str],
    size: int = inference.CHUNK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, dead_letter)``: chunks of the table as a model lays them out anew.

    ``ask`` turns prompts ``(batch_id, n, prompt)`` into ``reply`` and ``error``,
    for example with ``inference.infer``. Rows lacking a value and repeated rows
    are dropped; a failed chunk goes to the dead letters and is missing.
    """
    prompts = inference.chunk_prompts(df, template, COLUMNS, order_by, size)
    fields = StructType([StructField(c, StringType()) for c in COLUMNS])
    rows, dead = inference.reply_rows(ask(prompts), fields, ["batch_id"])
    return clean(rows.select(*COLUMNS)).distinct(), dead


def cluster_items(
    df: DataFrame,
    embed: Callable[[DataFrame, str], DataFrame],
    k: int = vectors.NEIGHBOURS,
    min_sim: float = vectors.MIN_SIMILARITY,
) -> DataFrame:
    """Clusters of similar items in ``row_id`` order, with member names."""
    edges = vectors.knn(embed(df, LEVELS.item), "row_id", "vector", k, min_sim)
    found = clusters.cluster_table(clusters.leader_assignment(edges))
    names = df.select(F.col("row_id").alias("member_id"), F.col(LEVELS.item).alias("member"))
    return found.join(names, "member_id")


def merge_synonyms(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Canonical item names; the smallest ``row_id`` of equal rows stays."""
    renamed = canonical.apply_map(df, mapping, LEVELS.item)
    return renamed.groupBy(*COLUMNS).agg(F.min("row_id").alias("row_id"))


def validate(df: DataFrame, pack: RulePack) -> DataFrame:
    """Ordered rules, then one row per item regardless of case."""
    moved = apply_rules(clean(df), pack, strip=False)
    return dedup.priority(moved, ignore_case=True)


def final_order(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS).orderBy(*COLUMNS)


def curate(
    df: DataFrame,
    correct_pack: RulePack,
    validate_pack: RulePack,
    name_clusters: Callable[[DataFrame], DataFrame],
    out: str,
    embed: Callable[[DataFrame, str], DataFrame] = vectors.embed_hashed,
    conditions: Mapping[str, Column] | None = None,
    targets: Mapping[str, int] | None = None,
    reset: bool = False,
    run_key: str = "",
    **options: Any,
) -> tuple[DataFrame, DataFrame]:
    """Run all steps; returns ``(final table, report)``.

    ``name_clusters`` turns clusters ``(cluster_id, members)`` into model or
    recorded replies ``(cluster_id, members, reply)``. Each step writes its
    table under ``out`` and is skipped when it is already there; clusters whose
    reply failed merge nothing and go to ``out/dead_letters``; the run's metrics
    go to ``out/metrics`` as JSON. A step's folder is named by the input files,
    the packs and the options, and by ``run_key``, which stands for what a plan
    does not show: another model, encoder or changed file contents.
    """
    started = time.monotonic()
    min_items = options.get("min_items", hierarchy.MIN_ITEMS)
    k = options.get("k", vectors.NEIGHBOURS)
    min_sim = options.get("min_sim", vectors.MIN_SIMILARITY)

    key = fingerprint(
        sorted(df.inputFiles()), correct_pack, validate_pack, sorted(options.items()), run_key
    )

    def step(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return materialize(df.sparkSession, f"{out}/{name}-{key}", build, reset)

    rows = df if "row_id" in df.columns else positions(df, df.columns, "row_id")
    # The first step's write sees every row anyway: it counts them on the way.
    seen: list[Observation] = []

    def watched() -> DataFrame:
        seen.append(Observation("curate-input"))
        return correct(rows.observe(seen[0], F.count(F.lit(1)).alias("n")), correct_pack, min_items)

    corrected = step("corrected", watched)
    input_rows = _remembered(df.sparkSession, f"{out}/input-rows-{key}", seen, rows)
    grouped = step("clusters", lambda: cluster_items(corrected, embed, k, min_sim))
    lists = clusters.cluster_lists(grouped, "member")
    answers = step("replies", lambda: name_clusters(lists))
    good, dead = canonical.synonym_replies(answers)
    step("dead_letters", lambda: dead)
    mapping = step("synonyms", lambda: canonical.synonym_map(good))
    merged = merge_synonyms(corrected, mapping)
    final = step("final", lambda: validate(merged, validate_pack))
    report = quality.report(final, conditions or {}, targets)
    write_metrics(
        quality.metrics_row(
            report,
            input_rows=input_rows,
            input_file=",".join(sorted(df.inputFiles())),
            batches=-(-input_rows // inference.CHUNK_ROWS),
            clusters_created=grouped.select("cluster_id").distinct().count(),
            duplicates_removed=canonical.changes(mapping).first()[0],
            processing_time_minutes=round((time.monotonic() - started) / 60, 2),
        ),
        f"{out}/metrics",
    )
    return final_order(final), report


def _remembered(spark: SparkSession, path: str, seen: list[Observation], rows: DataFrame) -> int:
    """How many rows the first step has seen; kept beside it for runs that skip the step.

    A job of its own counts them only where an earlier run died between the two writes.
    """
    if seen or not is_complete(spark, path):
        n = seen[0].get["n"] if seen else rows.count()
        spark.createDataFrame([(n,)], "n long").write.mode("overwrite").parquet(path)
        return n
    return spark.read.schema("n long").parquet(path).first()["n"]

"""Prompts, model calls over a table, and reply parsing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.replies import all_null, clean_reply, parse_rows
from ..functions.text import bullet_list, let
from ..sources.stages import discard, is_complete, new_path, stage_at
from .batching import dealt, fixed_batches, pack_batches

# Records per prompt, and what stands between template and data.
CHUNK_ROWS = 25
# Prompts asked between two commits of a resumable run.
COMMIT_ROWS = 10_000
INPUT_JOINT = "\n\nINPUT:\n"
CLUSTER_JOINT = "\n\nInput cluster ("


def chunk_prompts(
    df: DataFrame,
    template: str,
    columns: Sequence[str],
    order_by: Sequence[str],
    size: int = CHUNK_ROWS,
) -> DataFrame:
    """``(batch_id, n, prompt)``: the template followed by a chunk as JSON."""
    packed = pack_batches(fixed_batches(df, size, order_by), columns)
    body = F.to_json("items", {"ignoreNullFields": "false"})
    return packed.select(
        "batch_id",
        F.size("items").alias("n"),
        F.concat(F.lit(template.strip() + INPUT_JOINT), body).alias("prompt"),
    )


def cluster_prompt(template: str, cluster_id: Column, members: Column) -> Column:
    """Prompt asking for the common name of one cluster."""
    head = F.concat(
        F.lit(template.strip() + CLUSTER_JOINT), cluster_id, F.lit("):\n")
    )
    return F.concat(head, bullet_list(members))


def infer(
    df: DataFrame,
    prompt_col: str,
    make_model: Callable[[], Callable[[list[str]], Sequence[str | Exception | None]]],
    keep: Sequence[str],
    batch: int = 64,
    partitions: int | None = None,
) -> DataFrame:
    """Call a user's model on every prompt: ``keep`` columns, ``reply``, ``error``.

    ``make_model`` runs once per task and returns a function from a list of at
    most ``batch`` prompts to as many replies; an exception in the list marks one
    failed prompt. When a call raises, its prompts are asked one by one, so that
    only those fail that raise alone. The kept columns pass through untouched. A
    model call is costly and may not repeat itself, so write the result out
    (``sources.stages.materialize``) before using it twice; ``partitions`` deals
    a small input over so many tasks.
    """
    schema = StructType(
        [df.schema[c] for c in keep]
        + [StructField("reply", StringType()), StructField("error", StringType())]
    )
    kept = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()

        def ask(prompts: list[str]) -> list:
            try:
                answers = list(model(prompts))
                if len(answers) != len(prompts):
                    raise ValueError(f"{len(answers)} replies to {len(prompts)} prompts")
                return answers
            except Exception as failure:
                if len(prompts) == 1:
                    return [failure]
                return [answer for p in prompts for answer in ask([p])]

        for rows in batches:
            prompts = rows.column(rows.schema.get_field_index(prompt_col)).to_pylist()
            answers = [a for s in range(0, len(prompts), batch) for a in ask(prompts[s:s + batch])]
            failed = [isinstance(a, Exception) for a in answers]
            replies = [None if f or a is None else str(a) for a, f in zip(answers, failed)]
            errors = [repr(a) if f else None for a, f in zip(answers, failed)]
            columns = [rows.column(rows.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(replies, pa.string()), pa.array(errors, pa.string())],
                names=[*kept, "reply", "error"],
            )

    prompts = df.select(*keep, *([] if prompt_col in keep else [prompt_col]))
    return dealt(prompts, partitions).mapInArrow(run, schema)


def prompt_key(prompt: Column, model_key: str) -> Column:
    """What a reply is filed under: the model's name and the whole prompt."""
    return F.sha2(F.concat_ws("\n", F.lit(model_key), prompt), 256)


def infer_resumable(
    df: DataFrame,
    prompt_col: str,
    make_model: Callable[[], Callable[[list[str]], Sequence[str | Exception | None]]],
    keep: Sequence[str],
    log: str,
    model_key: str = "",
    commit_rows: int = COMMIT_ROWS,
    batch: int = 64,
    partitions: int | None = None,
) -> DataFrame:
    """As ``infer``, with a log of answers under ``log``: a later run asks only what is missing there.

    Distinct prompts are asked once, in portions of about ``commit_rows``, and a
    portion's answers are committed before the next one is asked, so a run that
    dies loses one portion at most. An answer is filed under the model's name and
    the prompt; several tables and runs may share a log. Failed prompts are
    reported in ``error`` and not filed: the next run asks them again. A NULL
    prompt is not asked and gets an error.
    """
    spark = df.sparkSession
    asked = df.select(prompt_key(F.col(prompt_col), model_key).alias("asked"), F.col(prompt_col).alias("asked_prompt"))
    distinct = asked.where(F.col("asked_prompt").isNotNull()).groupBy("asked").agg(F.first("asked_prompt").alias("asked_prompt"))
    filed = _filed(spark, log)
    pending, pending_path = stage_at(distinct if filed is None else distinct.join(filed, "asked", "left_anti"), "prompts")
    portions = -(-pending.count() // commit_rows)
    portion = F.pmod(F.xxhash64("asked"), F.lit(max(portions, 1)))
    failed = new_path(spark, "failed-prompts")
    for i in range(portions):
        answers, path = stage_at(infer(pending.where(portion == i), "asked_prompt", make_model, ["asked"], batch, partitions), "answers")
        answers.where("error IS NOT NULL").select("asked", "error").write.mode("append").parquet(failed)
        # The last write of a portion files it; until then nothing of it counts.
        answers.where("error IS NULL").select("asked", "reply").write.mode("append").parquet(log)
        discard(spark, path)
    discard(spark, pending_path)
    filed, key = _filed(spark, log), prompt_key(F.col(prompt_col), model_key)
    answered = df.select(*keep, F.when(F.col(prompt_col).isNotNull(), key).alias("asked"))
    # A portion that was written when its run died may be filed twice: the first answer by text counts.
    replies = spark.createDataFrame([], FILED) if filed is None else filed.groupBy("asked").agg(F.min("reply").alias("reply"), F.lit(True).alias("answered"))
    if filed is None:
        replies = replies.withColumn("answered", F.lit(True))
    errors = spark.read.schema("asked string, error string").parquet(failed) if portions else spark.createDataFrame([], "asked string, error string")
    joined = answered.join(replies, "asked", "left").join(errors.groupBy("asked").agg(F.min("error").alias("error")), "asked", "left")
    return joined.select(*keep, "reply", F.when(F.col("answered").isNull(), F.coalesce("error", F.lit("no prompt"))).alias("error"))


FILED = "asked string, reply string"


def _filed(spark, log: str) -> DataFrame | None:
    """The log as far as it is committed; None when there is none yet."""
    return spark.read.schema(FILED).parquet(log) if is_complete(spark, log) else None


def replay(df: DataFrame, recorded: DataFrame, on: Sequence[str]) -> DataFrame:
    """Answer prompts from recorded ``(keys, reply)``; a missing reply is an error."""
    joined = df.join(recorded.select(*on, "reply"), list(on), "left")
    return joined.withColumn(
        "error", F.when(F.col("reply").isNull(), F.lit("no recorded reply"))
    )


def parse_replies(
    df: DataFrame, fields: StructType, reply_col: str = "reply"
) -> DataFrame:
    """Add ``parsed``: a struct of ``records`` and ``failure`` (reason or NULL).

    A unit fails when the call failed, the reply is not a list of records or an
    object, or a record has none of the expected fields. ``[]`` is a valid
    empty answer.
    """
    names = fields.fieldNames()
    errors = F.col("error") if "error" in df.columns else F.lit(None).cast("string")

    def verdict(records: Column) -> Column:
        hollow = F.exists(records, lambda r: r.isNull() | all_null(r, names))
        failure = (
            F.when(errors.isNotNull(), errors)
            .when(records.isNull(), F.lit("not a list of records"))
            .when(hollow, F.lit("record without expected fields"))
        )
        return F.struct(records.alias("records"), failure.alias("failure"))

    # let: the reply is parsed once, also where a filter on the verdict moves.
    return df.withColumn("parsed", let(parse_rows(clean_reply(reply_col), fields), verdict))


def reply_rows(
    df: DataFrame, fields: StructType, keys: Sequence[str], reply_col: str = "reply"
) -> tuple[DataFrame, DataFrame]:
    """Split replies into ``(rows, dead_letter)``; no unit is lost silently.

    ``rows`` carries ``keys``, ``idx`` (place in the reply) and the fields.
    """
    checked = parse_replies(df, fields, reply_col)
    failure = F.col("parsed.failure")
    good = F.when(failure.isNull(), F.col("parsed.records"))
    # The outer form adds no size filter, which would parse the reply again.
    rows = (
        checked.select(*keys, F.posexplode_outer(good).alias("idx", "record"))
        .where(F.col("idx").isNotNull())
        .select(*keys, "idx", "record.*")
    )
    dead = checked.where(failure.isNotNull()).select(
        *keys, reply_col, failure.alias("failure")
    )
    return rows, dead


def require_complete(dead_letter: DataFrame) -> None:
    """Strict mode: stop when any unit failed."""
    first = dead_letter.limit(1).collect()
    if first:
        raise RuntimeError(f"failed unit, for example {first[0].asDict()}")

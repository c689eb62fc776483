"""Greedy leader clustering over a neighbour table, as parallel rounds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import numbered
from ..sources.stages import discard, new_path, stage, stage_at
from .batching import positions


#: Ids that one task settles in order; with at most k edges each this bounds its memory.
BLOCK = 50_000

_SETTLED = "node long, verdict string"


def _settle(held: pd.DataFrame) -> pd.DataFrame:
    """The verdicts of one block of ids that follow from what is known outside of it.

    Rows that are not ``within`` sum up an id's listers outside the block:
    ``led`` says that one of them leads, ``waiting`` that one is undecided. The
    others are edges inside the block. A lister is smaller than whom it lists, so one walk
    in order of ids settles chains of any length.
    """
    outside = held[~held["within"]]
    led = dict(zip(outside["dst"], outside["led"]))
    waiting = dict(zip(outside["dst"], outside["waiting"]))
    inside = held[held["within"]]
    listers: dict[int, list[int]] = {}
    for src, dst in zip(inside["src"], inside["dst"]):
        listers.setdefault(dst, []).append(src)
    verdicts: dict[int, str | None] = {}
    for node in sorted({*led, *listers}):
        of = [verdicts.get(src) for src in listers.get(node, [])]
        if led.get(node, False) or "leader" in of:
            verdicts[node] = "member"
        else:
            verdicts[node] = None if waiting.get(node, False) or None in of else "leader"
    found = [(node, verdict) for node, verdict in verdicts.items() if verdict]
    return pd.DataFrame(found, columns=["node", "verdict"])


def leader_assignment(edges: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(member, leader, sim, rank)`` of the sequential greedy procedure.

    ``edges`` is ``(id, neighbour, sim, rank)``: whom a row absorbs if it leads.
    Going through ids in order, an id not yet absorbed leads and absorbs its
    neighbours not yet absorbed. Hence an id leads exactly when no smaller
    leader lists it, and a member belongs to its smallest leader.

    Ids that a smaller one lists are cut, in their order, into blocks of
    ``block``. A round settles in every block what follows from the other
    blocks' verdicts so far. A chain runs through blocks in order, so there are
    at most as many rounds as it meets blocks, however long it is; the first
    unsettled block is settled in each round, so the rounds end.

    Joins on the lister's side meet at most k edges per key, and so does a block
    inside. Listers in other blocks are aggregated, which combines before the
    shuffle, and joined with the one row of their verdict, which adaptive
    execution splits. A round's edges are deleted once the next round's are
    written.
    """
    spark = edges.sparkSession
    forward = stage(
        edges.where("id < neighbour").select(
            F.col("id").alias("src"), F.col("neighbour").alias("dst"), "sim", "rank"
        ),
        "leader-edges",
    )
    contested = positions(forward.select(F.col("dst").alias("node")).distinct(), ["node"], "place")
    blocks = stage(
        contested.select("node", F.floor(F.col("place") / block).alias("block")), "leader-blocks"
    )
    # Ids that nobody smaller lists lead from the start.
    of_src = blocks.select(F.col("node").alias("src"), F.col("block").alias("src_block"))
    of_dst = blocks.select(F.col("node").alias("dst"), F.col("block").alias("dst_block"))
    live = forward.select("src", "dst").join(of_dst, "dst").join(of_src, "src", "left").select(
        "src", "dst", "dst_block", "src_block",
        F.when(F.col("src_block").isNull(), "leader").otherwise("open").alias("state"),
    )
    live, live_path = stage_at(live, "leader-live")

    verdicts = new_path(spark, "leader-verdicts")
    turn = 0
    while not live.isEmpty():
        within = (F.col("state") == "open") & (F.col("src_block") == F.col("dst_block"))
        within = F.coalesce(within, F.lit(False))
        outside = live.where(~within).groupBy("dst_block", "dst").agg(
            F.max(F.col("state") == "leader").alias("led"),
            F.max(F.col("state") == "open").alias("waiting"),
        ).select("dst_block", F.col("dst").alias("src"), "dst", "led", "waiting", F.lit(False).alias("within"))
        no = F.lit(False)
        inside = live.where(within).select(
            "dst_block", "src", "dst", no.alias("led"), no.alias("waiting"), F.lit(True).alias("within")
        )
        decided = outside.union(inside).groupBy("dst_block").applyInPandas(_settle, _SETTLED)
        path = f"{verdicts}/turn={turn}"
        decided.write.parquet(path)
        decided = spark.read.schema(decided.schema).parquet(path)
        rest = live.join(decided, F.col("dst") == F.col("node"), "left_anti")
        live = rest.join(decided, F.col("src") == F.col("node"), "left").select(
            "src", "dst", "dst_block", "src_block", F.coalesce("verdict", "state").alias("state")
        )
        live, next_path = stage_at(live, "leader-live")
        discard(spark, live_path)
        live_path, turn = next_path, turn + 1

    if turn == 0:  # no id is listed by a smaller one
        return forward.select(
            F.col("dst").alias("member"), F.col("src").alias("leader"), "sim", "rank"
        )
    members = spark.read.schema("node long, verdict string").parquet(verdicts).where(
        "verdict = 'member'"
    ).select("node")
    led = forward.join(members, F.col("src") == F.col("node"), "left_anti")
    first = F.min(F.struct("src", "sim", "rank")).alias("a")
    return led.groupBy("dst").agg(first).select(
        F.col("dst").alias("member"),
        F.col("a.src").alias("leader"), F.col("a.sim").alias("sim"), F.col("a.rank").alias("rank"),
    )


def cluster_table(assignment: DataFrame) -> DataFrame:
    """Long form ``(cluster_id, leader_id, member_id, ord)``; the leader is ord 0.

    Clusters hold at most k rows, are numbered by leader and list members by
    falling similarity. Rows without members form no cluster.
    """
    leaders = positions(assignment.select("leader").distinct(), ["leader"], "number")
    ids = leaders.select("leader", numbered("cluster", F.col("number")).alias("cluster_id"))
    order = Window.partitionBy("leader").orderBy("rank", "member")
    members = assignment.select("leader", "member", F.row_number().over(order).alias("ord"))
    heads = assignment.select("leader", F.col("leader").alias("member"), F.lit(0).alias("ord"))
    rows = members.unionByName(heads.distinct())
    return rows.join(ids, "leader").select(
        "cluster_id", F.col("leader").alias("leader_id"), F.col("member").alias("member_id"), "ord"
    )


def cluster_lists(clusters: DataFrame, name_col: str) -> DataFrame:
    """Nested form ``(cluster_id, members)`` in ``ord`` order, for prompts and sinks."""
    entry = F.struct("ord", F.col(name_col).alias("name"))
    nested = clusters.groupBy("cluster_id").agg(F.sort_array(F.collect_list(entry)).alias("m"))
    return nested.select("cluster_id", F.col("m.name").alias("members"))

"""Near-duplicate vectors by iterative quantisation and multi-index hash tables.

A rotation is learned so that the signs of the rotated vectors are balanced
codes; the code is cut into substrings, one hash table for each. Two vectors
meet in a table where a substring is equal, and are then compared by the cosine
of the original vectors in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..sources import stages
from .components import connected_components
from .groups import dealt, local_components, whole_groups

#: The rotation is fitted on at most so many vectors, those of least hash; every vector is indexed.
FIT_ROWS = 20_000
#: Vectors of one table entry that are compared in one go; larger entries are cut into pairs of blocks.
BLOCK = 512
#: Vectors an entry should hold on average.
ENTRY = 32


@dataclass(frozen=True)
class Quantiser:
    """Rotations for vectors of one dimension: bits are the signs of (v / |v| - mean) R."""

    mean: np.ndarray
    rotation: np.ndarray
    bits: int
    tables: int

    def codes(self, unit: np.ndarray) -> np.ndarray:
        signs = ((unit - self.mean) @ self.rotation > 0)[:, :self.bits * self.tables]
        weights = (1 << np.arange(self.bits)).astype(np.int32)
        return signs.reshape(len(unit), self.tables, self.bits) @ weights


def _orthogonal(rng: np.random.Generator, d: int) -> np.ndarray:
    q, r = np.linalg.qr(rng.standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def fit(unit: np.ndarray, bits: int, tables: int, rounds: int = 50, seed: int = 0) -> Quantiser:
    """As many rotations as the code needs, each by alternating codes and rotation from a start of its own."""
    rng = np.random.default_rng(seed)
    d = unit.shape[1]
    mean = unit.mean(axis=0) if len(unit) else np.zeros(d)
    centred = unit - mean
    axes = np.linalg.eigh(centred.T @ centred + 1e-12 * np.eye(d))[1]
    projected = centred @ axes
    found = []
    for _ in range(math.ceil(bits * tables / d)):
        rotation = _orthogonal(rng, d)
        for _ in range(rounds if len(unit) > d else 0):
            code = np.where(projected @ rotation > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(code.T @ projected)
            rotation = (u @ v).T
        found.append(axes @ rotation)
    # Substrings mix bits of all parts of the code.
    order = rng.permutation(d * len(found))
    return Quantiser(mean, np.hstack(found)[:, order], bits, tables)


def table_shape(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a substring, so that entries stay small, and tables, so that pairs at the threshold meet."""
    bits = min(24, max(6, math.ceil(math.log2(max(rows, 1) / ENTRY))))
    kept = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - kept))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def comparable(vector: Column) -> Column:
    """Not NULL or empty, all components finite, not all zero."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(usable & F.exists(vector, lambda x: x != 0), F.lit(False))


def link(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    threshold: float = 0.98, recall: float = 0.9995,
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Rows link when their labels are equal and not NULL and the cosine is at
    least ``threshold``. ``n_links`` counts the other rows linked directly,
    copies included; ``component_id`` is the least key reachable by links.
    Vectors that are NULL, empty, zero or hold NULL or non-finite components
    link with nothing, nor do vectors of different lengths. Repeated keys stay
    separate rows; a NULL key is never the least unless there is no other.
    An empty table gives an empty table.

    Equal vectors of a label are one node with a count, so copies meet no
    table. Entries beyond ``BLOCK`` nodes are compared as pairs of blocks, by
    tasks of their own: none is left out. A pair that meets in several tables
    counts in the first. Tasks return a count and one link for each node.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("_key"), F.col(vector).alias("_vec"), F.col(label).alias("_label"))
    usable = rows.where(F.col("_label").isNotNull() & comparable(F.col("_vec")))
    nodes, nodes_path = stages.stage_at(
        usable.groupBy("_label", "_vec").agg(F.min("_key").alias("_least"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_node", F.monotonically_increasing_id()),
        "vectors",
    )
    # One row comes back, however many lengths there are: all vectors counted, and the commonest length.
    sizes = nodes.groupBy(F.size("_vec").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    total, main = sizes.agg(F.sum("n"), F.max(F.struct("n", "d"))["d"]).first()
    bits, tables = table_shape(total or 0, threshold, recall)
    models: dict[int, Quantiser] = {}
    if main is not None:
        sample = (
            nodes.where(F.size("_vec") == main).select("_vec", F.xxhash64("_vec").alias("h")).orderBy("h").limit(FIT_ROWS)
            .select("_vec").toArrow()
        )
        models[main] = fit(_unit(_matrix(sample.column(0))), bits, tables)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths):
                chosen = batch.filter(pa.array(lengths == d))
                if d not in models:  # another length than the fitted one: plain random rotations
                    models[d] = fit(np.zeros((0, d)), bits, tables)
                codes = models[d].codes(_unit(_matrix(chosen.column(1)))).astype(np.int32)
                offsets = np.arange(len(codes) + 1, dtype=np.int32) * tables
                yield pa.RecordBatch.from_arrays(
                    [*chosen.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel()))],
                    names=["_label", "_vec", "_node", "_rows", "_codes"],
                )

    chosen = nodes.select("_label", "_vec", "_node", "_rows")
    coded, coded_path = stages.stage_at(
        chosen.mapInArrow(encode, T.StructType([*chosen.schema.fields, T.StructField("_codes", T.ArrayType(T.IntegerType()))])), "codes"
    )
    entries = coded.select(
        F.col("_label"), F.size("_vec").alias("_d"), "_node", "_rows", "_vec", "_codes",
        F.posexplode("_codes").alias("_table", "_code"),
    )
    entry = ["_label", "_d", "_table", "_code"]
    large, large_path = stages.stage_at(
        entries.groupBy(*entry).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > BLOCK)
        .withColumn("_blocks", F.ceil(F.col("_n") / BLOCK).cast("int")).drop("_n"),
        "large-entries",
    )
    blocked = entries.join(large, entry, "left").withColumns({
        "_blocks": F.coalesce("_blocks", F.lit(1)),
    }).withColumn("_own", F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int"))
    placed = blocked.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    first, second = F.least("_own", "_other"), F.greatest("_own", "_other")
    grouped = placed.select(
        F.xxhash64(*entry, first, second).alias("group"), F.col("_table").cast("int").alias("table"),
        F.when(first == second, -1).otherwise(F.col("_own")).alias("side"),
        F.xxhash64(*entry).alias("entry"), "_node", "_rows", "_vec", "_codes",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches):
            ends = np.append(starts[1:], table.num_rows)
            busy = ends - starts > 1
            if not busy.any():
                continue
            take = np.concatenate([np.arange(s, e) for s, e in zip(starts[busy], ends[busy])])
            table = table.take(pa.array(take))
            sizes = (ends - starts)[busy]
            at = np.concatenate([[0], np.cumsum(sizes)])
            side, entry_of = table.column("side").to_numpy(), table.column("entry").to_numpy()
            number, node = table.column("table").to_numpy(), table.column("_node").to_numpy()
            count = table.column("_rows").to_numpy()
            codes = _matrix(table.column("_codes")).astype(np.int32)
            vectors = table.column("_vec").combine_chunks()
            links, found_a, found_b = np.zeros(len(node), np.int64), [], []
            for s, e in zip(at[:-1], at[1:]):
                x = _unit(_matrix(vectors.slice(s, e - s))) if _same_length(vectors, s, e) else None
                if x is None:
                    continue
                i, j = np.nonzero(np.triu(x @ x.T >= threshold - 1e-9, 1))
                keep = (entry_of[s + i] == entry_of[s + j]) & ((side[s + i] < 0) | (side[s + i] != side[s + j]))
                i, j = i[keep], j[keep]
                if len(i):
                    exact = (x[i] * x[j]).sum(axis=1) >= threshold
                    i, j = s + i[exact], s + j[exact]
                    earlier = (codes[i] == codes[j]) & (np.arange(tables) < number[i][:, None])
                    new = ~earlier.any(axis=1)
                    i, j = i[new], j[new]
                    np.add.at(links, i, count[j])
                    np.add.at(links, j, count[i])
                    found_a.append(i)
                    found_b.append(j)
            if not found_a:
                continue
            root = local_components(len(node), np.concatenate(found_a), np.concatenate(found_b))
            out = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[out]), pa.array(links[out]), pa.array(node[root[out]])], names=["node", "links", "root"]
            )

    found, found_path = stages.stage_at(
        dealt(grouped).mapInArrow(compare, "node long, links long, root long"), "links"
    )
    components = connected_components(found.select("node", "root"), "node", "root")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    least = (
        components.join(nodes.select(F.col("_node").alias("node"), "_least"), "node")
        .groupBy("component").agg(F.min("_least").alias("_component"))
    )
    linked = components.join(least, "component").select("node", "_component").join(counts, "node", "left")
    answers, _ = stages.stage_at(
        nodes.join(linked, nodes["_node"] == linked["node"], "left").select(
            "_label", "_vec", (F.col("_rows") - 1 + F.coalesce("links", F.lit(0))).alias("_links"),
            F.coalesce("_component", "_least").alias("_component"),
        ),
        "linked-vectors",
    )
    for path in (nodes_path, coded_path, large_path, found_path):
        stages.discard(spark, path)
    component = F.when(F.col("_links").isNotNull(), F.col("_component")).otherwise(F.col("_key"))
    return rows.join(answers, ["_label", "_vec"], "left").select(
        F.col("_key").alias(key), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("_key") == component, F.lit(False)).alias("kept"),
    )


def _same_length(vectors: pa.ListArray, s: int, e: int) -> bool:
    lengths = vectors.slice(s, e - s).value_lengths().to_numpy(zero_copy_only=False)
    return bool((lengths == lengths[0]).all())

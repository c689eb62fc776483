"""Near-duplicate texts by consistent weighted sampling of TF-IDF shingles.

1. Document frequencies of all shingles of the corpus, in hashed counters.
2. Improved consistent weighted samples of every text; samples are banded.
3. Texts that share a band meet, and are linked where their weighted Jaccard
   similarity, computed from the whole texts, reaches the threshold.
4. Connected components of the links are the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..sources import stages
from .components import connected_components
from .groups import dealt, local_components, whole_groups
from .pieces import free
from .shingles import counted, mix, shingle_hashes

#: log2 of the number of hashed counters of document frequencies: a fixed half megabyte, whatever the corpus.
COUNTER_BITS = 17
#: How much more the rarest shingle weighs than the most common one. Undamped, the copies of a large
#: family would make what they share so common that their few changes outweigh it.
RARITY = 0.25
#: Texts of a band entry that are compared in one go; larger entries are first cut into blocks.
BLOCK = 256
#: Texts of each side of a group of the second comparison, by hash: those not yet in the main class, and those they ask.
REST = 512
#: Bytes of text of a block, or of one side of such a group, on average; a longer text is one of its own.
GROUP_BYTES = 8_000_000
#: Bytes of text handled at a time inside a task.
PIECE_BYTES = 1_000_000


@dataclass(frozen=True)
class Settings:
    width: int = 5
    threshold: float = 0.8
    bands: int = 12
    rows: int = 5


def _pieces(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of about PIECE_BYTES; NULL is the empty text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) + 64
    piece = np.cumsum(sizes) // PIECE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(piece)]
    for start, end in zip(cuts[:-1], cuts[1:]):
        if end > start:
            yield start, [t or "" for t in texts.slice(start, end - start).to_pylist()]


def _parts(most: int) -> Column:
    """Blocks that the rows of an aggregate need: about ``most`` rows and GROUP_BYTES of text each."""
    by_bytes = F.ceil(F.sum("bytes") / GROUP_BYTES)
    return F.greatest(F.ceil(F.count(F.lit(1)) / most), by_bytes).cast("int")


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def shingle_weights(docs: DataFrame, text: str, width: int) -> np.ndarray:
    """Weight of a shingle by its counter: 1 + RARITY * ln(1 + N / df) / ln(1 + N).

    Every text counts once for each of its distinct shingles. A counter also
    holds what other shingles add to it by chance; that mean load is taken off,
    and frequencies below the load's usual swing are not told apart. The
    weights depend on the data as a set, not on its order or partitions. The
    counters have a fixed number, so they fit the driver at any size of corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << COUNTER_BITS, np.int64)
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for _, texts in _pieces(batch.column(0)):
                hashes, _, _ = counted(*shingle_hashes(texts, width))
                held += np.bincount(_counter(hashes), minlength=len(held))
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(held[used], rows))], names=["counter", "n"]
        )

    summed = docs.select(F.col(text).cast("string")).mapInArrow(run, "counter long, n long")
    rows = summed.groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(1 << COUNTER_BITS)
    at, n = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    held[at[at >= 0]] = n[at >= 0]
    total = max(float(n[at < 0].sum()), 1.0)
    load = held.mean()
    frequency = np.clip(held - load, max(1.0, math.sqrt(load)), total)
    return (1 + RARITY * np.log1p(total / frequency) / np.log1p(total)).astype(np.float32)


def _gamma_table() -> np.ndarray:
    """Quantiles of Gamma(2, 1) at 65,536 even steps."""
    x = np.linspace(0, 40, 400_001)
    return np.interp((np.arange(65_536) + 0.5) / 65_536, 1 - (1 + x) * np.exp(-x), x)


class Sampler:
    """Improved consistent weighted sampling: texts agree in a sample with the chance of their weighted Jaccard."""

    def __init__(self, settings: Settings):
        self.settings = settings
        gamma = _gamma_table()
        self.r = gamma.astype(np.float32)
        self.inverse_r = (1 / gamma).astype(np.float32)
        self.log_c = np.log(gamma).astype(np.float32)
        self.beta = ((np.arange(65_536) + 0.5) / 65_536).astype(np.float32)
        k = np.arange(settings.bands * settings.rows, dtype=np.uint64)
        with np.errstate(over="ignore"):
            self.factors = mix(k + np.uint64(0x1234567)) | np.uint64(1)

    def bands(self, hashes: np.ndarray, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One key for each band of every text that has shingles; texts without any must not be among them."""
        starts = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)
        log_w = np.log(weights).astype(np.float32)
        low = np.uint64(0xFFFF)
        keys = np.zeros((len(counts), self.settings.bands), np.uint64)
        with np.errstate(over="ignore"):
            for k, factor in enumerate(self.factors):
                u = hashes * factor
                u ^= u >> np.uint64(29)
                i = (u >> np.uint64(48)).astype(np.int32)
                j = ((u >> np.uint64(32)) & low).astype(np.int32)
                b = ((u >> np.uint64(16)) & low).astype(np.int32)
                t = np.floor(log_w * self.inverse_r[i] + self.beta[b])
                log_a = self.log_c[j] - self.r[i] * (t - self.beta[b] + np.float32(1))
                least = np.minimum.reduceat(log_a, starts)
                at = np.flatnonzero(log_a == least[owner])
                at = at[np.append(True, owner[at][1:] != owner[at][:-1])]
                sample = mix(hashes[at] + t[at].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                band = k // self.settings.rows
                keys[:, band] = mix(keys[:, band] * np.uint64(31) + sample + np.uint64(k))
        return keys.view(np.int64)


def signatures(docs: DataFrame, text: str, weights: np.ndarray, settings: Settings) -> DataFrame:
    """The rows with ``_bands`` (array of long) in place of the text; empty for texts without words."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(weights)
    kept = docs.drop(text)
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, weight = Sampler(settings), shared.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for start, texts in _pieces(column):
                hashes, frequency, counts = counted(*shingle_hashes(texts, settings.width))
                some = counts > 0
                lengths = np.where(some, settings.bands, 0)
                if some.any():
                    keys = sampler.bands(hashes, frequency * weight[_counter(hashes)], counts[some])
                else:
                    keys = np.zeros((0, settings.bands), np.int64)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                rows = batch.slice(start, len(texts)).select(names)
                yield rows.append_column("_bands", pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return docs.mapInArrow(run, f"{schema}, _bands array<bigint>")


class Features:
    """The weighted shingles of some texts; the k-th occurrence of a shingle is a feature of its own."""

    def __init__(self, texts: list[str], weights: np.ndarray, width: int):
        hashes, frequency, counts = counted(*shingle_hashes(texts, width))
        owner = np.repeat(np.arange(len(texts)), counts)
        at = np.repeat(np.arange(len(hashes)), frequency)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(frequency) - frequency, frequency)
        with np.errstate(over="ignore"):
            self.hash = np.where(nth == 0, hashes[at], mix(hashes[at] + nth.astype(np.uint64)))
        self.weight = weights[_counter(hashes)][at].astype(np.float64)
        self.owner = owner[at]
        order = np.lexsort((self.hash, self.owner))
        self.hash, self.weight, self.owner = self.hash[order], self.weight[order], self.owner[order]
        self.bounds = np.searchsorted(self.owner, np.arange(len(texts) + 1))
        self.total = np.bincount(self.owner, self.weight, minlength=len(texts))

    def similarity(self, a: int, other: Features, b: int) -> float:
        x = self.hash[self.bounds[a]:self.bounds[a + 1]]
        y = other.hash[other.bounds[b]:other.bounds[b + 1]]
        at = np.minimum(np.searchsorted(y, x), len(y) - 1)
        common = self.weight[self.bounds[a]:self.bounds[a + 1]][y[at] == x].sum()
        return common / (self.total[a] + other.total[b] - common)

    def _dense(self, rows: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Square roots of weights, one row for each of ``rows``; ``features`` in ascending order."""
        out = np.zeros((len(rows), len(features)), np.float32)
        at = np.concatenate([np.arange(self.bounds[r], self.bounds[r + 1]) for r in rows])
        owner = np.repeat(np.arange(len(rows)), self.bounds[rows + 1] - self.bounds[rows])
        place = np.minimum(np.searchsorted(features, self.hash[at]), len(features) - 1)
        known = features[place] == self.hash[at]
        out[owner[known], place[known]] = np.sqrt(self.weight[at[known]])
        return out

    def links(
        self, a: np.ndarray, other: Features, b: np.ndarray, threshold: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a row ``a`` here and a row ``b`` of ``other`` that reach the threshold."""
        if len(a) * len(b) <= 64:
            pairs = [
                (i, j) for i in a for j in b
                if min(self.total[i], other.total[j]) >= threshold * max(self.total[i], other.total[j])
                and self.similarity(i, other, j) >= threshold
            ]
            found = np.array(pairs, np.int64).reshape(-1, 2)
            return found[:, 0], found[:, 1]
        here = np.unique(np.concatenate([self.hash[self.bounds[r]:self.bounds[r + 1]] for r in a]))
        there = np.unique(np.concatenate([other.hash[other.bounds[r]:other.bounds[r + 1]] for r in b]))
        features = np.intersect1d(here, there, assume_unique=True)
        common = np.zeros((len(a), len(b)))
        # Features in strips, so the dense part stays small however long the texts are.
        strip = max(1, 4_000_000 // (len(a) + len(b)))
        for low in range(0, len(features), strip):
            part = features[low:low + strip]
            common += self._dense(a, part) @ other._dense(b, part).T
        similarity = common / (self.total[a][:, None] + other.total[b][None, :] - common)
        i, j = np.nonzero(similarity >= threshold - 1e-4)
        sure = similarity[i, j] >= threshold + 1e-4
        for k in np.flatnonzero(~sure):  # single precision does not decide close cases
            sure[k] = self.similarity(a[i[k]], other, b[j[k]]) >= threshold
        return a[i[sure]], b[j[sure]]


def _compare(grouped: DataFrame, weights: np.ndarray, settings: Settings) -> DataFrame:
    """(node, root, settled): links of one spanning tree for each class inside each group.

    ``grouped``: group, asks, main, among, node, text. Rows that ask are compared
    with all other rows of the group, block by block, and with one another where
    they say ``among``. An asking row that is linked with a main row asks no
    further: it is in the main class then (``settled``), and who is not will ask
    for it. A settled row that is the root of its tree is linked with itself.
    """
    shared = grouped.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        for table, starts in whole_groups(batches):
            node, texts = table.column("node").to_numpy(), table.column("text")
            asks, main, among = (table.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("asks", "main", "among"))
            for s, e in zip(starts, np.append(starts[1:], table.num_rows)):
                if e - s < 2 or not asks[s:e].any():
                    continue
                features = lambda rows: Features(texts.take(pa.array(s + rows)).to_pylist(), weight, settings.width)
                askers, others = np.flatnonzero(asks[s:e]), np.flatnonzero(~asks[s:e])
                own = features(askers)
                asking, found = np.arange(len(askers)), [(askers[:0], askers[:0])]
                if among[s:e].any():
                    i, j = own.links(asking, own, asking, settings.threshold)
                    found.append((askers[i[i != j]], askers[j[i != j]]))
                for low in range(0, len(others), BLOCK):
                    part = others[low:low + BLOCK]
                    offered = features(part)
                    i, j = own.links(asking, offered, np.arange(len(part)), settings.threshold)
                    found.append((askers[i], part[j]))
                    asking = np.setdiff1d(asking, i[main[s + part[j]]])
                    if not len(asking):
                        break
                root = local_components(e - s, *(np.concatenate(x) for x in zip(*found)))
                settled = asks[s:e] & np.isin(root, root[main[s:e]])
                linked = np.flatnonzero((root != np.arange(e - s)) | settled)
                if len(linked):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[s + linked]), pa.array(node[s + root[linked]]), pa.array(settled[linked])],
                        names=["node", "root", "settled"],
                    )

    chosen = grouped.select("group", "asks", "main", "among", "node", "text")
    return dealt(chosen).mapInArrow(run, "node long, root long, settled boolean")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(key, digest, class_id, class_digest) of every row: near duplicates share both of the latter.

    A result named like the key gets an underscore behind its own name; other
    columns of ``docs`` are not read and may have any names.

    ``class_id`` is their least key, which two classes may share where keys
    repeat; ``class_digest``, the least digest of their texts, is never shared.

    Equal texts are copies whatever their length, also those without words;
    NULL is the empty text. Texts of fewer than five words have one shingle of
    all of them. Rows with equal keys stay separate rows; a NULL key is the
    least only where there is no other. An empty table gives an empty table.

    Copies become one node before anything meets. Entries of a band beyond
    ``BLOCK`` texts or ``GROUP_BYTES`` are compared inside random blocks first; texts that are
    then outside the main class of a family of large entries are compared with
    all of the family, as pairs of hash blocks of about ``REST`` texts and at most
    about ``GROUP_BYTES`` in tasks of their own. No pair is left out and none is emitted: tasks return a spanning
    tree of the links they found.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    named = rows.withColumns({"digest": F.unhex(F.md5("text")), "bytes": F.octet_length("text").cast("long")})
    weights = shingle_weights(rows, "text", settings.width)
    nodes, nodes_path = stages.stage_at(
        signatures(named, "text", weights, settings).groupBy("digest")
        .agg(F.min("key").alias("least"), F.first("_bands").alias("bands"), F.first("bytes").alias("bytes"))
        .withColumn("node", F.monotonically_increasing_id()),
        "texts",
    )
    entries = nodes.select("node", "bytes", F.posexplode("bands").alias("band", "code")).select(
        "node", "bytes", F.xxhash64("band", "code").alias("entry")
    )
    shared = entries.groupBy("entry").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("head"), _parts(BLOCK).alias("blocks")
    ).where("n > 1")
    members, members_path = stages.stage_at(entries.drop("bytes").join(shared, "entry"), "members")
    # Entries with the same few members say the same; one of them is enough.
    same = members.groupBy("entry", "n", "head").agg(F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"))
    chosen = same.groupBy("n", "head", "sum").agg(F.min("entry").alias("entry")).select("entry")
    members = members.join(chosen, "entry", "left_semi")
    wanted = members.select("node").distinct().join(nodes.select("node", "digest", "least"), "node")
    texts, texts_path = stages.stage_at(
        named.join(wanted, (named["digest"] == wanted["digest"]) & named["key"].eqNullSafe(wanted["least"]))
        .select("node", "bytes", "text").dropDuplicates(["node"]),
        "met-texts",
    )
    first = members.join(texts, "node").select(
        F.xxhash64("entry", F.pmod(F.xxhash64("node", "entry"), F.col("blocks"))).alias("group"),
        F.lit(True).alias("asks"), F.lit(False).alias("main"), F.lit(True).alias("among"), "node", "text",
    )
    links, links_path = stages.stage_at(_compare(first, weights, settings), "links")
    paths = [nodes_path, members_path, texts_path, links_path]
    large = members.where("blocks > 1")
    if large.limit(1).count():
        for more, path in _rest(large, links, texts, weights, settings):
            paths.append(path)
            links = links.union(more)
    components = connected_components(links, "node", "root")
    least = components.join(nodes.select("node", "least", "digest"), "node").groupBy("component").agg(
        F.min("least").alias("class_id"), F.min("digest").alias("class_digest")
    )
    named_classes = components.join(least, "component").select("node", "class_id", "class_digest")
    answers, _ = stages.stage_at(
        nodes.join(named_classes, "node", "left").select(
            "digest", F.when(F.col("class_digest").isNull(), F.col("least")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("class_digest", "digest").alias("class_digest"),
        ),
        "classes",
    )
    for path in paths:
        stages.discard(spark, path)
    light = docs.select(F.col(key).alias("key"), F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))).alias("digest"))
    results = [F.col(c).alias(free(c, [key])) for c in ("digest", "class_id", "class_digest")]
    return light.join(answers, "digest").select(F.col("key").alias(key), *results)


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row of every class: that with the least key, and the lesser digest among texts of that key.

    A NULL key is greater than any other. All columns stay as they were, whatever
    their names. Rows that agree in key and text are copies, of which one stays.
    An empty table gives an empty table.
    """
    found = classes(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "key", "text", settings)
    rows = found.groupBy("class_digest", "key", "digest").agg(F.count(F.lit(1)).alias("copies"))
    first = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "digest", "copies")).alias("one")
    own, kept_digest, copies, digest = (free(c, docs.columns) for c in ("_key", "_kept", "_copies", "_digest"))
    kept, _ = stages.stage_at(
        rows.groupBy("class_digest").agg(first).select(
            F.col("one.key").alias(own), F.col("one.digest").alias(kept_digest), F.col("one.copies").alias(copies)
        ),
        "kept",
    )
    named = docs.withColumn(digest, F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))))
    told = F.col(key).eqNullSafe(F.col(own)) & (F.col(digest) == F.col(kept_digest))
    several = F.col(copies) > 1
    out = named.join(kept, told, "left_semi") if not kept.where(several).limit(1).count() else (
        named.join(kept.where(~several), told, "left_semi").unionByName(
            named.join(kept.where(several), told, "left_semi").dropDuplicates([key, digest])
        )
    )
    return out.drop(digest)


def _cut(rows: DataFrame, name: str) -> DataFrame:
    """The rows with ``name``, their hash block of about REST rows and GROUP_BYTES of the family, and the number of those."""
    sizes = rows.groupBy("family").agg(_parts(REST).alias(f"{name}s"))
    return rows.join(sizes, "family").withColumn(name, F.pmod(F.xxhash64("node"), F.col(f"{name}s")).cast("int"))


def _grouped(rows: DataFrame, first: str, second: str, asks: Column, main: bool, among: Column) -> DataFrame:
    return rows.select(
        F.xxhash64("family", first, second, F.lit(main)).alias("group"), asks.alias("asks"),
        (~asks & F.lit(main)).alias("main"), among.alias("among"), "node", "text",
    )


def _across(asking: DataFrame, answering: DataFrame, main: bool, low: int = 0, high: int | None = None) -> DataFrame:
    """Groups of each part of ``asking`` with each block of ``answering`` (cut already) from ``low`` up to ``high``."""
    parted = _cut(asking, "part")
    parts = parted.groupBy("family").agg(F.max("parts").alias("parts"))
    blocks = answering.groupBy("family").agg(F.max("blocks").alias("blocks"))
    if high is not None:
        blocks = blocks.withColumn("blocks", F.least("blocks", F.lit(high)))
        answering = answering.where(F.col("block").between(low, high - 1))
    asks = parted.join(blocks.where(F.col("blocks") > low), "family").withColumn(
        "block", F.explode(F.sequence(F.lit(low), F.col("blocks") - 1))
    )
    answers = answering.join(parts, "family").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    yes, no = F.lit(True), F.lit(False)
    return _grouped(asks, "part", "block", yes, main, no).union(_grouped(answers, "part", "block", no, main, no))


def _among(asking: DataFrame) -> DataFrame:
    """Groups of each two parts of ``asking``, and of each part alone."""
    pairs = _cut(asking, "part").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = pairs.withColumns({"first": F.least("part", "other"), "second": F.greatest("part", "other")})
    alone = F.col("first") == F.col("second")
    # Apart from the groups of _across, which may have the same two numbers.
    return _grouped(placed.withColumn("first", -1 - F.col("first")), "first", "second", F.col("part") == -1 - F.col("first"), False, alone)


def _rest(
    large: DataFrame, links: DataFrame, texts: DataFrame, weights: np.ndarray, settings: Settings
) -> list[tuple[DataFrame, str]]:
    """Links of the second comparison: in families of large entries, who is not in the main class asks all others.

    They ask the main class first, twice as many blocks of it in each round, and
    who was linked with it leaves before the next. Who is left then asks all who
    have asked. Both sides of a group are bounded, however large the family is.
    """
    spark = large.sparkSession
    families = connected_components(large.select("node", "head"), "node", "head").withColumnRenamed("component", "family")
    joined, joined_path = stages.stage_at(
        families.join(
            connected_components(links, "node", "root").withColumnRenamed("component", "class"), "node", "left"
        ).withColumn("class", F.coalesce("class", "node")),
        "families",
    )
    sizes = joined.groupBy("family", "class").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("family").agg(F.max(F.struct("size", "class"))["class"].alias("main"))
    placed = joined.join(main, "family").select("family", "node", (F.col("class") == F.col("main")).alias("in_main"))
    known, known_path = stages.stage_at(placed.join(texts, "node"), "family-texts")
    askers = known.where("NOT in_main").drop("in_main")
    families_asking = askers.select("family").distinct()
    core, core_path = stages.stage_at(
        _cut(known.where("in_main").drop("in_main").join(families_asking, "family", "left_semi"), "block"), "main-texts"
    )
    blocks = core.agg(F.max("blocks")).first()[0] or 0
    found: list[tuple[DataFrame, str]] = []
    settled = askers.select("node").limit(0)
    low, high = 0, 1
    while low < blocks and askers.join(settled, "node", "left_anti").limit(1).count():
        asking = askers.join(settled, "node", "left_anti")
        found.append(stages.stage_at(_compare(_across(asking, core, True, low, high), weights, settings), "rest-links"))
        settled = settled.union(found[-1][0].where("settled").select("node")).distinct()
        low, high = high, 2 * high + 1
    asking = askers.join(settled, "node", "left_anti")
    told = _cut(askers.join(settled, "node", "left_semi"), "block")
    found.append(stages.stage_at(
        _compare(_among(asking).union(_across(asking, told, False)), weights, settings), "rest-links"
    ))
    for path in (joined_path, known_path, core_path):
        stages.discard(spark, path)
    return found

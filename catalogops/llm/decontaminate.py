"""Benchmark passages in documents by spaced seeds.

A mask keeps some of a run of words and ignores the others, so a substituted
word under an ignored place leaves the seed as it was. Seeds of all documents
are joined with those of the benchmark; around every hit the two texts are laid
over one another without gaps and their agreeing words are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import let
from ..sources import stages
from .pieces import free

#: Fixed masks: 1 keeps a word, 0 ignores it. Whichever 3 of 12 words in a row differ, one of the masks fits
#: between them at some place, so every window of WINDOW words (or whole item of 12) with SHARE agreement is hit.
MASKS = ("110111", "11010011", "11000001011", "1110000011")
#: Items of fewer words have masks of their own: whichever 2 of 8 words differ, one fits between them, and of
#: 8 to 11 words SHARE allows two to differ.
LONG = 12
SHORT_MASKS = ("1111", "11011", "11000011")
#: An overlap has a window of this many words, or of the whole item if it is shorter ...
WINDOW = 13
#: ... in which at least this share agrees.
SHARE = 0.75
#: Shorter items have to be there word for word: from FEW words on anywhere in a text, below as the whole of it.
SHORT, FEW = 8, 5
#: Benchmark seeds up to which they are broadcast, 24 bytes each; more are joined by shuffle.
BROADCAST_SEEDS = 200_000


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-case words: runs of letters and digits. NULL has none."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(words: Column, start: Column, mask: str) -> Column:
    """NULL where the mask would reach beyond the last word."""
    kept = [F.get(words, start + F.lit(k)) for k, bit in enumerate(mask) if bit == "1"]
    return F.when(start + F.lit(len(mask)) <= F.size(words), F.xxhash64(F.lit(mask), *kept))


def seeds(df: DataFrame, words: str, masks: tuple[str, ...]) -> DataFrame:
    """One row for each place and mask that fits there: ``seed`` and ``at``, the first word's place from 0."""
    span = min(map(len, masks))
    places = F.when(F.size(words) >= span, F.sequence(F.lit(0), F.size(words) - span))
    placed = df.withColumn("at", F.explode(places))
    return placed.withColumn(
        "seed", F.explode(F.array(*[_seed(F.col(words), F.col("at"), m) for m in masks]))
    ).where("seed IS NOT NULL")


def _trimmed(text: Column) -> Column:
    """Without what is no word at either end, where a split would leave an empty word."""
    return F.regexp_replace(text, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def item_words(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, words) of the items that have words."""
    trimmed = _trimmed(F.col(text))
    return benchmark.where(F.length(trimmed) > 0).select(
        F.col(item).alias("item_id"), word_hashes(trimmed).alias("words")
    ).distinct()


def overlaps(
    docs: DataFrame, benchmark: DataFrame, keys: list[str], text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(keys, item_id, n_agree, window_agree, start): every document with an item it overlaps.

    ``n_agree`` counts the item's words that the document has in the same
    places, ``window_agree`` those of the best window, ``start`` is the place in
    the document where the item's first word would stand (negative where the
    document starts inside the item). Of several overlaps with one item the best
    is given, the first of equals. NULL and empty texts on either side overlap
    nothing; equal items with different ids are all reported; rows with equal
    keys are one document. Items of 8 to 11 words have lighter masks of their
    own; shorter ones must agree in every word, those of 1 to 4 words with the
    whole of a text. Keys may have any names; a result named like a key gets an
    underscore behind its own. Empty tables overlap nothing.

    The documents are read in one pass without a shuffle: seeds are made and
    looked up inside one piece of generated code, and only numbers leave it: the
    text's digest, the item and the place. Words are fetched for these hits
    alone, so neither the broadcast nor the shuffles carry any others. Equal
    texts are judged once.
    """
    spark = docs.sparkSession
    items, items_path = stages.stage_at(
        item_words(benchmark, item, item_text).withColumn("_item", F.monotonically_increasing_id()), "items"
    )
    own = docs.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col(text).cast("string").alias("_text")
    ).where("_text IS NOT NULL")
    own = own.withColumns({"_a": F.xxhash64("_text"), "_b": F.xxhash64(F.lit("b"), "_text")})
    # Written before they are judged, else the optimizer would draw the judging into the code that finds them.
    hits, hits_path = stages.stage_at(_hits(own, items), "hits")
    judged, judged_path = stages.stage_at(_judged(own, items, hits), "judged")
    found = own.join(judged, ["_a", "_b"])
    best = F.max(F.struct("window_agree", "n_agree", (-F.col("start")).alias("before"))).alias("best")
    names = [f"_key{i}" for i in range(len(keys))]
    given = lambda c: free(c, keys)
    out = found.groupBy(*names, "item_id").agg(best).select(
        *[F.col(n).alias(k) for n, k in zip(names, keys)], F.col("item_id").alias(given("item_id")),
        F.col("best.n_agree").cast("long").alias(given("n_agree")),
        F.col("best.window_agree").cast("long").alias(given("window_agree")),
        (-F.col("best.before")).cast("long").alias(given("start")),
    )
    out, _ = stages.stage_at(out, "overlaps")
    for path in (items_path, hits_path, judged_path):
        stages.discard(spark, path)
    return out


def _hits(own: DataFrame, items: DataFrame) -> DataFrame:
    """(_a, _b, _item, at): texts and where in them the first word of an item would stand, each once."""
    size = F.size("words")
    bands = [(size >= LONG, MASKS), ((size < LONG) & (size >= SHORT), SHORT_MASKS)]
    bands += [(size == n, ("1" * n,)) for n in range(FEW, SHORT)]
    present = {r[0] for r in items.select(F.least(size, F.lit(LONG))).distinct().collect()}
    bands = [b for b, sizes in zip(bands, (
        {LONG}, set(range(SHORT, LONG)), *({n} for n in range(FEW, SHORT))
    )) if present & sizes]
    met = [_met(own, items.where(where), masks) for where, masks in bands]
    if present & set(range(1, FEW)):
        first = F.when(F.rlike("_text", F.lit(r"^[^\p{L}\p{N}]")), 1).otherwise(0)
        whole = own.select("_a", "_b", word_hashes(_trimmed(F.col("_text"))).alias("_words"), first.alias("at"))
        few = items.where(size < FEW).select("_item", F.xxhash64("words").alias("seed"))
        met.append(whole.where(F.size("_words") < FEW).withColumn("seed", F.xxhash64("_words")).join(few, "seed").select("_a", "_b", "_item", "at"))
    if not met:
        return own.select("_a", "_b", F.lit(0).cast("long").alias("_item"), F.lit(0).alias("at")).limit(0)
    hits = met[0]
    for more in met[1:]:
        hits = hits.unionByName(more)
    return hits.distinct()


def _met(own: DataFrame, items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """Hits of the items that these masks are for."""
    wanted = seeds(items, "words", masks).select("seed", "_item", F.col("at").alias("item_at")).distinct()
    placed = seeds(own.select("_a", "_b", word_hashes(F.col("_text")).alias("_words")), "_words", masks)
    if wanted.count() <= BROADCAST_SEEDS:
        wanted = F.broadcast(wanted)
    return placed.select("_a", "_b", "at", "seed").join(wanted, "seed").select(
        "_a", "_b", "_item", (F.col("at") - F.col("item_at")).alias("at")
    ).distinct()


def _judged(own: DataFrame, items: DataFrame, hits: DataFrame) -> DataFrame:
    """(_a, _b, item_id, n_agree, window_agree, start) of the hits that are overlaps."""
    texts = own.join(hits.select("_a", "_b").distinct(), ["_a", "_b"], "left_semi")
    words = texts.groupBy("_a", "_b").agg(F.first("_text").alias("_text")).select(
        "_a", "_b", word_hashes(F.col("_text")).alias("_words")
    )
    sized = hits.join(items.select("_item", F.size("words").alias("n")), "_item")
    # Of a text only what lies beside the item goes on; -1 keeps the places before its start.
    first = F.greatest(F.col("at"), F.lit(0))
    last = F.least(F.col("at") + F.col("n"), F.size("_words"))
    beside = sized.join(words, ["_a", "_b"]).select(
        "_a", "_b", "_item", "at", F.slice("_words", first + 1, F.greatest(last - first, F.lit(0))).alias("_part"), (first - F.col("at")).alias("_skip"),
    )
    laid = F.transform("words", lambda w, k: F.when(F.get("_part", k - F.col("_skip")) == w, 1).otherwise(0))

    def counted(agree: Column) -> Column:
        width = F.least(F.size(agree), F.lit(WINDOW))
        windows = F.transform(
            F.sequence(F.lit(1), F.size(agree) - width + 1),
            lambda s: F.aggregate(F.slice(agree, s, width), F.lit(0), lambda total, x: total + x),
        )
        return F.struct(
            F.aggregate(agree, F.lit(0), lambda total, x: total + x).alias("n_agree"), F.array_max(windows).alias("window_agree"),
            F.when(F.size(agree) < SHORT, F.size(agree)).otherwise(F.ceil(width * SHARE)).alias("needed"),
        )

    # let: the agreements of a hit are laid out once, not once for every window.
    return beside.join(items.select("_item", "item_id", "words"), "_item").select(
        "_a", "_b", "item_id", F.col("at").alias("start"), F.explode(F.array(let(laid, counted))).alias("x")
    ).select("_a", "_b", "item_id", "start", "x.n_agree", "x.window_agree", "x.needed").where("window_agree >= needed").drop("needed")


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that overlap no item, all their columns as they were.

    A document is told by its key and text, so rows that share a key are judged
    one by one; equal rows are judged alike. Columns may have any names.
    """
    digest = free("_digest", docs.columns)
    told = docs.withColumn(digest, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    named = told.select(F.col(key).alias("_key"), F.col(digest).alias("_dirty"), F.col(text).alias("_text"))
    dirty = overlaps(named, benchmark, ["_key", "_dirty"], "_text").select("_key", "_dirty").distinct()
    dirty = dirty.select(F.col("_key").alias(free("_dirty_key", told.columns)), F.col("_dirty").alias(free("_dirty", told.columns)))
    same = told[key].eqNullSafe(dirty[dirty.columns[0]]) & (told[digest] == dirty[dirty.columns[1]])
    return told.join(dirty, same, "left_anti").drop(digest)

"""Keyword tables of any size: substrings of the lengths that occur, joined to the table.

The loop of ``functions.text`` is right for lists that a rule spells out. A table
of keywords stays on the cluster: each distinct text is cut into the substrings
that have a keyword's length, and those that pass a filter of fixed size meet the
keywords in an equality join. The work follows the texts and the number of
different lengths, not the number of keywords. A substring carries its text's
digest, never the text, so what is sorted and shuffled does not grow with the
length of a text times its keywords.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import col, folded

#: log2 of the bits of the filter; more keywords let more substrings through, none is lost.
FILTER_BITS = 23
#: Lengths of keywords in code points, at most; longer texts are no keywords.
LONGEST = 256

# Stands behind a text; a keyword with it can only match an end.
_END = "￿"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)


def _window_hashes(codes: np.ndarray, lengths: list[int]) -> Iterator[np.ndarray]:
    """Hashes of all windows of each length, from one pass over the prefixes."""
    with np.errstate(over="ignore"):
        powers, back = (
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(codes), base)]), dtype=np.uint64) for base in (_BASE, _BASE_INVERSE)
        )
        # Sums of code times base to the place; a window is moved back to the first place.
        sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * powers[:-1], dtype=np.uint64)])
        for length in lengths:
            n = len(codes) - length + 1
            if n < 1:
                yield np.zeros(0, np.uint64)
                continue
            window = (sums[length:] - sums[:n]) * back[:n]
            h = window ^ (window >> np.uint64(31))
            h = h * np.uint64(0x94D049BB133111EB)
            yield h ^ (h >> np.uint64(29))


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _forms(c: Column | str, match: str) -> Column:
    """The texts in which keys are looked up, as an array."""
    if match == "substring":
        return F.array(F.lower(col(c)))
    if match == "word_prefix":
        return F.array(F.lower(F.concat(F.lit(" "), col(c))))
    if match == "padded_suffix":
        return F.array(F.concat(F.lit(" "), folded(c), F.lit(" ")), F.concat(folded(c), F.lit(_END)))
    raise ValueError(f"no such match: {match}")


def _keys(match: str) -> Column:
    """What a keyword looks like in those texts."""
    k = F.col("keyword")
    return {
        "substring": F.array(k),
        "word_prefix": F.array(F.concat(F.lit(" "), k)),
        "padded_suffix": F.array(F.concat(F.lit(" "), k, F.lit(" ")), F.concat(k, F.lit(_END))),
    }[match]


def digest(c: Column | str) -> Column:
    """32 bytes that stand for a text; NULL for NULL."""
    return F.unhex(F.sha2(col(c), 256))


def hits(df: DataFrame, c: str, keywords: DataFrame, match: str = "substring", digests: bool = False) -> DataFrame:
    """``(text, keyword)``: every keyword that each distinct value of column ``c`` holds, once.

    ``keywords`` has a column ``keyword`` in lower case, in any number. The same
    matches as those of ``functions.text``. NULLs hold and match nothing; an empty
    keyword, and one of more than LONGEST code points, is an error. ``digests``
    gives ``(text_digest, keyword)`` instead: long texts are best joined by
    ``digest`` after the hits are counted or chosen from.
    """
    listed = keywords.where(F.col("keyword").isNotNull()).select("keyword", F.explode(_keys(match)).alias("key")).distinct()
    lengths = sorted(r[0] for r in listed.select(F.char_length("key")).distinct().limit(2 * LONGEST).collect())
    shortest = keywords.agg(F.min(F.char_length("keyword"))).first()[0]
    if shortest == 0:
        raise ValueError("an empty keyword matches nothing; drop it")
    if lengths and lengths[-1] > LONGEST + 2:
        raise ValueError(f"a keyword has more than {LONGEST} characters")
    spark = df.sparkSession
    passing = _filter(listed)
    shared = spark.sparkContext.broadcast((lengths, passing))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, allowed = shared.value
        for batch in batches:
            texts, cuts = [], []
            for text, form in zip(batch.column(0).to_pylist(), batch.column(1)):
                form = form.as_py()
                found: set[str] = set()
                for length, h in zip(sizes, _window_hashes(_codes(form), sizes)):
                    slot = _slots(h)
                    at = np.flatnonzero(allowed[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                    found.update(form[i:i + length] for i in at.tolist())
                cuts += found
                texts += [text] * len(found)
                if len(cuts) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(cuts, pa.string())], names=["text_digest", "key"])
                    texts, cuts = [], []
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(cuts, pa.string())], names=["text_digest", "key"])

    distinct = df.select(F.col(c).alias("text")).distinct().where(F.col("text").isNotNull())
    forms = distinct.select(digest("text").alias("text_digest"), F.explode(_forms("text", match)).alias("form"))
    found = forms.mapInArrow(cut, "text_digest binary, key string").join(listed, "key").select("text_digest", "keyword").distinct()
    if digests:
        return found
    return distinct.withColumn("text_digest", digest("text")).join(found, "text_digest").select("text", "keyword")


def _filter(listed: DataFrame) -> np.ndarray:
    """One bit for each hash of a key: a fixed number of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        for batch in batches:
            for key in batch.column(0).to_pylist():
                codes = _codes(key)
                slot = _slots(next(_window_hashes(codes, [len(codes)])))
                held[slot >> 3] |= np.left_shift(1, slot & 7).astype(np.uint8)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at].astype(np.int32))], names=["at", "bits"])

    rows = listed.select("key").mapInArrow(run, "at long, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out


def mark(df: DataFrame, c: str, keywords: DataFrame, out: str, match: str = "substring") -> DataFrame:
    """Add the boolean ``out``: column ``c`` holds some keyword; False for NULL."""
    holding = hits(df, c, keywords, match, digests=True).select(F.col("text_digest").alias("_holding")).distinct()
    joined = df.drop(out).join(holding, digest(c) == F.col("_holding"), "left")
    return joined.withColumn(out, F.col("_holding").isNotNull()).drop("_holding")


def classify(df: DataFrame, c: str, keywords: DataFrame, default: str, out: str, match: str = "substring") -> DataFrame:
    """Add ``out``: the label of the keyword of least ``priority`` that column ``c`` holds, else ``default``.

    ``keywords`` is (keyword, priority, label); ties go to the first label by name.
    """
    found = hits(df, c, keywords, match, digests=True).join(keywords.select("keyword", "priority", "label"), "keyword")
    first = found.groupBy(F.col("text_digest").alias("_held")).agg(F.min(F.struct("priority", "label")).alias("_first"))
    joined = df.drop(out).join(first, digest(c) == F.col("_held"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_first.label"), F.lit(default))).drop("_held", "_first")

"""Alignment of two tokenizers over a corpus, each distinct text tokenised once.

Texts are shuffled by their full text and counted; every distinct text is
tokenised and aligned once; the links between token ids are summed with the
number of copies as weight; and the measures go back to the rows by a digest of
their text. Byte offsets where tokens of both sides end cut a text into groups.

Inside a task, texts are cut before each space that follows a character other
than white space. No token of either side reaches across such a place: byte-level
BPE splits words there before it merges, and no piece of the other vocabulary
holds the space sign behind another character (checked when it is loaded). So a
segment is tokenised and aligned once per task, and a text is put together from
its segments. Sums and digests are those of the whole text.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources import stages
from .bpe import byte_symbols
from .pieces import Numbering, free, pieces, runs, sums

#: Segments a task remembers, and their characters, before it starts afresh.
SEGMENTS = 300_000
SEGMENT_CHARS = 16_000_000
#: Characters of a text that are put together at a time.
STRETCH = 1_000_000
#: Token pairs with at least this fraction of all links meet the texts by broadcast: at most so many rows.
FREQUENT = 50_000

_SHIFT = 32
_SPACE = "▁"
_BORDER = re.compile(r"(?<=\S)(?= )")
#: A space behind white space: only there a cut at each space would be wrong.
_NO_BORDER = re.compile(r"\s ")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens side by side in one array."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        if (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError("the first tokenizer has to be a byte-level one")
        symbols = byte_symbols()
        entries = {i: bytes(symbols[c] for c in text) for text, i in spec["model"]["vocab"].items()
                   if all(c in symbols for c in text)}
        pieces_b = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any(_SPACE in p.lstrip(_SPACE) for p in pieces_b):
            raise ValueError("a piece of the second tokenizer reaches across the start of a word")
        self.space = self.b.piece_to_id(_SPACE)
        self.bytes_a = self._table([entries.get(i, b"") for i in range(max(entries) + 1)])
        self.bytes_b = self._table([
            bytes([int(m[1], 16)]) if self.b.is_byte(i) and (m := _BYTE_PIECE.fullmatch(p)) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces_b)
        ])

    @staticmethod
    def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths

    def encode(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Segments start with the space that the second tokenizer puts before a text itself."""
        a = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        b = self.b.encode([s[1:] for s in segments], num_threads=1)
        # Nothing is put before the empty text: a space at the end of a text is a piece of its own.
        return a, [ids if s != " " else [self.space] for s, ids in zip(segments, b)]


@functools.lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter((i for row in ids for i in row), np.int64, int(counts.sum())), counts


def _same_bytes(
    ids: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray], raw: np.ndarray, sizes: np.ndarray,
) -> np.ndarray:
    """Of each segment: do its tokens' bytes, joined, equal its own?"""
    flat, starts, lengths = table
    same = sums(lengths[ids], counts) == sizes
    use = np.repeat(same, counts)
    own = np.repeat(same, sizes)
    differ = flat[runs(starts[ids[use]], lengths[ids[use]])] != raw[own]
    same[same] = sums(differ.astype(np.int64), sizes[same]) == 0
    return same


class Aligner:
    """Aligns texts and remembers the segments it has seen."""

    def __init__(self, path_a: str, path_b: str):
        self.tokenizers = tokenizers(path_a, path_b)
        self.forget()

    def forget(self) -> None:
        self.index, self.chars = Numbering(), 0
        #: By segment: tokens of both sides, groups, whether it does not come back.
        self.measures = np.zeros((0, 4), np.int64)
        self.said: list[str] = []
        self.links = np.zeros(0, np.int64)
        self.link_starts = np.zeros(0, np.int64)

    def _learn(self, segments: list[str]) -> None:
        ids_a, ids_b = self.tokenizers.encode(segments)
        (a, n_a), (b, n_b) = _flat(ids_a), _flat(ids_b)
        encoded = [s.encode() for s in segments]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        raw = np.frombuffer(b"".join(encoded), np.uint8)
        good = _same_bytes(a, n_a, self.tokenizers.bytes_a, raw, sizes) & _same_bytes(b, n_b, self.tokenizers.bytes_b, raw, sizes)
        # Both sides of the good segments fill the same bytes, so ends can be counted through.
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        ends_a, ends_b = np.cumsum(self.tokenizers.bytes_a[2][a]), np.cumsum(self.tokenizers.bytes_b[2][b])
        _, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups, i, j = [], 0, 0
        for k, m in zip((at_a + 1).tolist(), (at_b + 1).tolist()):
            groups.append(f"{','.join(text_a[i:k])}|{','.join(text_b[j:m])}")
            i, j = k, m
        owner = np.repeat(np.arange(len(segments)), n_a)[at_a]
        n_groups = np.bincount(owner, minlength=len(segments))
        ends = np.cumsum(n_groups).tolist()
        self.said += [";".join(groups[i:j]) for i, j in zip([0, *ends[:-1]], ends)]
        self.link_starts = np.concatenate([self.link_starts, len(self.links) + np.cumsum(n_groups) - n_groups])
        # Tokens are never empty: of the tokens that end at an offset there is one on either side.
        self.links = np.concatenate([self.links, (a[at_a] << _SHIFT) | b[at_b]])
        self.measures = np.concatenate([self.measures, np.stack([n_a, n_b, n_groups, ~good], axis=1)])
        self.chars += sum(map(len, segments))

    def align(self, texts: list[str]) -> list[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
        """Of each text: tokens of both sides, groups, digest of the groups, distinct linked pairs and their links.

        A text that does not come back from both sides has zeros, no digest and no pairs.
        """
        totals = [_Total() for _ in texts]
        waiting, size = [], 0
        for total, text in zip(totals, texts):
            for stretch in stretches(" " + text):
                waiting.append((total, stretch))
                size += len(stretch)
                if size >= STRETCH:
                    self._add(waiting)
                    waiting, size = [], 0
        self._add(waiting)
        return [t.result() for t in totals]

    def _add(self, waiting: list[tuple[_Total, str]]) -> None:
        """Put stretches to their totals; what is new in them is tokenised together."""
        if len(self.index) > SEGMENTS or self.chars > SEGMENT_CHARS:
            self.forget()
        numbers = [np.array(self.index.numbers(_segments(stretch)), np.int64) for _, stretch in waiting]
        if self.index.fresh:
            self._learn(self.index.fresh)
            self.index.fresh = []
        for (total, _), own in zip(waiting, numbers):
            measures = self.measures[own]
            pairs = self.links[runs(self.link_starts[own], measures[:, 2])]
            total.add(measures.sum(axis=0), map(self.said.__getitem__, own.tolist()), pairs)


class _Total:
    """What has been added up of one text."""

    def __init__(self):
        self.n, self.digest, self.pairs, self.counts = np.zeros(4, np.int64), hashlib.sha256(), [], []

    def add(self, n: np.ndarray, said: Iterable[str], pairs: np.ndarray) -> None:
        self.digest.update((";" if self.n.any() else "").encode() + ";".join(said).encode())
        self.n = self.n + n
        pair, count = np.unique(pairs, return_counts=True)
        self.pairs.append(pair)
        self.counts.append(count)

    def result(self) -> tuple[int, int, int, str, np.ndarray, np.ndarray]:
        if self.n[3]:
            return 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, counts = self.pairs[0], self.counts[0]
        if len(self.pairs) > 1:
            pairs, back = np.unique(np.concatenate(self.pairs), return_inverse=True)
            counts = np.bincount(back, np.concatenate(self.counts)).astype(np.int64)
        return *self.n[:3].tolist(), self.digest.hexdigest(), pairs, counts


def _segments(stretch: str) -> list[str]:
    if _NO_BORDER.search(stretch):
        return _BORDER.split(stretch)
    return [" " + s for s in stretch.split(" ")[1:]]


def stretches(text: str, most: int = STRETCH) -> Iterator[str]:
    """The text in parts of about ``most`` characters, cut where no token reaches across."""
    start = 0
    while len(text) - start > most:
        border = _BORDER.search(text, start + most)
        if not border:
            break
        yield text[start:border.start()]
        start = border.start()
    yield text[start:]


_ALIGNED = (
    "_text_id binary, _copies long, _n_a long, _n_b long, _n_groups long, _groups string, _pairs array<long>, _links array<long>"
)


def text_id(text: Column) -> Column:
    """SHA-256 of the text, 32 bytes: what stands for a text once it has been shuffled in full."""
    return F.unhex(F.sha2(text, 256))


def _aligned(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(_text, _copies) with what the alignment of each text gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            for rows in pieces(batch, "_text"):
                out = aligner.align(rows.column(1).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(o[4]) for o in out])]).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([o[k] for o in out]).astype(np.int64)))
                    for k in (4, 5)
                ]
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), rows.column(2), *(pa.array([o[k] for o in out], pa.int64()) for k in range(3)),
                    pa.array([o[3] for o in out], pa.string()), *lists,
                ], names=[c.split(" ")[0] for c in _ALIGNED.split(", ")])

    return texts.select(text_id(F.col("_text")), "_text", "_copies").mapInArrow(run, _ALIGNED)


def token_pairs(aligned: DataFrame) -> DataFrame:
    """(_pair, _count, _best): links of the whole corpus by id pair, and whether no other pair of its second id has more."""
    each = aligned.select("_copies", F.explode(F.arrays_zip("_pairs", "_links")).alias("_z"))
    counts = each.groupBy(F.col("_z._pairs").alias("_pair")).agg(F.sum(F.col("_z._links") * F.col("_copies")).alias("_count"))
    # At most the first vocabulary's size in rows for each id of the second.
    by_second = Window.partitionBy(F.col("_pair").bitwiseAND(F.lit((1 << _SHIFT) - 1)))
    return counts.withColumn("_best", F.col("_count") == F.max("_count").over(by_second))


def _scored(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """(_text_id, _n_best, _count_sum) of every text with links.

    Pairs with at least 1 in FREQUENT of all links are FREQUENT at most, so they may be broadcast; each
    of the others has too few links to be a hot key.
    """
    total = pairs.agg(F.sum("_count")).first()[0] or 0
    often = F.col("_count") * F.lit(FREQUENT) >= F.lit(total)
    frequent = F.broadcast(pairs.where(often))
    each = aligned.select("_text_id", F.explode(F.arrays_zip("_pairs", "_links")).alias("_z")).select(
        "_text_id", F.col("_z._pairs").alias("_pair"), F.col("_z._links").alias("_n")
    )
    best = F.sum(F.when(F.col("_best"), F.col("_n")).otherwise(F.lit(0))).alias("_n_best")
    counted = F.sum(F.col("_n") * F.col("_count")).alias("_count_sum")
    near = each.join(frequent, "_pair").groupBy("_text_id").agg(best, counted)
    far = each.join(F.broadcast(pairs.where(often).select("_pair")), "_pair", "left_anti").join(
        pairs.where(~often), "_pair"
    ).groupBy("_text_id").agg(best, counted)
    return near.unionByName(far)


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(measures of every row, token pairs of the corpus).

    Measures: the key, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links whose
    pair no other pair of its second id exceeds, ties included), ``count_sum`` (corpus-wide counts,
    added up over the links) and ``groups_sha256``. Pairs: ``a_id``, ``b_id``, ``n_links``, ``best``.

    The first tokenizer gets a space before the text, the second puts one there itself; strings of
    special tokens are plain text. NULL and empty texts, and texts that do not come back from both
    sides, have zeros and an empty digest, and link nothing. Texts of any length are taken whole. Equal
    texts are aligned once and count as often as they occur, whatever their keys; a repeated or NULL key
    gets a row each time. Only the key is carried along, so no other column can clash; a measure named
    like the key gets an underscore behind its name. Empty tables give empty tables.

    The pairs and measures are staged under the shared folder; who calls discards that when done.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    texts = rows.where(F.length("_text") > 0).groupBy("_text").agg(F.count(F.lit(1)).alias("_copies"))
    aligned, aligned_path = stages.stage_at(_aligned(texts, path_a, path_b), "aligned")
    pairs = stages.stage(token_pairs(aligned), "token-pairs")
    scored = _scored(aligned, pairs).select("_text_id", *_zeros("_n_a", "_n_b", "_n_groups"), F.lit("").alias("_groups"), "_n_best", "_count_sum")
    measured = aligned.where("_n_a > 0").select("_text_id", "_n_a", "_n_b", "_n_groups", "_groups", *_zeros("_n_best", "_count_sum"))
    measures = stages.stage(
        measured.unionByName(scored).groupBy("_text_id").agg(
            *(F.sum(c).alias(c) for c in ("_n_a", "_n_b", "_n_groups", "_n_best", "_count_sum")), F.max("_groups").alias("_groups"),
        ), "alignment",
    )
    stages.discard(spark, aligned_path)
    # Rows without text must not meet in one task: numbers of eight bytes equal no digest.
    own = F.when(F.length("_text") > 0, text_id(F.col("_text"))).otherwise(F.unhex(F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")))
    joined = rows.select("_key", own.alias("_text_id")).join(measures, "_text_id", "left")
    number = lambda c, name: F.coalesce(c, F.lit(0)).cast("long").alias(free(name, [key]))
    out = joined.select(
        F.col("_key").alias(key), number("_n_a", "n_a"), number("_n_b", "n_b"), number("_n_groups", "n_groups"),
        number("_n_groups", "n_links"), number("_n_best", "n_best"), number("_count_sum", "count_sum"),
        F.coalesce("_groups", F.lit("")).alias(free("groups_sha256", [key])),
    )
    return out, pairs.select(
        F.shiftright("_pair", _SHIFT).alias("a_id"), F.col("_pair").bitwiseAND(F.lit((1 << _SHIFT) - 1)).alias("b_id"),
        F.col("_count").alias("n_links"), F.col("_best").alias("best"),
    )


def _zeros(*names: str) -> list[Column]:
    return [F.lit(0).cast("long").alias(n) for n in names]

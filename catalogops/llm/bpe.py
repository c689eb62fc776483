"""Byte-level BPE by speculation and verification, and its exact decoding.

Per distinct word: greedy longest match proposes tokens; one vectorised check
then tests every adjacent pair of all proposals at once; words with a pair that
the merges would not have left standing are merged exactly.

Why the check decides: merges run in order of rank, and a token's rank is above
those of its parts, so the merges carried out inside one word never go back in
rank. A proposed border between tokens s and t survives if and only if no merge
across it came up while it was the next one due. At any time the border lies
between a node of the right spine of s and a node of the left spine of t, so it
is enough to undo both spines in reverse order of rank and to look up each pair.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

#: Fixed value: the pattern byte-level BPE splits text with before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The same split in the faster standard engine, for texts without characters
#: that the two engines class differently.
_PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_NOT_PLAIN = re.compile("[^\t\n\r\x20-\x7e\u00a1\u00ab\u00b7\u00bb\u00bf-\u024f\u2010-\u2027\u20ac]")

#: Bytes of text handled at a time inside a task; longer texts go alone.
CHUNK_BYTES = 1_000_000
#: Distinct words a task remembers before it starts afresh.
CACHED_WORDS = 400_000
#: Bytes of a word up to which failing words are merged together, a step at a time.
SHORT_WORD = 64

_NEVER = np.int64(1 << 40)


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens and merges of one vocabulary file, as arrays indexed by token id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = byte_symbols()
        ids: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for text, i in ids.items():
            if text not in self.special:
                self.bytes[i] = bytes(symbols[c] for c in text)
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        plain = set(ids.values()) - set(self.special.values())
        self.size = size
        self.byte_id = [-1] * 256
        for i in plain:
            if len(self.bytes[i]) == 1:
                self.byte_id[self.bytes[i][0]] = i

        self.rank = np.full(size, -1, np.int64)
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = ids[a], ids[b], ids[a + b]
            self.merge[x, y] = (r, z)
            if self.rank[z] < 0:
                self.rank[z], self.left[z], self.right[z] = r, x, y
        keys = np.array([x * size + y for x, y in self.merge], np.int64)
        self._pairs = pd.Index(keys)
        self._pair_rank = np.append(np.array([r for r, _ in self.merge.values()], np.int64), _NEVER)
        self._pair_token = np.array([z for _, z in self.merge.values()], np.int64)
        self._byte_ids = np.array(self.byte_id, np.int64)

        made = np.array([i for i in plain if self.rank[i] >= 0], np.int64)
        whole = self.borders_hold(self.left[made], self.right[made], self.rank[made])
        reached = {*made[whole].tolist(), *(i for i in self.byte_id if i >= 0)}
        #: Only tokens that their own bytes merge into may be proposed.
        self.token = {self.bytes[i]: i for i in reached}
        self.longest: dict[bytes, int] = {}
        for b in self.token:
            self.longest[b[:3]] = max(len(b), self.longest.get(b[:3], 0))

        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.words = regex.compile(WORDS)

    def borders_hold(self, s: np.ndarray, t: np.ndarray, due: np.ndarray | None = None) -> np.ndarray:
        """For each pair: do the merges leave a border between s and t standing?

        ``due`` is the rank of the merge that later removes the border, if any.
        """
        holds = np.ones(len(s), bool)
        at = np.arange(len(s))
        a, b = s.astype(np.int64), t.astype(np.int64)
        next_a = np.full(len(s), _NEVER) if due is None else due.astype(np.int64)
        next_b = next_a.copy()
        while len(at):
            across = self._pair_rank[self._pairs.get_indexer(a * self.size + b)]
            # Equal ranks merge from the left: the left neighbour's merge comes first.
            broken = (across < next_a) & (across <= next_b)
            holds[at[broken]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            go = ~broken & ((rank_a >= 0) | (rank_b >= 0))
            at, a, b, next_a, next_b, rank_a, rank_b = (x[go] for x in (at, a, b, next_a, next_b, rank_a, rank_b))
            undo_a = rank_a > rank_b
            next_a = np.where(undo_a, rank_a, next_a)
            next_b = np.where(undo_a, next_b, rank_b)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return holds

    def propose(self, word: bytes) -> list[int]:
        """Longest token first, from left to right."""
        out, i, end = [], 0, len(word)
        token, longest = self.token, self.longest
        while i < end:
            reach = min(longest.get(word[i:i + 3], 2), end - i)
            while reach > 1:
                found = token.get(word[i:i + reach])
                if found is not None:
                    break
                reach -= 1
            else:
                found, reach = self.byte_id[word[i]], 1
            out.append(found)
            i += reach
        return out

    def merge_exactly(self, word: bytes) -> list[int]:
        """The merges themselves, lowest rank first and leftmost among equals."""
        ids = [self.byte_id[b] for b in word]
        end = len(ids)
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        merge = self.merge
        due = [(*m, i) for i in range(end - 1) if (m := merge.get((ids[i], ids[i + 1])))]
        due = [(r, i, z) for r, z, i in due]
        heapq.heapify(due)
        while due:
            r, i, z = heapq.heappop(due)
            j = after[i]
            if ids[i] < 0 or j >= end or merge.get((ids[i], ids[j]), (None,))[0] != r:
                continue
            ids[i], ids[j] = z, -1
            after[i] = j = after[j]
            if j < end:
                before[j] = i
                if m := merge.get((z, ids[j])):
                    heapq.heappush(due, (m[0], i, m[1]))
            if (h := before[i]) >= 0 and (m := merge.get((ids[h], z))):
                heapq.heappush(due, (m[0], h, m[1]))
        return [x for x in ids if x >= 0]

    def merge_together(self, words: list[bytes]) -> list[list[int]]:
        """The merges of many short words at once: each round carries out the next merge of every word."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids = self._byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            found = self._pairs.get_indexer(ids[:-1] * self.size + ids[1:])
            rank = np.append(self._pair_rank[found], _NEVER)
            rank[:-1][owner[1:] != owner[:-1]] = _NEVER
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(ids))))
            active = least < _NEVER
            done.append((owner[~active], ids[~active]))
            due = np.flatnonzero(active & (rank == least))
            due = due[np.append(True, owner[due][1:] != owner[due][:-1])] if len(due) else due
            ids[due] = self._pair_token[found[due]]
            keep = active
            keep[due + 1] = False
            ids, owner = ids[keep], owner[keep]
        owner, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(np.bincount(owner, minlength=len(words)))
        flat = ids[order].tolist()
        return [flat[i:j] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        proposals = [self.propose(w) for w in words]
        lengths = np.fromiter(map(len, proposals), np.int64, len(words))
        flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        holds = self.borders_hold(pairs // self.size, pairs % self.size)[back]
        failing = np.unique(owner[inner[~holds]]).tolist()
        short = [k for k in failing if len(words[k]) <= SHORT_WORD]
        if short:
            for k, merged in zip(short, self.merge_together([words[k] for k in short])):
                proposals[k] = merged
        for k in failing:
            if len(words[k]) > SHORT_WORD:
                proposals[k] = self.merge_exactly(words[k])
        return proposals


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the runs (start, length), one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class _WordIndex(dict):
    """Word -> number in order of first sight; new words also go to ``fresh``."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


class Encoder:
    """Encodes batches of texts and remembers the words it has seen."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary(path)
        special = [regex.escape(s) for s in sorted(self.vocabulary.special, key=len, reverse=True)]
        self.special = regex.compile("(" + "|".join(special) + ")") if special else None
        self.forget()

    def forget(self) -> None:
        self.index = _WordIndex()
        self.ids = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        for text, i in self.vocabulary.special.items():
            self.index[text] = len(self.index)
            self._append([[i]])

    def _append(self, encoded: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        flat = np.fromiter(chain.from_iterable(encoded), np.int64, int(lengths.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])

    def _split(self, text: str) -> Iterable[str]:
        find = self.vocabulary.words.findall if _NOT_PLAIN.search(text) else _PLAIN_WORDS.findall
        if self.special is None or not self.special.search(text):
            return find(text)
        parts = self.special.split(text)
        return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else find(part))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in a row, and the number of tokens of each."""
        if len(self.index) > CACHED_WORDS:
            self.forget()
        numbers = [list(map(self.index.__getitem__, self._split(t))) for t in texts]
        if self.index.fresh:
            self._append(self.vocabulary.encode_words([w.encode() for w in self.index.fresh]))
            self.index.fresh = []
        words = np.fromiter(map(len, numbers), np.int64, len(numbers))
        flat = np.fromiter(chain.from_iterable(numbers), np.int64, int(words.sum()))
        lengths = self.lengths[flat]
        ids = self.ids[_gather(self.starts[flat], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        borders = np.concatenate([[0], np.cumsum(words)])
        return ids, np.diff(ends[borders])


Batches = Iterator[pa.RecordBatch]
Step = tuple[Callable[[Batches], Batches], Callable[[T.StructType], T.StructType]]


def _pieces(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batch cut where its texts reach about CHUNK_BYTES."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False) + 64
    piece = np.cumsum(sizes) // CHUNK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(piece)]
    for start, end in zip(cuts[:-1], cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start), [t or "" for t in column.slice(start, end - start).to_pylist()]


def _put(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    at = batch.schema.get_field_index(name)
    return batch.set_column(at, name, values) if at >= 0 else batch.append_column(name, values)


def _with(name: str, kind: T.DataType) -> Callable[[T.StructType], T.StructType]:
    def extend(schema: T.StructType) -> T.StructType:
        if name in schema.names:
            return T.StructType([T.StructField(f.name, kind if f.name == name else f.dataType) for f in schema])
        return T.StructType([*schema.fields, T.StructField(name, kind)])

    return extend


def encoding(path: str, text: str = "text", ids: str = "ids") -> Step:
    def run(batches: Batches) -> Batches:
        encoder = Encoder(path)
        for batch in batches:
            for piece, texts in _pieces(batch, text):
                flat, counts = encoder.encode(texts)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield _put(piece, ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32))))

    return run, _with(ids, T.ArrayType(T.IntegerType()))


def _ragged(batch: pa.RecordBatch, ids: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(batch.schema.get_field_index(ids))
    counts = pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts


def decoding(path: str, ids: str = "ids", text: str = "decoded") -> Step:
    def run(batches: Batches) -> Batches:
        v = vocabulary(path)
        for batch in batches:
            flat, counts = _ragged(batch, ids)
            if len(flat) and (flat.min() < 0 or flat.max() >= v.size):
                raise ValueError("token id outside the vocabulary")
            lengths = v.lengths[flat]
            ends = np.concatenate([[0], np.cumsum(lengths)])
            borders = ends[np.concatenate([[0], np.cumsum(counts)])]
            data = v.flat[_gather(v.offsets[flat], lengths)].tobytes()
            texts = [data[i:j].decode("utf-8", "replace") for i, j in zip(borders[:-1], borders[1:])]
            yield _put(batch, text, pa.array(texts, pa.string()))

    return run, _with(text, T.StringType())


def digesting(key: str = "doc_id", ids: str = "ids", text: str = "decoded") -> Step:
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            flat, counts = _ragged(batch, ids)
            data = flat.astype("<u4").tobytes()
            ends = 4 * np.concatenate([[0], np.cumsum(counts)])
            hashed = [hashlib.sha256(data[i:j]).hexdigest() for i, j in zip(ends[:-1], ends[1:])]
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            said = [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index(key)), pa.array(counts),
                pa.array(hashed, pa.string()), pa.array(said, pa.string()),
            ], names=names)

    return run, lambda schema: T.StructType([
        schema[key], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])


def comparing(text: str, decoded: str, out: str = "exact") -> Step:
    """Put whether both columns agree (NULL as empty) in place of them."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            a, b = (pc.fill_null(batch.column(batch.schema.get_field_index(c)), "") for c in (text, decoded))
            kept = batch.select([c for c in batch.schema.names if c not in (text, decoded)])
            yield kept.append_column(out, pc.equal(a, b))

    return run, lambda schema: T.StructType(
        [*(f for f in schema.fields if f.name not in (text, decoded)), T.StructField(out, T.BooleanType())]
    )


def apply(df: DataFrame, *steps: Step) -> DataFrame:
    """The steps in one pass: batches go from one to the next inside the same worker."""
    schema = df.schema
    for _, extend in steps:
        schema = extend(schema)

    def run(batches: Batches) -> Batches:
        for step, _ in steps:
            batches = step(batches)
        return batches

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the column ``ids`` (array of int): the tokens of the whole of each text.

    NULL encodes like the empty text, to no tokens. Texts of any length are
    taken whole. A special token's string in a text becomes that token, as the
    vocabulary file says. A column already named ``ids`` is replaced. Rows keep
    their number and order; there is no shuffle. An empty table stays empty.
    """
    return apply(df.withColumn(text, F.col(text).cast("string")), encoding(path, text, ids))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the column ``text`` with what the tokens say; special tokens are kept.

    Tokens are bytes; a sequence that is no valid UTF-8 decodes to replacement
    characters. NULL or no ids decode to the empty text. An id outside the
    vocabulary is an error.
    """
    return apply(df, decoding(path, ids, text))


def round_trip_digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: tokens, SHA-256 of the ids as little-endian uint32, SHA-256 of the text decoded from them.

    A NULL text is the empty text, which has no tokens and the digests of
    nothing. Texts are encoded whole, however long. Rows with equal or NULL keys
    stay separate rows, an empty table gives an empty table, and columns other
    than key and text are not read.
    """
    chosen = df.select(key, F.col(text).cast("string").alias(text))
    only = (
        lambda batches: (b.select([key, "ids"]) for b in batches),
        lambda schema: T.StructType([schema[key], schema["ids"]]),
    )
    return apply(chosen, encoding(path, text), only, decoding(path), digesting(key))

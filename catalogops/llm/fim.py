"""Fill-in-middle order of whole texts: prefix, middle and suffix cut at drawn units.

A text lies in blocks of fixed size. A Fenwick tree over the blocks stores how
many units and how many code points each holds; descending it by halves finds
the block of a cut and the counts before it in a logarithm of the text's
length, and only that block is then read to place the boundary. All texts of a
piece descend side by side.

The cuts depend on a seed and the row's key alone, so a lost task draws the
same ones again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .bpe import Step, apply
from .pieces import free, pieces

#: Bytes of a block; the local search reads one block for each cut.
BLOCK = 512
#: What a cut may fall between.
UNITS = ("chars", "words", "lines")

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Form:
    """Markers before prefix, suffix and middle, and the shares (in percent) of the forms."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    plain: int = 10
    spm: int = 20

    def __post_init__(self):
        marks = [m.encode() for m in (self.prefix, self.suffix, self.middle)]
        for i, a in enumerate(marks):
            # A marker that could begin inside another, or inside itself, would make the way back ambiguous.
            if not a or any(
                b.find(a, int(i == j)) >= 0 or any(b.startswith(a[-k:]) for k in range(1, len(a))) for j, b in enumerate(marks)
            ):
                raise ValueError("markers must not be empty, hold or overlap one another")

    @property
    def marks(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


def unit_starts(raw: np.ndarray, first: np.ndarray, kind: str) -> np.ndarray:
    """Whether a unit starts at each byte; ``first`` marks the first byte of every text.

    Units are code points, words (each with the white space before it) or lines (each with its
    line end). White space is that of ASCII.
    """
    if kind == "chars":
        return (raw & 0xC0) != 0x80
    before = np.concatenate([raw[:1], raw[:-1]])
    if kind == "lines":
        return first | (before == 10)
    space, was_space = (((x == 32) | ((x >= 9) & (x <= 13))) for x in (raw, before))
    return first | (space & ~was_space)


class BlockTrees:
    """Fenwick trees over the blocks of several texts, side by side in one array.

    Node i of a text (counted from 1) holds the counts of the ``i & -i`` blocks that end with block i.
    """

    def __init__(self, counts: np.ndarray, blocks: np.ndarray):
        """``counts``: one row of counts for each block; ``blocks``: how many blocks each text has."""
        self.blocks, self.first = blocks, np.cumsum(blocks) - blocks
        total = np.concatenate([np.zeros((1, counts.shape[1]), np.int64), np.cumsum(counts, axis=0)])
        node = np.arange(len(counts)) - np.repeat(self.first, blocks) + 1
        at = np.arange(len(counts)) + 1
        self.nodes = total[at] - total[at - (node & -node)]

    def totals(self) -> np.ndarray:
        """The counts of whole texts: the nodes that a prefix walk from the last block meets."""
        out = np.zeros((len(self.blocks), self.nodes.shape[1]), np.int64)
        at = self.blocks.copy()
        while (live := np.flatnonzero(at)).size:
            out[live] += self.nodes[self.first[live] + at[live] - 1]
            at[live] &= at[live] - 1
        return out

    def descend(self, text: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(block that holds the unit of that number, units before it in the block, other counts before the block).

        A number as great as the text's units leads behind its last block.
        """
        block, rest = np.zeros(len(text), np.int64), unit.astype(np.int64).copy()
        before = np.zeros((len(text), self.nodes.shape[1] - 1), np.int64)
        step = 1 << int(self.blocks.max(initial=1)).bit_length()
        while step := step >> 1:
            reach = block + step
            inside = np.flatnonzero(reach <= self.blocks[text])
            node = self.nodes[self.first[text[inside]] + reach[inside] - 1]
            fits = node[:, 0] <= rest[inside]
            go, node = inside[fits], node[fits]
            block[go] = reach[go]
            rest[go] -= node[:, 0]
            before[go] += node[:, 1:]
        return block, rest, before


class Piece:
    """Some texts as one array of bytes, with their trees."""

    def __init__(self, texts: list[bytes], kind: str = "chars", block: int = BLOCK):
        self.block = block
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        first = np.zeros(len(self.raw), bool)
        first[self.starts[self.sizes > 0]] = True
        self.chars = (self.raw & 0xC0) != 0x80
        self.units = self.chars if kind == "chars" else unit_starts(self.raw, first, kind)
        blocks = -(-self.sizes // block)
        inner = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        edges = np.repeat(self.starts, blocks) + inner * block
        counts = np.zeros((len(edges), 2), np.int64)
        if len(edges):
            counts[:, 0] = np.add.reduceat(self.units, edges, dtype=np.int64)
            counts[:, 1] = np.add.reduceat(self.chars, edges, dtype=np.int64)
        self.trees = BlockTrees(counts, blocks)

    def cut(self, text: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte inside the text, code points before it) where the unit of that number starts; the end for one past the last."""
        block, rest, before = self.trees.descend(text, unit)
        chars = before[:, 0]
        at = np.where(block < self.trees.blocks[text], block * self.block, self.sizes[text])
        inside = np.flatnonzero(block < self.trees.blocks[text])
        window = np.arange(self.block)
        for part in np.array_split(inside, max(1, len(inside) // 4096)):
            place = (self.starts[text[part]] + at[part])[:, None] + window
            known = place < self.ends[text[part]][:, None]
            place = np.minimum(place, len(self.raw) - 1)
            passed = np.cumsum(self.units[place] & known, axis=1)
            local = np.argmax(passed > rest[part][:, None], axis=1)
            chars[part] += ((self.chars[place] & known) & (window < local[:, None])).sum(axis=1)
            at[part] += local
        return at, chars


def draws(key: object, seed: int) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers: the first groups of the SHA-256 of ``seed:key``; no key is the empty text."""
    said = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(said[k:k + 4], "big") for k in (0, 4, 8, 12))


_COLUMNS = ["n", "form", "prefix_chars", "middle_chars", "output"]


def _out_names(key: str) -> list[str]:
    return [free(c, [key]) for c in _COLUMNS]


def rearranging(key: str, text: str, form: Form, seed: int = 1, kind: str = "chars", block: int = BLOCK) -> Step:
    if kind not in UNITS:
        raise ValueError(f"units are one of {UNITS}")
    names = [key, *_out_names(key)]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for rows in pieces(batch, text):
                column = rows.column(rows.schema.get_field_index(text)).cast(pa.large_binary())
                texts = [t or b"" for t in column.to_pylist()]
                keys = rows.column(rows.schema.get_field_index(key))
                yield pa.RecordBatch.from_arrays(
                    [keys, *_rearranged(texts, keys.to_pylist(), form, seed, kind, block)], names=names
                )

    return run, lambda schema: T.StructType([
        schema[key], *(T.StructField(n, t) for n, t in zip(names[1:], (
            T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType(),
        ))),
    ])


def _rearranged(texts: list[bytes], keys: list, form: Form, seed: int, kind: str, block: int) -> list[pa.Array]:
    piece = Piece(texts, kind, block)
    n = piece.trees.totals()[:, 0]
    drawn = np.array([draws(k, seed) for k in keys], np.int64).reshape(-1, 4)
    cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
    at, chars = (x.reshape(-1, 2) for x in piece.cut(np.repeat(np.arange(len(texts)), 2), cuts.ravel()))
    p, s, m = form.marks
    held = np.array([bool(t) and p not in t and s not in t and m not in t for t in texts], bool)
    plain = ~held | (drawn[:, 2] % 100 >= 100 - form.plain)
    spm = ~plain & (drawn[:, 3] % 100 < form.spm)
    output = []
    for t, (i, j), is_plain, is_spm in zip(texts, at.tolist(), plain.tolist(), spm.tolist()):
        if is_plain:
            output.append(t)
        elif is_spm:
            output.append(b"".join((s, t[j:], p, t[:i], m, t[i:j])))
        else:
            output.append(b"".join((p, t[:i], s, t[j:], m, t[i:j])))
    return [
        pa.array(n), pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).tolist(), pa.string()),
        pa.array(chars[:, 0], mask=plain), pa.array(chars[:, 1] - chars[:, 0], mask=plain),
        pa.array(output, pa.binary()).cast(pa.string()),
    ]


def restored(output: bytes, kind: str, form: Form) -> bytes:
    """The text behind an output of that form."""
    if kind == "plain":
        return output
    p, s, m = form.marks
    front, middle = output.split(m, 1)
    if kind == "psm":
        prefix, suffix = front[len(p):].split(s, 1)
    else:
        suffix, prefix = front[len(s):].split(p, 1)
    return prefix + middle + suffix


def restoring(form: Form, output: str = "output", kind: str = "form", text: str = "restored") -> Step:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            said, kinds = (batch.column(batch.schema.get_field_index(c)) for c in (output, kind))
            back = [None if t is None else restored(t, k, form) for t, k in zip(said.cast(pa.large_binary()).to_pylist(), kinds.to_pylist())]
            kept = batch.select([c for c in batch.schema.names if c != text])
            yield kept.append_column(text, pa.array(back, pa.binary()).cast(pa.string()))

    return run, lambda schema: T.StructType([*(f for f in schema.fields if f.name != text), T.StructField(text, T.StringType())])


def digesting(columns: dict[str, str]) -> Step:
    """Put the SHA-256 of each column named, in lower-case hexadecimal, in its place under a new name."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            kept = batch.select([c for c in batch.schema.names if c not in columns])
            for c, name in columns.items():
                said = batch.column(batch.schema.get_field_index(c)).cast(pa.large_binary()).to_pylist()
                kept = kept.append_column(name, pa.array([hashlib.sha256(t).hexdigest() for t in said], pa.string()))
            yield kept

    return run, lambda schema: T.StructType([
        *(f for f in schema.fields if f.name not in columns), *(T.StructField(n, T.StringType()) for n in columns.values()),
    ])


def _chosen(df: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    """Key and text only; the text under a name that no other column has."""
    own = free("_text", [key])
    return df.select(F.col(key), F.col(text).cast("string").alias(own)), own


def transform(
    df: DataFrame, key: str = "doc_id", text: str = "text", form: Form = Form(), seed: int = 1, units: str = "chars",
) -> DataFrame:
    """Per row: the key, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    The prefix ends after the smaller of two drawn numbers of units, the middle
    after the larger. A NULL text is the empty text; an empty text, and one that
    holds a marker, stays plain. Plain rows have NULL lengths. Texts of any
    length are taken whole. Rows with equal keys are cut at the same shares, a
    NULL key counts as the empty text. Other columns are not carried along, so
    none can clash; a key that is named like a result keeps its name, and the
    result gets an underscore behind its own. There is no shuffle; an empty
    table stays empty.
    """
    chosen, own = _chosen(df, key, text)
    return apply(chosen, rearranging(key, own, form, seed, units))


def restore(df: DataFrame, form: Form = Form(), output: str = "output", kind: str = "form") -> DataFrame:
    """Add ``restored``: the exact text, from output and form alone; NULL output stays NULL. A column of that name is replaced."""
    return apply(df, restoring(form, output, kind))


def round_trip_digests(df: DataFrame, key: str = "doc_id", text: str = "text", form: Form = Form(), seed: int = 1) -> DataFrame:
    """As ``transform``, with the digests of output and restored text in place of the texts; one pass."""
    chosen, own = _chosen(df, key, text)
    output, kind = (_out_names(key)[k] for k in (4, 1))
    back = free("restored", [key])
    return apply(
        chosen, rearranging(key, own, form, seed), restoring(form, output, kind, back),
        digesting({output: free("output_sha256", [key]), back: free("restored_sha256", [key])}),
    )

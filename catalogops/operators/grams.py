"""Exact similarity join of texts by their character n-grams, over an inverted index.

Each text is the sparse vector of how often its n-grams occur. In one order for
all texts, rare n-grams first, only the front of a text is indexed: so much that
what is left is shorter than the threshold, and no text can reach it without
sharing an indexed n-gram. The index is stored once, in blocks of texts with about
as many n-grams; blocks meet where they are read, if any of their texts may hold
enough of one another's n-grams, and pairs are bounded from their shared front
before any whole text is looked at.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import folded
from ..sources.stages import discard, stage, stage_at
from .vectors import DIGITS, MIN_SIMILARITY, NEIGHBOURS, nearest_copies

#: Counters of texts that put n-grams in order, each a byte, and of a row of them; fewer or more change the work, never the result.
ORDER_BITS, _COUNTER_ROW = 24, 1 << 21
#: Texts of a task that it remembers, so as to write them once; blocks of a sorted range of texts.
_SEEN, _RANGE_BLOCKS = 100_000, 4
#: Texts of a block are alike in how evenly their n-grams are spread: how many more there are than a near text needs.
_SPREADS = (1.05, 1.5)
#: Texts of a block behind one n-gram of the index up to which its pairs are formed one by one.
LONG_POSTING = 128
#: Texts and characters of a block at most (one longer text is one block); few texts are cut finer, down to so many.
BLOCK_ROWS, BLOCK_CHARS, _LEAST_BLOCK = 2048, 8_000_000, 256
#: A row of a block, and a rest in steps, take two bytes.
_STEPS = 65535
#: Pairs behind n-grams, or n-grams of pairs, that a task handles at a time.
PIECE = 1_000_000
#: Tasks for each file's worth of blocks.
_TASKS_PER_FILE = 4
#: Columns of the dense product of two blocks.
_COLUMNS = 4096
#: Multiplications of a dense product in the time of one step of a search; near pairs for each text of a crowd.
_SEARCH, _CROWD = 300, 32
#: Rows of best lists that a task holds at most before it returns them.
_HELD = 2_000_000
_SLACK = 1e-9


def gram_hashes(text: str, n: int) -> np.ndarray:
    """One hash for each n-gram of the text between two spaces; none where it is shorter."""
    h = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    length = max(len(h) - n + 1, 0)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)

    def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out = left[: len(right)] * np.uint64(0xBF58476D1CE4E5B9)
        out += right[: len(out)]
        out ^= out >> np.uint64(31)
        return out

    # Hashes of 1, 2, 4 ... code points, put together as n is of powers of two.
    out, size, at = None, 1, 0
    while n >> 1 >= size or at < n:
        if n & size:
            out, at = h if out is None else joined(out, h[at:]), at + size
        if at < n:
            h, size = joined(h, h[size:]), 2 * size
    out = out[:length] * np.uint64(0x94D049BB133111EB)
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def _gram_counts(text: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text in order and how often each occurs."""
    grams = np.sort(gram_hashes(text, n))
    ends = np.flatnonzero(np.append(grams[1:] != grams[:-1], np.ones(min(1, len(grams)), bool)))
    counts = np.append(ends[:1] + 1, ends[1:] - ends[:-1])
    return grams[ends], counts


def _slots(grams: np.ndarray) -> np.ndarray:
    return (grams.view(np.uint64) >> np.uint64(64 - ORDER_BITS)).astype(np.int64)


def _support(counts: np.ndarray, min_sim: float) -> tuple[int, int]:
    """How many n-grams a text has, and how many of them a text near to it has at least.

    What two texts share holds at least the square of the threshold of the square of either (Cauchy-Schwarz), and
    no fewer n-grams can hold that than the most frequent ones.
    """
    times, many = np.unique(counts, return_counts=True)
    times, many = times[::-1].astype(np.float64) ** 2, many[::-1]
    held = np.cumsum(times * many)
    needed = max(min_sim - _SLACK, 0) ** 2 * held[-1] * (1 - _SLACK)
    at = int(np.searchsorted(held, needed))
    if at == len(held):
        return len(counts), len(counts) + 1
    before = held[at] - times[at] * many[at]
    return len(counts), int(many[:at].sum()) + max(1, math.ceil((needed - before) / times[at] - _SLACK))


def _placed(source: DataFrame, n: int, min_sim: float) -> DataFrame:
    """Rows of (id, text) with the text's digest and where its block lies, and rows of the counters.

    ``support`` is the number of n-grams, ``spread`` how unevenly they occur. A task writes a text that it
    meets again only once, packed. A counter has the number of texts with one of its n-grams, up to 255.
    """
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, vec binary, spread int, support long, text binary, slot int, counts binary"
    names = [c.split(" ")[0] for c in schema.split(", ")]
    types = [None, pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen, id_type = np.zeros(1 << ORDER_BITS, np.uint8), {}, None
        for batch in batches:
            ids, rows = batch.column(0), []
            id_type = ids.type
            for at in range(batch.num_rows):
                text = batch.column(1)[at].as_py()
                whole, packed = text.encode(), None
                vec = hashlib.sha256(whole).digest()
                if vec not in seen:
                    grams, counts = _gram_counts(text, n)
                    support, spread = 0, 0
                    if len(grams):
                        slots = _slots(grams)
                        held[slots] = np.minimum(held[slots], 254) + 1
                        support, least = _support(counts, min_sim)
                        spread = int(np.searchsorted(_SPREADS, min_sim**2 * support / least))
                        packed = zlib.compress(whole, 1)
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen[vec] = spread, support
                rows.append((vec, *seen[vec], packed, None, None))
            columns = zip(*rows) if rows else [()] * (len(types) - 1)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns, types[1:]))], names=names)
        for slot in range(0, len(held), _COUNTER_ROW):
            some = held[slot : slot + _COUNTER_ROW]
            if id_type is not None and some.any():
                row = (None, None, None, None, None, slot, zlib.compress(some.tobytes(), 1))
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, [id_type, *types[1:]])], names=names)

    return source.mapInArrow(run, schema)


def _order(placed: DataFrame) -> np.ndarray:
    """The counters of all tasks together: a fixed number of bytes."""

    def total(rows: pa.Table) -> pa.Table:
        held = np.zeros(_COUNTER_ROW, np.uint8)
        for packed in rows.column("counts").to_pylist():
            some = np.frombuffer(zlib.decompress(packed), np.uint8)
            held[: len(some)] = np.minimum(held[: len(some)], 255 - some) + some
        return pa.table({"slot": rows.column("slot")[:1], "counts": pa.array([zlib.compress(held.tobytes(), 1)], pa.binary())})

    rows = placed.where("slot IS NOT NULL").select("slot", "counts").groupBy("slot").applyInArrow(total, "slot int, counts binary").toArrow()
    out = np.zeros(1 << ORDER_BITS, np.uint8)
    for slot, packed in zip(rows.column("slot").to_pylist(), rows.column("counts").to_pylist()):
        some = np.frombuffer(zlib.decompress(packed), np.uint8)
        out[slot : slot + _COUNTER_ROW] = some[: len(out) - slot]
    return out


def _rests(counts: np.ndarray, min_sim: float) -> np.ndarray:
    """Length of what is left behind each indexed n-gram of a vector in the common order."""
    squares = counts.astype(np.float64) ** 2
    rest = np.sqrt(np.maximum(squares.sum() - np.cumsum(squares), 0) / squares.sum())
    return rest[: int(np.argmax(rest < min_sim - _SLACK)) + 1]


_BLOCK = (
    "block long, least long, most long, reps binary, texts array<binary>, bounds binary, grams binary, sizes binary, rows binary, counts binary, rests binary"
)


def _blocks(placed: DataFrame, n: int, min_sim: float, order: np.ndarray, block_rows: int, ranges: int) -> DataFrame:
    """One row for each block of texts of about as many n-grams: its texts, packed, and the index of their fronts.

    Texts too short for an n-gram are left out. ``bounds`` are square, largest count, total, what is left
    behind the front of each text, and its support; ``least`` and ``most`` are those of the block. The index is in
    the order of n-grams, of which it has 32 bits (others of the same bits add to what is shared, and stand at the
    same place in the common order, so bounds hold): each one, bytes of equal weight together as they compress best
    so, how many texts it has, their rows, its counts there, and what is left behind it, in steps of 1 / 65535,
    rounded up. What no other text has is not in the index.
    """
    shared = placed.sparkSession.sparkContext.broadcast(order)
    names = [c.split(" ")[0] for c in _BLOCK.split(", ")]

    def made(block: int, reps: list, held: list, bounds: list, fronts: list) -> pa.RecordBatch:
        gram, row, count, rest = (np.concatenate(x) for x in zip(*fronts))
        rank = np.argsort(gram, kind="stable")
        distinct, sizes = np.unique(gram, return_counts=True)
        blob = lambda values, kind: pa.array([np.asarray(values).astype(kind).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.array([block]), pa.array([min(b[5] for b in bounds)]), pa.array([max(b[4] for b in bounds)]),
            blob(reps, np.int64), pa.array([held], pa.list_(pa.binary())), blob(bounds, np.float64),
            blob(distinct.view(np.uint8).reshape(-1, 4).T, np.uint8), blob(sizes, np.uint16), blob(row[rank], np.uint16),
            blob(count[rank], np.int32), blob(np.ceil(rest[rank] * _STEPS), np.uint16),
        ], names=names)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(number, spread, smallest id, packed text) of each text; its copies follow each other by id."""
        last = held = None
        for batch in batches:
            for at in range(batch.num_rows):
                vec, text = batch.column(2)[at].as_py(), batch.column(4)[at].as_py()
                if vec != last:
                    if held:
                        yield tuple(held)
                    last, held = vec, [batch.column(0)[at].as_py(), batch.column(1)[at].as_py(), batch.column(3)[at].as_py(), text]
                held[3] = held[3] or text
        if held:
            yield tuple(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, kind, chars, lists = 0, 0, 0, ([], [], [], [])
        for number, spread, rep, packed in distinct(batches):
            text = zlib.decompress(packed).decode()
            gram, count = _gram_counts(text, n)
            reps, held, bounds, fronts = lists
            if reps and (len(reps) == block_rows or chars + len(text) > BLOCK_CHARS or spread != kind):
                yield made(block, *lists)
                chars, lists = 0, ([], [], [], [])
                reps, held, bounds, fronts = lists
            block, kind, chars = (block if reps else number), spread, chars + len(text)
            times = shared.value[_slots(gram)]
            rank = np.argsort(times, kind="stable")
            rest = _rests(count[rank], min_sim)
            front = rank[: len(rest)]
            met = times[front] != 1
            bits = (gram[front[met]].view(np.uint64) >> np.uint64(32)).astype(np.uint32)
            fronts.append((bits, np.full(len(bits), len(reps)), count[front[met]], rest[met]))
            exact = count.astype(np.float64)
            bounds.append(((exact * exact).sum(), exact.max(), exact.sum(), rest[-1], *_support(count, min_sim)))
            reps.append(rep)
            held.append(packed)
        if lists[0]:
            yield made(block, *lists)

    # A block has the number of its first row.
    by = ("spread", "support", "vec")
    texts = placed.where("support > 0").select(*by, "id", "text").repartitionByRange(ranges, *by).sortWithinPartitions(*by, "id")
    return texts.select(F.monotonically_increasing_id().alias("block"), "spread", "vec", "id", "text").mapInArrow(run, _BLOCK)


class _Block:
    """A stored block as arrays over what was read, and the whole vectors of the texts asked for so far."""

    def __init__(self, fields: dict[str, pa.Array], at: int, n: int):
        values = lambda name, kind: np.frombuffer(fields[name][at].as_buffer(), kind)
        self.number, self.n, self.texts, self.held = fields["block"][at].as_py(), n, fields["texts"][at].values, {}
        self.reps, self.rows, self.rests = values("reps", np.int64), values("rows", np.uint16).astype(np.int64), values("rests", np.uint16) / _STEPS
        self.square, self.most, self.total, self.last, self.support, self.least = np.ascontiguousarray(values("bounds", np.float64).reshape(-1, 6).T)
        self.weights = values("counts", np.int32) / np.sqrt(self.square)[self.rows]
        self.grams = np.ascontiguousarray(values("grams", np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
        self.sizes = values("sizes", np.uint16).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def vectors(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(n-grams, counts) of the whole texts in these rows."""
        new = [r for r in rows.tolist() if r not in self.held]
        for row, packed in zip(new, self.texts.take(pa.array(new, pa.int64())).to_pylist()):
            self.held[row] = _gram_counts(zlib.decompress(packed).decode(), self.n)
        return [self.held[r] for r in rows.tolist()]


def _summed(cell: np.ndarray, shared: np.ndarray, rest_a: np.ndarray, rest_b: np.ndarray):
    """Each cell once, with the sum of what is shared and the least rests."""
    rank = np.argsort(cell, kind="stable")
    cell = cell[rank]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(cell)), bool), cell[1:] != cell[:-1]]))
    if not len(cell):
        return cell, shared, rest_a, rest_b
    least = (np.minimum.reduceat(rest[rank], starts) for rest in (rest_a, rest_b))
    return cell[starts], np.add.reduceat(shared[rank], starts), *least


def _candidates(a: _Block, b: _Block, min_sim: float, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two blocks that share an indexed n-gram and may still reach the threshold, by the row of ``a``.

    Either has as many n-grams as the other needs of it. A dot product is at most one side's total times
    the other's largest count. And it is at most what
    the shared fronts give, plus what comes behind the last n-gram they share: the product of what is
    left there on both sides, or of what is left on one side at the end of its front (the one that ends
    first; the larger product covers either case) and on the other behind that n-gram. N-grams of more
    than ``limit`` texts on both sides, taken together, are multiplied as columns; what is behind them is
    taken to be all.
    """
    width = len(b.reps)
    parts = []
    both = np.sort(np.concatenate([a.grams, b.grams]))
    common = both[1:][both[1:] == both[:-1]]
    in_a, in_b = np.searchsorted(a.grams, common), np.searchsorted(b.grams, common)
    size = a.sizes[in_a] * b.sizes[in_b]
    long = size > limit * limit
    product = np.zeros((len(a.reps), width) if long.any() else 0)
    for some in np.array_split(np.flatnonzero(long), math.ceil(long.sum() / _COLUMNS) or 1):
        if len(some):
            dense = []
            for block, own in ((a, in_a[some]), (b, in_b[some])):
                column = np.repeat(np.arange(len(own)), block.sizes[own])
                entry = np.arange(len(column)) + np.repeat(block.starts[own] - np.cumsum(block.sizes[own]) + block.sizes[own], block.sizes[own])
                dense.append(np.zeros((len(block.reps), len(own))))
                dense[-1][block.rows[entry], column] = block.weights[entry]
            product += dense[0] @ dense[1].T
    cell = np.flatnonzero(product)
    parts.append((cell, product.ravel()[cell], np.ones(len(cell)), np.ones(len(cell))))
    in_a, in_b, size = in_a[~long], in_b[~long], size[~long]
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // PIECE)) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(size)]):
        many = size[start:end]
        own = np.repeat(np.arange(start, end), many)
        within = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
        down, across = np.divmod(within, b.sizes[in_b[own]])
        left, right = a.starts[in_a[own]] + down, b.starts[in_b[own]] + across
        row, column = a.rows[left], b.rows[right]
        some = np.flatnonzero((a.least[row] <= b.support[column]) & (b.least[column] <= a.support[row]))
        left, right, cell = left[some], right[some], row[some] * width + column[some]
        parts.append(_summed(cell, a.weights[left] * b.weights[right], a.rests[left], b.rests[right]))
        if sum(len(part[0]) for part in parts) > len(a.reps) * width + 4 * PIECE:
            parts = [_summed(*map(np.concatenate, zip(*parts)))]
    cell, shared, rest_a, rest_b = _summed(*map(np.concatenate, zip(*parts)))
    row, column = np.divmod(cell, max(width, 1))
    behind = np.maximum(a.last[row] * rest_b, b.last[column] * rest_a)
    reachable = np.minimum(a.most[row] * b.total[column], b.most[column] * a.total[row])
    near = shared + behind >= min_sim - _SLACK
    near &= reachable >= (min_sim - _SLACK) * np.sqrt(a.square[row] * b.square[column])
    near &= (a.least[row] <= b.support[column]) & (b.least[column] <= a.support[row])
    near &= a.reps[row] != b.reps[column]
    return row[near], column[near]


def _dots(a: _Block, b: _Block, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Dot products of the whole texts in the given pairs of rows, by the row of ``a``; they are whole numbers."""
    dot = np.zeros(len(row))
    if not len(row):
        return dot
    rows, columns = np.unique(row), np.unique(column)
    left, right = a.vectors(rows), b.vectors(columns)
    # A crowd: where most pairs are near, a dense product of all may be less work than one search for each.
    crowd = len(row) > _CROWD * (len(rows) + len(columns))
    flat = [np.concatenate([grams for grams, _ in side]) for side in (left, right)] if crowd else []
    distinct = np.intersect1d(*flat) if crowd else ()
    if crowd and len(row) * len(flat[1]) * _SEARCH > len(rows) * len(columns) ** 2 * len(distinct):
        product = np.zeros((len(rows), len(columns)))
        for start in range(0, len(distinct), _COLUMNS):
            parts, some = [], distinct[start : start + _COLUMNS]
            for side in (left, right):
                dense = np.zeros((len(side), len(some)))
                for i, (grams, counts) in enumerate(side):
                    at = np.minimum(np.searchsorted(some, grams), len(some) - 1)
                    there = some[at] == grams
                    dense[i, at[there]] = counts[there]
                parts.append(dense)
            product += parts[0] @ parts[1].T
        return product[np.searchsorted(rows, row), np.searchsorted(columns, column)]
    at_right = np.searchsorted(columns, column)
    for (grams, counts), start, end in zip(left, np.searchsorted(row, rows), np.searchsorted(row, rows, "right")):
        for i in range(start, end):
            others, times = right[at_right[i]]
            at = np.minimum(np.searchsorted(grams, others), len(grams) - 1)
            there = grams[at] == others
            dot[i] = counts[at[there]] @ times[there]
    return dot


def _best(k: int, rep: np.ndarray, other: np.ndarray, sim: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rank = np.lexsort((other, -sim, rep))
    rep, other, sim = rep[rank], other[rank], sim[rank]
    keep = np.arange(len(rep)) - np.searchsorted(rep, rep) < k
    return rep[keep], other[keep], sim[keep]


def _meeting(blocks: DataFrame, n: int, k: int, min_sim: float, limit: int) -> DataFrame:
    """(rep, other, sim): the ``k`` best of each text, itself included, among the blocks that a task has for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, best = None, {}

        def out() -> Iterator[pa.RecordBatch]:
            for found in best.values():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["rep", "other", "sim"])
            best.clear()

        for batch in batches:
            sides = [dict(zip([f.name for f in side.type], side.flatten())) for side in batch.columns]
            for i in range(batch.num_rows):
                if a is None or a.number != sides[0]["block"][i].as_py():
                    a = _Block(sides[0], i, n)
                b = a if a.number == sides[1]["block"][i].as_py() else _Block(sides[1], i, n)
                row, column = _candidates(a, b, min_sim, limit)
                sim = np.round(_dots(a, b, row, column) / np.sqrt(a.square[row] * b.square[column]), DIGITS)
                passed = sim >= min_sim
                left, right, sim = a.reps[row[passed]], b.reps[column[passed]], sim[passed]
                # A text is its own nearest: its copies are among its neighbours.
                ways = [(a, left, right, sim), (a, a.reps, a.reps, np.ones(len(a.reps))) if a is b else (b, right, left, sim)]
                for block, *found in ways:
                    held = best.get(block.number)
                    best[block.number] = _best(k, *(map(np.concatenate, zip(held, found)) if held else found))
                if sum(len(found[0]) for found in best.values()) > _HELD:
                    yield from out()
        yield from out()

    side = lambda name: blocks.select(F.struct("*").alias(name))
    met = side("a").crossJoin(side("b")).where(F.col("a.block") <= F.col("b.block"))
    met = met.where((F.col("a.least") <= F.col("b.most")) & (F.col("b.least") <= F.col("a.most")))
    # The pairs of one block with many others follow each other: a task keeps one best list for each of its blocks.
    tasks = max(1, _TASKS_PER_FILE * blocks.rdd.getNumPartitions())
    return met.coalesce(tasks).mapInArrow(run, "rep long, other long, sim double")


def gram_join(
    df: DataFrame, id_col: str, text_col: str, n: int = 3, k: int = NEIGHBOURS, min_sim: float = MIN_SIMILARITY,
    partitions: int | None = None, long_posting: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact ``k - 1`` nearest other rows with n-gram cosine >= ``min_sim`` (above 0).

    Texts are compared without case and outer white space; ids are longs. Returns
    ``(id, neighbour, sim, rank)``, ties by id. A NULL text, and one that has no
    n-gram, is near to nothing. Equal texts are compared once. Blocks of
    ``block_rows`` texts, each with its part of the index, are stored once and meet in
    a join that reads them again, so disk holds the index once, however many blocks
    each meets. A task holds two blocks and at most the ``k`` best of each text so far,
    so that no crowd of similar texts ever becomes all its pairs in a table. Pairs of
    one n-gram are formed one by one only up to ``long_posting`` texts of a block.
    """
    if not min_sim > 0:
        raise ValueError("min_sim has to be above 0: texts without a common n-gram are in no index")
    limit = LONG_POSTING if long_posting is None else long_posting
    spark = df.sparkSession
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).dropna().withColumn("text", folded("text"))
    placed, placed_path = stage_at(_placed(source, n, min_sim), "grams-texts", compression="zstd")
    source = placed.where("slot IS NULL").select("id", "vec")
    copies = Window.partitionBy("vec").orderBy("id")
    first = stage(source.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k).drop("copy"), "grams-copies")
    order, texts = _order(placed), placed.where("text IS NOT NULL").count()
    # Few texts are cut finer, so that every core has blocks.
    rows = min(block_rows, _STEPS, max(_LEAST_BLOCK, math.ceil(texts / (2 * (partitions or 1)))))
    ranges = max(partitions or 1, math.ceil(texts / (_RANGE_BLOCKS * rows)))
    # A file for each block, so that the join has tasks for every core and each holds few blocks.
    blocks, blocks_path = stage_at(_blocks(placed, n, min_sim, order, rows, ranges), "grams-blocks", maxRecordsPerFile=1, compression="zstd")
    best = Window.partitionBy("rep").orderBy(F.desc("sim"), "other")
    nearest = _meeting(blocks, n, k, min_sim, limit).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
    nearest = stage(nearest.drop("n"), "grams-nearest")
    discard(spark, blocks_path)
    return nearest_copies(source, first, nearest, k)

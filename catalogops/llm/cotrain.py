"""Quality of documents by co-training two views.

The content view sees the words and letter runs of a text (naive Bayes over
hashed features); the metadata view sees source, language, length and layout
measurements (logistic regression). Each starts from a bounded sample of
labelled documents. In every round both score every document of the corpus, and
what one is sure of teaches the other. At the end the calibrated views are
combined. Only sums of fixed size ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..sources import stages
from .shingles import word_hashes

#: At most so many labelled documents, those of least hash, start the views and calibrate them.
LABELLED = 20_000
#: Rounds of exchange, each over the whole corpus.
ROUNDS = 2
#: A view teaches what it gives at least this probability (or at most one less it).
SURE = 0.95
#: log2 of the hashed features of letter runs, and as many again of words.
FEATURE_BITS = 15
PIECE_BYTES = 1_000_000

_D = 2 << FEATURE_BITS
_KINDS = np.zeros(256, np.int8)  # 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 sign, 7 beyond ASCII
_KINDS[97:123], _KINDS[65:91], _KINDS[48:58] = 1, 2, 3
_KINDS[[32, 9]], _KINDS[[10, 13]], _KINDS[128:] = 4, 5, 7
_KINDS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 6
_SHAPES, _LANGS, _SOURCES = 9, 8, 16
#: Measurements, their squares, hashed language, hashed source, constant.
WIDTH = 2 * _SHAPES + _LANGS + _SOURCES + 1


@dataclass
class Models:
    """Both views and how they are combined; all arrays have a fixed size."""

    content: np.ndarray
    content_scale: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    metadata: np.ndarray
    combined: np.ndarray
    prior: float


def _segments(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs; empty runs give 0."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


class Piece:
    """Features of some texts: hashed letter runs and words, and the measurements of layout."""

    def __init__(self, texts: list[str], langs: list, sources: list, lengths: list):
        n = len(texts)
        words, self.words = word_hashes(texts)
        owner = np.repeat(np.arange(n), self.words)
        again = np.zeros(len(words), bool)
        if len(words):
            again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
        encoded = [t.encode() for t in texts]
        self.bytes = np.fromiter(map(len, encoded), np.int64, n)
        raw = np.frombuffer(b"".join(encoded), np.uint8)
        wide = np.concatenate([raw, np.zeros(2, np.uint8)]).astype(np.uint64)
        # Runs across the end of a text are few and fall to the text they start in.
        runs = (wide[:-2] << np.uint64(16)) | (wide[1:-1] << np.uint64(8)) | wide[2:]
        shift = np.uint64(64 - FEATURE_BITS)
        with np.errstate(over="ignore"):
            self.run_features = ((runs * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)
        word_features = (1 << FEATURE_BITS) + (words >> shift).astype(np.int64)
        self.word_features = np.where(again, 1 << FEATURE_BITS, word_features)

        kinds = _KINDS[raw]
        length = np.maximum(self.bytes, 1)
        share = lambda k: _segments(kinds == k, self.bytes) / length
        stated = np.array([0.0 if v is None else float(v) for v in lengths])
        shapes = np.stack([
            np.log1p(self.bytes), np.log1p(np.maximum(stated, 0)), share(2), share(3), share(6), share(5),
            _segments(raw == ord("|"), self.bytes) / length, self.words / length,
            _segments(again, self.words) / np.maximum(self.words, 1),
        ], axis=1)
        hot = np.zeros((n, _LANGS + _SOURCES + 1))
        hot[np.arange(n), [xxhash.xxh32_intdigest(str(v)) % _LANGS for v in langs]] = 1
        hot[np.arange(n), [_LANGS + xxhash.xxh32_intdigest(str(v)) % _SOURCES for v in sources]] = 1
        hot[:, -1] = 1
        self.shapes, self.hot = shapes, hot

    def counts(self, chosen: np.ndarray) -> np.ndarray:
        """How often each feature occurs in the chosen texts."""
        letters = self.run_features[np.repeat(chosen, self.bytes)]
        return np.bincount(letters, minlength=_D) + np.bincount(
            self.word_features[np.repeat(chosen, self.words)], minlength=_D
        )

    def content_score(self, weights: np.ndarray) -> np.ndarray:
        """Mean log odds of the features, letter runs and words apart; 0 without any."""
        return np.stack([
            _segments(weights[self.run_features], self.bytes) / np.maximum(self.bytes, 1),
            _segments(weights[self.word_features], self.words) / np.maximum(self.words, 1),
        ], axis=1)


def design(shapes: np.ndarray, hot: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((shapes - centre) / scale, -8, 8)
    return np.hstack([z, z * z, hot])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def newton_step(w: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, ridge: float) -> np.ndarray:
    return w - np.linalg.solve(hessian + ridge * np.eye(len(w)), gradient + ridge * w)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        w = newton_step(w, x.T @ (p - y), (x * (p * (1 - p))[:, None]).T @ x, ridge)
    return w


def log_odds(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Naive Bayes weights, letter runs and words each with their own totals."""
    half = _D // 2
    out = np.zeros(_D)
    for part in (slice(0, half), slice(half, _D)):
        g, b = good[part] + 0.5, bad[part] + 0.5
        out[part] = np.log(g / g.sum()) - np.log(b / b.sum())
    return out.astype(np.float32)


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def view_logits(piece: Piece, m: Models) -> tuple[np.ndarray, np.ndarray]:
    content = _with_one(piece.content_score(m.content)) @ m.content_scale
    metadata = design(piece.shapes, piece.hot, m.centre, m.scale) @ m.metadata
    return content, metadata


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, Piece]]:
    """Batches have the columns text, lang, source, length first."""
    sizes = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False) + 64
    part = np.cumsum(sizes) // PIECE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for s, e in zip(cuts[:-1], cuts[1:]):
        if e > s:
            rows = batch.slice(s, e - s)
            text, lang, source, length = (rows.column(k).to_pylist() for k in range(4))
            yield s, rows, Piece([t or "" for t in text], lang, source, length)


def _chosen(docs: DataFrame, text: str, lang: str, source: str, length: str, *more) -> DataFrame:
    return docs.select(
        F.col(text).cast("string"), F.col(lang).cast("string"), F.col(source).cast("string"),
        F.col(length).cast("double"), *more,
    )


_PARTIAL = "kind int, at int, value double"


def _partial(kind: int, values: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(values)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(values[at].astype(np.float64)),
    ], names=["kind", "at", "value"])


def _gathered(partials: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """Sums over all tasks: a fixed number of values for each kind."""
    rows = partials.groupBy("kind", "at").agg(F.sum("value").alias("value")).toArrow()
    kind, at, value = (rows.column(c).to_numpy() for c in range(3))
    out = {}
    for k, size in sizes.items():
        out[k] = np.zeros(size)
        out[k][at[kind == k]] = value[kind == k]
    return out


def _start(labelled: DataFrame) -> tuple[dict[int, np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature counts of the teaching half by class; shapes, hot columns, labels and who teaches of the whole sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, _D))
        for batch in batches:
            for _, rows, piece in _pieces(batch):
                y, teach = rows.column(4).to_numpy(), rows.column(5).to_numpy(zero_copy_only=False)
                for k in (0, 1):
                    held[k] += piece.counts((y == k) & teach)
        yield from (_partial(k, held[k]) for k in (0, 1))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, piece in _pieces(batch):
                both = np.hstack([piece.shapes, piece.hot])
                offsets = np.arange(len(both) + 1, dtype=np.int32) * both.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(offsets), pa.array(both.ravel())), rows.column(4), rows.column(5)],
                    names=["x", "y", "teaches"],
                )

    counts = _gathered(labelled.mapInArrow(count, _PARTIAL), {0: _D, 1: _D})
    rows = labelled.mapInArrow(measure, "x array<double>, y double, teaches boolean").toArrow()
    y = rows.column("y").to_numpy()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(len(y), _SHAPES + _LANGS + _SOURCES + 1)
    teaches = rows.column("teaches").to_numpy().astype(bool)
    return counts, x[:, :_SHAPES], x[:, _SHAPES:], y, teaches


def _calibrated(labelled: DataFrame, m: Models) -> None:
    """Scale the content view and combine both on the half of the sample that did not teach."""
    shared = labelled.sparkSession.sparkContext.broadcast(m)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, piece in _pieces(batch):
                held = ~rows.column(5).to_numpy(zero_copy_only=False)
                raw = piece.content_score(shared.value.content)[held]
                metadata = view_logits(piece, shared.value)[1][held]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (raw[:, 0], raw[:, 1], metadata, rows.column(4).to_numpy()[held])],
                    names=["runs", "words", "metadata", "y"],
                )

    rows = labelled.mapInArrow(score, "runs double, words double, metadata double, y double").toArrow()
    runs, words, metadata, y = (rows.column(c).to_numpy() for c in range(4))
    x = _with_one(np.stack([runs, words], axis=1))
    m.content_scale = logistic(x, y, ridge=1e-3)
    m.combined = logistic(_with_one(np.stack([x @ m.content_scale, metadata], axis=1)), y, ridge=1e-2)


def _round(docs: DataFrame, m: Models) -> None:
    """One exchange over all documents: both views score, and each learns what the other is sure of.

    Known labels stand; documents of which the teacher is not sure teach
    nothing. Two passes: one counts features under the metadata view's labels
    and sums the metadata view's Newton step under the content view's; the step
    is taken as it is, from the weights that hold so far.
    """
    shared = docs.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        held = np.zeros((2, _D))
        gradient, hessian = np.zeros(WIDTH), np.zeros((WIDTH, WIDTH))
        for batch in batches:
            for _, rows, piece in _pieces(batch):
                known = rows.column(4).to_numpy(zero_copy_only=False).astype(np.float64)
                some = piece.words > 0
                content, metadata = (sigmoid(z) for z in view_logits(piece, models))
                taught = np.where(np.isnan(known), _sure(metadata), known)
                for k in (0, 1):
                    held[k] += piece.counts((taught == k) & some)
                y = np.where(np.isnan(known), _sure(content), known)
                use = ~np.isnan(y) & some
                x = design(piece.shapes[use], piece.hot[use], models.centre, models.scale)
                p = metadata[use]
                gradient += x.T @ (p - y[use])
                hessian += (x * (p * (1 - p))[:, None]).T @ x
        yield from (_partial(k, v) for k, v in enumerate((held[0], held[1], gradient, hessian.ravel())))

    summed = _gathered(docs.mapInArrow(run, _PARTIAL), {0: _D, 1: _D, 2: WIDTH, 3: WIDTH * WIDTH})
    if summed[0].any() and summed[1].any():
        m.content = log_odds(summed[1], summed[0])
    step = newton_step(m.metadata, summed[2], summed[3].reshape(WIDTH, WIDTH), ridge=1.0)
    # A step that leaves the region where it was measured is shortened.
    change = step - m.metadata
    m.metadata = m.metadata + change * min(1.0, 5.0 / max(np.abs(change).max(), 1e-9))


def _sure(p: np.ndarray) -> np.ndarray:
    return np.where(p >= SURE, 1.0, np.where(p <= 1 - SURE, 0.0, np.nan))


def label_sample(labels: DataFrame, key: str, label: str, bound: int = LABELLED) -> DataFrame:
    """(key, y, teaches) of at most ``bound`` labelled keys, those of least hash; the share of ones decides repeats."""
    named = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_label_key")).agg(
        F.when(F.avg(F.col(label)) >= 0.5, 1.0).otherwise(0.0).alias("_y")
    )
    hashed = named.withColumn("_h", F.xxhash64("_label_key"))
    return hashed.orderBy("_h").limit(bound).withColumn("_teaches", F.pmod("_h", F.lit(2)) == 0).drop("_h")


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    source: str = "source", length: str = "n_chars", label: str = "quality", rounds: int = ROUNDS,
) -> Models | None:
    """Both views after all rounds; None when the labels do not show both classes."""
    sample, _ = stages.stage_at(label_sample(labels, key, label), "label-sample")
    small = F.broadcast(sample)  # at most LABELLED rows
    columns = (text, lang, source, length)
    given = docs.join(small, F.col(key) == F.col("_label_key")).select(
        *[F.col(c).cast("double" if c == length else "string").alias(n)
          for c, n in zip(columns, ("text", "lang", "source", "length"))], "_label_key", "_y", "_teaches",
    )
    # One row of a key, that of the least text digest: the sample stays bounded where keys repeat.
    order = F.struct(F.md5("text").alias("digest"), "source", "lang", "length", "text")
    one = given.groupBy("_label_key", "_y", "_teaches").agg(F.min(order).alias("one"))
    labelled, labelled_path = stages.stage_at(
        one.select(*[F.col(f"one.{n}").alias(n) for n in ("text", "lang", "source", "length")], "_y", "_teaches"), "labelled"
    )
    counts, shapes, hot, y, teaches = _start(labelled)
    if not (0 < y.sum() < len(y)) or not counts[0].any() or not counts[1].any():
        stages.discard(docs.sparkSession, labelled_path)
        return None
    centre, scale = shapes.mean(axis=0), shapes.std(axis=0) + 1e-6
    m = Models(
        log_odds(counts[1], counts[0]), np.zeros(3), centre, scale,
        logistic(design(shapes[teaches], hot[teaches], centre, scale), y[teaches]), np.zeros(3), float(y.mean()),
    )
    _calibrated(labelled, m)
    # The half that calibrates teaches neither view in any round.
    all_docs = _chosen(
        docs.join(small, F.col(key) == F.col("_label_key"), "left").where(F.coalesce("_teaches", F.lit(True))),
        *columns, F.col("_y"),
    )
    for _ in range(rounds):
        _round(all_docs, m)
        _calibrated(labelled, m)
    stages.discard(docs.sparkSession, labelled_path)
    return m


def score(
    docs: DataFrame, m: Models | None, text: str = "text", lang: str = "lang", source: str = "source",
    length: str = "n_chars",
) -> DataFrame:
    """Add ``p_content``, ``p_metadata`` and ``p_quality`` to every document, in one pass without a shuffle.

    A NULL text and one without words get the share of good labels from every
    view; NULL language, source and length are values of their own. Without
    models (no labels of both classes) every probability is 1: nothing is known
    against a document. Columns of those names are replaced.
    """
    names = ["p_content", "p_metadata", "p_quality"]
    kept = docs.drop(*names)
    if m is None:
        return kept.withColumns({n: F.lit(1.0) for n in names})
    shared = docs.sparkSession.sparkContext.broadcast(m)
    front = [F.col(text).cast("string").alias("_0"), F.col(lang).cast("string").alias("_1"),
             F.col(source).cast("string").alias("_2"), F.col(length).cast("double").alias("_3")]
    columns_out = [*kept.columns, *names]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), *(f"{n} double" for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            for _, rows, piece in _pieces(batch):
                content, metadata = view_logits(piece, models)
                both = _with_one(np.stack([content, metadata], axis=1)) @ models.combined
                some = piece.words > 0
                out = [np.where(some, sigmoid(z), models.prior) for z in (content, metadata, both)]
                columns = rows.columns[4:] + [pa.array(p) for p in out]
                yield pa.RecordBatch.from_arrays(columns, names=columns_out)

    return kept.select(*front, *kept.columns).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, least: float = 0.5, **columns: str) -> DataFrame:
    """Fit on ``labels`` and all ``docs``, then add the probabilities and ``keep``: p_quality >= ``least``.

    An empty table gives an empty table.
    """
    scored = score(docs, fit(docs, labels, **columns), **{k: v for k, v in columns.items() if k not in ("key", "label", "rounds")})
    return scored.withColumn("keep", F.col("p_quality") >= least)

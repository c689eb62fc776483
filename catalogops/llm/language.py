"""Language of whole texts by interpolated Kneser-Ney character models, one per language.

Each language has a model of the letters of its words, of order five, in sorted
arrays of 64-bit hashes: seen n-grams with their interpolated log probability,
contexts with the log weight of what they leave to the shorter context. A text
goes to the language with the least cross-entropy per symbol. How sure that is,
is calibrated on blocks that no model has counted: every block is judged with
its own language and once more without it, as if nobody had learned that
language, and a logistic regression tells both cases apart.

Words are runs of letters, in lower case; each is a sequence of its own between
a start and an end, so distinct words are scored once per task. Counting runs on
Spark over a bounded sample; all texts are scored in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..sources import stages
from .pieces import Numbering, free, pieces, sums

#: Characters of an n-gram.
ORDER = 5
#: Fitting sample in code points: of each language, and of all together.
SAMPLE_CHARS = 1_000_000
SAMPLE_ALL = 4_000_000
#: Code points of a block, the unit of the sample; one in HELD of the sampled blocks calibrates.
BLOCK = 500
HELD = 5
#: More learned languages than this are an error: labels are a small set of names.
LANGUAGES = 1_000
#: What belongs to no learned language: texts without a letter.
UNDETERMINED = "und"

#: Words a task remembers, and their characters, before it starts afresh.
WORDS = 300_000
WORD_CHARS = 16_000_000
#: Characters of a text taken at a time.
STRETCH = 1_000_000

_START, _END = "<", ">"  # never letters
_LETTERS = re.compile(r"[^\W\d_]+")
_NO_LETTER = re.compile(r"[\W\d_]")


def words(text: str) -> Iterator[list[str]]:
    """The words of the whole text, in lists; runs of letters in lower case."""
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > STRETCH and (border := _NO_LETTER.search(text, start + STRETCH)):
            end = border.start()
        # Number signs that are no digits (such as ½) pass for word characters, but are no letters.
        found = _LETTERS.findall(text[start:end].lower())
        yield found if all(map(str.isalpha, found)) else [w for f in found for w in "".join(c if c.isalpha() else " " for c in f).split()]
        start = end


def _hashed(codes: np.ndarray) -> np.ndarray:
    """One hash for each row of code points; rows of different width do not meet."""
    with np.errstate(over="ignore"):
        h = np.full(len(codes), 0x9E3779B97F4A7C15 + codes.shape[1], np.uint64)
        for k in range(codes.shape[1]):
            h = (h ^ codes[:, k].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class SortedTable:
    """Hashes in ascending order, each with a number."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order].astype(np.float32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which are there, their values)."""
        if not len(self.hashes):
            return np.zeros(len(hashes), bool), np.zeros(0)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        there = self.hashes[at] == hashes
        return there, self.values[at[there]].astype(np.float64)


class Model:
    """Interpolated Kneser-Ney model of one language: for each order n-grams and contexts as sorted tables, logarithms to base 2."""

    def __init__(self, grams: dict[int, tuple[np.ndarray, np.ndarray]], symbols: int):
        """``grams``: by order, code points (a row each) and how often each occurs; ``symbols``: size of the alphabet of all languages."""
        self.order = max(grams)
        self.floor = -np.log2(symbols)
        self.grams: dict[int, SortedTable] = {}
        self.contexts: dict[int, SortedTable] = {}
        for n in range(1, self.order + 1):
            codes, raw = grams[n]
            counts = raw.astype(np.float64)
            if n < self.order:
                # Shorter n-grams count how many symbols they follow, save those at the start of a word, which follow none.
                ends, n_before = np.unique(_hashed(grams[n + 1][0][:, 1:]), return_counts=True)
                inner = codes[:, 0] != ord(_START)
                at = np.minimum(np.searchsorted(ends, _hashed(codes[inner])), max(len(ends) - 1, 0))
                counts[inner] = n_before[at] if len(ends) else counts[inner]
            if n == 1:
                codes, counts = codes[codes[:, 0] != ord(_START)], counts[codes[:, 0] != ord(_START)]
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.95))
            contexts, of = np.unique(_hashed(codes[:, :-1]), return_inverse=True)
            total = np.bincount(of, counts, len(contexts))
            left = discount * np.bincount(of, minlength=len(contexts)) / total
            lower = self.score(codes[:, 1:]) if n > 1 else np.full(len(codes), self.floor)
            p = np.maximum(counts - discount, 0) / total[of] + left[of] * np.exp2(lower)
            self.grams[n] = SortedTable(_hashed(codes), np.log2(p))
            self.contexts[n] = SortedTable(contexts, np.log2(left))

    def score(self, codes: np.ndarray) -> np.ndarray:
        """log2 P(last symbol | those before it) of n-grams of one length; unseen ones fall back to the shorter context."""
        out = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        for n in range(codes.shape[1], 0, -1):
            rows = codes[open_][:, codes.shape[1] - n:]
            there, value = self.grams[n].find(_hashed(rows))
            out[open_[there]] += value
            open_, rows = open_[~there], rows[~there]
            if not len(open_):
                return out
            there, value = self.contexts[n].find(_hashed(rows[:, :-1]))
            out[open_[there]] += value
        out[open_] += self.floor
        return out


@dataclass
class Models:
    """The models in order of language, and the weights of the calibration (None: only one language)."""

    languages: list[str]
    models: list[Model]
    usual: np.ndarray
    weights: np.ndarray | None = None

    def score_words(self, found: list[str]) -> np.ndarray:
        """Bits of each word (with its end) in every model, and its number of symbols as last column."""
        order = self.models[0].order
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = _codes("".join(f"{_START}{w}{_END}" for w in found))
        word_ends = np.cumsum(lengths + 2)
        word_starts = word_ends - lengths - 2
        place = np.arange(len(flat)) - np.repeat(word_starts, lengths + 2)
        bits = np.zeros((len(flat), len(self.models)))
        # In a word the context grows until the n-gram is full; equal n-grams are looked up once.
        for n in range(2, order + 1):
            at = np.flatnonzero(place >= n - 1 if n == order else place == n - 1)
            if len(at):
                rows = flat[at[:, None] + np.arange(1 - n, 1)]
                _, first, back = np.unique(_hashed(rows), return_index=True, return_inverse=True)
                distinct = rows[first]
                bits[at] = np.stack([-m.score(distinct) for m in self.models], axis=1)[back]
        return np.hstack([sums(bits, lengths + 2), (lengths + 1)[:, None]])


def _features(entropy: np.ndarray, symbols: np.ndarray, usual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language of least cross-entropy, features of how sure that is): margin and excess per symbol, and with the length."""
    best = np.argmin(entropy, axis=1)
    rows = np.arange(len(best))
    least = entropy[rows, best]
    others = entropy.copy()
    others[rows, best] = np.inf
    second = others.min(axis=1)
    margin = np.clip(np.where(np.isfinite(second), second - least, 0.0), 0, 5)
    excess = np.clip(least - usual[best], -5, 5)
    length = np.log2(symbols + 1) / 8
    return best, np.stack([np.ones(len(best)), margin, excess, length, margin * length, excess * length], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
    return w


def _blocks(text: str) -> Iterator[str]:
    """Blocks of about BLOCK code points, cut between words where one ends soon."""
    start = 0
    while start < len(text):
        end = start + BLOCK
        border = text.find(" ", end, end + BLOCK // 5)
        end = border if border >= 0 else end
        yield text[start:end]
        start = end


def sample(labelled: DataFrame) -> DataFrame:
    """(_lang, _block, _holds): distinct blocks of the labelled texts, those of least hash; ``_holds`` are for calibration.

    The share that is taken of a language follows from its code points, so that
    about SAMPLE_CHARS of each are taken, and SAMPLE_ALL of all at most.
    """
    sizes = labelled.groupBy("_lang").agg(F.sum(F.char_length("_text")).alias("chars")).where("chars > 0")
    rows = sizes.limit(LANGUAGES + 1).collect()
    if len(rows) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    most = min(SAMPLE_CHARS, SAMPLE_ALL / max(len(rows), 1))
    reach = {r["_lang"]: int(min(1.0, most / r["chars"]) * 2**64) for r in rows}
    spark = labelled.sparkSession
    shared = spark.sparkContext.broadcast(reach)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "_text"):
                langs, taken, holds = [], [], []
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for block in _blocks(text):
                        h = xxhash.xxh64_intdigest(block.encode())
                        if h < shared.value.get(lang, 0):
                            langs.append(lang)
                            taken.append(block)
                            holds.append(xxhash.xxh64_intdigest(block.encode(), 1) % HELD == 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(taken, pa.string()), pa.array(holds, pa.bool_())],
                    names=["_lang", "_block", "_holds"],
                )

    return labelled.select("_text", "_lang").mapInArrow(run, "_lang string, _block string, _holds boolean").distinct()


def gram_counts(blocks: DataFrame) -> DataFrame:
    """(_lang, _gram, _n): how often the n-grams of up to ORDER symbols occur in the words of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, found = [], []
            for block, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = [f"{_START}{w}{_END}" for part in words(block) for w in part]
                found += own
                langs += [lang] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.string())], names=["_lang", "_word"])

    each = blocks.select("_block", "_lang").mapInArrow(run, "_lang string, _word string")
    counted = each.groupBy("_lang", "_word").agg(F.count(F.lit(1)).alias("_n"))
    word = F.col("_word")

    def of_length(n: int) -> Column:
        starts = F.when(F.char_length(word) >= n, F.sequence(F.lit(1), F.char_length(word) - n + 1))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.substring(word, i, F.lit(n)))

    grams = F.flatten(F.array(*[of_length(n) for n in range(1, ORDER + 1)]))
    return counted.select("_lang", "_n", F.explode(grams).alias("_gram")).groupBy("_lang", "_gram").agg(F.sum("_n").alias("_n"))


def _build(counts: pa.Table) -> Models | None:
    """Models of all languages from the counts of a bounded sample."""
    lang, gram, n = (counts.column(c).combine_chunks() for c in ("_lang", "_gram", "_n"))
    languages = sorted(pc.unique(lang).to_pylist())
    if not languages:
        return None
    lengths = pc.utf8_length(gram).to_numpy(zero_copy_only=False)
    by, n = lang.to_numpy(zero_copy_only=False), n.to_numpy(zero_copy_only=False)
    symbols = len(set(pc.unique(gram.filter(pa.array(lengths == 1))).to_pylist()))
    models = []
    for name in languages:
        own, grams = by == name, {}
        for k in range(1, ORDER + 1):
            chosen = own & (lengths == k)
            grams[k] = (_codes("".join(gram.filter(pa.array(chosen)).to_pylist())).reshape(-1, k), n[chosen])
        models.append(Model(grams, symbols + 1))
    return Models(languages, models, np.zeros(len(models)))


def _measured(found: DataFrame, models: Models) -> pa.Table:
    """Of each calibration block: its language, bits in every model and symbols; cut to lengths from 1 word on."""
    shared = found.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, bits = [], []
            for block, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = [w for part in words(block) for w in part][: 1 << xxhash.xxh64_intdigest(block.encode(), 2) % 8]
                if own and lang in shared.value.languages:
                    langs.append(lang)
                    bits.append(shared.value.score_words(own).sum(axis=0).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(bits, pa.list_(pa.float64()))], names=["lang", "bits"])

    return found.select("_block", "_lang").mapInArrow(run, "lang string, bits array<double>").orderBy("lang", "bits").toArrow()


def calibrate(models: Models, measured: pa.Table) -> None:
    """Set the usual cross-entropy of every language, and the weights that tell learned languages from others."""
    if not measured.num_rows:
        return
    bits = np.array(measured.column("bits").to_pylist())
    true = np.array([models.languages.index(v) for v in measured.column("lang").to_pylist()])
    entropy, symbols = bits[:, :-1] / bits[:, -1:], bits[:, -1]
    rows = np.arange(len(true))
    # By symbols, so that blocks of a word or two do not blur what is usual.
    weight = np.bincount(true, symbols, len(models.languages))
    bits_of = np.bincount(true, entropy[rows, true] * symbols, len(models.languages))
    # A language without a block to calibrate on gets what is usual in all.
    models.usual = np.where(weight > 0, bits_of / np.maximum(weight, 1), bits_of.sum() / max(weight.sum(), 1))
    if len(models.languages) < 3:
        # Without its own language a block would have no second one to compare with.
        return
    best, known = _features(entropy, symbols, models.usual)
    without = entropy.copy()
    without[rows, true] = np.inf
    _, unknown = _features(without, symbols, models.usual)
    models.weights = _logistic(np.vstack([known, unknown]), np.concatenate([(best == true).astype(float), np.zeros(len(true))]))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Models | None:
    """Models of every language that labels a text with letters; None where there is none.

    Learns from a bounded sample (``sample``); rows with a NULL text or language teach nothing.
    """
    labelled = docs.select(F.col(text).cast("string").alias("_text"), F.col(lang).cast("string").alias("_lang")).where(
        F.col("_text").isNotNull() & F.col("_lang").isNotNull()
    )
    taken, path = stages.stage_at(sample(labelled), "language-sample")
    models = _build(gram_counts(taken.where("NOT _holds")).toArrow())
    if models:
        calibrate(models, _measured(taken.where("_holds"), models))
    stages.discard(docs.sparkSession, path)
    return models


class Scorer:
    """Bits of whole texts in every model; remembers the words it has seen."""

    def __init__(self, models: Models):
        self.models = models
        self.forget()

    def forget(self) -> None:
        self.index, self.chars = Numbering(), 0
        self.bits = np.zeros((0, len(self.models.languages) + 1))

    def score(self, texts: Iterable[str]) -> np.ndarray:
        """Of each text: bits in every model, and symbols; zeros without a word."""
        totals, waiting, size = [], [], 0
        for k, text in enumerate(texts):
            totals.append(np.zeros(self.bits.shape[1]))
            for part in words(text):
                waiting.append((k, part))
                size += len(part)
                if size > STRETCH // 4:
                    self._add(waiting, totals)
                    waiting, size = [], 0
        self._add(waiting, totals)
        return np.array(totals).reshape(-1, self.bits.shape[1])

    def _add(self, waiting: list[tuple[int, list[str]]], totals: list[np.ndarray]) -> None:
        if len(self.index) > WORDS or self.chars > WORD_CHARS:
            self.forget()
        numbers = [(k, np.array(self.index.numbers(part), np.int64)) for k, part in waiting]
        if self.index.fresh:
            self.bits = np.concatenate([self.bits, self.models.score_words(self.index.fresh)])
            self.chars += sum(map(len, self.index.fresh))
            self.index.fresh = []
        for k, own in numbers:
            totals[k] = totals[k] + self.bits[own].sum(axis=0)

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Of each text: language, calibrated score, cross-entropy per symbol (NaN without a word)."""
        bits = self.score(texts)
        symbols = bits[:, -1]
        some = symbols > 0
        entropy = bits[:, :-1] / np.maximum(symbols, 1)[:, None]
        best, x = _features(entropy, symbols, self.models.usual)
        w = self.models.weights
        score = np.ones(len(best)) if w is None else 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        named = [self.models.languages[b] if s else UNDETERMINED for b, s in zip(best, some)]
        return named, np.where(some, score, 0.0), np.where(some, entropy[np.arange(len(best)), best], np.nan)


_NAMES = ["lang_pred", "score", "cross_entropy", "accepted"]


def predict(docs: DataFrame, models: Models | None, text: str = "text", least: float = 0.5) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1), ``cross_entropy`` (bits per symbol) and ``accepted``: score >= ``least``.

    The language of least cross-entropy, ties to the first by name. ``score`` is the calibrated
    probability that the text is in it, and that it is a learned one at all; with one or two languages
    nothing can be calibrated and it is 1. A NULL text and one without a letter are ``und`` with score 0
    and no cross-entropy; so are all texts where nothing was learned (``models`` is None). Whole texts of
    any length. Rows keep their number; columns of the four names are replaced. An empty table stays empty.
    """
    kept = docs.drop(*_NAMES)
    if models is None:
        return kept.withColumns({
            "lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0), "cross_entropy": F.lit(None).cast("double"), "accepted": F.lit(False),
        })
    shared = docs.sparkSession.sparkContext.broadcast(models)
    own = free("_text", kept.columns)
    names = [*kept.columns, *_NAMES]
    schema = ", ".join([
        *(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema),
        "lang_pred string", "score double", "cross_entropy double", "accepted boolean",
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for rows in pieces(batch, own):
                named, score, entropy = scorer.judge([t or "" for t in rows.column(0).to_pylist()])
                out = [
                    pa.array(named, pa.string()), pa.array(score), pa.array(entropy, mask=np.isnan(entropy)), pa.array(score >= least),
                ]
                yield pa.RecordBatch.from_arrays([*rows.columns[1:], *out], names=names)

    return kept.select(docs[text].cast("string").alias(own), *kept.columns).mapInArrow(run, schema)

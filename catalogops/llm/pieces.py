"""Arrow batches cut into pieces of bounded text, and ragged arrays out of them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time inside a task; a longer text goes alone.
PIECE_BYTES = 1_000_000


def pieces(batch: pa.RecordBatch, text: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut where its texts reach about ``most`` bytes."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False) + 64
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for start, end in zip(cuts[:-1], cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the runs (start, length), one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs along the first axis; empty runs give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


class Numbering(dict):
    """Word -> number in order of first sight; new words also go to ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number

    def numbers(self, words: Iterable[str]) -> list[int]:
        return list(map(self.__getitem__, words))


def free(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores behind it until no column in ``taken`` has it (case aside, as Spark compares)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name

"""Small helpers that the training-data operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, read_table, scratch_block

# Fixed value: the white space that separates words in the query contracts (space, tab to
# carriage return); Python's ``bytes.split()`` uses the same six bytes.
WORD_SPACE = r"[\x20\x09-\x0D]+"

__all__ = ["WORD_SPACE", "WordHashes", "fold", "in_slices", "in_tasks", "materialize", "mix64", "per_worker", "pick", "read_table", "scratch_block"]


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so that a task's working memory is a slice's."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def in_tasks(df: DataFrame, rows: int, each: int) -> DataFrame:
    """``df`` of about ``rows`` rows in tasks of ``each``, but no fewer than the cluster runs at once; never in more than before.

    For what is written: a file costs a task more than thousands of narrow rows, and every shuffle
    partition writes one unless AQE joins it with others.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads, so that a caller's further columns never clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a one-to-one map)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


_held: dict[tuple, Any] = {}


def per_worker(key: tuple, build: Callable[[], Any]) -> Any:
    """What ``build`` makes, kept by the worker process while its tasks ask for the same key.

    Workers outlive their tasks and run other operators' ones next, so they hold one such object
    only: that of another key goes first.
    """
    if key not in _held:
        _held.clear()
        gc.collect()  # an encoder and its memo refer to each other
        _held[key] = build()
    return _held[key]


class WordHashes:
    """64-bit hashes of a text's words, ASCII letters lowered, by array operations.

    A word's hash is the polynomial of its bytes at a fixed odd base, taken as a difference
    of prefix sums, and mixed. Words are separated by ASCII white space.
    """

    BASE = 0x9E3779B97F4A7C15
    SLICE = 1 << 20  # bytes handled at once; a longer word is taken whole

    def __init__(self):
        # 0 for white space, else the lowered byte plus one
        codes = np.arange(1, 257, dtype=np.uint64)
        codes[65:91] += np.uint64(32)
        codes[[32, *range(9, 14)]] = 0
        self.codes = codes
        self._grow(1 << 14)

    def _grow(self, n: int) -> None:
        self.power = np.full(n, self.BASE, np.uint64)
        self.inverse = np.full(n, pow(self.BASE, -1, 1 << 64), np.uint64)
        for x in (self.power, self.inverse):
            x[0] = 1
            np.multiply.accumulate(x, out=x)

    def _slices(self, data: bytes) -> Iterator[bytes]:
        at = 0
        while len(data) - at > self.SLICE:
            cut = max(data.rfind(c, at, at + self.SLICE) for c in (b" ", b"\n"))
            if cut <= at:
                found = [i for i in (data.find(c, at + self.SLICE) for c in (b" ", b"\n")) if i >= 0]
                cut = min(found, default=len(data))
            yield data[at:cut]
            at = cut
        yield data[at:]

    def _hash(self, data: bytes) -> np.ndarray:
        code = self.codes[np.frombuffer(data, np.uint8)]
        if len(code) > len(self.power):
            self._grow(2 * len(code))
        inside = np.zeros(len(code) + 2, np.int8)
        inside[1:-1] = code > 0
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edge[::2], edge[1::2]
        sums = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(code * self.power[:len(code)], out=sums[1:])
        return mix64((sums[ends] - sums[starts]) * self.inverse[:len(code) + 1][starts])

    def __call__(self, text: str | None) -> np.ndarray:
        data = (text or "").encode()
        if not data:
            return np.empty(0, np.uint64)
        parts = [self._hash(x) for x in self._slices(data)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

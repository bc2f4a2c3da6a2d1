"""What the operators of this package share: Arrow batches as byte buffers, words, rolling hashes, scratch tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.session import scratch_root

# A task looks at about this many bytes of text at a time, in no more rows than that, or at one text where it is longer.
SLICE_BYTES = 1 << 19
SLICE_ROWS = 1024

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that all executors share (``spark.checkpoint.dir``), its lineage cut there."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def give_back() -> None:
    """Return freed memory to the system: Python workers are kept, and stages to come need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not glibc


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, giving memory back when a task ends."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def text_slices(batch: pa.RecordBatch, name: str, size: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with the UTF-8 bytes of a column and the bounds of its rows. A null is an empty text."""
    column = pc.fill_null(batch.column(batch.schema.get_field_index(name)), "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1)
        last = min(last, first + rows, len(column))
        yield batch.slice(first, last - first), whole[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def words(data: np.ndarray, bounds: np.ndarray, blank: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``, and for each row its first word's number (one more at the end).

    A word is a longest run of bytes that are not blank; it does not reach over a row's bounds.
    """
    letter = ~blank[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = letter
    edges = bounds[bounds < len(data)]
    begins = letter & ~before[:-1]
    begins[edges] = letter[edges]
    starts = np.flatnonzero(begins)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = letter[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(letter & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


class Rolling:
    """Rabin-Karp hashes modulo 2^64 of byte spans and of windows over a sequence of hashes."""

    def __init__(self, seed: int) -> None:
        random = np.random.default_rng(seed)
        self.table = random.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
        self.base = int(random.integers(0, 1 << 61)) * 8 + 5
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.up) <= n:
            n = n + 1 + n // 8
            inverse = pow(self.base, -1, 1 << 64)
            for name, factor in (("up", self.base), ("down", inverse)):
                powers = np.full(n, factor, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def _between(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._reach(len(values))
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.down[starts])

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._between(self.table[data], starts, ends)

    def windows(self, hashes: np.ndarray, width: int) -> np.ndarray:
        """The hash of ``hashes[i : i + width]`` for each i with a whole window."""
        n = max(0, len(hashes) - width + 1)
        starts = np.arange(n)
        return self._between(hashes, starts, starts + width)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def numbers_in(counts: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n of ``counts``, one after another."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)

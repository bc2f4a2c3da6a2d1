"""Importance resampling of documents towards a target corpus, on hashed n-grams.

The n-grams of a slice of text are interned in an open-addressed table of numpy arrays: keys are XXH64 hashes, equal keys
are told apart by their bytes. A slot stores its n-gram's bucket and its count; the number of its slot stands for each
occurrence. Counts by bucket of the source and the target, added up by Spark, give each bucket a gain; documents gather
the gains of their slots. Scores with Gumbel noise are ranked over range partitions, and the highest are drawn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.places import placed
from tidemark.llm.shared import lean, settled, text_slices, words

BUCKETS = 10_000
REACH = 2
SHARE = 25
MIN_WORDS = 20
SEED = 7

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.ones(256, dtype=bool)
_BLANK[np.r_[0x30:0x3A, 0x41:0x5B, 0x61:0x7B, 0x80:0x100]] = False

# The primes of XXH64, and the polynomial of CRC-32 (reversed).
_PRIMES = [np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)]
_POLYNOMIAL = 0xEDB88320

_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_STRIPE = 32


class Spans:
    """Byte ranges of a buffer, read eight bytes at a time."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
        self.data = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        self.start, self.length = start, length
        self.eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=self.data, strides=(1,))

    def lane(self, which: np.ndarray, k: int) -> np.ndarray:
        """The ``k``-th eight bytes of some ranges that are longer than 8 x ``k``, zeros beyond their ends."""
        left = np.minimum(self.length[which] - 8 * k, 8)
        return self.eight[self.start[which] + 8 * k] & _LOW_BYTES[left]

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the ranges ``a`` have the bytes of the ranges ``b``."""
        same = self.length[a] == self.length[b]
        at, k = np.flatnonzero(same), 0
        while len(at):
            differ = self.lane(a[at], k) != self.lane(b[at], k)
            same[at[differ]] = False
            k += 1
            at = at[~differ & (self.length[a[at]] > 8 * k)]
        return same

    def xxh64(self, seed: int = 0) -> np.ndarray:
        """XXH64 of each range: those under a stripe of 32 bytes together, longer ones by the library."""
        p1, p2, p3, p4, p5 = _PRIMES
        h = np.uint64(seed) + p5 + self.length.astype(np.uint64)
        short = np.flatnonzero(self.length < _STRIPE)
        for k in range(_STRIPE // 8 - 1):
            at = short[self.length[short] >= 8 * (k + 1)]
            h[at] = _turned(h[at] ^ (_turned(self.lane(at, k) * p2, 31) * p1), 27) * p1 + p4
        rest = self.length & 7
        place = self.start + (self.length & ~7)
        at = short[rest[short] >= 4]
        h[at] = _turned(h[at] ^ ((self.eight[place[at]] & _LOW_BYTES[4]) * p1), 23) * p2 + p3
        place, rest = place + (rest & 4), rest & 3
        for k in range(3):
            at = short[rest[short] > k]
            h[at] = _turned(h[at] ^ (self.data[place[at] + k].astype(np.uint64) * p5), 11) * p1
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(self.length >= _STRIPE):
            h[i] = xxhash.xxh64_intdigest(self.data[self.start[i] : self.start[i] + self.length[i]].tobytes(), seed)
        return h

    def crc32(self, which: np.ndarray) -> np.ndarray:
        """The CRC-32 of some ranges, a byte of all of them at a time."""
        falling = np.argsort(-self.length[which], kind="stable")
        size, start = self.length[which[falling]], self.start[which[falling]]
        crc = np.full(len(which), 0xFFFFFFFF, dtype=np.uint32)
        longer = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
        for k, n in enumerate(longer):
            crc[:n] = _CRC[(crc[:n] ^ self.data[start[:n] + k]) & 0xFF] ^ (crc[:n] >> 8)
        out = np.empty(len(which), dtype=np.uint32)
        out[falling] = crc ^ np.uint32(0xFFFFFFFF)
        return out


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


_CRC = _crc_table()


class Interned:
    """Distinct byte ranges in an open-addressed table: ``slot`` of each occurrence, ``bucket`` and ``count`` of each slot."""

    def __init__(self, spans: Spans, buckets: int, hashes: np.ndarray | None = None) -> None:
        n = len(spans.start)
        hashes = spans.xxh64() if hashes is None else hashes
        size = 1 << max(3, (2 * n).bit_length())
        owner = np.full(size, -1, dtype=np.int64)
        place = (hashes & np.uint64(size - 1)).astype(np.int64)
        self.slot, left = np.empty(n, dtype=np.int64), np.arange(n)
        while len(left):
            at = place[left]
            free = owner[at] < 0
            owner[at[free]] = left[free]
            held = owner[at]
            same = (hashes[held] == hashes[left]) & spans.equal(held, left)
            self.slot[left[same]] = at[same]
            left = left[~same]
            place[left] = (place[left] + 1) & (size - 1)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, dtype=np.int64)
        used = np.flatnonzero(owner >= 0)
        self.bucket[used] = spans.crc32(owner[used]) % buckets


class Features:
    """The n-grams of a slice: interned, in order of their last words; and the first word of each row."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, reach: int, buckets: int) -> None:
        starts, ends, self.first = words(data, bounds, _BLANK)
        size = ends - starts
        # The words in lower case, a space after each: every run of them is a range of bytes.
        begin = np.cumsum(size + 1) - (size + 1)
        joined = np.full(int((size + 1).sum()), 0x20, dtype=np.uint8)
        letters = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        there = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        joined[there] = _LOWER[data[letters]]
        within = np.arange(len(starts)) - np.repeat(self.first[:-1], np.diff(self.first))
        self.last, start = [], []
        for n in range(1, reach + 1):
            last = np.flatnonzero(within >= n - 1)
            self.last.append(last)
            start.append(begin[last - (n - 1)])
        self.last = np.concatenate(self.last)
        start = np.concatenate(start)
        self.interned = Interned(Spans(joined, start, begin[self.last] + size[self.last] - start), buckets)

    def totals(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the number of its n-grams and the sum of their gains."""
        per_word = np.zeros((2, self.first[-1] + 1), dtype=np.int64)
        gained = gains[self.interned.bucket][self.interned.slot]
        order = np.argsort(self.last, kind="stable")
        ends = np.cumsum(np.bincount(self.last, minlength=self.first[-1]))
        sums = np.concatenate([[0], np.cumsum(gained[order])])
        per_word[0, 1:], per_word[1, 1:] = ends, sums[ends]
        return tuple(np.diff(p[self.first]) for p in per_word)


def _bucket_counts(reach: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, data, bounds in text_slices(batch, "text"):
                found = Features(data, bounds, reach, buckets).interned
                np.add.at(total, found.bucket, found.count)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, text_col: str = "text", reach: int = REACH, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of all documents each bucket has; the driver gets one number for a bucket."""
    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(lean(_bucket_counts(reach, buckets)), "bucket int, n bigint")
    out = np.zeros(buckets, dtype=np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain in thousandths: the logarithm of its share in the target against that in the source, smoothed by one."""
    s, t, n = source.astype(np.float64), target.astype(np.float64), float(len(source))
    ratio = ((t + 1) * (s.sum() + n)) / ((s + 1) * (t.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weights(gain: np.ndarray, reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in text_slices(batch, "text"):
                found = Features(data, bounds, reach, len(gain))
                n, total = found.totals(gain)
                weight = np.floor_divide(total, np.maximum(n, 1))
                columns = [rows.column(0), pa.array(np.diff(found.first)), pa.array(n), pa.array(weight)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first eight hex digits of the hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    reach: int = REACH,
    buckets: int = BUCKETS,
    share: int = SHARE,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` (null if not drawn).

    Words are runs of digits, of letters a to z after A to Z are lower-cased, and of all beyond ASCII. ``share`` percent
    (rounded down) of the documents with ``min_words`` words or more are drawn, by score, ties to the smaller id, a null
    id first; repeated rows are drawn one after another. A null or empty text has no features and a weight of 0. A null
    id has the noise of an empty one. An empty target, or no documents, is no error. Only the columns named are read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    gain = gains(bucket_counts(docs, text_col, reach, buckets), bucket_counts(target, target_col, reach, buckets))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    weighed = texts.mapInArrow(lean(_weights(gain, reach)), f"id {kind}, n_words bigint, n_features bigint, weight bigint")
    scored = settled(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)))
    enough = scored.where(F.col("n_words") >= min_words)
    ranked = placed(enough.withColumn("all", F.lit(0)), "all", [F.desc("score"), F.asc("id")], "pos", "of")
    drawn = F.col("pos") < F.floor(F.col("of") * share / 100)
    ranked = ranked.withColumn("rank", F.when(drawn, F.col("pos") + 1)).drop("all", "pos", "of")
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).withColumnRenamed("id", id_col)

"""Documents scored by the masked pseudo-likelihood of a small bidirectional network.

Words are numbered by their counts over the whole corpus: the most frequent, more of them the more distinct words there
are, have a number of their own, the others share buckets, whose probability their words share by their counts. A network with one hidden layer predicts a word from
two words on each side, in two steps: its class, then the word in it. Documents are dealt to shards by the hash of their
text, as many as the corpus asks for, and lie there in the order of hashes: how the table is cut into files or tasks
changes nothing. Every shard trains a copy, in the first turn on every second word of each document; Spark averages the
copies, weighted by what each has seen, and a second turn on all other words starts from the average. Copies of a text
teach together, weighted by their number. The summed logarithms of the probabilities of all words, each from both of its
sides, are a document's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt
from zlib import compress, decompress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.shared import Rolling, lean, numbers_in, settled, text_slices, words

_SEED = 41
OWN = 896
BUCKETS = 128
CLASSES = 32
HIDDEN = 32
REACH = (-2, -1, 1, 2)
STRIDE = 2
TURNS = 2
# Spark joins words with their counts in ranges of hashes: so many at least, and more where one would hold more words than this.
_PARTS = 1 << 8
_PART_WORDS = 1 << 19
_SIZE = OWN + BUCKETS
_PAD = _SIZE
_BATCH = 1024
_HELD = 1 << 18
# A shard for so many words; of a small corpus, shards of a million words at least, up to 64.
SHARD_WORDS = 1 << 26
LEAST_SHARD = 1 << 20
# Words that are cut into batches together, and weights that are added up together.
_TOGETHER = 1 << 16
_BLOCK = 1 << 13
# Words that are scored together: more than most slices have, so that a class has many of them.
_SCORED = 1 << 17
_FIXED = 1 << 16
# How often a neighbour comes in a batch at most, to be added up beside others.
_FEW = 8
# Steps of the hidden layer and the weights that documents are scored with, and the largest such weight: products are
# multiples of 2^-16 and sums of 32 of them stay below 2^8, so that 24 bits hold them whatever the order of adding.
_STEP = 1 << 8
_MOST = 8 - 1 / _STEP
# Steps of a word's logarithm, for sums in whole numbers.
_LOG_STEP = 1 << 24


@dataclass
class Vocabulary:
    """Hashes of the words with their own number, sorted, and those numbers; counts by number; words in each bucket.

    ``counted`` is the table (word, n) of all words, in Spark; it stays with the driver.
    """

    hashes: np.ndarray
    numbers: np.ndarray
    counts: np.ndarray
    distinct: np.ndarray
    counted: DataFrame | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"counted": None}

    @property
    def own(self) -> int:
        return len(self.counts) - BUCKETS

    @property
    def part_bits(self) -> int:
        """The bits of a hash that name the range in which it is joined with its count."""
        words = len(self.hashes) + int(self.distinct.sum())
        return (max(_PARTS, -(-words // _PART_WORDS)) - 1).bit_length()

    def spelled(self, data: np.ndarray, bounds: np.ndarray, rolling: Rolling | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the words of a slice, and the first word of each row; ``rolling`` saves a task its tables."""
        starts, ends, first = words(data, bounds)
        return (rolling or Rolling(_SEED)).spans(data, starts, ends).view(np.int64), first

    def numbered(self, h: np.ndarray) -> np.ndarray:
        """A word is looked up by the lowest bits of its hash; a search finds those own words that share them with another."""
        out = (self.own + np.mod(h, BUCKETS)).astype(np.int32)
        if len(self.hashes):
            mask = (1 << len(self.hashes).bit_length() + 4) - 1
            table, crowded, slots = np.zeros(mask + 1, dtype=np.int32), np.zeros(mask + 1, dtype=bool), self.hashes & mask
            table[slots] = np.arange(len(slots))
            crowded[slots[table[slots] != np.arange(len(slots))]] = True
            slot = h & mask
            at = np.take(table, slot)
            found = np.take(self.hashes, at) == h
            more = np.flatnonzero(np.take(crowded, slot) & ~found)
            at[more] = np.minimum(np.searchsorted(self.hashes, h[more]), len(slots) - 1)
            found[more] = self.hashes[at[more]] == h[more]
            np.copyto(out, np.take(self.numbers, at), where=found, casting="same_kind")
        return out

    def read(self, data: np.ndarray, bounds: np.ndarray, rolling: Rolling | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the words of a slice, and the first word of each row."""
        h, first = self.spelled(data, bounds, rolling)
        return self.numbered(h), first


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rolling, held, n = Rolling(_SEED), [], []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        values, place = np.unique(np.concatenate(held), return_inverse=True)
        return values, np.bincount(place, weights=np.concatenate(n), minlength=len(values)).astype(np.int64)

    def rows(values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["word", "n"])

    for batch in batches:
        for _, data, bounds in text_slices(batch, "text"):
            starts, ends, _ = words(data, bounds)
            values, counts = np.unique(rolling.spans(data, starts, ends), return_counts=True)
            held.append(values), n.append(counts)
            if sum(map(len, held)) > _HELD:
                values, counts = merged()
                held, n = [values], [counts]
                if len(values) > _HELD // 2:
                    yield rows(values, counts)
                    held, n = [], []
    if held:
        yield rows(*merged())


def vocabulary(docs: DataFrame, text_col: str = "text") -> Vocabulary:
    """Counts of all words of all documents, added up by Spark; the driver gets ``OWN`` words, or the
    square root of the number of distinct words where that is more, and a row per bucket."""
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(lean(_word_counts), "word bigint, n bigint")
    counted = settled(counted.groupBy("word").agg(F.sum("n").alias("n")))
    bucket = F.pmod("word", F.lit(BUCKETS)).cast("int").alias("bucket")
    shared = counted.groupBy(bucket).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    own = max(OWN, -(-isqrt(sum(r.words for r in shared)) // CLASSES) * CLASSES)
    top = counted.orderBy(F.desc("n"), "word").limit(own).collect()
    counts, distinct = np.zeros(own + BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for row in shared:
        counts[own + row.bucket], distinct[row.bucket] = row.n, row.words
    for i, row in enumerate(top):
        counts[i] = row.n
        counts[own + row.word % BUCKETS] -= row.n
        distinct[row.word % BUCKETS] -= 1
    hashes = np.array([r.word for r in top], dtype=np.int64)
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], order.astype(np.int64), counts, distinct, counted)


class Network:
    """Tables of the hidden layer's inputs by place and word, and outputs for classes and for words in a class."""

    def __init__(self, counts: np.ndarray) -> None:
        random = np.random.default_rng(3)
        size = len(counts)
        per = size // CLASSES
        share = (counts + 0.5).reshape(per, CLASSES).T / (counts.sum() + 0.5 * size)
        self.inputs = (0.1 * random.standard_normal((len(REACH), size + 1, HIDDEN))).astype(np.float32)
        self.hidden = np.zeros(HIDDEN, dtype=np.float32)
        self.to_class = (0.1 * random.standard_normal((HIDDEN, CLASSES))).astype(np.float32)
        self.of_class = np.log(share.sum(axis=1)).astype(np.float32)
        self.to_word = (0.1 * random.standard_normal((CLASSES, HIDDEN, per))).astype(np.float32)
        self.of_word = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.hidden, self.to_class, self.of_class, self.to_word, self.of_word]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def load(self, values: np.ndarray) -> Network:
        at = 0
        for p in self.parts():
            p[...] = values[at : at + p.size].reshape(p.shape)
            at += p.size
        return self

    def hide(self, around: np.ndarray) -> np.ndarray:
        total = np.take(self.inputs[0], around[0], axis=0)
        total += self.hidden
        for k in range(1, len(REACH)):
            total += np.take(self.inputs[k], around[k], axis=0)
        return np.tanh(total, out=total)

    def log_share(self, around: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The logarithm of each word's probability between its neighbours (one row of ``around`` for each place).

        Hidden layer and weights are rounded so that their products add up exactly: the same for the same neighbours,
        whatever stands beside them in a batch.
        """
        order, ends = _by_class(word)
        around, within, logs = np.take(around, order, axis=1), (word // CLASSES)[order], np.empty(len(word), dtype=np.float64)
        # The hidden layer stays in whole steps, the weights are divided by them.
        to_class = _rounded(self.to_class).T / np.float32(_STEP)
        for c, (low, high) in enumerate(zip([0, *ends], ends)):
            to_word = _rounded(self.to_word[c]).T / np.float32(_STEP) if low < high else None
            # As many rows as a core's cache holds.
            for at in range(low, high, _BATCH):
                some = slice(at, min(at + _BATCH, high))
                h = self.hide(around[:, some])
                h *= _STEP
                h = np.rint(h, out=h).T
                logs[some] = _log_softmax_at(to_class @ h, self.of_class, c)
                logs[some] += _log_softmax_at(to_word @ h, self.of_word[c], within[some])
        out = np.empty_like(logs)
        out[order] = logs
        return out

    def learn(self, around: np.ndarray, word: np.ndarray, rate: float, seen: list[np.ndarray], weight: np.ndarray | None = None) -> None:
        """One step of AdaGrad on a batch, whose words may have weights.

        Words lie by class, so that each class is a few products of matrices into parts of the whole batch's tables.
        """
        order, ends = _by_class(word)
        around, word, n = np.take(around, order, axis=1), word[order], len(word)
        # Equal weights come to ones.
        even = weight is None or not np.ptp(weight)
        weight = None if even else (weight[order] * (n / weight.sum())).astype(np.float32)[:, None]
        h, kind, within, places = self.hide(around), word % CLASSES, word // CLASSES, np.arange(n)
        classes = list(zip(range(CLASSES), [0, *ends], ends))
        miss = _softmax(h @ self.to_class, self.of_class)
        miss[places, kind] -= 1
        off = np.empty((n, self.of_word.shape[1]), dtype=np.float32)
        for c, low, high in classes:
            h[low:high].dot(self.to_word[c], off[low:high])
        _softmax(off, np.take(self.of_word, kind, axis=0))
        off[places, within] -= 1
        if not even:
            miss *= weight
            off *= weight
        back, more = miss @ self.to_class.T, np.empty_like(h)
        slopes = [None, None, h.T @ miss / n, miss.sum(axis=0) / n]
        # A column of ones beside the hidden layer: one product gives a class's slopes of weights and of biases.
        ones, both = np.ones((n, HIDDEN + 1), dtype=np.float32), np.empty((CLASSES, HIDDEN + 1, off.shape[1]), dtype=np.float32)
        ones[:, :HIDDEN] = h
        for c, low, high in classes:
            part = off[low:high]
            part.dot(self.to_word[c].T, more[low:high])
            ones[low:high].T.dot(part, both[c])
        slopes += [both[:, :HIDDEN] / n, both[:, HIDDEN] / n]
        back += more
        h *= h
        back *= np.subtract(1, h, out=h)
        slopes[1] = back.sum(axis=0) / n
        for p, s, a in list(zip(self.parts(), slopes, seen))[1:]:
            step = s * s
            a += step
            s *= rate
            s /= np.sqrt(a, out=step)
            p -= s
        # The places' tables as one: a word has a row in each.
        inputs, been = self.inputs.reshape(-1, HIDDEN), seen[0].reshape(-1, HIDDEN)
        s, at = _sums_by_row(back, around, self.inputs.shape[1])
        s /= n
        step, a = s * s, np.take(been, at, axis=0)
        a += step
        been[at] = a
        s *= rate
        s /= np.sqrt(a, out=a)
        inputs[at] = np.subtract(np.take(inputs, at, axis=0), s, out=s)


def _rounded(weights: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(weights, -_MOST, _MOST) * _STEP) / np.float32(_STEP)


def _highest(x: np.ndarray) -> np.ndarray:
    """The maximum of each row; column by column, as numpy is slow on short rows."""
    return np.ascontiguousarray(x.T).max(axis=0)[:, None]


def _softmax(x: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """``x`` plus ``bias``, turned in place into probabilities of each row."""
    x += bias
    x -= _highest(x)
    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
    return np.exp(x, out=x)


def _log_softmax_at(x: np.ndarray, bias: np.ndarray, at: np.ndarray | int) -> np.ndarray:
    """The logarithm of one probability of each column of ``x`` plus ``bias``; ``x`` is used up.

    Numpy is quick on few long rows, slow on many short ones.
    """
    x += bias[:, None]
    x -= x.max(axis=0)
    found = x[at, np.arange(x.shape[1])]
    return found - np.log(_column_sums(np.exp(x, out=x)))


def _column_sums(x: np.ndarray) -> np.ndarray:
    """Sums over the rows, in eight sums at first, which loses less than one would."""
    whole = len(x) // 8 * 8
    if not whole:
        return x.sum(axis=0)
    part = x[:whole].reshape(-1, 8, x.shape[1]).sum(axis=0)
    total = ((part[0] + part[1]) + (part[2] + part[3])) + ((part[4] + part[5]) + (part[6] + part[7]))
    for row in x[whole:]:
        total += row
    return total


def _sums_by_row(slopes: np.ndarray, around: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sum of a batch's slopes for each neighbour at each place, and its row in the places' tables of ``size`` rows each.

    Most neighbours come a few times in a batch: the first of each are taken together, then the second ones, and so on.
    Only those that come more often than ``_FEW`` are added up one by one.
    """
    order = np.argsort(around.astype(np.min_scalar_type(size)), axis=1, kind="stable")
    place = np.arange(len(around))[:, None]
    own = np.take(around + size * place, order + around.shape[1] * place).ravel()
    order, edges = order.ravel(), np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
    heads, often = edges[:-1], edges[1:] - edges[:-1]
    # The most frequent come first; ``more[k]`` of them come more than k times.
    heads = heads[np.argsort((len(order) - often).astype(np.min_scalar_type(len(order))), kind="stable")]
    more = len(heads) - np.cumsum(np.bincount(often, minlength=_FEW + 1))
    many, sums = more[_FEW], np.take(slopes, order[heads], axis=0)
    rest = np.take(slopes, order[heads[many : more[1]] + 1], axis=0)
    for k in range(2, _FEW):
        rest[: more[k] - many] += np.take(slopes, order[heads[many : more[k]] + k], axis=0)
    sums[many : more[1]] += rest
    if many:
        n = np.sort(often)[: -many - 1 : -1]
        starts = np.cumsum(n) - n
        sums[:many] = np.add.reduceat(np.take(slopes, order[np.repeat(heads[:many], n) + numbers_in(n)], axis=0), starts, axis=0)
    return sums, own[heads]


def _by_class(word: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The order of words by class, and where each class ends in it."""
    kind = (word % CLASSES).astype(np.uint8)
    return np.argsort(kind, kind="stable"), np.cumsum(np.bincount(kind, minlength=CLASSES)).tolist()


def _spaced(numbers: np.ndarray, first: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """The words with ``blank`` before and after each document, as far as neighbours reach, and where each word is there."""
    at = np.arange(len(numbers)) + max(REACH) * np.repeat(np.arange(1, len(first)), np.diff(first))
    spaced = np.full(len(numbers) + max(REACH) * len(first), blank, dtype=np.int32)
    spaced[at] = numbers
    return spaced, at


def _around(spaced: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The neighbours of the words at some places of ``spaced``, one row for each distance."""
    return np.take(spaced, at + np.array(REACH)[:, None])


def _numbered(known: Vocabulary):
    """(texthash, n, numbers) for the distinct texts of a batch: how many they are, and the numbers of their words."""
    kind = np.uint16 if len(known.counts) <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(_SEED)
        for batch in batches:
            for rows, data, bounds in text_slices(batch, "text"):
                numbers, first = known.read(data, bounds, rolling)
                numbers = numbers.astype(kind)
                _, at, n = np.unique(rows.column(1).to_numpy(), return_index=True, return_counts=True)
                some = np.diff(first)[at] > 0
                at, n = at[some], n[some]
                held = [numbers[first[k] : first[k + 1]].tobytes() for k in at]
                yield pa.RecordBatch.from_arrays([rows.column(1).take(pa.array(at)), pa.array(n), pa.array(held, pa.binary())], names=["texthash", "n", "numbers"])

    return run


def shards(docs: DataFrame, known: Vocabulary, text_col: str = "text") -> DataFrame:
    """(texthash, n, numbers), settled, a shard in each partition: documents by the hash of their text, in its order."""
    total = int(known.counts.sum())
    count = max(1, -(-total // SHARD_WORDS), min(64, -(-total // LEAST_SHARD)))
    texts = docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("texthash"))
    numbers = texts.mapInArrow(lean(_numbered(known)), "texthash bigint, n bigint, numbers binary")
    return settled(numbers.repartitionById(count, F.pmod("texthash", F.lit(count)).cast("int")).sortWithinPartitions("texthash"))


def _trained(known: Vocabulary, weights: np.ndarray, turn: int, stride: int):
    kind = np.uint16 if len(known.counts) <= 1 << 16 else np.uint32

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        """Each text once, with its number of copies."""
        now, n, numbers = None, 0, b""
        for batch in batches:
            for name, more, own in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if name != now or own != numbers:
                    if n:
                        yield n, np.frombuffer(numbers, dtype=kind).astype(np.int32)
                    now, n, numbers = name, 0, own
                n += more
        if n:
            yield n, np.frombuffer(numbers, dtype=kind).astype(np.int32)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, np.ndarray]]]:
        held, n = [], 0
        for one in texts(batches):
            held.append(one)
            n += len(one[1])
            if n >= _TOGETHER:
                yield held
                held, n = [], 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, done = Network(known.counts).load(weights), 0
        seen = [np.full(p.shape, 1e-4, dtype=np.float32) for p in net.parts()]
        for held in together(batches):
            numbers = np.concatenate([x for _, x in held])
            size = np.array([len(x) for _, x in held])
            first = np.concatenate([[0], np.cumsum(size)])
            copies = np.repeat(np.array([n for n, _ in held], dtype=np.float64), size)
            places = np.flatnonzero(numbers_in(size) % stride == turn % stride)
            spaced, there = _spaced(numbers, first, len(known.counts))
            for k in range(0, len(places), _BATCH):
                at = places[k : k + _BATCH]
                net.learn(_around(spaced, there[at]), numbers[at], 0.2 / (1 + turn), seen, copies[at])
            done += int(copies[places].sum())
        if done:
            n = -(-done // 1024)
            values = np.rint(net.flat().astype(np.float64) * _FIXED).astype(np.int64)
            parts = [_packed(values[k : k + _BLOCK]) for k in range(0, len(values), _BLOCK)]
            columns = [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array(np.full(len(parts), n)), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "n", "weights"])

    return run


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers as bytes; most are small, so that few of their bytes are left."""
    return compress(values.astype(np.int64).tobytes(), 1)


def _unpacked(held: bytes) -> np.ndarray:
    return np.frombuffer(decompress(held), dtype=np.int64)


def _added(weighted: bool):
    """Blocks of weights added up as they come, each ``n`` times if ``weighted``; a sum is held for each block of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for block, n, held in zip(*(batch.column(c).to_pylist() for c in range(3))):
                values = _unpacked(held)
                own = total.setdefault(block, [0, np.zeros(len(values), dtype=np.int64)])
                own[0] += n
                own[1] += values * n if weighted else values
        columns = [pa.array(list(total), pa.int32()), pa.array([x[0] for x in total.values()], pa.int64()), pa.array([_packed(x[1]) for x in total.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "n", "weights"])

    return run


def train(docs: DataFrame, known: Vocabulary, text_col: str = "text", stride: int = STRIDE, turns: int = TURNS) -> np.ndarray:
    """The network's weights after ``turns`` turns; in each, every document teaches each ``stride``-th of its words.

    A turn begins one word after the last one did: in ``stride`` turns every word of every document is taught once.
    A turn's copies are added up in fixed point, in blocks and a tree, so that the order of adding doesn't matter; the
    driver gets one average. Rows in any order, files or tasks give the same weights.
    """
    dealt, weights = shards(docs, known, text_col), Network(known.counts).flat()
    schema = "block int, n bigint, weights binary"
    for turn in range(turns):
        sums = dealt.mapInArrow(lean(_trained(known, weights, turn, stride)), schema).withColumn("salt", F.spark_partition_id() % 16)
        for by in (["block", "salt"], ["block"]):
            sums = sums.repartition(*by).select("block", "n", "weights").mapInArrow(_added("salt" in by), schema).withColumn("salt", F.lit(0))
        found = sums.select("block", "n", "weights").collect()
        if found:
            parts = {r.block: _unpacked(r.weights) / r.n / _FIXED for r in found}
            weights = np.concatenate([parts[k] for k in sorted(parts)])
    return weights


def _scored(known: Vocabulary, weights: np.ndarray):
    """A row per slice: ids, words and sums of its documents, as if all words of a bucket had a count of 1; how many words of
    each document are in buckets, which (numbers into the slice's list of such words), and that list by ranges of hashes."""

    bits = known.part_bits
    low, high = np.uint64(bits), np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, rolling = Network(known.counts).load(weights), Rolling(_SEED)
        spread = np.concatenate([np.zeros(known.own), np.log(np.maximum(known.counts[known.own :], 1))])
        for batch in batches:
            for rows, data, bounds in text_slices(batch, "text"):
                h, first = known.spelled(data, bounds, rolling)
                numbers = known.numbered(h)
                logs, (spaced, there) = np.zeros(len(numbers), dtype=np.int64), _spaced(numbers, first, len(known.counts))
                for k in range(0, len(numbers), _SCORED):
                    at = slice(k, k + _SCORED)
                    share = net.log_share(_around(spaced, there[at]), numbers[at]) - spread[numbers[at]]
                    logs[at] = np.rint(share * _LOG_STEP)
                n = np.diff(first)
                total = np.diff(np.concatenate([[0], np.cumsum(logs)])[first]) / _LOG_STEP
                away = numbers >= known.own
                per = np.diff(np.concatenate([[0], np.cumsum(away)])[first])
                # The range of a hash, its lowest bits, comes first in this order.
                turned = h[away].view(np.uint64)
                turned = (turned << high) | (turned >> low)
                turned, which = np.unique(turned, return_inverse=True)
                listed = ((turned << low) | (turned >> high)).view(np.int64)
                ends = np.searchsorted(turned >> high, np.arange((1 << bits) + 1, dtype=np.uint64))
                parts = [{"part": int(p), "words": listed[ends[p] : ends[p + 1]].tobytes()} for p in np.flatnonzero(np.diff(ends))]
                which = which.astype(np.uint16 if len(listed) <= 1 << 16 else np.uint32)
                columns = [pa.array([x.tobytes()], pa.binary()) for x in (n.astype(np.int64), total, per.astype(np.int64), which)]
                ids = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows.column(0))
                kind = pa.list_(pa.struct([("part", pa.int32()), ("words", pa.binary())]))
                yield pa.RecordBatch.from_arrays([ids, *columns, pa.array([parts], kind)], names=["ids", "n", "total", "per", "which", "parts"])

    return run


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of the lists of words that follow, in the order of rows, the counted words of their range."""
    now, held, table = None, [], None
    for batch in batches:
        part, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        lists, units, out = batch.column(5).to_pylist(), batch.column(4), []
        edges = np.flatnonzero(np.concatenate([[True], (np.diff(part) != 0) | (asks[1:] != asks[:-1]), [True]])) if len(part) else []
        for low, high in zip(edges[:-1], edges[1:]):
            if part[low] != now:
                now, held, table = part[low], [], None
            if not asks[low]:
                held.append([batch.column(c).slice(low, high - low).to_numpy() for c in (2, 3)])
                continue
            if table is None:
                word, n = (np.concatenate([np.zeros(0, dtype=np.int64), *(x[c] for x in held)]).astype(np.int64) for c in (0, 1))
                order = np.argsort(word)
                held, table = [], (word[order], n[order])
            h = np.frombuffer(b"".join(lists[low:high]), dtype=np.int64)
            n = np.zeros(len(h), dtype=np.int64)
            if len(table[0]):
                at = np.minimum(np.searchsorted(table[0], h), len(table[0]) - 1)
                n = np.where(table[0][at] == h, table[1][at], 0)
            ends = np.cumsum([0, *(len(x) // 8 for x in lists[low:high])])
            out += [n[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        asked = pa.array(asks, pa.bool_())
        yield pa.RecordBatch.from_arrays([units.filter(asked), batch.column(0).filter(asked), pa.array(out, pa.binary())], names=["unit", "part", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each slice, whose row comes before those with the counts of its words."""
    slice_, counts = None, []

    def done() -> Iterator[pa.RecordBatch]:
        if slice_ is None:
            return
        ids, n, total, per, which = slice_
        n, total, per = np.frombuffer(n, np.int64), np.frombuffer(total, np.float64), np.frombuffer(per, np.int64)
        which = np.frombuffer(which, np.uint16 if len(which) == 2 * per.sum() else np.uint32)
        logs = np.log(np.maximum(np.frombuffer(b"".join(counts), np.int64), 1))
        total = total + np.bincount(np.repeat(np.arange(len(per)), per), weights=logs[which], minlength=len(per))
        mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
        yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(total), mean], names=["id", "n_words", "log_prob", "mean_log_prob"])

    for batch in batches:
        for k, part in enumerate(batch.column(1).to_pylist()):
            if part < 0:
                yield from done()
                slice_, counts = [batch.column(2)[k].values, *(batch.column(c)[k].as_py() for c in range(3, 7))], []
            else:
                counts.append(batch.column(7)[k].as_py())
    yield from done()


def score(docs: DataFrame, known: Vocabulary, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``log_prob`` (summed over all words) and ``mean_log_prob``.

    A null or blank text has no words, a sum of 0 and a null mean. A bucket's words share its probability by their counts
    in the corpus behind ``known``; words that it lacks count like those that it has once. The counts are joined in Spark
    with the distinct words of each slice of text. Ids, null or repeated, are carried along; no text is shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"ids array<{kind}>, n binary, total binary, per binary, which binary, parts array<struct<part:int,words:binary>>"
    slices = settled(texts.mapInArrow(lean(_scored(known, weights)), schema).withColumn("unit", F.monotonically_increasing_id()))
    asked = slices.select("unit", F.inline("parts")).selectExpr("part", "true AS asks", "0L AS word", "0L AS n", "unit", "words")
    counted = known.counted.selectExpr(f"CAST(word & {(1 << known.part_bits) - 1} AS int) AS part", "false AS asks", "word", "n", "0L AS unit", "CAST(null AS binary) AS words")
    both = counted.unionAll(asked).repartition("part").sortWithinPartitions("part", "asks")
    found = both.mapInArrow(lean(_looked_up), "unit bigint, part int, counts binary")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("ids", f"array<{kind}>"), ("n", "binary"), ("total", "binary"), ("per", "binary"), ("which", "binary"))]
    whole = slices.select("unit", F.lit(-1).alias("part"), "ids", "n", "total", "per", "which", F.lit(None).cast("binary").alias("counts"))
    rows = whole.unionAll(found.select("unit", "part", *none, "counts")).repartition("unit").sortWithinPartitions("unit", "part")
    return rows.mapInArrow(lean(_summed), f"id {kind}, n_words bigint, log_prob double, mean_log_prob double").withColumnRenamed("id", id_col)

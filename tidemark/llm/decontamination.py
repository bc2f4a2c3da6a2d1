"""Passages of test items in training documents, copied, edited or paraphrased.

Pairs of an item's words, neighbours or with one word between, are its seeds. An alignment that reaches the limit has
enough pairs of matches with one edit between them at most, which are seeds in item and document alike, to allow for two
things without losing any match: of each item's seeds the most frequent ones in the corpus are left out, and a place must
hold several of the rare ones left. Only such places are aligned, by Smith and Waterman's method, many pairs at a time, and
the score decides. Seeds are counted by Spark; items, which are few beside the documents, come to the tasks, so that no
document moves, and no match depends on how often it occurs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.language_id import lowered
from tidemark.llm.shared import Rolling, lean, mixed, numbers_in, text_slices, words

MIN_SCORE = 0.5
# Shorter items match documents that have no other words.
MIN_WORDS = 5
# Words of the items that a task holds at a time; more are looked for in further passes over the documents.
BLOCK_WORDS = 2_000_000
_MATCH, _OTHER, _GAP = 2, -1, -1
_CELLS = 1 << 21
_HITS = 1 << 20
_BINS = 4

_BLANK = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


@dataclass
class Items:
    """Items of a block: ids, word hashes with bounds; their seeds in order (``keys``, each once, in ``sieve`` by their lowest
    bits), and for those kept the item, the place and a number; how many of them a place must hold, by item; short items."""

    ids: list
    words: np.ndarray
    first: np.ndarray
    keys: np.ndarray
    sieve: np.ndarray
    begin: np.ndarray
    item: np.ndarray
    place: np.ndarray
    need: np.ndarray
    short: dict


def _spelled(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a slice, case and punctuation aside, and the first word of each row."""
    small = lowered(data)
    starts, ends, first = words(small, bounds, _BLANK)
    return Rolling(31).spans(small, starts, ends), first


def _pairs(hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Key and place of all pairs of neighbours, then of all words with one between, within rows."""
    turned = hashes * np.uint64(0x9E3779B97F4A7C15)
    for apart in (1, 2):
        n = max(0, len(hashes) - apart)
        inside = np.ones(n, dtype=bool)
        for k in range(1, apart + 1):
            edge = first[1:-1] - k
            inside[edge[(edge >= 0) & (edge < n)]] = False
        at = np.flatnonzero(inside)
        yield mixed(turned[at] + hashes[at + apart]), at


_SIEVE = 20


def _known(block: Items, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the key, place) of the pairs of a slice that are seeds of an item."""
    for keys, at in _pairs(hashes, first):
        hit = np.flatnonzero(block.sieve[keys & np.uint64((1 << _SIEVE) - 1)])
        if not len(hit) or not len(block.keys):
            continue
        there = np.minimum(np.searchsorted(block.keys, keys[hit]), len(block.keys) - 1)
        same = block.keys[there] == keys[hit]
        yield there[same], at[hit[same]]


def _whole(hashes: np.ndarray) -> bytes:
    return hashes.tobytes()


def _block(rows: list[tuple], least: float = MIN_SCORE) -> Items:
    texts = [(t or "").encode() for _, t in rows]
    bounds = np.cumsum([0, *map(len, texts)])
    hashes, first = _spelled(np.frombuffer(b"".join(texts), dtype=np.uint8), bounds)
    size = np.diff(first)
    short: dict[bytes, list[int]] = {}
    for i in np.flatnonzero((size > 0) & (size < MIN_WORDS)):
        short.setdefault(_whole(hashes[first[i] : first[i + 1]]), []).append(int(i))
    keys, at = (np.concatenate(x) for x in zip(*_pairs(hashes, first)))
    item = np.searchsorted(first, at, side="right") - 1
    keep = size[item] >= MIN_WORDS
    keys, at, item = keys[keep], at[keep], item[keep]
    order = np.argsort(keys, kind="stable")
    keys, at, item = keys[order], at[order], item[order]
    distinct, begin = np.unique(keys, return_index=True)
    sieve = np.zeros(1 << _SIEVE, dtype=bool)
    sieve[distinct & np.uint64((1 << _SIEVE) - 1)] = True
    need = np.maximum(1, np.ceil(least * size - 1 - 1e-9).astype(np.int64))
    return Items([i for i, _ in rows], hashes, first, distinct, sieve, np.append(begin, len(keys)), item, at - first[item], need, short)


def rare(block: Items, counts: np.ndarray) -> Items:
    """The block with the most frequent seeds of each item left out: half as many as it could do without."""
    number = np.repeat(np.arange(len(block.keys)), np.diff(block.begin))
    left_out = np.maximum(block.need - 1, 0) // 2
    order = np.lexsort((number, -counts[number], block.item))
    per = np.bincount(block.item, minlength=len(block.ids))
    position = np.empty(len(order), dtype=np.int64)
    position[order] = numbers_in(per)
    kept = np.flatnonzero(position >= left_out[block.item])
    used, begin = np.unique(number[kept], return_index=True)
    sieve = np.zeros(1 << _SIEVE, dtype=bool)
    sieve[block.keys[used] & np.uint64((1 << _SIEVE) - 1)] = True
    return Items(
        block.ids, block.words, block.first, block.keys[used], sieve, np.append(begin, len(kept)), block.item[kept], block.place[kept], block.need - left_out, block.short
    )


def blocks(items: DataFrame, id_col: str, text_col: str, size: int = BLOCK_WORDS, least: float = MIN_SCORE) -> Iterator[Items]:
    """Items with words, in blocks of about ``size`` words; the driver holds one at a time."""
    held, n = [], 0
    for row in items.select(id_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        text = row[1].encode()
        held.append((row[0], row[1]))
        n += len(words(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]), _BLANK)[0])
        if n >= size:
            yield _block(held, least)
            held, n = [], 0
    if held:
        yield _block(held, least)


def _counted(block: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(block.keys), dtype=np.int64)
        for batch in batches:
            for _, data, bounds in text_slices(batch, "text"):
                for number, _ in _known(block, *_spelled(data, bounds)):
                    total += np.bincount(number, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["key", "n"])

    return run


def seed_counts(docs: DataFrame, block: Items, text_col: str = "text") -> np.ndarray:
    """How often each seed of the block is in the corpus; the driver gets a number for a seed."""
    out = np.zeros(len(block.keys), dtype=np.int64)
    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(lean(_counted(block)), "key bigint, n bigint")
    for row in counts.groupBy("key").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row.key] = row.n
    return out


def align(left: np.ndarray, left_n: np.ndarray, right: np.ndarray, right_n: np.ndarray) -> np.ndarray:
    """Smith-Waterman scores of pairs of sequences, the rows of two padded arrays, by antidiagonals."""
    pairs, n, m = len(left), left.shape[1], right.shape[1]
    before, now, best = (np.zeros((pairs, n + 1), dtype=np.int32) for _ in range(3))
    column = np.arange(n)
    inside = column[None, :] < left_n[:, None]
    padded = np.concatenate([np.zeros((pairs, n), right.dtype), right, np.zeros((pairs, n), right.dtype)], axis=1)
    turned = padded[:, ::-1]
    for d in range(n + m - 1):
        # On antidiagonal d, word i of the left meets word d - i of the right.
        other = turned[:, m + n - 1 - d : m + 2 * n - 1 - d]
        real = inside & (d - column >= 0)[None, :] & (d - column[None, :] < right_n[:, None])
        score = np.where(left == other, _MATCH, _OTHER)
        new = np.maximum(before[:, :-1] + score, np.maximum(now[:, :-1], now[:, 1:]) + _GAP)
        new = np.where(real, np.maximum(new, 0), 0)
        before, now = now, np.concatenate([np.zeros((pairs, 1), dtype=np.int32), new], axis=1)
        np.maximum(best, now, out=best)
    return best.max(axis=1)


def _candidates(hashes: np.ndarray, first: np.ndarray, block: Items) -> Iterator[np.ndarray]:
    """(row, item, begin) of the stretches of documents that may hold an item: it may begin from ``begin`` on.

    A seed says where the item would begin; that moves with each word put in or left out, by less than four bins of half
    the item's length over an alignment. The seeds in four bins must be as many as the item needs. They come in parts of
    bounded size, of whole rows.
    """
    found = [x for x in _known(block, hashes, first) if len(x[0])]
    if not found:
        return
    number, at = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(at, kind="stable")
    number, at = number[order], at[order]
    row = np.searchsorted(first, at, side="right") - 1
    times = np.diff(block.begin)[number]
    part = np.cumsum(np.bincount(row, weights=times, minlength=len(first) - 1))[row] // _HITS
    for hit in np.split(np.arange(len(at)), np.flatnonzero(np.diff(part)) + 1):
        seed = np.repeat(block.begin[number[hit]], times[hit]) + numbers_in(times[hit])
        item, of_row, place = block.item[seed], np.repeat(row[hit], times[hit]), np.repeat(at[hit], times[hit])
        half = np.maximum(np.diff(block.first)[item] // 2, 1)
        longest = int(np.diff(block.first).max())
        bins = (place - first[of_row] - block.place[seed] + longest) // half
        wide = int(bins.max()) + _BINS + 1
        stretch = (of_row * len(block.ids) + item) * wide + bins
        held = np.unique(np.stack([stretch, seed], axis=1), axis=0)[:, 0]
        stretch, n = np.unique(held, return_counts=True)
        ends = np.concatenate([[0], np.cumsum(n)])
        inside = ends[np.searchsorted(stretch, stretch + _BINS)] - ends[:-1]
        of, bins = stretch // wide, stretch % wide
        item = of % len(block.ids)
        enough = np.flatnonzero(inside >= block.need[item])
        item = item[enough]
        begin = bins[enough] * np.maximum(np.diff(block.first)[item] // 2, 1) - longest
        yield np.stack([of[enough] // len(block.ids), item, begin], axis=1)


def _matched(hashes: np.ndarray, first: np.ndarray, block: Items, least: float) -> dict[tuple[int, int], float]:
    """The best score of each (row, item) that reaches ``least``."""
    size, out = np.diff(block.first), {}
    for row in np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < MIN_WORDS)) if block.short else ():
        for item in block.short.get(_whole(hashes[first[row] : first[row + 1]]), ()):
            out[int(row), item] = 1.0
    for found in _candidates(hashes, first, block):
        found = found[np.argsort(size[found[:, 1]], kind="stable")]
        start = 0
        while start < len(found):
            step = max(1, _CELLS // int(5 * size[found[min(start + 2000, len(found) - 1), 1]] + 1))
            part, start = found[start : start + min(step, 2000)], start + min(step, 2000)
            n = size[part[:, 1]]
            begin = np.maximum(part[:, 2] - n // 2, 0)
            whole = np.diff(first)[part[:, 0]]
            m = np.maximum(np.minimum(part[:, 2] + 4 * n, whole) - begin, 0)
            columns = np.arange(n.max())
            at = np.minimum(block.first[part[:, 1]][:, None] + columns, len(block.words) - 1)
            left = np.where(columns < n[:, None], block.words[at], np.uint64(1))
            columns = np.arange(max(1, m.max()))
            at = np.minimum((first[part[:, 0]] + begin)[:, None] + columns, len(hashes) - 1)
            right = np.where(columns < m[:, None], hashes[at], np.uint64(2))
            for (row, item, _), score in zip(part, align(left, n, right, m) / (_MATCH * n)):
                if score >= least:
                    key = (int(row), int(item))
                    out[key] = max(out.get(key, 0.0), float(score))
    return out


def _prepared(docs: DataFrame, items: DataFrame, text_col: str, item_id_col: str, item_text_col: str, least: float, block_words: int) -> Iterator[Items]:
    for block in blocks(items, item_id_col, item_text_col, block_words, least):
        yield rare(block, seed_counts(docs, block, text_col))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    least: float = MIN_SCORE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row (id, item, score) per document and item that it holds; other documents have no row.

    The score is that of the best local alignment by words (2 for equal words, -1 for others and gaps) over the most an
    item can reach; ``least`` of it, 0.5 or more, makes a match. Case and ASCII punctuation don't count. Null or empty
    texts hold nothing, null items and those without words are in nothing. Of an item under five words, which is in texts
    of all kinds, only a document that consists of it is a copy. Repeated items, and repeated rows, each match.
    """
    if not MIN_SCORE <= least <= 1:
        raise ValueError(f"least is {MIN_SCORE} to 1: below it places with fewer seeds would count")
    kind, item_kind = docs.schema[id_col].dataType, items.schema[item_id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("item", item_kind), T.StructField("score", T.DoubleType())])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = []
    for block in _prepared(docs, items, text_col, item_id_col, item_text_col, least, block_words):
        parts.append(texts.mapInArrow(lean(_rows(block, least, to_arrow_type(item_kind))), schema))
    found = docs.sparkSession.createDataFrame([], schema)
    for part in parts:
        found = part if part is parts[0] else found.unionAll(part)
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_id_col if item_id_col != id_col else "item"), "score")


def _rows(block: Items, least: float, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in text_slices(batch, "text"):
                found = sorted(_matched(*_spelled(data, bounds), block, least).items())
                ids = rows.column(0).take(pa.array([k[0] for k, _ in found], pa.int64()))
                names = pa.array([block.ids[k[1]] for k, _ in found], kind)
                yield pa.RecordBatch.from_arrays([ids, names, pa.array([x for _, x in found], pa.float64())], names=["id", "item", "score"])

    return run


def clean(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    least: float = MIN_SCORE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs``, whole, that hold no item in the sense of ``contaminated``."""
    place = docs.columns.index(text_col)
    for block in _prepared(docs, items, text_col, item_id_col, item_text_col, least, block_words):

        def run(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                named = pa.RecordBatch.from_arrays(batch.columns, names=[f"c{i}" for i in range(len(batch.columns))])
                for rows, data, bounds in text_slices(named, f"c{place}"):
                    keep = np.ones(len(rows), dtype=bool)
                    keep[[row for row, _ in _matched(*_spelled(data, bounds), block, least)]] = False
                    yield pa.RecordBatch.from_arrays(rows.filter(pa.array(keep)).columns, schema=batch.schema)

        docs = docs.mapInArrow(lean(run), docs.schema)
    return docs

"""Removal of word sequences that another document, or an earlier place, already has.

Rabin-Karp hashes stand for every window of a fixed number of words. Equal windows hold the same smallest hash of eight
words, so a first count in Spark goes over those (about one for seven windows) and only windows whose smallest hash
recurs are counted themselves, by that hash and two of the whole window: 96 bits decide that two windows are equal.
Each task first settles what repeats within it and passes on a row or two for each distinct value, which keeps very
common passages from meeting in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.llm.places import placed
from tidemark.llm.shared import Rolling, lean, mixed, numbers_in, settled, text_slices, words

WINDOW = 20
_ANCHOR = 8
# Values that a task remembers, of those it has passed on; beyond, it starts anew and passes on a few more.
_REMEMBERED = 1 << 20
_UPPER = np.uint64(0xFFFFFFFF00000000)


class _Windows:
    """The windows of a slice: row, first word (within the slice and the document), smallest hash in each and its place."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, width: int, rolling: tuple[Rolling, ...]) -> None:
        byte, *wide = rolling
        starts, ends, first = words(data, bounds)
        self.hashes, self.wide, self.width = byte.spans(data, starts, ends), wide, width
        anchor = min(_ANCHOR, width)
        counts = np.maximum(np.diff(first) - width + 1, 0)
        self.row = np.repeat(np.arange(len(counts)), counts)
        self.place = numbers_in(counts)
        self.start = np.repeat(first[:-1], counts) + self.place
        low, reach, wanted = byte.windows(self.hashes, anchor), 1, width - anchor + 1
        at = np.arange(len(low))
        while reach < wanted and len(low) > wanted - reach:
            step = min(reach, wanted - reach)
            right = low[step:] < low[:-step]
            low, at = np.where(right, low[step:], low[:-step]), np.where(right, at[step:], at[:-step])
            reach += step
        some = len(self.start) > 0
        self.low, self.at = low[self.start] if some else low[:0], at[self.start] if some else at[:0]

    def whole(self, which: int = 0) -> np.ndarray:
        """One of two hashes of each window."""
        return self.wide[which].windows(self.hashes, self.width)


def _rolling() -> tuple[Rolling, ...]:
    return Rolling(11), Rolling(23), Rolling(29)


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new) > 1:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


class _Seen:
    """Pairs of 64-bit values that a task has met, in sorted arrays; forgotten when there are too many."""

    def __init__(self, most: int = _REMEMBERED) -> None:
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.key, self.a, self.b = (np.zeros(0, dtype=np.uint64) for _ in range(3))

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.key):
            return np.zeros(len(a), dtype=bool)
        at = np.minimum(np.searchsorted(self.key, mixed(a) ^ b), len(self.key) - 1)
        return (self.a[at] == a) & (self.b[at] == b)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs that differ from each other and from those held."""
        if len(self.key) + len(a) > self.most:
            self.forget()
        key = mixed(a) ^ b
        order = np.argsort(key)
        at = np.searchsorted(self.key, key[order])
        for name, values in (("key", key), ("a", a), ("b", b)):
            setattr(self, name, np.insert(getattr(self, name), at, values[order]))


def _anchor_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, serial, once, twice = _rolling(), 1, _Seen(), _Seen()
        for batch in batches:
            for rows, data, bounds in text_slices(batch, "text"):
                w = _Windows(data, bounds, width, rolling)
                heads = np.flatnonzero(_heads(w.at)) if len(w.row) else np.zeros(0, dtype=np.int64)
                row, low = w.row[heads], w.low[heads]
                order = np.argsort(low, kind="stable")
                row, low = row[order], low[order]
                new = _heads(low) if len(low) else np.zeros(0, dtype=bool)
                size = np.diff(np.append(np.flatnonzero(new), len(low)))
                # The first of a value goes out with its count, as does, from a later slice, the second; the others, known
                # to recur, each under a number of their own.
                n, salt = np.full(len(low), 2), np.zeros(len(low), dtype=np.int64)
                n[new] = np.minimum(size, 2)
                value, none = low[new], np.zeros(int(new.sum()), dtype=np.uint64)
                met, often = once.has(value, none), twice.has(value, none)
                alone = ~new
                alone[new] = often
                n[alone] = 2
                salt[alone] = serial + np.arange(int(alone.sum()))
                serial += int(alone.sum())
                once.add(value[~met & ~often], none[~met & ~often])
                again = (met | (size > 1)) & ~often
                twice.add(value[again], none[again])
                yield pa.RecordBatch.from_arrays(
                    [_signed(low), pa.array(salt), rows.column(0).take(pa.array(row)), pa.array(n.astype(np.int32))],
                    names=["low", "salt", "id", "n"],
                )

    return run


def _window_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, seen, last = _rolling(), _Seen(), None
        for batch in batches:
            for rows, data, bounds in text_slices(batch, "text"):
                # What a task has met comes before what it meets, as long as ids rise from slice to slice.
                ids = rows.column(0)
                ends = pc.min_max(ids)
                if ids.null_count or last is not None and not pc.less(last, ends["min"]).as_py():
                    seen.forget()
                last = ends["max"] if ends["max"].is_valid else None
                w = _Windows(data, bounds, width, rolling)
                lows = rows.column(2)
                tag = mixed(np.arange(1, len(rows) + 1, dtype=np.uint64))
                sizes = pc.list_value_length(lows).to_numpy(zero_copy_only=False).astype(np.int64)
                wanted = lows.flatten().to_numpy(zero_copy_only=False).view(np.uint64) + np.repeat(tag, sizes)
                hit = np.flatnonzero(np.isin(w.low + tag[w.row], wanted))
                if not len(hit):
                    continue
                rank = pc.rank(ids, null_placement="at_start", tiebreaker="min").to_numpy().astype(np.int64)
                row, place, low = w.row[hit], w.place[hit], w.low[hit]
                whole, other = w.whole()[w.start[hit]], w.whole(1)[w.start[hit]]
                order = np.lexsort((place, rank[row], whole, low))
                new = _heads(low[order], whole[order])
                group = np.cumsum(new) - 1
                first = order[np.flatnonzero(new)]
                head = first[group]
                later = np.zeros(len(hit), dtype=bool)
                later[order] = (rank[row[order]] != rank[row[head]]) | (place[order] != place[head])
                met = seen.has(low[first], whole[first])
                later[order] |= met[group]
                seen.add(low[first[~met]], whole[first[~met]])
                for done in (False, True):
                    pick = np.flatnonzero(later == done)
                    if not len(pick):
                        continue
                    r, p, v, h = row[pick], place[pick], low[pick], whole[pick]
                    if done:
                        begin = np.ones(len(r), dtype=bool)
                        begin[1:] = (r[1:] != r[:-1]) | (p[1:] != p[:-1] + 1)
                        at = np.flatnonzero(begin)
                        length = np.diff(np.append(at, len(r)))
                        key = mixed(mixed(tag[r[at]] ^ v[at]) + p[at].astype(np.uint64))
                        r, p, h = r[at], p[at], length.astype(np.uint64) << np.uint64(32)
                    else:
                        # Not by the smallest hash alone: a common line is in many windows that differ around it.
                        key = mixed(v) ^ other[pick]
                    # The upper half of the hash, or a run's length, stands above the place: fewer bytes to exchange.
                    word = (h & _UPPER) | p.astype(np.uint64)
                    columns = [_signed(key), pa.array(np.full(len(key), done)), ids.take(pa.array(r)), _signed(word)]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "done", "id", "word"])

    return run


def _cut(width: int, joined: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in text_slices(batch, "text"):
                places, lengths, raw = rows.column(2), rows.column(3), data.tobytes()
                texts, total, removed, firsts, lasts = [], [], [], [], []
                for k in range(len(rows)):
                    text = raw[bounds[k] : bounds[k + 1]]
                    parts = text.split()
                    n = len(parts)
                    total.append(n)
                    if not places[k].is_valid or not len(places[k]):
                        removed.append(0), firsts.append([]), lasts.append([])
                        texts.append(b" ".join(parts) if joined else text if rows.column(1)[k].is_valid else None)
                        continue
                    begin = places[k].values.to_numpy()
                    change = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(change, begin, 1)
                    np.add.at(change, np.minimum(begin + lengths[k].values.to_numpy() + width - 1, n), -1)
                    gone = np.cumsum(change)[:n] > 0
                    edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
                    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                    removed.append(int(gone.sum())), firsts.append(first.tolist()), lasts.append(last.tolist())
                    if joined:
                        texts.append(b" ".join([x for x, g in zip(parts, gone.tolist()) if not g]))
                    else:
                        start, _, _ = words(data[bounds[k] : bounds[k + 1]], np.array([0, len(text)]))
                        start = np.append(start, len(text))
                        kept = [text[i:j] for i, j in zip([0, *start[last]], [*start[first], len(text)])]
                        texts.append(b"".join(kept))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        rows.column(4),
                        pa.array(texts, type=pa.binary()).cast(pa.string()),
                        pa.array(total, type=pa.int64()),
                        pa.array(removed, type=pa.int64()),
                        pa.array(firsts, type=pa.list_(pa.int32())),
                        pa.array(lasts, type=pa.list_(pa.int32())),
                    ],
                    names=["id", "rest", "kept", "n_words", "n_removed", "first_word", "end_word"],
                )

    return run


def _repeated(texts: DataFrame, kind: str, window: int) -> DataFrame:
    """(id, place, length): runs of window starts, numbered by their first word, whose words also start earlier."""
    anchors = texts.select("id", "text").mapInArrow(lean(_anchor_rows(window)), f"low bigint, salt bigint, id {kind}, n int")
    total = F.sum("n").over(Window.partitionBy("low", "salt"))
    again = anchors.select("low", "id", total.alias("total")).where("total > 1")
    wanted = again.groupBy(F.col("id").alias("own")).agg(F.collect_list("low").alias("lows"))
    # ``rest`` goes along unread: the exchange of the texts is then the one that the last join needs, and made once.
    near = texts.join(wanted, F.col("id").eqNullSafe(F.col("own"))).select("id", "text", "lows", "rest")
    each = near.mapInArrow(lean(_window_rows(window)), f"key bigint, done boolean, id {kind}, word bigint").repartition("key")
    each = each.select("key", "done", "id", F.shiftright("word", 32).alias("hash"), F.col("word").bitwiseAND(0x7FFFFFFF).cast("int").alias("place"))
    first = F.min(F.struct("id", "place")).over(Window.partitionBy("key", "done", "hash"))
    marked = each.select("id", "place", "done", "hash", first.alias("first"))
    later = marked.where(F.col("done") | (F.struct("id", "place") > F.col("first")))
    return later.select("id", "place", F.when(F.col("done"), F.col("hash").cast("int")).otherwise(1).alias("length"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, joined: bool = True
) -> DataFrame:
    """One row per row of ``docs``: id, ``kept``, ``n_words``, ``n_removed``, the removed intervals of words and ``rest``.

    A word goes if a window of ``window`` consecutive words covers it whose words also start at a smaller id, or earlier
    in the same document; all windows are judged on the input. Words are runs of bytes other than space and tab to
    carriage return. ``kept`` has the other words joined by one space, or, without ``joined``, the text as it was outside
    the removed intervals (``first_word`` up to before ``end_word``, maximal and in order). ``rest`` is a struct of the
    other columns of ``docs`` (null if there are none).

    A null text has no words and ``kept`` is empty (null without ``joined``); texts shorter than a window stay whole. A null id comes before all
    others. Different texts under one id, or under none, are documents of their own, in the order of their hashes; rows that
    repeat id and text count as one document: they get the same result and don't cut each other.
    """
    kind = docs.schema[id_col].dataType
    others = [docs[c] for c in docs.columns if c not in (id_col, text_col)]
    rest = F.struct(*others) if others else F.lit(None).cast("boolean")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), rest.alias("rest"))
    several = texts.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    numbered = not several.isEmpty()
    if numbered:
        # What shares an id is told apart by a number that follows the order of ids and texts' hashes.
        hashed = texts.withColumn("texthash", F.xxhash64("text"))
        names = settled(hashed.select("id", "texthash").distinct().withColumn("all", F.lit(0)))
        names = placed(names, "all", ["id", "texthash"]).select(F.col("id").alias("named"), F.col("texthash").alias("hash"), "pos")
        same = F.col("id").eqNullSafe(F.col("named")) & (F.col("texthash") == F.col("hash"))
        texts = hashed.join(names, same).select(F.col("pos").alias("id"), "text", F.struct("id", "rest").alias("rest"))
        runs = _repeated(texts.groupBy("id").agg(F.first("text").alias("text")).withColumn("rest", F.lit(None).cast("boolean")), "bigint", window)
    else:
        runs = _repeated(texts, kind.simpleString(), window)
    runs = runs.groupBy(F.col("id").alias("own")).agg(F.collect_list("place").alias("places"), F.collect_list("length").alias("lengths"))
    found = texts.join(runs, F.col("id").eqNullSafe(F.col("own")), "left").select("id", "text", "places", "lengths", "rest")
    new = T.StructType.fromDDL("kept string, n_words bigint, n_removed bigint, first_word array<int>, end_word array<int>")
    schema = T.StructType([T.StructField("id", found.schema["id"].dataType), T.StructField("rest", found.schema["rest"].dataType), *new])
    found = found.mapInArrow(lean(_cut(window, joined)), schema)
    if numbered:
        found = found.select(F.col("rest.id").alias("id"), F.col("rest.rest").alias("rest"), *new.names)
    return found.withColumnRenamed("id", id_col)

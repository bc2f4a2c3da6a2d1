"""Packing of token sequences by minimum bin slack.

What fits together depends on lengths alone, so the search runs on the histogram of lengths (as many rows as a sequence
has tokens): the longest length left opens a sequence, a bitset of reachable sums over the lengths left finds its fullest
completion, and the combination is taken as often as its lengths last. Pieces get a rank within their length, from a
count per task and length, and look up the place that their length and rank have in the plan. No piece meets another.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.pretokens import pretokens
from tidemark.llm.shared import Rolling, lean, numbers_in, settled, text_slices

CAPACITY = 1024
END_ID = 2
_KNOWN = 1 << 19
_LINES = 256
_SLICE = 1 << 19


class _Encoder:
    """Ids of pre-tokens by the tokenizers library, each distinct one encoded once while it is remembered."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder()
        self.special = {t.content.encode(): i for i, t in added.items()}
        self.rolling = Rolling(5)
        self.line = self.library.encode("\n", add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        self.known, self.place = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.flat, self.begin, self.size = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, one after another, and the number of each one's ids.

        A line break is a pre-token of its own before a word or a space and a word, so that such are given to the library
        many to a text, with line breaks between them; the others one by one.
        """
        plain = [len(self.line) == 1 and w.removeprefix(" ").isalnum() for w in words]
        many = [w for w, p in zip(words, plain) if p]
        lines = ["\n".join(many[i : i + _LINES]) + "\n" for i in range(0, len(many), _LINES)]
        single = [w for w, p in zip(words, plain) if not p]
        found = self.library.encode_batch_fast(lines + single, add_special_tokens=False)
        joined = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in found[: len(lines)]] or [np.zeros(0, dtype=np.uint32)])
        others = [np.array(e.ids, dtype=np.uint32) for e in found[len(lines) :]]
        breaks = np.flatnonzero(joined == self.line[0])
        if len(breaks) != len(many):
            raise RuntimeError("the vocabulary doesn't keep line breaks apart")
        sizes = np.concatenate([np.diff(breaks, prepend=-1) - 1, [len(x) for x in others]]).astype(np.int64)
        flat = np.concatenate([np.delete(joined, breaks), *others])
        # Back to the order of ``words``.
        order = np.empty(len(words), dtype=np.int64)
        plain = np.array(plain, dtype=bool)
        order[plain], order[~plain] = np.arange(len(many)), len(many) + np.arange(len(single))
        begin = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        return flat[np.repeat(begin, sizes) + numbers_in(sizes)], sizes

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice, and for each row the number of its ids."""
        starts, ends, row, at, until, signs = pretokens(data, bounds, tuple(self.special))
        distinct, first, each = np.unique(self.rolling.spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > _KNOWN:
            self.forget()
        there = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        new[there < len(self.known)] = self.known[there[there < len(self.known)]] != distinct[there < len(self.known)]
        raw = data.tobytes()
        if new.any():
            fresh = first[new]
            flat, size = self._look_up([raw[i:j].decode() for i, j in zip(starts[fresh].tolist(), ends[fresh].tolist())])
            self.known = np.insert(self.known, there[new], distinct[new])
            self.place = np.insert(self.place, there[new], len(self.begin) + np.arange(len(size)))
            self.begin = np.append(self.begin, len(self.flat) + np.cumsum(size) - size)
            self.size, self.flat = np.append(self.size, size), np.append(self.flat, flat)
            there = np.searchsorted(self.known, distinct)
        numbers = self.place[there][each] if len(distinct) else np.zeros(0, dtype=np.int64)
        begin, size, flat = self.begin, self.size, self.flat
        if len(signs):
            # Special strings stand between pre-tokens, as words of one id.
            ids = np.array([self.special[raw[i:j]] for i, j in zip(at.tolist(), until.tolist())], dtype=np.uint32)
            begin, size = np.append(begin, len(flat) + np.arange(len(ids))), np.append(size, np.ones(len(ids), dtype=np.int64))
            flat = np.append(flat, ids)
            order = np.argsort(np.append(starts, at), kind="stable")
            numbers = np.append(numbers, len(self.begin) + np.arange(len(ids)))[order]
            row = np.append(row, signs)[order]
        lengths = size[numbers]
        ids = flat[np.repeat(begin[numbers], lengths) + numbers_in(lengths)]
        return ids, np.bincount(row, weights=lengths, minlength=len(bounds) - 1).astype(np.int64)


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    """One per worker process, with the words it remembers."""
    return _Encoder(path)


def _piece_rows(tokenizer: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = _encoder(tokenizer), np.zeros(capacity + 1, dtype=np.int64)
        part, tail = TaskContext.get().partitionId(), np.uint32(end_id).tobytes()
        for batch in batches:
            for rows, data, bounds in text_slices(batch, "text", _SLICE):
                ids, total = encoder.encode(data, bounds)
                ends = np.cumsum(total)
                raw = ids.astype("<u4").tobytes()
                source, piece, start, length, crc = [], [], [], [], []
                for k, (end, n) in enumerate(zip(ends.tolist(), total.tolist())):
                    own = raw[4 * (end - n) : 4 * end] + tail
                    n, at, number = n + 1, 0, 0
                    while at < n:
                        until = at + ((n - at - 1) % capacity + 1)
                        source.append(k), piece.append(number), start.append(at), length.append(until - at)
                        crc.append(zlib.crc32(own[4 * at : 4 * until]))
                        at, number = until, number + 1
                sizes = np.array(length, dtype=np.int64)
                order = np.argsort(sizes, kind="stable")
                rank = np.empty(len(sizes), dtype=np.int64)
                per = np.bincount(sizes, minlength=capacity + 1)
                rank[order] = numbers_in(per[per > 0]) + seen[sizes[order]]
                seen += per
                columns = [
                    rows.column(0).take(pa.array(source, type=pa.int64())),
                    pa.array(piece, type=pa.int32()),
                    pa.array(start, type=pa.int64()),
                    pa.array(sizes),
                    pa.array(crc, type=pa.int64()),
                    pa.array(np.full(len(sizes), part, dtype=np.int32)),
                    pa.array(rank),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return run


def _fullest(left: dict[int, int], room: int) -> dict[int, int]:
    """The combination of the lengths left that fills most of ``room``, long ones first."""
    sums, within, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in left if x <= room and left[x]), reverse=True):
        steps.append((length, sums))
        for _ in range(min(left[length], room // length)):
            more = (sums | sums << length) & within
            if more == sums:
                break
            sums = more
        if sums >> room & 1:
            break
    target, taken = sums.bit_length() - 1, {}
    for length, before in reversed(steps):
        used = 0
        while not before >> target & 1:
            target, used = target - length, used + 1
        if used:
            taken[length] = used
    return taken


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how many sequences each fills, for a histogram of lengths."""
    left, out = {x: n for x, n in lengths.items() if n}, []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        taken = Counter(_fullest(rest, capacity - longest)) + Counter([longest])
        times = min(left[x] // n for x, n in taken.items())
        out.append((dict(taken), times))
        for x, n in taken.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return out


def _slots(combinations: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset) in order: ranks from the first on go to sequences from that on."""
    rows, rank, sequence = [], Counter(), 0
    for taken, times in combinations:
        offset = 0
        for length in sorted(taken, reverse=True):
            for _ in range(taken[length]):
                rows.append((length, rank[length], sequence, offset))
                rank[length] += times
                offset += length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens, with a part and a rank that number the pieces of a length."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(lean(_piece_rows(tokenizer, capacity, end_id)), schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id and offset.

    A document is its ids by the tokenizers library (``tokenizer``: path of a byte-level BPE file, on every worker),
    without special tokens added, then ``end_id``. One longer than ``capacity`` is cut; its first piece takes what whole
    pieces leave. Offsets within a sequence run from 0 without gaps. A null text is empty: a piece with ``end_id`` alone.
    Each row is a document of its own, whatever its id. No rows give no rows.
    """
    cut = settled(pieces(docs, tokenizer, capacity, end_id, id_col, text_col))
    parts = settled(cut.groupBy("length", "part").agg(F.count("*").alias("n")))
    # At most ``capacity`` rows.
    lengths = {r.length: r.n for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(plan(lengths, capacity))
    keys = slots[:, 0] << 44 | slots[:, 1]
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = settled(parts.select("length", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            sequence = slots[at, 2] + rank - slots[at, 1]
            columns = [*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(slots[at, 3])]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = cut.join(bases, ["length", "part"])
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return ranked.mapInArrow(lean(place), schema).withColumnRenamed("id", id_col)

"""Keyed state for streams: one processor per kind of state.

Spark hands a processor the micro-batch rows of one key in no promised order, so
each sorts them by the order columns. A key's share of a micro-batch is in one
task; bound the micro-batch (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``)
where one key is very frequent.
"""

from __future__ import annotations

import heapq
import pickle
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import timezone
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Python workers get these classes by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a key that are sorted together, rows of such a run that are pickled together, and rows of a block.
RUN_ROWS = 1 << 14
PIECE_ROWS = 1 << 8
BLOCK_ROWS = 1 << 10
# Rows, or bytes, that a task divides among the shares of keys at once.
PACK_ROWS, PACK_BYTES = 1 << 17, 1 << 26


def in_blocks(rows: Iterable[Row], kind: pa.ListType) -> Iterator[Row]:
    """Rows as blocks: each a row whose ``rows`` is a list of them, an Arrow scalar of the type ``kind``.

    Spark's worker holds all that comes out for a key as Python objects until the key ends; blocks are Arrow's by then.
    """
    rows, block = iter(rows), Row("rows")
    while held := [row.asDict(True) for row in islice(rows, BLOCK_ROWS)]:
        ends = pa.array([0, len(held)], pa.int32())
        yield block(pa.ListArray.from_arrays(ends, pa.array(held, kind.value_type), type=kind)[0])


class Ordered(StatefulProcessor):
    """Feeds rows to ``on_row`` in arrival order."""

    def __init__(self, order: Sequence[str], columns: Sequence[str]):
        self.order = list(order)
        self.columns = list(columns)

    def in_order(self, rows: Iterable[Row]) -> Iterable[Row]:
        """The rows of a key, sorted. Of more than a run of them, sorted runs wait as bytes, and are merged piece by piece."""

        def place(row):
            return tuple(row[c] for c in self.order)

        def unpacked(pieces):
            for piece in pieces:
                yield from (out(*values) for values in pickle.loads(piece))

        rows = iter(rows)
        run, packed = sorted(islice(rows, RUN_ROWS), key=place), []
        if len(run) < RUN_ROWS:
            return run
        out = Row(*run[0].__fields__)
        while run:
            packed.append([pickle.dumps([tuple(r) for r in run[k : k + PIECE_ROWS]]) for k in range(0, len(run), PIECE_ROWS)])
            run = sorted(islice(rows, RUN_ROWS), key=place)
        return heapq.merge(*map(unpacked, packed), key=place)

    def keep(self, row: Row) -> tuple:
        return tuple(row[c] for c in self.columns)

    def close(self) -> None:
        pass


class StepProcessor(Ordered):
    """One state tuple per key; ``step(state, row) -> (state, extra columns or None)``.

    The output is the row's own columns plus the extra ones, in blocks of the Arrow type ``kind`` if there is one; None emits
    nothing. A key's row of an initial state holds the state tuple in the columns ``held``.
    """

    def __init__(self, order, columns, state_schema: str, names: Sequence[str], step: Callable, held: Sequence[str] = (), kind: pa.ListType | None = None):
        super().__init__(order, columns)
        self.kind = kind
        self.state_schema = state_schema
        self.fields = list(columns) + list(names)
        self.step = step
        self.held = list(held)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", self.state_schema)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update(tuple(initialState[c] for c in self.held))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        return self._steps(rows) if self.kind is None else in_blocks(self._steps(rows), self.kind)

    def _steps(self, rows) -> Iterator[Row]:
        # None without a state: to ask for it first would be another call.
        state, out = self.state.get(), Row(*self.fields)
        for row in self.in_order(rows):
            state, extra = self.step(state, row)
            if extra is not None:
                yield out(*self.keep(row), *extra)
        self.state.update(tuple(state))


class Context:
    """What user code may do for a key: emit rows, set and cancel timers, read the clock."""

    def __init__(self, handle: StatefulProcessorHandle, now: int | None):
        self.handle = handle
        self.now = now
        self.rows: list[tuple] = []
        self.set: set[int] = set()

    def emit(self, tag: str, *values) -> None:
        self.rows.append((tag, *values))

    def register(self, at_ms: int) -> None:
        """Once is enough: rows that ask for the same timer again cost no call."""
        if at_ms not in self.set:
            self.handle.registerTimer(at_ms)
            self.set.add(at_ms)

    def cancel(self, at_ms: int) -> None:
        self.set.discard(at_ms)
        self.handle.deleteTimer(at_ms)


class UserProcessor(Ordered):
    """``on_row`` for each row of a key and ``on_timer`` for each timer due, over one state tuple."""

    def __init__(self, order, keys: Sequence[str], state_schema: str, names: Sequence[str], on_row, on_timer, clock: str):
        super().__init__(order, keys)
        self.state_schema = state_schema
        self.fields = [*keys, "tag", *names]
        self.on_row = on_row
        self.on_timer = on_timer
        self.clock = clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.state_schema)

    def _context(self, timer_values) -> Context:
        if self.clock == "eventTime":
            now = timer_values.getCurrentWatermarkInMs()
        else:
            now = timer_values.getCurrentProcessingTimeInMs() if self.clock == "processingTime" else None
        return Context(self.handle, now)

    def _held(self):
        return self.state.get()

    def _keep(self, state) -> None:
        if state is None:
            self.state.clear()
        else:
            self.state.update(tuple(state))

    def _out(self, key: tuple, context: Context) -> Iterator[Row]:
        if context.rows:
            out = Row(*self.fields)
            for row in context.rows:
                yield out(*key, *row)
            context.rows.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state, context = self._held(), self._context(timerValues)
        for row in self.in_order(rows):
            state = self.on_row(context, state, row)
            yield from self._out(tuple(key), context)
        self._keep(state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        context = self._context(timerValues)
        self._keep(self.on_timer(context, self._held(), expiredTimerInfo.getExpiryTimeInMs()))
        yield from self._out(tuple(key), context)


def packed(share: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: the rows of each share, as ``rows``: the bytes of an Arrow batch without the column ``share``."""

    def pack(batches):
        held, size, nbytes = [], 0, 0
        for batch in batches:
            held, size, nbytes = [*held, batch], size + batch.num_rows, nbytes + batch.nbytes
            if size >= PACK_ROWS or nbytes >= PACK_BYTES:
                yield _by_share(pa.Table.from_batches(held), share)
                held, size, nbytes = [], 0, 0
        if size:
            yield _by_share(pa.Table.from_batches(held), share)

    return pack


def _by_share(table: pa.Table, share: str) -> pa.RecordBatch:
    numbers = table.column(share).to_numpy()
    place = np.argsort(numbers, kind="stable")
    numbers, rows = numbers[place], table.drop_columns([share]).take(place)
    starts = np.flatnonzero(np.diff(numbers, prepend=numbers[0] - 1))
    parts = [_bytes(rows.slice(a, b - a)) for a, b in zip(starts, [*starts[1:], len(numbers)])]
    return pa.record_batch([pa.array(numbers[starts], pa.int32()), pa.array(parts, pa.binary())], names=["share", "rows"])


def _bytes(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as stream:
        for batch in table.combine_chunks().to_batches():
            stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _table(held: bytes) -> pa.Table:
    return pa.ipc.open_stream(held).read_all()


def _local(value):
    """A value as state gives it back: times have no time zone, and are those of the local clock."""
    if isinstance(value, Row):
        value = value.asDict()
    if isinstance(value, dict):
        return {k: _local(v) for k, v in value.items()}
    if isinstance(value, list | tuple):
        return type(value)(map(_local, value))
    return value.astimezone().replace(tzinfo=None) if getattr(value, "tzinfo", None) else value


def _given(value):
    """A value of an Arrow batch as state gives it back: times as ``_local`` has them, and structs as rows."""
    return _as_rows(_local(value))


def _as_rows(value):
    if isinstance(value, dict):
        row = tuple.__new__(Row, map(_as_rows, value.values()))
        row.__fields__ = list(value)
        return row
    return type(value)(map(_as_rows, value)) if isinstance(value, list | tuple) else value


def _timed(kind: pa.DataType) -> bool:
    return "timestamp" in str(kind)


def _one(value):
    """A part of a key so that equal ones are one in a dict: as Spark groups, a NaN is like another, and -0.0 is 0.0."""
    if isinstance(value, float):
        return _NAN if value != value else value + 0.0
    if isinstance(value, list):
        return tuple(map(_one, value))
    if isinstance(value, dict):
        return tuple((k, _one(v)) for k, v in value.items())
    return value.astimezone(timezone.utc).replace(tzinfo=None) if getattr(value, "tzinfo", None) else value


_NAN = float("nan")


class ReorderProcessor(UserProcessor):
    """As ``UserProcessor``, with rows held in state until the watermark passes their time.

    It works on shares of the keys, as ``packed`` gives them: a call to the state, of which there are about ten for a share
    in a micro-batch, takes longer than a row does. ``held`` has the rows that wait, in Arrow batches with the least and
    the greatest time in them; ``kept``, an Arrow batch too, the state of each key and the user's timers.

    A timer at the earliest time held releases what the watermark has passed, rows and the user's own timers in the order
    of time (a timer after the rows of its time). Rows whose time it had passed already go to ``on_late``.
    """

    def __init__(self, order, keys, columns, time_ms: str, on_late, kept: pa.Schema, kind: pa.ListType, *args):
        super().__init__(order, keys, *args, "eventTime")
        self.keys = list(keys)
        self.held_columns = list(columns)
        self.time_ms = time_ms
        self.on_late = on_late
        self.kept_schema = kept
        self.kind = kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "low bigint, high bigint, rows binary")
        self.kept = handle.getValueState("kept", "kept binary")
        # Shares whose rows have been released in this micro-batch: of several timers the first has done it all.
        self.released: set = set()

    def _keys(self, columns: Sequence[pa.ChunkedArray]) -> list[tuple]:
        plain = [c.to_pylist() for c in columns]
        for i, c in enumerate(columns):
            if pa.types.is_floating(c.type) or pa.types.is_nested(c.type) or _timed(c.type):
                plain[i] = list(map(_one, plain[i]))
        return list(zip(*plain))

    def _load(self) -> dict[tuple, tuple]:
        """(state, the user's timers) of each key that has any."""
        found = self.kept.get()
        if found is None:
            return {}
        table, n = _table(found[0]), len(self.keys)
        due, given, *parts = (c.combine_chunks() for c in table.columns[n:])
        times, ends = due.values.to_pylist(), due.offsets.to_pylist()
        states = zip(*(map(_as_rows, c.to_pylist()) if pa.types.is_nested(c.type) else c.to_pylist() for c in parts))
        rows = zip(self._keys(table.columns[:n]), given.to_pylist(), states, ends, ends[1:])
        return {key: (state if there else None, times[a:b]) for key, there, state, a, b in rows}

    def _save(self, kept: dict[tuple, tuple]) -> None:
        kept = {key: held for key, held in kept.items() if held[0] is not None or held[1]}
        if not kept:
            self.kept.clear()
            return
        n, none = len(self.keys), (None,) * (len(self.kept_schema) - len(self.keys) - 2)
        ends = np.cumsum([0, *(len(due) for _, due in kept.values())])
        due = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array([t for _, due in kept.values() for t in due], pa.int64()), type=self.kept_schema.field("due").type)
        columns = list(zip(*(none if state is None else state for state, _ in kept.values()), strict=True))
        kinds = self.kept_schema.types
        columns = [map(_local, c) if _timed(kind) or pa.types.is_nested(kind) else c for c, kind in zip(columns, kinds[n + 2 :], strict=True)]
        arrays = [pa.array(list(c), kind) for c, kind in zip(zip(*kept), kinds)]
        arrays += [due, pa.array([state is not None for state, _ in kept.values()])]
        arrays += [pa.array(list(c), kind) for c, kind in zip(columns, kinds[n + 2 :])]
        self.kept.update((_bytes(pa.Table.from_arrays(arrays, schema=self.kept_schema)),))

    def _blocks(self, rows: list[tuple]) -> Iterator[Row]:
        kinds = list(self.kind.value_type)
        if any(pa.types.is_nested(f.type) for f in kinds):
            out = Row(*self.fields)
            yield from in_blocks((out(*r) for r in rows), self.kind)
            return
        block = Row("rows")
        for k in range(0, len(rows), BLOCK_ROWS):
            columns = zip(*rows[k : k + BLOCK_ROWS], strict=True)
            part = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], fields=kinds)
            yield block(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part, type=self.kind)[0])

    def _rows(self, table: pa.Table, columns: Sequence[str], given: Callable = lambda value: value) -> Iterator[Row]:
        """Rows as Spark makes them, their times and what is nested as ``given`` gives it."""
        fields, new = list(columns), tuple.__new__
        plain = [table.column(c).to_pylist() for c in fields]
        kinds = [table.schema.field(c).type for c in fields]
        plain = [list(map(given, held)) if _timed(kind) or pa.types.is_nested(kind) else held for kind, held in zip(kinds, plain)]
        for values in zip(*plain):
            row = new(Row, values)
            row.__fields__ = fields
            yield row

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        table = pa.concat_tables([_table(row["rows"]) for row in rows])
        times = table.column(self.time_ms)
        late = pc.fill_null(pc.less(times, mark), True)
        if self.on_late and pc.any(late).as_py():
            yield from self._late(table.filter(late), mark)
        fresh = table.filter(pc.invert(late))
        if fresh.num_rows:
            self._wait([self._run(fresh)])

    def _run(self, rows: pa.Table) -> tuple:
        span = pc.min_max(rows.column(self.time_ms)).as_py()
        return span["min"], span["max"], _bytes(rows)

    def _wait(self, runs: list[tuple]) -> None:
        self.held.appendList(runs)
        self.handle.registerTimer(min(low for low, _, _ in runs))

    def _late(self, table: pa.Table, mark: int) -> Iterator[Row]:
        kept, found, asked = self._load(), {}, set()
        for key, row in zip(self._keys([table.column(c) for c in self.keys]), self._rows(table, table.column_names)):
            found.setdefault(key, []).append(row)
        for key, rows in found.items():
            context, (state, due) = Waiting(self.handle, mark), kept.get(key, (None, []))
            for row in self.in_order(rows):
                state = self.on_late(context, state, row)
            kept[key] = state, sorted({*due, *context.asked})
            asked |= context.asked
            yield from self._blocks([(*key, *values) for values in context.rows])
        self._save(kept)
        if asked:
            self.handle.registerTimer(min(asked))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if key in self.released:
            return
        self.released.add(key)
        mark = timerValues.getCurrentWatermarkInMs()
        ready, rest, due = [], [], {}
        runs = list(self.held.get())
        for run in runs:
            if run[0] >= mark:
                rest.append(run)
                continue
            table = _table(run[2])
            passed = pc.less(table.column(self.time_ms), mark)
            ready.append(table.filter(passed))
            if run[1] >= mark:
                rest.append(self._run(table.filter(pc.invert(passed))))
        kept = self._load()
        if ready:
            due = self._by_key(pa.concat_tables(ready))
        for own, (_, timers) in kept.items():
            if timers and timers[0] < mark:
                due.setdefault(own, [])
        out = []
        for own, rows in due.items():
            kept[own] = self._release(own, rows, *kept.get(own, (None, [])), mark, out)
        yield from self._blocks(out)
        if due:
            self._save(kept)
        if ready:
            self.held.put(rest) if rest else self.held.clear()
        waiting = [run[0] for run in rest] + [timers[0] for _, timers in kept.values() if timers]
        if waiting:
            self.handle.registerTimer(min(waiting))

    def _by_key(self, table: pa.Table) -> dict[tuple, list[Row]]:
        """The rows of each key, by time, then by the order columns, then as they came."""
        keys, rows = self._keys([table.column(c) for c in self.keys]), list(self._rows(table, self.held_columns, _given))
        orders = [table.column(c).to_pylist() for c in (self.time_ms, *self.order)]
        places, found = list(zip(*orders)), {}
        for i in sorted(range(len(rows)), key=places.__getitem__):
            found.setdefault(keys[i], []).append(rows[i])
        return found

    def _release(self, key: tuple, rows: list[Row], state, due: list[int], mark: int, out: list[tuple]) -> tuple:
        """Runs the user's code for a key; the state and the timers it leaves."""
        context, timers = Waiting(self.handle, None), set(due)
        ahead = [t for t in due if t < mark]
        heapq.heapify(ahead)
        at = self.held_columns.index(self.time_ms)
        rows = iter(rows)
        row = next(rows, None)
        while row is not None or ahead:
            if ahead and (row is None or ahead[0] < row[at]):
                now = heapq.heappop(ahead)
                if now in context.dropped:
                    continue
                context.now = now
                timers.discard(now)
                state = self.on_timer(context, state, now) if self.on_timer else state
            else:
                context.now = row[at]
                state = self.on_row(context, state, row)
                row = next(rows, None)
            for t in context.take_new() if context.fresh else ():
                if t < mark and t not in timers:
                    heapq.heappush(ahead, t)
                timers.add(t)
        out += [(*key, *values) for values in context.rows]
        return state, sorted(timers - context.dropped)


class Waiting(Context):
    """A context whose timers wait with the rows that are held."""

    def __init__(self, handle: StatefulProcessorHandle, now: int | None):
        super().__init__(handle, now)
        self.asked: set[int] = set()
        self.dropped: set[int] = set()
        self.fresh: list[int] = []

    def register(self, at_ms: int) -> None:
        self.asked.add(at_ms)
        self.dropped.discard(at_ms)
        self.fresh.append(at_ms)

    def cancel(self, at_ms: int) -> None:
        self.dropped.add(at_ms)

    def take_new(self) -> list[int]:
        new, self.fresh = self.fresh, []
        return new


class TopProcessor(Ordered):
    """The n highest values of a key, in list state."""

    def __init__(self, order, columns, value: str, value_type: str, n: int):
        super().__init__(order, columns)
        self.value = value
        self.value_type = value_type
        self.n = n

    def init(self, handle) -> None:
        self.best = handle.getListState("best", f"v {self.value_type}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = [t[0] for t in self.best.get()] if self.best.exists() else []
        for row in self.in_order(rows):
            if row[self.value] is not None:
                best = sorted([*best, row[self.value]], reverse=True)[: self.n]
            yield Row(**dict(zip([*self.columns, "top"], [*self.keep(row), list(best)])))
        if best:
            self.best.put([(v,) for v in best])


class ValueCountProcessor(Ordered):
    """Count per value of a key, in map state; emits the entry a row changed."""

    def __init__(self, order, columns, value: str, value_type: str):
        super().__init__(order, columns)
        self.value = value
        self.value_type = value_type

    def init(self, handle) -> None:
        self.counts = handle.getMapState("counts", f"v {self.value_type}", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # Each value is read from and written to the store once per micro-batch.
        counts: dict = {}
        for row in self.in_order(rows):
            value = row[self.value]
            if value not in counts:
                counts[value] = self.counts.getValue((value,))[0] if self.counts.containsKey((value,)) else 0
            counts[value] += 1
            yield Row(**dict(zip([*self.columns, "cnt"], [*self.keep(row), counts[value]])))
        for value, n in counts.items():
            self.counts.updateValue((value,), (n,))


class CountWindowProcessor(Ordered):
    """Count windows: the last ``size`` values in list state and a row counter.

    Fires at every ``step``-th row; ``whole`` holds back windows with fewer rows.
    """

    def __init__(self, order, columns, keys, value: str, value_type: str, size: int, step: int, whole: bool):
        super().__init__(order, columns)
        self.keys = list(keys)
        self.value = value
        self.value_type = value_type
        self.size = size
        self.step = step
        self.whole = whole

    def init(self, handle) -> None:
        self.recent = handle.getListState("recent", f"v {self.value_type}")
        self.seen = handle.getValueState("seen", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        recent = [t[0] for t in self.recent.get()] if self.recent.exists() else []
        seen = self.seen.get()[0] if self.seen.exists() else 0
        for row in self.in_order(rows):
            seen += 1
            recent = [*recent, row[self.value]][-self.size :]
            if seen % self.step == 0 and (len(recent) == self.size or not self.whole):
                at = [row[k] for k in self.keys]
                yield Row(**dict(zip([*self.keys, "firing", "elements"], [*at, seen // self.step, list(recent)])))
        self.recent.put([(v,) for v in recent])
        self.seen.update((seen,))


class TtlProcessor(Ordered):
    """The value before a row, forgotten ``ttl_ms`` of processing time after its last write.

    With ``refresh`` a read writes the value back and so prolongs it; only rows with
    the ``write`` column true then replace it.
    """

    def __init__(self, order, columns, value: str, value_type: str, ttl_ms: int, refresh: bool, write: str | None):
        super().__init__(order, columns)
        self.value = value
        self.value_type = value_type
        self.ttl_ms = ttl_ms
        self.refresh = refresh
        self.write = write

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", f"v {self.value_type}", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in self.in_order(rows):
            held = self.last.get() if self.last.exists() else None
            value = held[0] if held else None
            yield Row(**dict(zip([*self.columns, "last_vc"], [*self.keep(row), value])))
            if self.write is None or row[self.write]:
                self.last.update((row[self.value],))
            elif self.refresh and held:
                self.last.update((value,))


class TimerProcessor(Ordered):
    """An event-time timer at a fixed time; rows register it, and it fires once passed."""

    def __init__(self, keys: Sequence[str], at_ms: int, refire: bool):
        super().__init__([], [])
        self.keys = list(keys)
        self.at_ms = at_ms
        self.refire = refire

    def init(self, handle) -> None:
        self.handle = handle
        self.fired = handle.getValueState("fired", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for _ in rows:
            pass
        if self.refire or not self.fired.exists():
            self.handle.registerTimer(self.at_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n = (self.fired.get()[0] if self.fired.exists() else 0) + 1
        self.fired.update((n,))
        at = expiredTimerInfo.getExpiryTimeInMs()
        yield Row(**dict(zip([*self.keys, "fired_at_ms", "firing"], [*key, at, n])))

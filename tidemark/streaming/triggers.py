"""Windows over all rows of a key, fired and emptied by triggers with a state of their own.

A trigger is asked at each row, and at each of its timers, whether the window fires and whether it is emptied. It keeps a
number per key, and sets timers by the clock that it names.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, types as T

from tidemark.streaming import keyed

# Python workers get the triggers by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GO_ON, FIRE, PURGE, FIRE_AND_PURGE = (False, False), (True, False), (False, True), (True, True)


class Trigger:
    """Subclasses say what happens at a row and at a timer: an action, and the number to keep."""

    clock = "none"

    def on_row(self, context, held: int, time_ms: int | None) -> tuple[tuple[bool, bool], int]:
        return GO_ON, held

    def on_timer(self, context, held: int, at_ms: int) -> tuple[tuple[bool, bool], int]:
        return GO_ON, held


@dataclass
class Count(Trigger):
    """Fires at every ``n``-th row."""

    n: int

    def on_row(self, context, held, time_ms):
        return (FIRE, 0) if held + 1 >= self.n else (GO_ON, held + 1)


@dataclass
class EventTime(Trigger):
    """Fires when the event time passes the end of a span of ``every_ms`` in which a row was."""

    every_ms: int
    clock = "eventTime"

    def on_row(self, context, held, time_ms):
        context.register(time_ms - time_ms % self.every_ms + self.every_ms)
        return GO_ON, held

    def on_timer(self, context, held, at_ms):
        return FIRE, held


@dataclass
class Clock(Trigger):
    """Fires ``every_ms`` of processing time after the first row since the last firing."""

    every_ms: int
    clock = "processingTime"

    def on_row(self, context, held, time_ms):
        if not held:
            held = context.now + self.every_ms
            context.register(held)
        return GO_ON, held

    def on_timer(self, context, held, at_ms):
        return FIRE, 0


@dataclass
class Purging(Trigger):
    """Empties the window whenever the other trigger fires it."""

    other: Trigger

    @property
    def clock(self):
        return self.other.clock

    def on_row(self, context, held, time_ms):
        (fire, purge), held = self.other.on_row(context, held, time_ms)
        return (fire, purge or fire), held

    def on_timer(self, context, held, at_ms):
        (fire, purge), held = self.other.on_timer(context, held, at_ms)
        return (fire, purge or fire), held


def trigger_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    trigger: Trigger,
    window: str,
    create: Callable[[], tuple],
    add: Callable[[tuple, object], tuple],
    time_ms: str | None = None,
) -> DataFrame:
    """(keys, ``firing``, the columns of ``window``) for each firing of a key's window, numbered from 1.

    ``create()`` is an empty window, ``add(held, row)`` one with another row; both are tuples of the ``window`` columns. An
    event-time trigger needs ``time_ms``, the column of a row's time, and a watermark: rows are then taken in the order
    of time, as the watermark passes them, and those that come later than it are left out.
    """
    if trigger.clock == "eventTime" and not time_ms:
        raise ValueError("an event-time trigger needs time_ms")
    names = T._parse_datatype_string(window).fieldNames()
    if time_ms and trigger.clock != "eventTime":
        time_ms = None

    def done(context, action, held, firing, content):
        fire, purge = action
        if fire:
            firing += 1
            context.emit("fire", firing, *content)
        return (held, firing, *(create() if purge else content))

    def parts(state):
        return (state[0], state[1], tuple(state[2:])) if state else (0, 0, tuple(create()))

    def on_row(context, state, row):
        held, firing, content = parts(state)
        content = add(content, row)
        action, held = trigger.on_row(context, held, row[time_ms] if time_ms else None)
        return done(context, action, held, firing, content)

    def on_timer(context, state, at_ms):
        held, firing, content = parts(state)
        action, held = trigger.on_timer(context, held, at_ms)
        return done(context, action, held, firing, content)

    kept = f"held bigint, firing bigint, {window}"
    run = keyed.process(df, keys, order, kept, f"firing bigint, {window}", on_row, on_timer, trigger.clock, time_ms)
    return run.select(*keys, "firing", *names)

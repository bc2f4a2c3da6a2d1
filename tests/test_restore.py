"""State of stopped streams, dealt to another number of shares."""

import datetime
import decimal
import os

import pyarrow as pa
import pytest
from pyspark.sql import Row, functions as F

from tests.conftest import rows
from tidemark.operators.scan import running_count, running_max, running_sum
from tidemark.streaming import folds, keyed, processors, restore, runs

SCHEMA = "share bigint, at bigint, vc int"


def halves(old, new, n=40):
    """Rows of ``old`` shares, then of ``new`` ones."""
    middle = n // 2
    first = [(i % old, i, None if i % 5 == 0 else i * 7 % 31) for i in range(middle)]
    return first, [(i % new, i, None if i % 5 == 0 else i * 7 % 31) for i in range(middle, n)]


def grouped(data, size=10):
    return [data[i : i + size] for i in range(0, len(data), size)]


def counts(data, begin):
    seen, out = dict(begin), []
    for share, at, _ in data:
        seen[share] = seen.get(share, 0) + 1
        out.append((share, at, seen[share]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("old, new, whole", [(4, 7, False), (7, 4, False), (3, 2, True)])
def test_counts_go_on_with_other_shares(spark, stream_of, tmp_path, old, new, whole):
    first, rest = halves(old, new)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", min(old, 2))
        stopped = keyed.running_count(stream_of(SCHEMA, *grouped(first), name="a"), ["share"], ["at"])
        runs.drain_to_table(stopped, "stopped", path=str(tmp_path / "stopped"))
        held = restore.stored_state(spark, str(tmp_path / "stopped" / "checkpoint"))
        mine = {s: sum(1 for r in first if r[0] == s) for s in range(old)}
        assert dict(rows(held)) == mine
        deal = restore.dealt_whole if whole else restore.dealt
        initial = deal(held, "share", new, {"n": F.sum("n")})
        begin = {s: sum(mine.values()) if whole else sum(n for o, n in mine.items() if o % new == s) for s in range(new)}
        assert dict(rows(initial)) == {s: n for s, n in begin.items() if n}
        spark.conf.set("spark.sql.shuffle.partitions", 3)
        resumed = keyed.running_count(stream_of(SCHEMA, *grouped(rest), name="b"), ["share"], ["at"], initial=initial)
        got = runs.drain_to_table(resumed, "resumed")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows(got, "share", "at", "cnt") == counts(rest, begin)


def test_an_initial_state_is_read_once(spark, stream_of, tmp_path):
    """A stream that began from a state, stopped and resumed from its own checkpoint, counts on from there."""
    first, rest = halves(2, 2, 24)
    initial = spark.createDataFrame([(0, 100), (5, 7)], "share int, n int")
    path = str(tmp_path / "table")
    stream = stream_of(SCHEMA, first)
    runs.drain_to_table(keyed.running_count(stream, ["share"], ["at"], initial=initial), "x", path=path)
    spark.createDataFrame(rest, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "late"))
    (part,) = (tmp_path / "late").glob("*.parquet")
    target = tmp_path / "in" / "9999.parquet"
    target.write_bytes(part.read_bytes())
    os.utime(target, (1_800_000_000, 1_800_000_000))
    got = runs.drain_to_table(keyed.running_count(stream, ["share"], ["at"], initial=initial), "x", path=path)
    assert rows(got, "share", "at", "cnt") == counts(first + rest, {0: 100})
    held = restore.stored_state(spark, f"{path}/checkpoint")
    assert dict(rows(held)) == {0: 112, 1: 12, 5: 7}


def test_an_earlier_state_can_be_read(spark, stream_of, tmp_path):
    first, _ = halves(2, 2)
    runs.drain_to_table(keyed.running_count(stream_of(SCHEMA, *grouped(first)), ["share"], ["at"]), "x", path=str(tmp_path / "t"))
    checkpoint = str(tmp_path / "t" / "checkpoint")
    assert restore.last_batch(spark, checkpoint) == 1
    assert dict(rows(restore.stored_state(spark, checkpoint, batch=0))) == {0: 5, 1: 5}
    assert restore.last_batch(spark, str(tmp_path / "nowhere")) is None


def test_dealing_keeps_types_and_holds_nothing_of_nothing(spark):
    held = spark.createDataFrame([(0, 1, None), (1, 2, 5), (4, 3, 9)], "share int, n int, high int")
    merge = {"n": F.sum("n"), "high": F.max("high")}
    for deal in (restore.dealt, restore.dealt_whole):
        got = deal(held, "share", 4, merge)
        assert got.schema.simpleString() == held.schema.simpleString()
        assert deal(held.limit(0), "share", 4, merge).count() == 0
        with pytest.raises(ValueError):
            deal(held, "share", 0, merge)
    assert rows(restore.dealt(held, "share", 4, merge)) == [(0, 4, 9), (1, 2, 5)]
    assert rows(restore.dealt_whole(held, "share", 2, merge)) == [(0, 6, 9), (1, 6, 9)]


@pytest.mark.parametrize("old, new", [(4, 7), (7, 4)])
def test_folds_go_on_with_other_shares(spark, stream_of, tmp_path, old, new):
    first, rest = halves(old, new, 60)
    wanted = {"cnt": running_count(), "total": running_sum(F.col("vc")), "high": running_max(F.col("vc"))}
    at = lambda name: str(tmp_path / name)
    stopped = stream_of(SCHEMA, *grouped(first, 8), name="a")
    with pytest.raises(ValueError):
        folds.stored_folds(stopped, ["share"], ["at"], wanted, at("so"), at("sc"), every=2)
    runs.drain(folds.fold_stream(stopped, ["share"], ["at"], wanted, at("so"), at("sc"), every=2))
    held = folds.stored_folds(stopped, ["share"], ["at"], wanted, at("so"), at("sc"), every=2)
    initial = restore.dealt(held, "share", new, {"cnt": F.sum("cnt"), "total": F.sum("total"), "high": F.max("high")})
    resumed = stream_of(SCHEMA, *grouped(rest, 8), name="b")
    runs.drain(folds.fold_stream(resumed, ["share"], ["at"], wanted, at("ro"), at("rc"), every=2, initial=initial))
    got = spark.read.parquet(at("ro/rows"))
    seen: dict[int, list] = {}
    for share, _, vc in first:
        seen.setdefault(share % new, []).append(vc)
    expected = []
    for share, place, vc in rest:
        values = seen.setdefault(share, [])
        values.append(vc)
        known = [v for v in values if v is not None]
        expected.append((share, place, len(values), sum(known) if known else None, max(known, default=None)))
    assert rows(got, "share", "at", "cnt", "total", "high") == sorted(expected, key=repr)


def test_keys_without_rows_keep_what_they_begin_with(spark, stream_of, tmp_path):
    wanted = {"total": running_sum(F.col("vc"))}
    initial = spark.createDataFrame([(0, 50), (9, 4)], "share bigint, total bigint")
    stream = stream_of(SCHEMA, [(0, 1, 2)], [(1, 2, 3)], [(9, 3, 1)])
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    runs.drain(folds.fold_stream(stream, ["share"], ["at"], wanted, out, checkpoint, initial=initial))
    assert rows(spark.read.parquet(f"{out}/rows"), "share", "total") == [(0, 52), (1, 3), (9, 5)]
    assert rows(folds.stored_folds(stream, ["share"], ["at"], wanted, out, checkpoint)) == [(0, 52), (1, 3), (9, 5)]


@pytest.mark.parametrize("n", [1, 7, 8, 50])
def test_rows_of_a_key_wait_as_bytes(monkeypatch, n):
    """Rows of more than a run are merged in order, ties as they came; few of them are rows at a time."""
    monkeypatch.setattr(processors, "RUN_ROWS", 8)
    monkeypatch.setattr(processors, "PIECE_ROWS", 2)
    made = Row("at", "i", "inner")
    data = [made((k * 7) % 13, k, Row(a=None, b=[k])) for k in range(n)]
    ordered = processors.ValueCountProcessor(["at"], ["at", "i"], "i", "int")
    found = list(ordered.in_order(iter(data)))
    assert found == sorted(data, key=lambda r: r.at) and all(r.inner.b == [r.i] for r in found)
    live, most = [0], 0

    class Held(Row):
        def __del__(self):
            live[0] -= 1

    def come():
        nonlocal most
        for k in range(400):
            live[0] += 1
            most = max(most, live[0])
            yield Held(at=k * 7 % 400, i=k)

    for _ in ordered.in_order(come()):
        most = max(most, live[0])
    assert live[0] <= 1 and most <= 2 * processors.RUN_ROWS + 2


def test_output_of_a_key_comes_in_blocks(monkeypatch):
    """What a key gives is made into Arrow block by block, not held as rows until the key ends."""
    monkeypatch.setattr(processors, "BLOCK_ROWS", 4)
    kind = pa.list_(pa.field("element", pa.struct([pa.field("at", pa.int64()), pa.field("s", pa.string())]), nullable=False))
    data = [Row(at=k, s=None if k % 3 else str(k)) for k in range(10)]
    blocks = [r.rows for r in processors.in_blocks(iter(data), kind)]
    assert [len(b) for b in blocks] == [4, 4, 2] and all(isinstance(b, pa.Scalar) and b.type == kind for b in blocks)
    assert [x for b in blocks for x in b.as_py()] == [r.asDict() for r in data]
    assert not list(processors.in_blocks(iter([]), kind))


def test_steps_of_a_large_key(spark, stream_of):
    """A key of many runs and blocks, with values of several types, some null."""
    schema = "k string, at bigint, d decimal(12,2), ts timestamp, tags array<string>, s struct<a:int,b:string>"
    when = datetime.datetime(2024, 1, 2, 3, 4, 5, 678)
    data = [
        ("a", k * 7919 % 20011, None if k % 5 == 0 else decimal.Decimal(k) / 4, when if k % 3 else None, [str(k), None] if k % 2 else None, (k, None))
        for k in range(20011)
    ]
    data += [("b", 1, None, None, [], None)]
    got = runs.drain_to_table(keyed.running_sum(stream_of(schema, data), ["k"], "d", ["at"]), "large").collect()
    total, want = None, []
    for row in sorted(data[:-1], key=lambda r: r[1]):
        total = row[2] if total is None else total if row[2] is None else total + row[2]
        want.append((*row, total))
    have = sorted((tuple(r) for r in got if r.k == "a"), key=lambda r: r[1])
    assert have == [(*r[:5], Row(a=r[5][0], b=None), r[6]) for r in want]
    assert [tuple(r) for r in got if r.k == "b"] == [("b", 1, None, None, [], None, None)]

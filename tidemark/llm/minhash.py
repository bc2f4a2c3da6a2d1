"""MinHash near-duplicates by bottom-k sketches from one hash function.

A document's set is that of its hashed shingles; documents with equal sets are one class from the start. A class's sketch
is the ``SKETCH`` smallest hashes of its set. Each sketch value retains the list of its classes (the inverted lists), and
overlaps come from there: of a sketch whose overlap with a partner must be ``need``, the size - need + 1 values that occur
in the fewest classes are enough to meet every partner, so that common passages are hardly ever looked up.

A list is not resolved by its pairs. All its classes are tied to its smallest one, the hub; the pair's union sketch
estimates the resemblance, and exact Jaccard on the full sets verifies. What the hubs leave apart, classes of one hub in
different components, is compared among itself in blocks of bounded size, by products of 0/1 matrices of the full sets;
only links that join components come out. Rows grow with the lists, not with their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import Rolling, lean, mixed, settled, text_slices, words

SHINGLE = 3
PERCENT = 85
SKETCH = 64
# Of 64 sketch values, two sets of resemblance 0.85 share fewer than 34 once in 10^9 times, and sets that are more alike
# more rarely; sets whose partners fit into a sketch are held to their exact overlap.
SHARED = 34
# Shingles and classes in a block; salted hubs meet so many classes at a time.
BLOCK_SHINGLES = 1 << 19
BLOCK = 1024
_COLUMNS = 1 << 12

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _sets(data: np.ndarray, bounds: np.ndarray, shingle: int, rolling: tuple[Rolling, Rolling]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; of a row with fewer words the hash of all of them; else none."""
    byte, word = rolling
    data = _LOWER[data]
    starts, ends, first = words(data, bounds)
    hashes = byte.spans(data, starts, ends)
    whole = word.windows(hashes, shingle).view(np.int64)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= shingle:
            yield np.unique(whole[low : high - shingle + 1])
        elif high > low:
            yield word.windows(hashes[low:high], high - low).view(np.int64)
        else:
            yield whole[:0]


def _rolling() -> tuple[Rolling, Rolling]:
    return Rolling(53), Rolling(59)


def _name(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, whatever its order."""
    raw = values.view(np.uint64)
    both = (mixed(raw ^ np.uint64(c)).sum(dtype=np.uint64) for c in (0x9E3779B97F4A7C15, 0x6A09E667F3BCC909))
    return tuple(int(x.view(np.int64)) for x in both)


def _prints(shingle: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = _rolling()
        for batch in batches:
            for rows, data, bounds in text_slices(batch, "text"):
                n, one, two, sketches = [], [], [], []
                for values in _sets(data, bounds, shingle, rolling):
                    a, b = _name(values)
                    n.append(len(values)), one.append(a), two.append(b), sketches.append(values[:size])
                ends = np.cumsum([0, *map(len, sketches)]).astype(np.int32)
                flat = pa.array(np.concatenate(sketches) if sketches else np.zeros(0, dtype=np.int64))
                columns = [pa.array(x, pa.int64()) for x in (n, one, two)]
                sketch = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), *columns, sketch], names=["id", "texthash", "n", "k1", "k2", "sketch"])

    return run


def _full(shingle: int):
    """The full sets of classes, from the text of one of their documents; other texts under its id and hash give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = _rolling()
        for batch in batches:
            for rows, data, bounds in text_slices(batch, "text"):
                named = list(zip(rows.column(2).to_pylist(), rows.column(3).to_pylist()))
                found = [values.tobytes() if _name(values) == own else None for values, own in zip(_sets(data, bounds, shingle, rolling), named)]
                kept = pa.array([x is not None for x in found])
                yield pa.RecordBatch.from_arrays([rows.column(1).filter(kept), pa.array(found, pa.binary()).filter(kept)], names=["cls", "values"])

    return run


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if not len(a) or not len(b):
        return 0
    return int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())


def _linked(common: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int, percent: int):
    return 100 * common >= percent * (a + b - common)


def _verified(percent: int):
    """Rows of a hub and a salt: first the hub's own set, then those it is compared with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            hubs, classes, out = batch.column(0).to_pylist(), batch.column(2).to_pylist(), []
            for k, (hub, cls) in enumerate(zip(hubs, classes)):
                values = np.frombuffer(batch.column(3)[k].as_buffer(), dtype=np.int64)
                if hub == cls:
                    now, held = hub, values
                elif hub == now and _linked(_common(held, values), len(held), len(values), percent):
                    out.append((hub, cls))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of all sets of ``left`` with all of ``right``."""
    values, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    often = np.bincount(place, minlength=len(values)) > 1
    number = np.cumsum(often) - 1
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    row, place = row[often[place]], number[place[often[place]]]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for low in range(0, int(often.sum()), _COLUMNS):
        a, b = np.searchsorted(place, (low, low + _COLUMNS))
        part = np.zeros((len(left) + len(right), _COLUMNS), dtype=np.float32)
        part[row[a:b], place[a:b] - low] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return np.rint(out).astype(np.int64)


def _joined(percent: int):
    """Links that join components, between the classes of two blocks of a hub (or within one)."""

    def run(table: pa.Table) -> pa.Table:
        side = table.column("block").to_numpy()
        cls, label = table.column("cls").to_numpy(), table.column("label").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in table.column("values").combine_chunks()]
        low, high = int(table.column("i")[0].as_py()), int(table.column("j")[0].as_py())
        left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
        out = []
        if len(left) and len(right):
            size = np.array([len(s) for s in sets])
            common = _overlaps([sets[k] for k in left], [sets[k] for k in right])
            near = _linked(common, size[left][:, None], size[right][None, :], percent)
            near &= label[left][:, None] != label[right][None, :]
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while parent.get(x, x) != x:
                    x = parent[x]
                return x

            for k in np.flatnonzero(near.any(axis=1)):
                partners = right[np.flatnonzero(near[k])]
                for p in partners[np.unique(label[partners], return_index=True)[1]]:
                    a, b = root(int(label[left[k]])), root(int(label[p]))
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        out.append((int(cls[left[k]]), int(cls[p])))
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return run


def candidates(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(hub, cls), settled: classes (cls, sketch) that share one of their rarest retained values, by the list's smallest."""
    size = F.size("sketch")
    need = F.when(100 * size <= percent * SKETCH, F.ceil(size * percent / 100)).otherwise(SHARED).cast("int")
    retained = classes.select("cls", need.alias("need"), F.explode("sketch").alias("value"))
    shared = settled(retained.groupBy("value").agg(F.count("*").alias("n")).where("n > 1"))
    met = retained.join(shared, "value").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("met"), F.max("need").alias("need"))
    # Values of one class alone come first among the rarest, and are not in ``met``.
    rare = met.where(F.size("met") >= F.col("need")).select("cls", F.explode(F.slice("met", 1, F.size("met") - F.col("need") + 1)).alias("m"))
    lists = settled(rare.select("cls", F.col("m.value").alias("value")))
    hubs = lists.groupBy("value").agg(F.min("cls").alias("hub"))
    return settled(lists.join(hubs, "value").where("hub < cls").select("hub", "cls").distinct())


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of which the union's sketch is shared in a part of at least SHARED of SKETCH values."""
    a, b = (classes.select(F.col("cls").alias(f"c_{x}"), F.col("sketch").alias(x)) for x in "ab")
    met = pairs.join(b, F.col("cls") == F.col("c_b")).join(a, F.col("hub") == F.col("c_a"))
    union = F.slice(F.array_sort(F.array_union("a", "b")), 1, SKETCH)
    both = F.size(F.array_intersect(union, F.array_intersect("a", "b")))
    return met.where(both * SKETCH >= F.size(union) * SHARED).select("hub", "cls")


def _hub_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, cls) that exact Jaccard verifies."""
    salts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("salts"))
    members = pairs.join(salts, "hub").select("hub", F.expr("pmod(xxhash64(cls), salts)").cast("int").alias("salt"), "cls")
    own = salts.select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("hub").alias("cls"))
    rows = own.unionByName(members).join(sets, "cls").select("hub", "salt", "cls", "values")
    rows = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.col("cls") != F.col("hub"))
    return rows.mapInArrow(lean(_verified(percent)), "a bigint, b bigint")


def _rest_links(pairs: DataFrame, classes: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes of one hub that are in different components so far."""
    named = pairs.join(labels, F.col("cls") == F.col("node"), "left").select("hub", "cls", F.coalesce("root", "cls").alias("label"))
    named = named.join(classes.select("cls", "n"), "cls")
    apart = named.groupBy("hub").agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK)).cast("int").alias("blocks"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
    )
    rest = named.join(apart.where("low <> high"), "hub")
    rest = rest.withColumn("block", F.expr("pmod(xxhash64(cls), blocks)").cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select("hub", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cls", "label", "block")
    return rest.join(sets, "cls").groupBy("hub", "i", "j").applyInArrow(_joined(percent), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles`` (of its set), ``component_id`` (the smallest id it is linked to).

    Two documents are linked if their sets share ``percent`` of their union at least. Words are runs of bytes other than
    space and tab to carriage return, A to Z in lower case. A null or blank text has an empty set and is linked with
    nothing. Rows may repeat; a null id is a component's only where that has no other. Other columns are not looked at.
    ``percent`` below 85 is refused: the overlap that sketches are held to is not proven for it.
    """
    if not PERCENT <= percent <= 100:
        raise ValueError(f"percent is {PERCENT} to 100")
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, texthash bigint, n bigint, k1 bigint, k2 bigint, sketch array<bigint>"
    prints = texts.select("id", "text", F.xxhash64("text")).mapInArrow(lean(_prints(shingle, SKETCH)), schema)
    prints = settled(prints.withColumn("row", F.monotonically_increasing_id()))
    named = settled(prints.where("n > 0").groupBy("k1", "k2").agg(F.min("id").alias("low"), F.min("row").alias("cls")))
    classes = settled(prints.join(named.select(F.col("cls").alias("row")), "row").withColumnRenamed("row", "cls"))

    pairs = candidates(classes, percent)
    used = pairs.select("cls").union(pairs.select("hub")).distinct()
    wanted = classes.join(used, "cls").select(F.col("id").alias("own"), "texthash", "cls", "k1", "k2")
    same = F.col("id").eqNullSafe(F.col("own")) & (F.xxhash64("text") == F.col("texthash"))
    sets = texts.join(wanted, same).select("text", "cls", "k1", "k2").mapInArrow(lean(_full(shingle)), "cls bigint, values binary")
    sets = settled(sets.groupBy("cls").agg(F.first("values").alias("values")))

    near = settled(_hub_links(settled(estimated(pairs, classes)), sets, percent))
    labels = settled(components(near))
    rest = settled(_rest_links(pairs, classes, labels, sets, percent))
    if not rest.isEmpty():
        labels = settled(components(near.union(rest)))

    rooted = named.join(labels, F.col("cls") == F.col("node"), "left").select("k1", "k2", "low", F.coalesce("root", "cls").alias("root"))
    rooted = settled(rooted)
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    member = settled(rooted.join(lowest, "root").select("k1", "k2", "component_id"))
    full = prints.where("n > 0").select("id", "n", "k1", "k2").join(member, ["k1", "k2"]).select("id", "n", "component_id")
    found = full.unionByName(prints.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")

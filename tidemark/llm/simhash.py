"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments. Each is read as a word of the perfect (23, 12) Golay code and gives
the index of the codeword it decodes to and, where that lies at distance three, of the five codewords at distance four:
words that differ in one bit share an index. Two differing bits in three segments leave, in each case, a segment without
an error followed (in a ring) by one with an error at most, so that each segment exact, joined to the indices of the one
after it, makes keys under which all linked fingerprints meet. What meets is verified by its bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import lean, settled, text_slices

SHINGLE = 3
MAX_BITS = 2
# A key that more fingerprints share is resolved by the words one bit away instead of by pairs.
PAIRED = 64

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SEGMENTS = (22, 21, 21)
_GENERATOR = 0b110001110101


def _fingerprint(text: bytes, width: int) -> int:
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else [b" ".join(words)]
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), shingles), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for first in range(0, len(hashes), 1 << 15):
        part = hashes[first : first + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, hash of the text, fingerprint as a long) per row. A null or blank text has fingerprint 0; short texts are one shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in text_slices(batch, "text"):
                raw = data.tobytes()
                prints = [_fingerprint(raw[i:j], shingle) for i, j in zip(bounds[:-1], bounds[1:])]
                column = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), column], names=["id", "texthash", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("texthash"))
    return texts.mapInArrow(lean(run), f"id {kind}, texthash bigint, fp bigint")


def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of one byte in each of three places; by syndrome, the error nearest to it and those of weight four."""
    unit = [1 << i for i in range(23)]
    for i in range(23):
        for place in range(22, 10, -1):
            if unit[i] >> place & 1:
                unit[i] ^= _GENERATOR << (place - 11)
    tables = np.zeros((3, 256), dtype=np.int64)
    for byte in range(3):
        for value in range(256):
            for bit in range(min(8, 23 - 8 * byte)):
                if value >> bit & 1:
                    tables[byte, value] ^= unit[8 * byte + bit]
    near, four = np.zeros(2048, dtype=np.int64), [[] for _ in range(2048)]
    for weight in range(1, 5):
        for places in combinations(range(23), weight):
            syndrome = 0
            for p in places:
                syndrome ^= unit[p]
            error = sum(1 << p for p in places)
            if weight < 4:
                near[syndrome] = error
            else:
                four[syndrome].append(error)
    return tables, near, np.array([e if len(e) == 5 else [-1] * 5 for e in four], dtype=np.int64)


def indices(segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) of the codewords near each 23-bit word; words that differ in one bit share an index."""
    tables, near, four = _golay()
    syndrome = tables[0][segments & 255] ^ tables[1][segments >> 8 & 255] ^ tables[2][segments >> 16]
    rows, codewords = np.arange(len(segments)), segments ^ near[syndrome]
    far = np.flatnonzero(np.bitwise_count(near[syndrome].astype(np.uint64)) == 3)
    more = (segments[far, None] ^ four[syndrome[far]]).ravel()
    return np.concatenate([rows, np.repeat(far, 5)]), np.concatenate([codewords, more]) >> 11


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        cuts, parts = np.cumsum((0, *_SEGMENTS)), []
        for cut, size in zip(cuts, _SEGMENTS):
            parts.append(((prints >> np.uint64(cut)) & np.uint64((1 << size) - 1)).astype(np.int64))
        for ring in range(3):
            rows, codes = indices(parts[(ring + 1) % 3])
            key = (ring << 40) | (parts[ring][rows] << 12) | codes
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(prints[rows].view(np.int64))], names=["key", "fp"])


def links(prints: DataFrame, paired: int = PAIRED) -> DataFrame:
    """Pairs (a, b) that connect all fingerprints (column fp, distinct) at two differing bits or fewer.

    Keys of up to ``paired`` fingerprints give each verified pair. Where more share a key, each of them is listed under
    itself and its 64 neighbours at one bit; two fingerprints are linked exactly if they share such a word, and all
    under a word are tied to the smallest one there: rows grow with the fingerprints, never with their pairs.
    """
    keyed = prints.select("fp").mapInArrow(lean(_keys), "key bigint, fp bigint")
    shared = settled(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    met = settled(keyed.join(shared, "key"))
    few = met.where(F.col("n") <= paired)
    left, right = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    pairs = left.join(right, "key").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS))
    bits = [F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64))]
    crowd = met.where(F.col("n") > paired).select("fp").distinct()
    around = crowd.select("fp", F.explode(F.array(*(F.col("fp").bitwiseXOR(x) for x in bits))).alias("word"))
    least = settled(around.groupBy("word").agg(F.min("fp").alias("low"), F.count("*").alias("n")).where("n > 1").drop("n"))
    ties = around.join(least, "word").where("fp != low").select(F.col("fp").alias("a"), F.col("low").alias("b"))
    return pairs.select("a", "b").union(ties).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (a long), ``component_id``, the smallest id it is linked to, and
    ``texthash`` and ``root``, XXH64 of its text and a fingerprint that names its component.

    Links: fingerprints that differ in two bits or fewer. Rows may repeat. A null id is carried along and is the
    component's only where it has no other; no rows give no rows. Other columns are not looked at.
    """
    prints = settled(fingerprints(docs, id_col, text_col, shingle))
    classes = settled(prints.groupBy("fp").agg(F.min("id").alias("low")))
    found = settled(components(links(classes)).select(F.col("node").alias("fp"), "root"))
    rooted = settled(classes.join(found, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")))
    lowest = settled(rooted.groupBy("root").agg(F.min("low").alias("component_id")))
    member = settled(rooted.select("fp", "root").join(lowest, "root").select("fp", "component_id", "root"))
    found = prints.join(member, "fp")
    return found.select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id", "texthash", "root")


def as_hex(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))

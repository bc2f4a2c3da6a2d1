import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidemark.llm import importance as im
from tidemark.llm.shared import text_slices

SCHEMA = "doc_id bigint, text string"


def grams(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", text)
    return ws, ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]


def bucket(gram):
    return zlib.crc32(gram.encode()) % im.BUCKETS


def brute(docs, target, share=25, least=20):
    s, t = [0] * im.BUCKETS, [0] * im.BUCKETS
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for g in grams(text)[1]:
                counts[bucket(g)] += 1
    size_s, size_t = sum(s), sum(t)

    def gain(g):
        b = bucket(g)
        return math.floor(1000 * math.log((t[b] + 1) * (size_s + 10000) / ((s[b] + 1) * (size_t + 10000))))

    out = []
    for i, text in docs:
        ws, gs = grams(text)
        weight = sum(map(gain, gs)) // len(gs) if gs else 0
        u = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((u + 0.5) / 4294967296))), None, len(ws)])
    order = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(order[: share * len(order) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def mine(spark, docs, target, parts=4):
    df = spark.createDataFrame(docs, SCHEMA).repartition(parts)
    found = im.resample(df, spark.createDataFrame([(t,) for t in target], "text string"))
    return sorted((tuple(r) for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def made(n, seed=3):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Über", "don't", "x-y", "Ünï", "ABC", "12", "longword" * 9]
    return [(i * 5 % n, r.choice([" ", "\n", ", "]).join(r.choice(vocabulary) for _ in range(r.randint(0, 60)))) for i in range(n)]


def test_against_brute_force(spark):
    docs, target = made(90), ["w1 w2 w3 Über w1", "w4 w1 w2", None, ""]
    assert mine(spark, docs, target) == brute(docs, target) == mine(spark, docs, target, 1)


def test_edges(spark):
    assert mine(spark, [], ["a"]) == []
    docs = [(1, None), (2, ""), (3, " .,-\n"), (None, "a b " * 20), (None, "a b " * 20), (7, "A1" * 3000 + " "), (7, "x " * 30), (7, "x " * 30)]
    docs += [(9, " ".join(f"t{i % 5000}" for i in range(120_000))), (10, "\x00\x7f[`{/:@")]
    assert mine(spark, docs, []) == brute(docs, [])
    assert mine(spark, docs, ["x"]) == brute(docs, ["x"])
    named = spark.createDataFrame([(1, "a " * 30, 4, "z", 1)], SCHEMA + ", score int, `all` string, bucket int")
    assert im.resample(named, named).first().n_features == 59


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(im, "noise", lambda doc_id, seed: doc_id % 2)
    docs = spark.createDataFrame([(i, "same words here " * 10) for i in range(40)], SCHEMA).repartition(5)
    ranked = {r["doc_id"]: r["rank"] for r in im.resample(docs, docs).collect()}
    assert [i for i, k in sorted(ranked.items(), key=lambda x: (x[1] or 99, x[0])) if k] == [2 * i + 1 for i in range(10)]


def test_hashes_of_ranges():
    r = random.Random(1)
    parts = [bytes(r.randrange(256) for _ in range(r.randrange(70))) for _ in range(2000)]
    length = np.array([len(p) for p in parts])
    spans = im.Spans(np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum(length) - length, length)
    assert spans.xxh64().tolist() == [xxhash.xxh64_intdigest(p) for p in parts]
    assert spans.xxh64(9).tolist() == [xxhash.xxh64_intdigest(p, 9) for p in parts]
    assert spans.crc32(np.arange(len(parts))).tolist() == [zlib.crc32(p) for p in parts]


@pytest.mark.parametrize("keys", [None, 1])
def test_equal_keys_are_told_apart_by_their_bytes(keys):
    words = [f"n{i % 97}" * (1 + i % 11) for i in range(900)]
    raw = [w.encode() for w in words]
    length = np.array([len(w) for w in raw])
    spans = im.Spans(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum(length) - length, length)
    hashes = None if keys is None else np.ones(len(words), dtype=np.uint64)
    table = im.Interned(spans, 1000, hashes)
    assert len(set(table.slot.tolist())) == len(set(words))
    for w, slot in zip(words, table.slot):
        assert table.count[slot] == words.count(w) and table.bucket[slot] == zlib.crc32(w.encode()) % 1000


def test_slices_agree():
    texts = [t for _, t in made(60, 8)] + ["", "one", "word " * 5000]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    gain = np.arange(im.BUCKETS)
    for size in (1, 300, 1 << 20):
        got = []
        for _, data, bounds in text_slices(batch, "text", size):
            got += list(zip(*(x.tolist() for x in im.Features(data, bounds, 2, im.BUCKETS).totals(gain))))
        assert got == [(len(g), sum(map(bucket, g))) for g in (grams(t)[1] for t in texts)]

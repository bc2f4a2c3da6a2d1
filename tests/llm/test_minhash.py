import random

import numpy as np
import pytest

from tidemark.llm import minhash as mh

SCHEMA = "doc_id bigint, text string"


def shingles(text, width=3):
    raw = (text or "").encode()
    ws = bytes(b + 32 if 65 <= b <= 90 else b for b in raw).split()
    return {tuple(ws[i : i + width]) for i in range(len(ws) - width + 1)} if len(ws) >= width else {tuple(ws)} if ws else set()


def brute(docs, percent=85):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(sets[k]), low.get(find(k))) for k, (i, _) in enumerate(docs)), key=repr)


def mine(spark, docs, parts=4):
    return sorted((tuple(r) for r in mh.near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(parts)).collect()), key=repr)


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
    return words


def families(seed, groups=8, size=30):
    """Copies with a few to many edits around the limit, texts of all lengths, a line that all have."""
    r, docs = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{r.randrange(60)}" for _ in range(r.choice([4, 12, 40, 150, 500]))]
        for _ in range(size):
            words = edited(r, base, r.randint(0, max(1, len(base) // 14)))
            docs.append(" ".join(words + (["the", "common", "line", "of", "all"] if r.random() < 0.5 else [])))
    r.shuffle(docs)
    return [(i * 11 % len(docs), t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("block", [None, 4])
def test_against_brute_force(spark, monkeypatch, block):
    """Small blocks stand for crowded hubs, whose classes are salted and compared block by block."""
    if block:
        monkeypatch.setattr(mh, "BLOCK", block)
    docs = families(1 if block else 2)
    assert mine(spark, docs) == brute(docs)


def test_chains_beyond_the_hub(spark):
    """Neighbours in a chain are linked, its ends are not; and no text is near to all others."""
    words = [f"c{i}" for i in range(400)]
    docs = [(i, " ".join(words[4 * i : 4 * i + 200])) for i in range(40)]
    docs += [(100 + i, " ".join(edited(random.Random(i), words[:150], 9))) for i in range(60)]
    assert mine(spark, docs) == brute(docs)


def test_edges(spark):
    assert mine(spark, []) == []
    docs = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\ttwo"), (8, "one two one two")]
    docs += [(9, "É a b"), (10, "é a b"), (None, "p q r s"), (None, "p q r s"), (None, "lonely text here"), (12, "p q R s")]
    docs += [(13, "u v w x"), (13, "u v w x"), (13, "another text under one id"), (None, None)]
    docs += [(20, " ".join(f"v{i % 9001}" for i in range(60_000))), (21, " ".join(f"V{i % 9001}" for i in range(59_000)))]
    assert mine(spark, docs) == brute(docs) == mine(spark, docs, 1)
    named = spark.createDataFrame([(1, "a b c", "x", 2), (2, "a b c", "y", 3)], SCHEMA + ", cls string, n int")
    assert {r.component_id for r in mh.near_duplicates(named).collect()} == {1}
    with pytest.raises(ValueError):
        mh.near_duplicates(named, percent=80)


def test_candidates_leave_out_what_is_common(spark):
    """A passage that all texts share retains values, but brings no two of them together."""
    r = random.Random(4)
    common = " ".join(f"x{i}" for i in range(60))
    docs = spark.createDataFrame([(i, common + " " + " ".join(f"y{r.randrange(10**7)}" for _ in range(120))) for i in range(200)], SCHEMA)
    prints = docs.selectExpr("doc_id AS id", "text", "0L AS h").mapInArrow(mh._prints(3, mh.SKETCH), "id bigint, texthash bigint, n bigint, k1 bigint, k2 bigint, sketch array<bigint>")
    assert mh.candidates(prints.withColumnRenamed("id", "cls")).isEmpty()


def test_overlaps(monkeypatch):
    monkeypatch.setattr(mh, "_COLUMNS", 7)
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(-40, 40, n)) for n in (0, 1, 5, 30, 60)]
    got = mh._overlaps(sets[:3], sets[2:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets[:3]]
    assert [[mh._common(a, b) for b in sets[2:]] for a in sets[:3]] == got.tolist()

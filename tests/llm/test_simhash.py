import random
from itertools import combinations

import numpy as np
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components

SCHEMA = "doc_id bigint, text string"


def fingerprint(text):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    return {(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, classes([i for i, _ in rows], prints))}


def classes(ids, prints):
    root = list(range(len(ids)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            root[top(i)] = top(j)
    out = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            out[top(i)] = min(out.get(top(i), ids[i]), ids[i])
    return [out.get(top(i)) for i in range(len(ids))]


def mine(spark, rows):
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    return {tuple(r) for r in found.select("doc_id", simhash.as_hex(found.fingerprint), "component_id").collect()}


def test_words_one_bit_apart_share_an_index():
    words = np.random.default_rng(0).integers(0, 1 << 23, 3000)
    rows, codes = simhash.indices(words)
    own = [set() for _ in words]
    for r, c in zip(rows, codes):
        own[r].add(int(c))
    assert {len(x) for x in own} == {1, 6}
    for bit in range(23):
        rows, codes = simhash.indices(words ^ (1 << bit))
        met = np.zeros(len(words), dtype=bool)
        for r, c in zip(rows, codes):
            met[r] |= int(c) in own[r]
        assert met.all()


def test_against_brute_force(spark):
    r = random.Random(1)
    vocabulary = [f"w{i}" for i in range(40)] + ["Ünï", "É"]
    rows = [(i, " ".join(r.choices(vocabulary, k=r.randint(0, 30)))) for i in range(60)]
    for i in range(60, 120):
        text = r.choice(rows)[1].split()
        for _ in range(r.randint(0, 1)):
            if text:
                text[r.randrange(len(text))] = "x"
        rows.append((i, "\t ".join(text).upper() if i % 5 == 0 else " ".join(text)))
    rows += [(500, None), (501, ""), (502, "one"), (503, "ONE"), (504, "one two"), (505, "a " * 50_000)]
    assert mine(spark, rows) == brute(rows)


def test_crowded_keys_and_pairs_give_the_same_classes(spark):
    r = random.Random(2)
    centre = r.getrandbits(64)
    prints = {centre} | {centre ^ (1 << i) ^ (1 << j) for i, j in combinations(range(64), 2) if r.random() < 0.15}
    prints |= {r.getrandbits(64) for _ in range(50)} | {0, 1, 3, 1 << 63}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    want = classes(signed, prints)
    for paired in (2, 10, 10_000):
        tied = {x.node: x.root for x in components(simhash.links(df, paired)).collect()}
        got = [tied.get(s, s) for s in signed]
        assert got == want


def test_edges(spark):
    assert mine(spark, []) == set()
    same = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "q r s t u")]
    assert mine(spark, same) == brute(same)
    named = spark.createDataFrame([(1, "a b c", 7, "z")], "doc_id bigint, text string, fp int, id string")
    assert simhash.near_duplicates(named).collect()[0].component_id == 1


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 90), (51, 50), (50, 51)], "a long, b long")
    assert {(x.node, x.root) for x in components(chain).collect()} == {(i, 0) for i in range(41)} | {(50, 50), (51, 50)}

import hashlib
import random
import zlib

import pytest

from tidemark.llm import merkle
from tidemark.llm.queries import LEAF_COLUMNS, tree

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grown(digests):
    """The levels of a tree, lowest first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def walk(levels, at):
    for level in levels[:-1]:
        low = at - at % 3
        yield level[low:at], level[at + 1 : low + 3]
        at //= 3


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    groups = {g: sorted(v, key=lambda x: x[:3]) for g, v in groups.items()}
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: grown([x[2] for x in groups[g]]) for g in names}
    top = grown([trees[g][-1][0] for g in names])
    out = []
    for g in names:
        for k, (_, _, leaf, row) in enumerate(groups[g]):
            steps = [*walk(trees[g], k), *walk(top, names.index(g))]
            own = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                own = leaf_of((*row[:4], row[4].replace("\n", "")))
            for left, right in steps:
                own = h(*left, own, *right)
            proof = h(*(d for left, right in steps for d in [*left, *right]))
            out.append((row[0], leaf, trees[g][-1][0], top[-1][0], proof, own, own == top[-1][0]))
    return sorted(out, key=repr)


def mine(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in tree(df, "").collect()), key=repr)


def made(n, groups, seed=1):
    r = random.Random(seed)
    return [(i * 7 % n, r.choice(groups), r.choice(["en", None]), r.choice([None, i]), r.choice([f"a{i}\nb", f"é{i}", None, ""])) for i in range(n)]


@pytest.mark.parametrize("levels", [7, 1, 2])
def test_against_brute_force(spark, monkeypatch, levels):
    """Blocks of 3 or 9 leaves stand for large groups, which take more rounds."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = made(60, ["a"] * 20 + ["b", "c", "ä", None, "", "-", "1:x"])
    assert mine(spark, rows) == brute(rows)


def test_edges(spark):
    assert mine(spark, []) == []
    one = [(4, None, None, None, None)]
    (row,) = mine(spark, one)
    assert row == brute(one)[0] and row[1] == row[2] == row[3] == row[5] and row[4] == h() and row[6]
    # Repeated rows, null ids and one id with several texts are leaves of their own.
    rows = [(None, "a", "x", 1, "t"), (None, "a", "x", 1, "t"), (3, "a", "x", 1, "p\nq"), (3, "a", "x", 1, "p\nq"), (3, "a", "x", 2, "z")]
    rows += [(5, "a", "x", 9, "long " * 200_000), (None, None, None, None, None)]
    assert mine(spark, rows) == brute(rows) == mine(spark, rows, 1)


def test_tampering_shows(spark):
    rows = [(i, "s", "en", 3, "a\nb") for i in range(40)]
    for r in mine(spark, rows):
        assert r[6] == (zlib.crc32(str(r[0]).encode()) % 2 == 1)


def test_other_columns_and_names(spark):
    df = spark.createDataFrame([(i, "g", f"x{i}", "keep") for i in range(5)], "k int, tree string, leaf string, `pos` string")
    found = merkle.manifest(df, "tree", ["k"])
    assert found.columns == ["k", "tree", "leaf", "pos", "subroot", "root", "path"]
    levels = grown([f"x{i}" for i in range(5)])
    assert {r.root for r in found.collect()} == {levels[-1][0]}
    docs = spark.createDataFrame([(1, "s", "en", 2, "t", "p", 3)], SCHEMA + ", path string, n int")
    assert merkle.row_leaves(docs, LEAF_COLUMNS, "doc_id", "source", "text").first().leaf == leaf_of((1, "s", "en", 2, "t"))
    assert tree(docs, "").count() == 1
    with pytest.raises(ValueError):
        merkle.manifest(df.withColumn("root", df.k), "tree", ["k"])

import random
import re

import numpy as np

from tidemark.llm import decontamination

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def smith_waterman(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (2 if x == y else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
    return max(map(max, table))


def spelled(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items, least=0.5):
    out = {}
    for d, text in docs:
        for i, item in items:
            words = spelled(item)
            if len(words) >= 5 and (score := smith_waterman(words, spelled(text)) / (2 * len(words))) >= least:
                out[d, i] = round(score, 9)
            elif 0 < len(words) < 5 and words == spelled(text):
                out[d, i] = 1.0
    return out


def mine(spark, docs, items, **options):
    found = decontamination.contaminated(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), **options)
    return {(r.doc_id, r.item_id): round(r.score, 9) for r in found.collect()}


def test_alignment_against_the_plain_table():
    r = np.random.default_rng(0)
    left, right = r.integers(5, 9, (200, 12)).astype(np.uint64), r.integers(5, 9, (200, 30)).astype(np.uint64)
    n, m = r.integers(1, 13, 200), r.integers(1, 31, 200)
    left[np.arange(12) >= n[:, None]], right[np.arange(30) >= m[:, None]] = 1, 2
    got = decontamination.align(left, n, right, m)
    assert got.tolist() == [smith_waterman(a[:i].tolist(), b[:j].tolist()) for a, i, b, j in zip(left, n, right, m)]


def case(seed):
    r = random.Random(seed)
    word = lambda: f"{r.choice('bdfgk')}{r.choice('aeiou')}{r.randint(0, 40)}"
    items = [(i, " ".join(word() for _ in range(r.randint(15, 50))) + ".") for i in range(12)]
    docs = []
    for d in range(60):
        parts = [word() for _ in range(r.randint(0, 80))]
        if d % 2:
            passage = r.choice(items)[1].split()
            for _ in range(int(len(passage) * r.choice([0, 0.1, 0.2, 0.3]))):
                k = r.randrange(len(passage))
                passage[k : k + 1] = r.choice([[], [word()], [word(), passage[k]]])
            if r.random() < 0.3:
                passage = [p.upper() + "," for p in passage]
            parts[len(parts) // 2 : len(parts) // 2] = passage
        docs.append((d, " ".join(parts)))
    return docs, items


def test_edited_copies_against_brute_force(spark):
    """All matches from the limit on, with their scores."""
    for seed in (1, 2):
        docs, items = case(seed)
        want = brute(docs, items)
        assert len(want) > 15
        assert mine(spark, docs, items) == want == mine(spark, docs, items, block_words=150)


def dense(seed, n=150):
    """Items of 5 to 60 words with an edit at up to every other word, among words that items share."""
    r = random.Random(seed)
    word = lambda: f"{r.choice('bdfgk')}{r.choice('aeiou')}{r.randint(0, 30)}"
    items = [(i, " ".join(word() for _ in range(r.choice([5, 6, 7, 8, 12, 20, 35, 60])))) for i in range(25)]
    docs = []
    for d in range(n):
        passage, out = r.choice(items)[1].split(), []
        every, kind = r.choice([2, 2, 3, 3, 4]), r.choice("irdm")
        for k, w in enumerate(passage):
            do = r.choice("ird") if kind == "m" else kind
            if k % every != every - 1 or do == "k":
                out.append(w)
            else:
                out += {"i": [w, word()], "r": [word()], "d": []}[do]
        docs.append((d, " ".join([*(word() for _ in range(r.randint(0, 70))), *out, *(word() for _ in range(r.randint(0, 70)))])))
    return docs, items


def test_densely_edited_copies_are_found_from_the_limit_on(spark):
    docs, items = dense(5)
    want = brute(docs, items)
    got = mine(spark, docs, items)
    low = [v for v in want.values() if v < 0.6]
    assert len(want) > 60 and len(low) > 20
    assert got == want


def test_the_probes_of_an_item(spark):
    item = [f"w{i}" for i in range(24)]
    inserted = [x for i, w in enumerate(item) for x in ([w, f"z{i}"] if i % 2 else [w])]
    replaced = [f"z{i}" if i % 3 == 2 else w for i, w in enumerate(item)]
    docs = [(1, " ".join(["a", "b", *inserted, "c"])), (2, " ".join(["a", *replaced, "c"])), (3, " ".join(item[::2]))]
    got = mine(spark, docs, [(7, " ".join(item))])
    assert got == brute(docs, [(7, " ".join(item))]) and set(got) == {(1, 7), (2, 7)}


def test_frequent_seeds_are_left_out_and_no_match_is_lost(spark):
    docs, items = case(6)
    phrase = "which of the following is true of "
    docs = [(i, (phrase + t) if i % 3 else phrase * 30) for i, t in docs]
    items = [(i, phrase + t) for i, t in items]
    want = brute(docs, items)
    assert mine(spark, docs, items) == want and len(want) > 10
    block = decontamination._block(items)
    frame = spark.createDataFrame(docs, DOCS)
    counts = decontamination.seed_counts(frame, block)
    kept = decontamination.rare(block, counts)
    words = spelled(phrase)
    hashes, first = decontamination._spelled(*(lambda d: (np.frombuffer(d, np.uint8), np.array([0, len(d)])))(phrase.encode()))
    common = np.concatenate([k for k, _ in decontamination._pairs(hashes, first)])
    per = [np.isin(np.repeat(x.keys, np.diff(x.begin)), common) for x in (block, kept)]
    # What is left out, of each item, are seeds of the phrase.
    assert len(words) == 7 and per[0].sum() == 11 * len(items) and (~per[0]).sum() == (~per[1]).sum()
    assert per[0].sum() - per[1].sum() == sum(min(11, (n - 1) // 2) for n in block.need) > 3 * len(items)
    # A leak is found whether it occurs once or in a thousand documents.
    leak = " ".join(w if k % 4 else "zz" for k, w in enumerate(items[0][1].split()))
    for n in (1, 1000):
        got = mine(spark, [*docs, *((1000 + k, leak) for k in range(n))], items)
        assert sum(d >= 1000 and i == 0 for d, i in got) == n


def test_a_passage_in_all_documents_is_found_in_all(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = [(i, f"a{i} b c {passage} d") for i in range(50)] + [(99, "nothing like it w0 w1 w2 w5")]
    assert mine(spark, docs, [(7, passage)]) == {(i, 7): 1.0 for i in range(50)}


def test_an_edited_passage_in_many_documents_is_found_in_all(spark):
    item = [f"w{i}" for i in range(20)]
    edited = " ".join("other" if i % 5 == 4 else w for i, w in enumerate(item))
    alone = mine(spark, [(0, f"a b {edited} c")], [(7, " ".join(item))])
    assert alone == {(0, 7): round(smith_waterman(item, edited.split()) / 40, 9)}
    docs = [(i, f"a{i} b {edited} c") for i in range(50)]
    assert mine(spark, docs, [(7, " ".join(item))]) == {(i, 7): alone[0, 7] for i in range(50)}
    docs.append((50, " ".join(item)))
    assert mine(spark, docs, [(7, " ".join(item))]) == {(i, 7): alone[0, 7] for i in range(50)} | {(50, 7): 1.0}


def test_hits_are_looked_at_in_parts(spark, monkeypatch):
    docs, items = case(4)
    phrase = "which of the following "
    docs, items = [(i, f"{phrase * 5}{t}") for i, t in docs], [(i, phrase + t) for i, t in items]
    data = [t.encode() for _, t in docs]
    data, bounds = np.frombuffer(b"".join(data), dtype=np.uint8), np.cumsum([0, *map(len, data)])
    block, parts = decontamination._block(items), []
    for hits in (1 << 20, 7):
        monkeypatch.setattr(decontamination, "_HITS", hits)
        parts.append(decontamination._matched(*decontamination._spelled(data, bounds), block, 0.5))
    assert parts[0] == parts[1] and {(docs[d][0], items[i][0]): round(s, 9) for (d, i), s in parts[0].items()} == brute(docs, items)


def test_edges(spark):
    docs, items = case(3)
    assert mine(spark, docs, []) == {}
    assert mine(spark, [], items) == {}
    odd = [(1, None), (2, ""), (3, "..."), (None, items[0][1]), (4, items[0][1]), (4, items[0][1]), (5, "x " * 40_000 + items[1][1])]
    odd += [(6, "X, x"), (7, "x x and more")]
    got = mine(spark, odd, [(0, items[0][1]), (0, items[0][1]), (1, items[1][1]), (2, None), (3, ""), (4, "x x"), (None, "x x.")])
    assert got == {(None, 0): 1.0, (4, 0): 1.0, (5, 1): 1.0, (6, 4): 1.0, (6, None): 1.0}
    named = spark.createDataFrame([(1, items[0][1], 2, [1])], "doc_id bigint, text string, item int, found array<int>")
    found = decontamination.contaminated(named, spark.createDataFrame(items, ITEMS))
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 0)]
    more = spark.createDataFrame([(2, "clean", 3, None), (3, None, 4, [5])], named.schema)
    left = decontamination.clean(named.union(more), spark.createDataFrame(items, ITEMS))
    assert left.schema == named.schema and sorted(r.doc_id for r in left.collect()) == [2, 3]
    assert decontamination.clean(more, spark.createDataFrame([], ITEMS)).count() == 2

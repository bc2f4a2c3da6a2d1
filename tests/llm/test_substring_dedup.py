import random

from tidemark.llm import substring_dedup

SCHEMA = "doc_id bigint, text string"


def brute(rows, width):
    texts = {i: (t or "").encode().split() for i, t in rows}
    order = sorted(texts, key=lambda i: (i is not None, i))
    seen, out = set(), {}
    for i in order:
        words, gone = texts[i], set()
        for k in range(len(words) - width + 1):
            window = tuple(words[k : k + width])
            if window in seen:
                gone.update(range(k, k + width))
            seen.add(window)
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        out[i] = (i, kept, len(words), len(gone))
    return set(out.values())


def mine(spark, rows, width, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = substring_dedup.remove_repeats(df, window=width)
    return {tuple(r) for r in found.select("doc_id", "kept", "n_words", "n_removed").collect()}


def passages(seed, n, vocabulary):
    r = random.Random(seed)
    shared = [[r.choice(vocabulary) for _ in range(r.randint(15, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(r.randint(0, 5)):
            words += r.choice(shared) if r.random() < 0.5 else [r.choice(vocabulary) for _ in range(r.randint(0, 30))]
        rows.append((i * 3 % n, r.choice([" ", "\n", " \t"]).join(words)))
    return list({i: (i, t) for i, t in rows}.values())


def test_against_brute_force(spark):
    many, few = [f"w{i}é" for i in range(500)], ["a", "b"]
    for seed, vocabulary, width in ((1, many, 20), (2, few, 20), (3, many, 9), (4, few, 3), (5, many, 8)):
        rows = passages(seed, 40, vocabulary)
        assert mine(spark, rows, width) == brute(rows, width)


def test_periods_within_a_document(spark):
    rows = [(i, " ".join(f"p{k % (i + 1)}" for k in range(20 + 2 * i))) for i in range(12)]
    assert mine(spark, rows, 20) == brute(rows, 20)


def test_slices_agree(spark):
    rows = passages(6, 40, ["a", "b", "c"])
    whole = mine(spark, rows, 10, 1)
    assert whole == brute(rows, 10) == mine(spark, rows, 10, 12)


def test_tasks_that_see_many_slices(spark, monkeypatch):
    """What a task remembers, or has forgotten, changes nothing; ids may come in any order."""
    import pyarrow as pa

    rows = passages(7, 60, [f"w{i}" for i in range(30)])
    want = brute(rows, 10)
    batches = [pa.RecordBatch.from_pylist([{"id": i, "text": t} for i, t in rows[k : k + 7]]) for k in range(0, len(rows), 7)]
    anchors = pa.Table.from_batches(list(substring_dedup._anchor_rows(10)(iter(batches))))
    counts = {}
    for r in anchors.to_pylist():
        counts[r["low"], r["salt"]] = counts.get((r["low"], r["salt"]), 0) + r["n"]
    per_task = [sum(1 for r in anchors.to_pylist() if (r["low"], r["salt"]) == k) for k in counts if k[1] == 0]
    assert max(per_task) <= 2
    whole = {}
    for r in anchors.to_pylist():
        whole[r["low"]] = max(whole.get(r["low"], 0), counts[r["low"], r["salt"]])
    assert {low for low, n in whole.items() if n > 1} == {low for low, _ in counts if sum(v for (x, _), v in counts.items() if x == low) > 1}
    assert mine(spark, sorted(rows), 10, 1) == want == mine(spark, rows[::-1], 10, 2)
    monkeypatch.setattr(substring_dedup._Seen.__init__, "__defaults__", (5,))
    assert mine(spark, rows, 10, 3) == want


def test_edges(spark):
    assert mine(spark, [], 20) == set()
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "short"), (5, text), (7, text + " x"), (None, text)]
    assert mine(spark, rows, 20) == brute(rows, 20)
    twice = [(1, text), (1, text), (2, text)]
    got = spark.createDataFrame(twice, SCHEMA)
    got = sorted(tuple(r) for r in substring_dedup.remove_repeats(got).select("doc_id", "n_removed").collect())
    assert got == [(1, 0), (1, 0), (2, 30)]
    long = " ".join(f"v{i % 7001}" for i in range(60_000))
    assert mine(spark, [(1, long)], 20) == brute([(1, long)], 20)
    named = spark.createDataFrame([(1, text, "k", 3)], "doc_id bigint, text string, key string, places int")
    assert substring_dedup.remove_repeats(named).first().kept == text


def test_layout_outside_of_intervals_is_kept(spark):
    shared = " ".join(f"s{i}" for i in range(20))
    rows = [(1, f"a\n{shared}\nb  c"), (2, f" x  y\n{shared}\n\nz\t"), (3, shared)]
    found = substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), joined=False)
    assert {r.doc_id: r.kept for r in found.collect()} == {1: rows[0][1], 2: " x  y\nz\t", 3: ""}
    assert {r.doc_id: list(zip(r.first_word, r.end_word)) for r in found.collect()} == {1: [], 2: [(2, 22)], 3: [(0, 20)]}


def test_rows_that_share_an_id(spark):
    """Other texts under one id are documents of their own, as are texts without an id."""
    long, other = [" ".join(f"{c}{i}" for i in range(200)) for c in "ab"]
    rows = [(1, long), (2, " ".join(f"c{i}" for i in range(150)) + " " + long), (2, "only five words are here"), (3, long), (3, other)]
    rows += [(None, f"n{k} " + " ".join(f"n{k}w{i}" for i in range(30))) for k in range(40)] + [(None, long), (None, None), (4, long), (4, long)]
    df = spark.createDataFrame(rows, SCHEMA + "").withColumnRenamed("text", "body").selectExpr("doc_id", "body AS text", "doc_id AS named", "'x' AS pos")
    for joined in (True, False):
        found = substring_dedup.remove_repeats(df.repartition(4), joined=joined).collect()
        assert len(found) == len(rows) and all(r.rest.named == r.doc_id and r.rest.pos == "x" for r in found)
        left = sorted(((r.doc_id, r.n_words, r.n_removed) for r in found), key=repr)
        want = [(1, 200, 200), (2, 350, 200), (2, 5, 0), (3, 200, 200), (3, 200, 0), (4, 200, 200), (4, 200, 200), (None, 0, 0), (None, 200, 0)]
        want += [(None, 31, 0)] * 40
        assert left == sorted(want, key=repr)

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lm_scoring as lm

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents of one of three topics, each with words of its own in a cycle with some noise."""
    r, rows = random.Random(0), []
    for i in range(300):
        topic, words, at = i % 3, [], 0
        for _ in range(60):
            at = r.randrange(20) if r.random() < 0.1 else (at + 1) % 20
            words.append(f"t{topic}w{at}")
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def model(corpus):
    known = lm.vocabulary(corpus)
    return known, lm.train(corpus, known, stride=1, turns=2)


def test_vocabulary_counts_the_whole_corpus(corpus, model):
    known, _ = model
    assert known.counts.sum() == 300 * 60 and len(known.hashes) == 60
    assert (known.counts[:60] > 0).all() and known.distinct.sum() == 0


def test_shares_add_up_to_one(model):
    known, weights = model
    net = lm.Network(known.counts).load(weights)
    around = np.tile(np.array([[3], [4], [lm._PAD], [7]], dtype=np.int32), (1, lm._SIZE))
    assert np.exp(net.log_share(around, np.arange(lm._SIZE))).sum() == pytest.approx(1, abs=1e-4)


def test_slopes_against_differences():
    random_ = np.random.default_rng(0)
    counts = random_.integers(0, 50, lm._SIZE)
    net = lm.Network(counts)
    around, word = random_.integers(0, lm._SIZE + 1, (4, 40)).astype(np.int32), random_.integers(0, lm._SIZE, 40)
    before = net.log_share(around, word).mean()
    for _ in range(30):
        net.learn(around, word, 0.05, [np.full(p.shape, 1e-4, dtype=np.float32) for p in net.parts()])
    assert net.log_share(around, word).mean() > before + 1


def test_both_sides_teach(spark, corpus, model):
    known, weights = model
    net = lm.Network(known.counts)
    for p in (net.inputs, net.to_class, net.to_word):
        p[...] = 0
    single = lm.score(corpus, known, net.flat()).agg(F.avg("mean_log_prob")).first()[0]
    trained = lm.score(corpus, known, weights).agg(F.avg("mean_log_prob")).first()[0]
    assert trained > single + 1.0
    shuffled = [(r.doc_id, " ".join(random.Random(r.doc_id).sample(r.text.split(), 60))) for r in corpus.collect()]
    mixed = lm.score(spark.createDataFrame(shuffled, SCHEMA), known, weights).agg(F.avg("mean_log_prob")).first()[0]
    assert trained > mixed + 0.5


def test_score_against_a_plain_loop(spark, model):
    known, weights = model
    net, rows = lm.Network(known.counts).load(weights), [(1, "t0w1 t0w2 unseen t1w3 t0w4"), (2, "t2w1"), (3, " ")]
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, SCHEMA), known, weights).collect()}
    for i, text in rows:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        numbers, _ = known.read(data, np.array([0, len(data)]))
        total = 0.0
        for k, n in enumerate(numbers):
            near = [[numbers[k + s] if 0 <= k + s < len(numbers) else lm._PAD] for s in lm.REACH]
            total += net.log_share(np.array(near), np.array([n]))[0]
            total -= np.log(max(known.distinct[n - lm.OWN], 1)) if n >= lm.OWN else 0
        assert got[i].log_prob == pytest.approx(total, abs=1e-3) and got[i].n_words == len(numbers)
        assert (got[i].mean_log_prob is None) == (len(numbers) == 0)


def test_edges(spark, model):
    known, weights = model
    rows = [(1, None), (2, ""), (None, "t0w1"), (4, "t0w1 " * 50_000), (4, "t0w1 " * 50_000)]
    got = lm.score(spark.createDataFrame(rows, SCHEMA).repartition(2), known, weights).collect()
    assert sorted(r.n_words for r in got) == [0, 0, 1, 50_000, 50_000]
    assert len({r.log_prob for r in got if r.doc_id == 4}) == 1
    none = spark.createDataFrame([], SCHEMA)
    empty = lm.vocabulary(none)
    assert lm.score(none, empty, lm.train(none, empty)).count() == 0
    assert lm.score(spark.createDataFrame([(1, "a b", 3)], SCHEMA + ", n_words int"), empty, lm.train(none, empty)).first().n_words == 2


def test_every_word_is_taught_once(monkeypatch):
    texts = ["a b c d e f g h i", "j", "k l", None, "m n o"]
    names = [w for t in texts for w in (t or "").split()]
    counted = np.sort(np.array([lm.Rolling(41).spans(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([1]))[0] for w in names]).view(np.int64))
    known = lm.Vocabulary(counted, np.arange(len(names)), np.ones(lm._SIZE, dtype=np.int64), np.zeros(lm.BUCKETS, dtype=np.int64))
    taught = []
    monkeypatch.setattr(lm.Network, "learn", lambda self, around, word, rate, seen, weight: taught.extend(zip(word.tolist(), weight.tolist())))
    batch = lm.pa.RecordBatch.from_arrays([lm.pa.array([*texts, "j", "j"]), lm.pa.array([1, 2, 3, 4, 5, 2, 2])], names=["text", "texthash"])
    numbers = list(lm._numbered(known)([batch]))
    for turn in range(lm.TURNS):
        list(lm._trained(known, lm.Network(known.counts).flat(), turn, lm.STRIDE)(numbers))
    # Copies of a text teach it once, by their number.
    assert sorted(taught) == sorted((i, 3 if names[k] == "j" else 1) for k, i in enumerate(known.numbered(np.array([lm.Rolling(41).spans(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([1]))[0] for w in names]).view(np.int64)).tolist()))


def test_weights_and_scores_do_not_follow_the_layout(spark, monkeypatch, tmp_path):
    """One table in one, three and seven files, cut into other tasks: the same weights and scores to the bit."""
    monkeypatch.setattr(lm, "LEAST_SHARD", 1 << 11)
    r = random.Random(11)
    rows = [(i, " ".join(f"w{r.randrange(300)}" for _ in range(r.randint(0, 120)))) for i in range(200)]
    rows += [(300 + i, rows[3][1]) for i in range(50)] + [(None, None)]
    found = []
    for files in (1, 3, 7):
        r.shuffle(rows)
        path = str(tmp_path / str(files))
        spark.createDataFrame(rows, SCHEMA).repartition(files).write.parquet(path)
        docs = spark.read.parquet(path)
        known = lm.vocabulary(docs)
        assert lm.shards(docs, known).rdd.getNumPartitions() > 3
        weights = lm.train(docs, known)
        found.append((weights.tobytes(), sorted((tuple(x) for x in lm.score(docs, known, weights).collect()), key=repr)))
    assert found[0] == found[1] == found[2]


def test_words_of_a_bucket_share_it_by_their_counts(spark):
    r = random.Random(5)
    frequent = [f"f{i}" for i in range(lm.OWN)]
    others = [f"o{i}" for i in range(400)]
    often = {w: 1 + i % 7 for i, w in enumerate(others)}
    words = frequent * 9 + [w for w, n in often.items() for _ in range(n)]
    r.shuffle(words)
    docs = [(i % 30 if i % 4 else None, " ".join(words[k : k + 50])) for i, k in enumerate(range(0, len(words), 50))]
    docs = spark.createDataFrame(docs, SCHEMA).repartition(5)
    known = lm.vocabulary(docs)
    weights = lm.Network(known.counts).flat()
    net = lm.Network(known.counts)
    texts = others + [f"{others[0]} {others[9]} f1 new {others[0]}"]
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(4), known, weights).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        numbers, _ = known.read(data, np.array([0, len(data)]))
        want = 0.0
        for k, (n, w) in enumerate(zip(numbers, text.split())):
            near = [[numbers[k + s] if 0 <= k + s < len(numbers) else lm._PAD] for s in lm.REACH]
            want += net.log_share(np.array(near), np.array([n]))[0]
            want += np.log(often.get(w, 1) / max(known.counts[n], 1)) if n >= lm.OWN else 0
        assert got[i].log_prob == pytest.approx(want, abs=1e-3)
    whole = lm.score(docs, known, weights)
    assert whole.count() == docs.count() and whole.agg(F.sum("n_words")).first()[0] == len(words)


def test_own_words_grow_with_the_vocabulary(spark):
    docs = spark.range(0, 1_000_000, 1000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(id, id + 999), x -> concat('w', x))) AS text")
    known = lm.vocabulary(docs)
    assert known.own == 1024 > lm.OWN and len(known.hashes) == 1024
    assert known.counts.sum() == 1_000_000 == known.distinct.sum() + 1024
    assert lm.score(docs, known, lm.Network(known.counts).flat()).where("n_words = 1000").count() == 1000


def test_equal_texts_have_equal_scores_in_any_layout(spark, model):
    known, weights = model
    r = random.Random(3)
    texts = [" ".join(f"t{r.randrange(4)}w{r.randrange(60)}" for _ in range(r.randint(1, 300))) for _ in range(60)]
    rows = [(i, texts[i % 60]) for i in range(240)]
    r.shuffle(rows)
    scores = []
    for parts in (1, 3, 7):
        got = lm.score(spark.createDataFrame(rows, SCHEMA).repartition(parts), known, weights).collect()
        scores.append({x.doc_id: x.log_prob for x in got})
        assert all(scores[-1][i] == scores[-1][i % 60] for i in range(240))
    assert scores[0] == scores[1] == scores[2]


def plain_step(net, around, word, rate, seen, weight):
    """One step of AdaGrad, class by class and column by column, as the formulas say."""
    n, per = len(word), net.of_word.shape[1]
    weight = (weight * (n / weight.sum()))[:, None]
    h = np.tanh(net.hidden + sum(net.inputs[k][around[k]] for k in range(len(lm.REACH))))
    share = lambda x: np.exp(x - x.max(axis=1, keepdims=True)) / np.exp(x - x.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)
    kind, within = word % lm.CLASSES, word // lm.CLASSES
    miss = (share(h @ net.to_class + net.of_class) - np.eye(lm.CLASSES)[kind]) * weight
    off = (share(np.einsum("nh,nhp->np", h, net.to_word[kind]) + net.of_word[kind]) - np.eye(per)[within]) * weight
    back = (miss @ net.to_class.T + np.einsum("np,nhp->nh", off, net.to_word[kind])) * (1 - h * h)
    slopes = [np.zeros(p.shape) for p in net.parts()]
    for k in range(len(lm.REACH)):
        np.add.at(slopes[0][k], around[k], back)
    slopes[1], slopes[2], slopes[3] = back.sum(axis=0), h.T @ miss, miss.sum(axis=0)
    np.add.at(slopes[4], kind, np.einsum("nh,np->nhp", h, off))
    np.add.at(slopes[5], kind, off)
    return [p - rate * (s / n) / np.sqrt(a + (s / n) ** 2) for p, s, a in zip(net.parts(), slopes, seen)]


@pytest.mark.parametrize("n", [1, 40, 500])
def test_a_step_against_its_formulas(n):
    r = np.random.default_rng(n)
    net = lm.Network(r.integers(0, 50, lm._SIZE))
    around, word, weight = r.integers(0, lm._SIZE + 1, (4, n)).astype(np.int32), np.minimum(r.geometric(0.02, n), lm._SIZE - 1), r.integers(1, 9, n).astype(float)
    for p in net.parts():
        p += (0.3 * r.standard_normal(p.shape)).astype(np.float32)
    seen = [np.full(p.shape, 1e-2, dtype=np.float32) for p in net.parts()]
    want = plain_step(net, around, word, 0.2, seen, weight)
    net.learn(around, word, 0.2, seen, weight)
    assert all(np.allclose(p, w, atol=2e-5) for p, w in zip(net.parts(), want))


def test_neighbours_end_with_the_document():
    numbers, first = np.arange(1, 8, dtype=np.int32), np.array([0, 0, 1, 1, 4, 7, 7])
    spaced, at = lm._spaced(numbers, first, 99)
    found = lm._around(spaced, at)
    for i in range(7):
        row = np.searchsorted(first, i, side="right") - 1
        assert found[:, i].tolist() == [numbers[i + s] if first[row] <= i + s < first[row + 1] else 99 for s in lm.REACH]
    assert lm._around(*lm._spaced(numbers[:0], np.array([0]), 99)).shape == (4, 0)


def test_weights_are_sent_in_few_bytes():
    """A shard sends its weights without their number of copies, in half of eight bytes each; they add up as before."""
    values = np.rint(0.1 * np.random.default_rng(1).standard_normal(lm._BLOCK) * lm._FIXED).astype(np.int64)
    assert len(lm._packed(values)) < 4 * len(values)
    rows = lambda *x: lm.pa.RecordBatch.from_arrays([lm.pa.array(c) for c in zip(*x)], names=["block", "n", "weights"])
    (once,) = lm._added(True)([rows((0, 3, lm._packed(values)), (0, 5, lm._packed(-values)))])
    (twice,) = lm._added(False)([once, rows((0, 2, lm._packed(values)))])
    assert twice.column(1).to_pylist() == [10] and (lm._unpacked(twice.column(2)[0].as_py()) == -values).all()


@pytest.mark.parametrize("words, n", [(3, 200), (40, 200), (5000, 200), (60, 1024), (70_000, 30), (9, 1)])
def test_slopes_of_a_neighbour_add_up(words, n):
    """Neighbours that come once, a few times and often, at each place: one row each, with the sum of their slopes."""
    r = np.random.default_rng(words)
    around = np.minimum(r.geometric(min(1, 3 / words), (4, n)) - 1, words).astype(np.int32)
    slopes, want = r.standard_normal((n, lm.HIDDEN)).astype(np.float32), np.zeros((4 * (words + 1), lm.HIDDEN))
    sums, at = lm._sums_by_row(slopes, around, words + 1)
    for k in range(4):
        np.add.at(want, around[k] + k * (words + 1), slopes)
    assert sorted(at) == np.unique(around + (words + 1) * np.arange(4)[:, None]).tolist()
    assert np.allclose(sums, want[at], atol=1e-4)


def test_own_words_are_found_where_hashes_end_alike():
    r = np.random.default_rng(2)
    hashes = np.unique(np.concatenate([r.integers(-(1 << 62), 1 << 62, 900), np.arange(-300, 300) << 20, np.arange(200)]))
    numbers = r.permutation(len(hashes))
    known = lm.Vocabulary(hashes, numbers, np.ones(len(hashes) + lm.BUCKETS, dtype=np.int64), np.zeros(lm.BUCKETS, dtype=np.int64))
    own = dict(zip(hashes.tolist(), numbers.tolist()))
    asked = np.concatenate([hashes, hashes + 1, hashes ^ (1 << 40), -hashes])
    assert known.numbered(asked).tolist() == [own.get(h, len(own) + h % lm.BUCKETS) for h in asked.tolist()]
    assert known.numbered(asked[:0]).dtype == np.int32 and len(known.numbered(asked[:0])) == 0


@pytest.mark.parametrize("size", [lm._SIZE, 68 * lm.CLASSES, 35 * lm.CLASSES])
def test_a_share_alone_and_among_others_is_the_same(size):
    r = np.random.default_rng(size)
    net = lm.Network(r.integers(0, 50, size))
    for p in net.parts():
        p += (0.5 * r.standard_normal(p.shape)).astype(np.float32)
    around, word = r.integers(0, size + 1, (4, 3000)).astype(np.int32), r.integers(0, size, 3000)
    word[:1500] = 5
    logs = net.log_share(around, word)
    assert all(net.log_share(around[:, k : k + 1], word[k : k + 1])[0] == logs[k] for k in range(0, 3000, 50))
    h = np.rint(net.hide(around).astype(np.float64) * 256) / 256
    kind, share = word % lm.CLASSES, lambda x: x - np.log(np.exp(x).sum(axis=1, keepdims=True))
    of_class = share(h @ lm._rounded(net.to_class) + net.of_class)[np.arange(3000), kind]
    of_word = share(np.einsum("nh,nhp->np", h, lm._rounded(net.to_word)[kind]) + net.of_word[kind])[np.arange(3000), word // lm.CLASSES]
    assert np.allclose(logs, of_class + of_word, atol=1e-4)


def test_equal_weights_are_no_weights():
    r = np.random.default_rng(4)
    around, word = r.integers(0, lm._SIZE + 1, (4, 100)).astype(np.int32), r.integers(0, lm._SIZE, 100)
    found = []
    for weight in (None, np.full(100, 3.0)):
        net = lm.Network(np.arange(lm._SIZE))
        net.learn(around, word, 0.2, [np.full(p.shape, 1e-4, dtype=np.float32) for p in net.parts()], weight)
        found.append(net.flat().tobytes())
    assert found[0] == found[1]


def test_ranges_of_words_grow_with_the_vocabulary(spark, model, monkeypatch):
    """Few ranges, so that a slice has few lists; more only where a range would hold too many words. Scores stay."""
    known, weights = model
    of = lambda n: lm.Vocabulary(known.hashes[:0], known.numbers[:0], known.counts, np.array([n])).part_bits
    most = lm._PARTS * lm._PART_WORDS
    assert [of(n) for n in (0, 10**7, most, most + 1, 2 * most, 2 * most + 1)] == [8, 8, 8, 9, 9, 10]
    r, found = random.Random(8), []
    docs = spark.createDataFrame([(i, " ".join(f"n{r.randrange(999)}" for _ in range(200))) for i in range(40)], SCHEMA)
    own = lm.vocabulary(docs)
    for parts, words in ((1 << 8, 1 << 19), (2, 100), (2, 1 << 19)):
        monkeypatch.setattr(lm, "_PARTS", parts), monkeypatch.setattr(lm, "_PART_WORDS", words)
        found.append(sorted(tuple(x) for x in lm.score(docs, own, lm.Network(own.counts).flat()).collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) == 40

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, pretokens, token_counts
from tidemark.llm.bpe import Transducer
from tidemark.llm.queries import tokenizer_path

SCHEMA = "doc_id bigint, text string"
ODD = [*"abstrvlledm'' '  \n\t12é中.,!ßÉ  ½²x-\x85", "'s", "'re", "'ll", " '", "<|endoftext|>", "  ", "THE", " the"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def texts(seed, n):
    r = random.Random(seed)
    return ["".join(r.choices(ODD, k=r.randint(0, 80))) for _ in range(n)]


def test_chunk_maps_compose_to_the_sequential_run():
    kinds = np.random.default_rng(0).integers(0, 12, 5000).astype(np.uint8)
    nexts, cuts, _ = pretokens._tables()
    state, want = 0, []
    for k in kinds:
        want.append(cuts[state * 12 + k])
        state = nexts[state * 12 + k]
    for chunk in (1, 7, 256, 9000):
        assert (pretokens.run(kinds, chunk) == want).all()
    assert len(pretokens.run(kinds[:0])) == 0


def test_counts_equal_the_library_and_survive_forgetting(library):
    words = [w for t in texts(1, 300) for w, _ in library.pre_tokenizer.pre_tokenize_str(t.replace("<|endoftext|>", ""))]
    from tidemark.llm.bpe import byte_signs

    signs = byte_signs()
    machine = Transducer(tokenizer_path(), full=50)
    for w in set(words):
        raw = bytes(signs[c] for c in w)
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        assert machine.count(raw) == len(library.encode(text, add_special_tokens=False).ids)
    assert len(machine.moves) < 500


def test_documents_equal_the_library(spark, library):
    rows = list(enumerate(texts(2, 200))) + [(900, None), (901, ""), (902, "word " * 30_000), (903, " " * 9000 + "x"), (None, "a b"), (1, "twice")]
    found = token_counts.count_tokens(spark.createDataFrame(rows, SCHEMA).repartition(4), tokenizer_path())
    want = sorted((i is not None, i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows if i is not None)
    got = sorted((r.doc_id is not None, *r) for r in found.collect() if r.doc_id is not None)
    assert got == want
    assert found.where("doc_id is null").first().n_tokens == 2
    assert token_counts.count_tokens(spark.createDataFrame([], SCHEMA), tokenizer_path()).count() == 0


def check_packing(found, rows, library, capacity):
    want = []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in found)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), -(-sum(w[3] for w in want) // capacity)


def test_packing(spark, library):
    r = random.Random(3)
    rows = [(i, " ".join(["word"] * r.choice([0, 1, 3, 30, 31, 32, 60, 200, 500, r.randint(0, 300)]))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "a <|endoftext|>b\n\n c" * 50), (None, "x y"), (None, "x y"), (3, "again")]
    found = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(5), tokenizer_path(), capacity=64).collect()
    used, least = check_packing(found, rows, library, 64)
    assert used <= 1.01 * least + 1
    assert packing.pack(spark.createDataFrame([], SCHEMA), tokenizer_path()).count() == 0


def test_plan_is_the_sequential_rule():
    """Taking a combination as often as it lasts gives what taking one at a time gives."""
    r = random.Random(4)
    for _ in range(20):
        lengths = {x: r.randint(1, 6) for x in r.sample(range(1, 41), 12)}
        single, left = [], dict(lengths)
        while left:
            taken, _ = packing.plan(left, 40)[0]
            single.append(tuple(sorted(taken.items())))
            left = {x: n - taken.get(x, 0) for x, n in left.items() if n > taken.get(x, 0)}
        bulk = [tuple(sorted(t.items())) for t, n in packing.plan(lengths, 40) for _ in range(n)]
        assert sorted(single) == sorted(bulk)
        assert all(sum(x * n for x, n in t) <= 40 for t in bulk)


def test_the_fullest_combination_is_found():
    r = random.Random(5)
    for _ in range(50):
        left = {x: r.randint(1, 2) for x in r.sample(range(1, 30), 5)}
        items = [x for x, n in left.items() for _ in range(n)]
        room = r.randint(1, 60)
        best = max(s for m in range(1 << len(items)) if (s := sum(x for i, x in enumerate(items) if m >> i & 1)) <= room)
        taken = packing._fullest(left, room)
        assert sum(x * n for x, n in taken.items()) == best
        assert all(n <= left[x] for x, n in taken.items())

"""The pipeline's stages against plain versions of what they must do, and the contract of the registered queries."""

import random
import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_simhash import classes, fingerprint
from tests.llm.test_substring_dedup import brute as repeats
from tests.llm.test_tokens import check_packing
from tidemark.llm.queries import QUERIES, tokenizer_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(0)
    words = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiouéü" for c in ("", "n", "s", "ra", "ten", "ung")]
    benchmark = [(i, " ".join(r.choices(words, k=20)) + ".") for i in range(4)]
    shared = [" ".join(r.choices(words, k=r.randint(25, 50))) for _ in range(3)]
    rows = []
    for i in range(80):
        text = " ".join(r.choices(words, k=r.randint(30, 120)))
        if i % 9 == 1:
            text += "\n" + r.choice(shared) + " \n" + " ".join(r.choices(words, k=5))
        if i % 13 == 2:
            text = text[: len(text) // 2] + " " + benchmark[i % 4][1].upper() + " " + text[len(text) // 2 :]
        if i % 11 == 3:
            text = rows[-2][1]
        rows.append((i, text, ("en", "de", "fr")[i % 3], f"s{i % 2}", len(text)))
    rows += [(200, None, "en", None, None), (201, "", None, "s", 0), (202, "12 - 34", "en", "s", 7), (203, None, None, None, None)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, benchmark


def after(spark, rows, stage, folder):
    found = dict(corpus_pipeline.STAGES)[stage](spark, spark.createDataFrame(rows, SCHEMA).repartition(3), folder)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return sorted((tuple(x) for x in found.collect()), key=repr)


def plain(rows, benchmark):
    """The rows after each of the first four stages."""
    rows = [x for x in rows if re.search(r"[^\W\d_]", x[1] or "")]
    yield sorted(rows, key=repr)
    least = dict(zip([x[0] for x in rows], classes([x[0] for x in rows], [fingerprint(x[1]) for x in rows])))
    rows = [x for x in rows if least[x[0]] == x[0]]
    yield sorted(rows, key=repr)
    cut = {i: (kept, n, gone) for i, kept, n, gone in repeats([x[:2] for x in rows], 20)}
    rows = [x for x in rows if cut[x[0]][2] == 0 or cut[x[0]][1]]
    yield [(x[0], cut[x[0]][0]) for x in sorted(rows, key=repr) if cut[x[0]][1] > cut[x[0]][2] or not cut[x[0]][2]]
    found = {d for d, _ in leaks([x[:2] for x in rows], benchmark)}
    yield found


def test_stages_against_plain_versions(spark, corpus):
    folder, rows, benchmark = corpus
    steps = plain(rows, benchmark)
    kept = after(spark, rows, "language_id", folder)
    assert kept == next(steps)
    kept = after(spark, kept, "simhash_near_dedup", folder)
    assert kept == next(steps)
    before = {x[0]: x for x in kept}
    kept = after(spark, kept, "substring_dedup", folder)
    assert [(x[0], " ".join(x[1].split())) for x in kept] == [(i, t) for i, t in next(steps)]
    for x in kept:
        assert x[2:4] == before[x[0]][2:4] and x[4] == len(x[1])
    assert any(x[1] != before[x[0]][1] for x in kept) and sum(x[1] == before[x[0]][1] for x in kept) > 40
    clean = after(spark, kept, "benchmark_decontamination", folder)
    bad = {d for d, _ in leaks([x[:2] for x in kept], benchmark)}
    assert bad and clean == [x for x in kept if x[0] not in bad]
    packed = corpus_pipeline.STAGES[-1][1](spark, spark.createDataFrame(clean, SCHEMA), folder).collect()
    check_packing(packed, [x[:2] for x in clean], Tokenizer.from_file(tokenizer_path()), 1024)
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(x[:5] for x in map(tuple, whole)) == sorted(x[:5] for x in map(tuple, packed))


def test_stages_take_odd_tables(spark, corpus):
    folder, rows, _ = corpus
    wide = "doc_id bigint, text string, id int, own string, kept string, found string, fp int, rest string, lows int"
    odd = [(1, rows[0][1], 1, "a", "k", "f", 3, "r", 5), (1, rows[0][1], 1, "a", "k", "f", 3, "r", 5), (None, rows[4][1], None, None, None, None, None, None, None)]
    odd += [(7, None, 2, "x", None, None, None, None, None), (8, "", 2, "x", None, None, None, None, None)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = [f"{c} {k}" for c, k in (x.split() for x in wide.split(", "))]
        df = spark.createDataFrame(odd, ", ".join(columns))
        if name == "language_id":
            df = df.selectExpr("*", "'en' AS lang")
        found = stage(spark, df, folder)
        assert found.columns == df.columns
        ids = [x.doc_id for x in found.collect()]
        assert 1 in ids and None in ids
        assert stage(spark, df.where("1 = 0"), folder).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, spark.createDataFrame(odd, wide), folder).select("doc_id").distinct().count() == 4


def test_registered_queries_return_their_columns(spark, corpus, tmp_path):
    folder, rows, _ = corpus
    pages = [(1, "http://a.example.org/es/1", "<article><p>x</p></article>"), (2, None, None)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.mode("overwrite").parquet(f"{folder}/pages.parquet")
    want = {
        "op1": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
        "op2": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
        "op3": {"doc_id": "bigint", "item_id": "bigint", "score": "double"},
        "op4": dict.fromkeys(["edited_sha256", "fingerprint", "edited_fingerprint"], "string") | {"near_edited": "double", "near_next": "double", "n_chars": "bigint"},
        "op5": {"doc_id": "bigint", "n_words": "bigint", "log_prob": "double"},
        "op6": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
        "op7": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
        "op8": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
        "op9": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
        "op10": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
        "op11": {"doc_id": "bigint", "verified": "boolean"} | dict.fromkeys(["leaf", "subroot", "root", "proof_sha256", "folded_root"], "string"),
        "op12": dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank"], "bigint"),
        "op13": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    }
    assert {n.split("_")[0] for n in QUERIES} == set(want)
    for name, function in QUERIES.items():
        kinds = dict(function(spark, folder).dtypes)
        for column, kind in want[name.split("_")[0]].items():
            assert kinds[column] == kind, (name, column)


def test_documents_without_an_id_of_their_own_stay(spark):
    texts = [" ".join(f"{c}{k}word{i}" for i in range(40)) for k, c in enumerate("abcdef")]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (6, texts[3]), (6, texts[4]), (7, texts[5]), (8, texts[5]), (None, texts[5])]
    rows += [(6, texts[3]), (None, texts[0]), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).repartition(3)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.one_of_each(spark, docs, "").collect()]
    assert sorted(kept, key=repr) == sorted([*((None, t) for t in texts[:3]), (6, texts[3]), (6, texts[4]), (7, texts[5]), (None, None)], key=repr)

"""The registered queries of this package, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import decontamination, fingerprints, html_extract, importance, language_id, lm_scoring, merkle, minhash, packing, simhash, substring_dedup, token_counts, url_filters
from tidemark.session import apply_defaults


# The most tokens a document may have before ``over_limit``, and the vocabulary file of both token queries.
TOKEN_LIMIT = 512
VOCABULARY = "byte_bpe_50k.json"


def tokenizer_path(name: str = VOCABULARY) -> str:
    """Where the public tokenizers package keeps a vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, table: str, sql: str | None = None):
    """Register a function of one whole table."""

    def register(function: Callable[..., DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            rows = apply_defaults(spark).read.parquet(f"{sf_dir}/{table}.parquet")
            return function(rows, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return function

    return register


@_query(
    "op2_substring_dedup",
    "documents",
    """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
      FROM documents),
    win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS s
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
    marked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS rn FROM win),
    gone AS (SELECT doc_id, list(DISTINCT j) AS js FROM
      (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM marked WHERE rn > 1) GROUP BY doc_id),
    kept AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(len(js), 0) AS n_removed,
        CASE WHEN js IS NULL THEN ws ELSE list_transform(
          list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda x: NOT list_contains(js, x[2])), lambda x: x[1]) END AS ks
      FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id)
    SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(ks, ' '), '')) AS kept_sha256 FROM kept""",
)
def substring(docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(docs)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op6_simhash_near_dedup", "documents")
def near_copies(docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


@_query("op9_token_counts", "documents")
def tokens(docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(docs, tokenizer_path()).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@_query("op10_best_fit_packing", "documents")
def packed(docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


def held_out(doc_id: Column) -> Column:
    """The documents that language identification must not learn from; one without an id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@_query("op7_language_id", "documents")
def languages(docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs.where(~held_out(F.col("doc_id"))))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), language_id.identify(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


@_query("op3_benchmark_decontamination", "documents")
def leaks(docs: DataFrame, sf_dir: str) -> DataFrame:
    items = docs.sparkSession.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated(docs, items)


# The rules that the contract of the url query names.
URL_RULES = ["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"]


@_query("op1_url_filters", "pages")
def urls(pages: DataFrame, sf_dir: str) -> DataFrame:
    weights = url_filters.fit(url_filters.labelled_urls(pages.sparkSession))
    found = url_filters.judge(pages, [url_filters.parse_rule(r) for r in URL_RULES], weights)
    return found.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict", "judged.share")


@_query("op4_document_fingerprints", "documents")
def prints(docs: DataFrame, sf_dir: str) -> DataFrame:
    found = fingerprints.edited_fingerprints(docs)
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_print")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@_query("op8_html_extraction", "pages")
def texts(pages: DataFrame, sf_dir: str) -> DataFrame:
    site, path = url_filters.host_and_path(F.col("url"))
    section = F.when(F.size(F.split(path, "/")) > 2, F.split(path, "/")[1])
    found = html_extract.main_texts(pages.withColumn("page", F.struct("page_id", "url")), site, "page", section=section)
    return found.select("page.page_id", "page.url", "text", F.length("text").cast("long").alias("n_chars"))


@_query("op5_lm_scoring", "documents")
def likelihoods(docs: DataFrame, sf_dir: str) -> DataFrame:
    known = lm_scoring.vocabulary(docs)
    return lm_scoring.score(docs, known, lm_scoring.train(docs, known))


# The columns of a manifest's leaves, in the order in which they are hashed.
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]

# CRC-32 in SQL: a table of bytes, and a pass over the characters of an id.
_CRC_TABLE = """crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)),
      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i)))"""


@_query(
    "op11_merkle_manifest",
    "documents",
    f"""WITH RECURSIVE {_CRC_TABLE},
    docs AS (SELECT *, row_number() OVER () AS row, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
        lambda a, b: xor(a >> 8, t[1 + CAST(xor(a & 255, b) AS BIGINT)])), 4294967295) AS crc FROM documents, crc),
    fields AS (SELECT row, doc_id, source, crc, text,
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
        replace(text, chr(10), '') AS cut FROM docs),
    leaf AS (SELECT row, doc_id, coalesce('=' || source, '') AS src, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        sha256(head || CASE WHEN crc % 2 = 0 THEN coalesce(strlen(cut) || ':' || cut, '-')
          ELSE coalesce(strlen(text) || ':' || text, '-') END) AS tampered FROM fields),
    placed AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id, leaf, row) - 1 AS pos, count(*) OVER (PARTITION BY src) AS n FROM leaf),
    up AS (SELECT 0 AS level, src, pos, n, leaf AS d FROM placed
      UNION ALL SELECT level + 1, src, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY level, src, pos // 3, n),
    subroots AS (SELECT src, d, level, row_number() OVER (ORDER BY src) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
    top AS (SELECT 0 AS level, pos, n, d FROM subroots
      UNION ALL SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 3, n),
    nodes AS (SELECT src, level, pos, d FROM up WHERE n > 1
      UNION ALL SELECT s.src, s.level + t.level, t.pos, t.d FROM subroots s, top t WHERE t.n > 1),
    walk AS (SELECT p.row, p.src, 0 AS level, p.pos, p.tampered AS d, '' AS proof FROM placed p
      UNION ALL SELECT w.row, w.src, w.level + 1, CASE WHEN w.level + 1 = any_value(s.level) THEN any_value(s.pos) ELSE w.pos // 3 END,
        sha256(string_agg(CASE WHEN o.pos = w.pos THEN w.d ELSE o.d END, '' ORDER BY o.pos)),
        w.proof || coalesce(string_agg(CASE WHEN o.pos <> w.pos THEN o.d END, '' ORDER BY o.pos), '')
      FROM walk w JOIN subroots s ON w.src = s.src JOIN nodes o ON o.src = w.src AND o.level = w.level AND o.pos // 3 = w.pos // 3
      GROUP BY w.row, w.src, w.level, w.pos, w.d, w.proof)
    SELECT p.doc_id, p.leaf, s.d AS subroot, (SELECT d FROM top WHERE n = 1) AS root, sha256(w.proof) AS proof_sha256,
      w.d AS folded_root, w.d = (SELECT d FROM top WHERE n = 1) AS verified
    FROM placed p JOIN subroots s ON p.src = s.src
    JOIN walk w ON w.row = p.row AND w.level = s.level + (SELECT max(level) FROM top)""",
)
def tree(docs: DataFrame, sf_dir: str) -> DataFrame:
    leaves = merkle.row_leaves(docs, LEAF_COLUMNS, "doc_id", "source", "text")
    proved = merkle.manifest(leaves, "group", ["id"]).withColumn("kept", F.coalesce("tampered", "leaf"))
    found = merkle.verify(proved, "kept")
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _gram_sql(table: str) -> str:
    """Every document's words and its runs of one or two of them."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    found = f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""(SELECT row, doc_id, len(ws) AS n_words, list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS grams
      FROM (SELECT row_number() OVER () AS row, {'doc_id' if table == 'documents' else 'item_id'} AS doc_id, {found} AS ws FROM {table}))"""


@_query(
    "op12_importance_resampling",
    "documents",
    f"""WITH {_CRC_TABLE},
    d AS {_gram_sql('documents')}, b AS {_gram_sql('benchmark')},
    od AS (SELECT row, unnest(grams) AS gram FROM d), ob AS (SELECT unnest(grams) AS gram FROM b),
    grams AS (SELECT gram FROM od UNION SELECT gram FROM ob),
    bucketed AS (SELECT gram, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
        list_transform(range(1, strlen(gram) + 1), lambda i: CAST('0x' || substr(hex(encode(gram)), 2 * i - 1, 2) AS BIGINT))),
        lambda x, y: xor(x >> 8, t[1 + CAST(xor(x & 255, y) AS BIGINT)])), 4294967295) % 10000 AS bucket FROM grams, crc),
    s AS (SELECT bucket, count(*) AS n FROM od JOIN bucketed USING (gram) GROUP BY 1),
    t AS (SELECT bucket, count(*) AS n FROM ob JOIN bucketed USING (gram) GROUP BY 1),
    gain AS (SELECT r.i AS bucket, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM od) + 10000.0::DOUBLE))
        / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM ob) + 10000.0::DOUBLE)))) AS BIGINT) AS gain
      FROM range(10000) r(i) LEFT JOIN s ON s.bucket = r.i LEFT JOIN t ON t.bucket = r.i),
    mean AS (SELECT row, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
      FROM od JOIN bucketed USING (gram) JOIN gain USING (bucket) GROUP BY row),
    scored AS (SELECT d.row, doc_id, len(grams) AS n_features, n_words, coalesce(weight, 0) AS weight, coalesce(weight, 0)
        + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN mean USING (row)),
    ranked AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE n_words >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM ranked) * 25 // 100 THEN rank END AS rank
    FROM scored LEFT JOIN ranked USING (row)""",
)
def resampled(docs: DataFrame, sf_dir: str) -> DataFrame:
    target = docs.sparkSession.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


@_query(
    "op13_minhash_near_dedup",
    "documents",
    """WITH RECURSIVE w AS (SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    sets AS (SELECT row, doc_id, list_distinct(CASE WHEN len(ws) >= 3
        THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
    each AS (SELECT row, len(s) AS n, unnest(s) AS shingle FROM sets),
    met AS (SELECT a.row AS a, b.row AS b FROM each a JOIN each b ON a.shingle = b.shingle AND a.row <> b.row
      GROUP BY a.row, b.row HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
    reach(row, goal) AS (SELECT row, row FROM sets UNION SELECT r.row, m.b FROM reach r JOIN met m ON m.a = r.goal)
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, o.component_id, s.doc_id IS NOT DISTINCT FROM o.component_id AS kept
    FROM sets s JOIN (SELECT r.row, min(t.doc_id) AS component_id FROM reach r JOIN sets t ON t.row = r.goal GROUP BY r.row) o ON o.row = s.row""",
)
def near_sets(docs: DataFrame, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(docs)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

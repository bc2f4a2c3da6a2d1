"""A training-data pipeline over ``documents``: five stages, each an operator of ``tidemark.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontamination, language_id, packing, simhash, substring_dedup
from tidemark.llm.queries import held_out, tokenizer_path
from tidemark.llm.shared import settled
from tidemark.session import apply_defaults, scratch_path

# Language identification, the benchmark alignment and the packing have no SQL.
ORACLE_SQL = None


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without text or letters go. The model learns from the rows not held out."""
    apply_defaults(spark)
    model = language_id.train(docs.where(~held_out(F.col("doc_id"))))
    found = language_id.identify(F.col("text"), model)["lang_pred"]
    if model is None:
        # Nothing to tell languages by: what remains of the decision is whether there is text to read.
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return docs.where(found != language_id.UNKNOWN)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that with the smallest id (a null is the largest; ties by the text's hash).

    Different texts under one id, or without an id, are documents of their own; rows that repeat id and text become one.
    """
    apply_defaults(spark)
    found = settled(simhash.near_duplicates(docs))
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("texthash").alias("hash"))
    first = settled(found.groupBy("root").agg(F.min(key).alias("first")).select("first.*"))
    same = docs["doc_id"].eqNullSafe(first["id"]) & (F.xxhash64(docs["text"]) == first["hash"])
    kept = docs.join(first, same, "left_semi")
    # Texts are exchanged again only where there are rows to merge.
    repeats = found.groupBy("doc_id", "texthash").agg(F.count("*").alias("n")).where("n > 1")
    return kept if repeats.isEmpty() else kept.dropDuplicates(["doc_id", "text"])


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word sequences that an earlier document has; a document of which nothing is left goes."""
    apply_defaults(spark)
    found = substring_dedup.remove_repeats(docs, joined=False).where("n_removed = 0 OR n_removed < n_words")
    columns = []
    for c in docs.columns:
        own = F.col("doc_id") if c == "doc_id" else F.col("kept") if c == "text" else F.col("rest")[c]
        if c == "n_chars":
            own = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema[c].dataType)).otherwise(own)
        columns.append(own.alias(c))
    return found.select(*columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, copied or edited."""
    items = apply_defaults(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean(docs, items)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 1024 tokens at most."""
    apply_defaults(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", identify),
    ("simhash_near_dedup", one_of_each),
    ("substring_dedup", without_repeats),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; between two of them the documents are a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

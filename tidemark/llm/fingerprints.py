"""Bottom-k fingerprints of documents: the smallest hashes of their five-word shingles, in Spark functions only.

A fingerprint is a sorted array of at most ``K`` distinct 64-bit hashes. Those of two parts of a set merge into that of
the whole, and from two fingerprints follow resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.shared import settled

K = 128
SHINGLE = 5


def word_hashes(text: Column) -> Column:
    """A 64-bit hash for each word (a run of bytes other than space and tab to carriage return)."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def fingerprint(hashes: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text whose word hashes are in a column. Fewer words than a shingle has are one; none, none."""
    n = F.size(hashes)
    places = F.sequence(F.lit(0), n - shingle)
    each = F.transform(places, lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(shingle))))
    some = F.when(n >= shingle, each).when(n > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))
    return F.slice(F.sort_array(F.array_distinct(some)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The fingerprint of the union of two sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct(a: Column, k: int = K) -> Column:
    """The estimated number of distinct shingles; exact where fewer than ``k``."""
    share = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of common shingles among all of both, from 0 to 1; 1 if both sets are empty."""
    both = merged(a, b, k)
    common = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of the shingles of ``a`` that ``b`` has too, from 0 to 1; 1 if ``a`` is empty."""
    share = resemblance(a, b, k) * distinct(merged(a, b, k), k) / distinct(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0)))


def merge_by(prints: DataFrame, keys: list[str], print_col: str = "fingerprint", k: int = K) -> DataFrame:
    """One fingerprint for each group: (keys, fingerprint). Empty fingerprints alone give a group an empty one.

    Distinct hashes are ranked; Spark drops those beyond the k-th in each task before the exchange, so that a group of any
    size brings ``k`` rows from each.
    """
    each = prints.select(*keys, F.explode_outer(print_col).alias("hash")).distinct()
    order = Window.partitionBy(*keys).orderBy(F.col("hash").asc_nulls_last())
    first = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return first.groupBy(*keys).agg(F.sort_array(F.collect_list("hash")).alias(print_col))


def as_text(print_col: Column) -> Column:
    """Sixteen hexadecimal digits for each hash."""
    return F.array_join(F.transform(print_col, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_next(docs: DataFrame, id_col: str, size: Column) -> DataFrame:
    """(id, next, size): for each distinct id the next smaller one, after the smallest the largest, and the largest size.

    Ids are dealt out by range; each range finds its own neighbours and one row for each range the borders between them.
    """
    light = docs.select(F.col(id_col).alias("id"), size.alias("size")).where("id IS NOT NULL")
    ids = light.groupBy("id").agg(F.max("size").alias("size"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settled(ids.repartitionByRange(parts, "id").withColumn("part", F.spark_partition_id()))
    borders = ranged.groupBy("part").agg(F.max("id").alias("high"))
    below = F.lag("high").over(Window.orderBy("part"))
    top = F.max("high").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    borders = settled(borders.select("part", F.coalesce(below, top).alias("below")))
    inside = F.lead("id").over(Window.partitionBy("part").orderBy(F.col("id").desc()))
    linked = ranged.select("id", "size", "part", inside.alias("inside")).join(borders, "part")
    return linked.select("id", F.coalesce("inside", "below").alias("next"), "size")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_chars, edited (text), fingerprint, edited_print, near_edited and near_next.

    The edited text has its last third of characters, rounded down, replaced by as many first ones (or all) of the next
    document, in the order of falling ids; the largest follows the smallest. A null text is empty. A null id has no
    next document: nothing replaces what is cut. Where rows share an id, the smallest beginning stands for them as the
    next document; each row keeps its own text. Two empty texts resemble each other by 1.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    hashed = texts.select("id", "text", word_hashes(F.col("text")).alias("hashes"))
    every = hashed.select("id", "text", fingerprint(F.col("hashes")).alias("print"))
    # Both joins read ``own`` alike, so that its exchange is made once and used twice.
    own = every.where("id IS NOT NULL")
    link = settled(with_next(texts, "id", F.length("text")))
    link = link.select(F.col("id").alias("of"), "next", F.floor(F.col("size") / 3).cast("int").alias("third"))
    sent = own.join(link, F.col("id") == F.col("next")).select("of", F.struct(F.expr("left(text, third)").alias("start"), "print").alias("next"))
    sent = sent.groupBy("of").agg(F.min("next").alias("next"))
    alone = every.where("id IS NULL").select("*", F.col("id").alias("of"), F.lit(None).cast(sent.schema["next"].dataType).alias("next"))
    both = own.join(sent, F.col("id") == F.col("of"), "left").unionByName(alone)
    both = both.select("id", "text", "print", F.length("text").alias("n_chars"), F.coalesce("next.start", F.lit("")).alias("start"), F.col("next.print").alias("next_print"))
    cut = "concat(left(text, n_chars - cast(floor(n_chars / 3) as int)), left(start, cast(floor(n_chars / 3) as int)))"
    changed = both.select("id", "n_chars", "print", "next_print", F.expr(cut).alias("edited"))
    changed = changed.select("*", word_hashes(F.col("edited")).alias("hashes"))
    changed = changed.select("id", "n_chars", "edited", "print", "next_print", fingerprint(F.col("hashes")).alias("edited_print"))
    nothing = F.array().cast("array<bigint>")
    return changed.select(
        F.col("id").alias(id_col),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited",
        F.col("print").alias("fingerprint"),
        "edited_print",
        resemblance(F.col("print"), F.col("edited_print")).alias("near_edited"),
        resemblance(F.col("print"), F.coalesce("next_print", nothing)).alias("near_next"),
    )

"""A Merkle manifest of a table: a digest per row, a tree per group, a tree over the groups, a proof for each row.

A level of a tree is made by lag and lead columns at fixed offsets: a node stands on the row of its first leaf, so that its
siblings on level l stand 3^l or 2 x 3^l rows before or after it. Its slot and the length of its run mask what lies outside
of the run; the row of a run's first child hashes the parent. Seven levels are made within blocks of 3^7 leaves, of which
no run reaches out; the blocks' tops are the leaves of the next round. So no task sees a whole group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.places import placed
from tidemark.llm.shared import settled

ARITY = 3
# Levels made in one pass; a block of so many leaves stays in the memory that a window has.
LEVELS = 7


def field(column: Column) -> Column:
    """A value as it is hashed: its UTF-8 byte count, a colon and itself; a null is a minus sign."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """The SHA-256 of the parts, one after another, as lowercase hexadecimal digits."""
    return F.sha2(F.concat(*parts), 256)


def leaf(columns: Sequence[Column]) -> Column:
    return digest(*(field(c) for c in columns))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf leads to by the siblings along its path."""
    return F.aggregate(path, start, lambda own, step: digest(step["left"], own, step["right"]))


def siblings(path: Column) -> Column:
    """The digests along a path, one after another."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _runs(count: Column, step: int) -> Column:
    return F.ceil(count / F.lit(step)).cast("bigint")


def _block(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, pos, n, digest) with their block, the digest on top of it, and the path up to that."""
    width = ARITY**LEVELS
    rows = nodes.withColumn("block", F.floor(F.col("pos") / width).cast("bigint")).withColumn("d0", F.col("digest"))
    order = Window.partitionBy("tree", "block").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for level in range(LEVELS):
        step, own = ARITY**level, F.col(f"d{level}")
        around = {f"lag{k}": F.lag(own, k * step).over(order) for k in range(1, ARITY)}
        around |= {f"lead{k}": F.lead(own, k * step).over(order) for k in range(1, ARITY)}
        rows = rows.withColumns(around)
        nodes_here = _runs(F.col("n"), step)
        at = F.floor(F.col("pos") / step)
        slot = at % ARITY
        run = F.least(F.lit(ARITY), nodes_here - (at - slot))
        live = (F.col("pos") % step == 0) & (nodes_here > 1)
        left = F.concat(*(F.when(slot >= k, F.col(f"lag{k}")).otherwise("") for k in range(ARITY - 1, 0, -1)))
        right = F.concat(*(F.when(run - slot > k, F.col(f"lead{k}")).otherwise("") for k in range(1, ARITY)))
        parent = F.when(live & (slot == 0), digest(own, right))
        rows = rows.withColumns(
            {f"step{level}": F.when(live, F.struct(left.alias("left"), right.alias("right"))), f"d{level + 1}": F.when(nodes_here > 1, parent).otherwise(own)}
        ).drop(*around)
    steps = [F.last(f"step{level}", ignorenulls=True).over(so_far) for level in range(LEVELS)]
    top = F.first(f"d{LEVELS}").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumns({"path": F.array(*steps), "top": top})
    return rows.select(*nodes.columns, "block", F.filter("path", lambda s: s.isNotNull()).alias("path"), "top")


def climb(nodes: DataFrame, most: int, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``nodes`` (tree, pos, n, digest and others) with ``path``, ``subroot`` and ``root``; ``most`` is the largest n.

    ``finish`` gets each tree's last node (tree, digest) and gives for it the path, subroot and root that it goes on to.
    """
    if most <= 1:
        return nodes.join(finish(nodes.select("tree", "digest")), "tree")
    width = ARITY**LEVELS
    within = _block(nodes)
    first = within.where(F.col("pos") % width == 0)
    tops = settled(first.select("tree", F.col("block").alias("pos"), _runs(F.col("n"), width).alias("n"), F.col("top").alias("digest")))
    above = climb(tops, -(-most // width), finish)
    above = above.select("tree", F.col("pos").alias("block"), F.col("path").alias("above"), "subroot", "root")
    met = within.join(above, ["tree", "block"])
    return met.select(*nodes.columns, F.concat("path", "above").alias("path"), "subroot", "root")


def _group_roots(tops: DataFrame) -> DataFrame:
    """The tree over the last nodes of all trees, in the order of their groups, a null first."""
    empty = F.lit(None).cast("array<struct<left:string,right:string>>")
    named = tops.select(F.lit(0).alias("all"), F.col("tree").alias("name"), F.col("digest").alias("subroot"))
    # A tree's name is its group as it is hashed: "-", or what follows the colon.
    group = F.when(F.col("name") != "-", F.expr("substring(name, instr(name, ':') + 1)"))
    rows = placed(settled(named.withColumn("group", group)), "all", ["group"])
    nodes = rows.select(F.col("all").alias("tree"), "pos", "n", F.col("subroot").alias("digest"), F.col("name"))

    def ended(last: DataFrame) -> DataFrame:
        return last.select("tree", F.coalesce(empty, F.array()).alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))

    found = climb(nodes, nodes.agg(F.max("n")).first()[0] or 0, ended)
    return settled(found.select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "root"))


def manifest(leaves: DataFrame, group: str, order: Sequence[str], digest_col: str = "leaf") -> DataFrame:
    """``leaves`` with ``subroot`` (of the row's group), ``root`` (of all) and ``path``, the siblings up to the root.

    Within a group the leaves ascend by ``order``, ties in ``digest_col``; repeated rows are leaves of their own. A null
    group is a group, the first. Per level, three consecutive nodes (the last run may have fewer, even one) become one;
    a tree with one node is done. The groups' subroots are the leaves of the upper tree, ordered by the group's UTF-8
    bytes. A null in ``order`` comes first. No rows give no rows. ``leaves`` is read more than once: settle it.
    """
    taken = [c for c in leaves.columns if c in ("path", "subroot", "root")]
    if taken:
        raise ValueError(f"columns that the manifest adds: {taken}")
    row = F.struct(*(F.col(f"`{c}`") for c in leaves.columns))
    keyed = leaves.select(row.alias("own"), field(F.col(group)).alias("tree"), F.col(digest_col).alias("digest"))
    nodes = placed(keyed, "tree", [*(F.col("own")[c] for c in order), "digest"])
    found = climb(nodes, nodes.agg(F.max("n")).first()[0] or 0, _group_roots)
    return found.select("own.*", "subroot", "root", "path")


def row_leaves(rows: DataFrame, columns: Sequence[str], id_col: str, group: str, text_col: str) -> DataFrame:
    """(id, group, ``leaf``, ``tampered``) per row, settled: the digest of ``columns``, and what it becomes in a copy of the
    table in which the text of the rows whose id has an even CRC-32 has lost its line feeds (null in all other rows)."""
    cut = F.translate(F.col(text_col), "\n", "")
    even = (F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0) & (F.instr(text_col, "\n") > 0)
    changed = leaf([cut if c == text_col else F.col(c) for c in columns])
    return settled(rows.select(F.col(id_col).alias("id"), F.col(group).alias("group"), leaf([F.col(c) for c in columns]).alias("leaf"), F.when(even, changed).alias("tampered")))


def verify(proved: DataFrame, leaf_col: str) -> DataFrame:
    """``proved`` with ``proof_sha256`` (of the path's digests), ``folded_root`` (of ``leaf_col`` along the path), ``verified``."""
    folded = proved.withColumn("folded_root", fold(F.col(leaf_col), F.col("path")))
    return folded.withColumns({"proof_sha256": F.sha2(siblings(F.col("path")), 256), "verified": F.col("folded_root") == F.col("root")})

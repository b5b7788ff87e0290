"""Merkle manifest of a table: a hash tree over its rows, with a proof for each.

Every row is a leaf; the leaves of a group (here: a language) are numbered in
order, and every 8 consecutive nodes hash to their parent until one node, the
group's subroot, is left. The subroots form the topmost tree in the same way.

A block is 512 consecutive nodes of a group. It is one row that keeps each of
its levels as one string of 64 hex characters a node: parents are hashes of
substrings of fixed width, and what flanks a node within its run of 8 is the
segment of its siblings. The tops of the blocks are the nodes of the next
round, until every group is one block; then the paths go down again, block by
block. A block is the largest thing that a task holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import ascii_lower, broadcast_small, stash
from costlens.operators.ranking import exact_rank

FAN = 8
LEVELS = 3  # of a block
BLOCK = FAN ** LEVELS
HEX = 64
# Paths that are broadcast at most; one has up to 1,344 characters a round, so this is under 50 MB.
PATH_ROWS = 4_000


def field(value: Column) -> Column:
    """``-`` for null, else the byte count of the value's text, a colon and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts joined."""
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def _cut(level: Column, start: Column, nodes: Column) -> Column:
    """``nodes`` nodes of a level from the 0-based ``start`` (of bytes, so cutting does not walk the string)."""
    return F.substring(level.cast("binary"), start.cast("int") * HEX + 1, F.greatest(nodes.cast("int"), F.lit(0)) * HEX).cast("string")


def _above(level: Column, n: Column) -> Column:
    """The next level's string: the hash of every run of a level of ``n`` nodes."""
    runs = F.transform(F.sequence(F.lit(0), F.ceil(n / FAN).cast("int") - 1), lambda j: digest(_cut(level, j * FAN, F.lit(FAN))))
    return F.array_join(runs, "")


def _count(n: Column, level: int) -> Column:
    return F.ceil(n / FAN ** level).cast("int")


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per block of ``nodes`` (g, at, n, node, item): its items in order, its level strings and its top.

    A group of one block ends at its root, any other block three levels up.
    """
    b = nodes.groupBy("g", F.floor(F.col("at") / BLOCK).alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "node", "item"))).alias("nodes"))
    b = b.withColumn("size", F.size("nodes")).withColumn("level0", F.array_join("nodes.node", ""))
    for k in range(LEVELS):
        b = b.withColumn(f"level{k + 1}", _above(F.col(f"level{k}"), _count(F.col("size"), k)))
    least = F.lit(LEVELS)
    for k in range(LEVELS - 1, -1, -1):
        least = F.when(F.col("n") <= FAN ** k, F.lit(k)).otherwise(least)
    b = b.withColumn("height", least)
    top = F.col(f"level{LEVELS}")
    for k in range(LEVELS - 1, -1, -1):
        top = F.when(F.col("height") == k, F.col(f"level{k}")).otherwise(top)
    return stash(b.withColumn("top", top).drop(f"level{LEVELS}"), "merkle-block")


def _path_in_block(i: Column) -> Column:
    """(left, right) siblings of the block's node ``i`` on each of its levels."""
    steps = []
    for k in range(LEVELS):
        at = F.floor(i / FAN ** k)
        start = F.floor(i / FAN ** (k + 1)) * FAN
        end = F.least(start + FAN, _count(F.col("size"), k))
        level = F.col(f"level{k}")
        steps.append(F.struct(_cut(level, start, at - start).alias("left"), _cut(level, at + 1, end - at - 1).alias("right")))
    return F.slice(F.array(*steps), F.lit(1), F.col("height"))


_PATH = "array<struct<left:string,right:string>>"


def tree(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hash trees of ``nodes`` (g, at: 0-based place, n: nodes of the group, node: digest, item: anything).

    Returns one row per node (g, at, node, item, path: the siblings left and
    right on every level from the node up) and one per group (g, root). ``g``
    must not be null.
    """
    item = nodes.schema["item"].dataType
    blocks = _blocks(nodes)
    many = blocks.where(F.col("n") > BLOCK)
    roots = blocks.where(F.col("n") <= BLOCK).select("g", F.col("top").alias("root"))
    if many.limit(1).count():
        upper, upper_roots = tree(many.select(
            "g", F.col("block").alias("at"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("node"),
            F.lit(0).alias("item")))
        above = upper.select("g", F.col("at").alias("block"), F.col("path").alias("above"))
        above = broadcast_small(stash(above, "merkle-path"), PATH_ROWS)
        blocks = blocks.join(above, ["g", "block"], "left")
        roots = roots.unionByName(upper_roots)
    else:
        blocks = blocks.withColumn("above", F.lit(None).cast(_PATH))
    rest = F.coalesce("above", F.array().cast(_PATH))
    each = F.transform("nodes", lambda x, i: F.struct(
        x["at"].alias("at"), x["node"].alias("node"), x["item"].cast(item).alias("item"),
        F.concat(_path_in_block(i), rest).alias("path")))
    return blocks.select("g", F.inline(each)), roots


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def manifest(docs: DataFrame, tampered: Column | None = None, id_col: str = "doc_id", group_col: str = "lang",
             fields: tuple = ("doc_id", "source", "lang", "n_chars", "text"), text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf hashes ``fields``. Leaves of a group ascend by id (null first),
    rows with one id by leaf; equal rows are equal leaves. The subroots ascend
    by group, null first, then by bytes. Rows where ``tampered`` holds fold
    the leaf of their lower-cased text (A-Z only) instead of their own; a null
    condition means untouched. ``verified`` says that the folded root is the
    root. Null fields are part of the leaf as such, so a null and an empty
    text differ; null groups form a group. Whole texts are hashed; only their
    digests are shuffled. Other columns are ignored. An empty table has no
    rows and no root.
    """
    leaf = digest(*[field(F.col(c)) for c in fields])
    touched = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    other = digest(*[field(ascii_lower(F.col(c)) if c == text_col else F.col(c)) for c in fields])
    # The group as a text that sorts as the group does; null first.
    g = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = stash(docs.select(F.col(id_col).alias("id"), g.alias("g"), leaf.alias("node"),
                               F.when(touched, other).alias("other")), "merkle-leaf")
    ranked = exact_rank(leaves, ["id", "node"], ["g"], out="at", total="n")
    paths, subroots = tree(ranked.select("g", "at", "n", "node", F.struct("id", "other").alias("item")))
    subroots = stash(subroots, "merkle-subroot")
    groups = exact_rank(subroots, ["g"], out="at", total="n")
    top, root = tree(groups.select(F.lit("").alias("g"), "at", "n", F.col("root").alias("node"), F.col("g").alias("item")))
    # One row a group, with its way to the root.
    top = top.select(F.col("item").alias("g"), F.col("node").alias("subroot"), F.col("path").alias("rest"), F.col("g").alias("all"))
    top = top.join(root.withColumnRenamed("g", "all"), "all").drop("all")
    out = paths.join(broadcast_small(stash(top, "merkle-top"), PATH_ROWS), "g")
    whole = F.concat("path", "rest")
    out = out.select(F.col("item.id").alias("doc_id"), F.col("node").alias("leaf"), "subroot", "root",
                     digest(siblings(whole)).alias("proof_sha256"),
                     fold(F.coalesce("item.other", "node"), whole).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

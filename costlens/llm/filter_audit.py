"""What each of five filters removes, alone and in every order of applying them.

Every document gets a mask of the filters that it fails. Four of them look at
its own text. The fifth, an equal text under a smaller id, is found behind a
counting Bloom filter: every text adds one to two counters, partial counts
are merged by addition, and a text with a counter of one is surely unique.
Only the others go through the shuffle that finds the least id of each full
text (told apart by length and SHA-256, so texts stay where they are read).
Documents then add up by part and mask, at most 32 rows a part, and all
orders are worked out from these counts.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import UPPER, broadcast_small, stash

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
# Counters per document, rounded up to a power of two: with two to a text, about 2 % of the unique ones stay in doubt.
COUNTERS = 16
# Pieces of the shared counters' bitmap (4 KB each) that are broadcast at most; more are joined by shuffle.
BITMAP_PIECES = 8_000
_SPACES = "\t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Limits:
    """Bounds of the filters on single documents."""

    min_words: int = 200
    distinct_percent: int = 50  # distinct words to words
    upper_percent: int = 3  # A-Z to characters
    symbols: str = "[#$%&*|]"


def _bit(fails: Column, letter: str) -> Column:
    return F.when(fails, F.lit(1 << FILTERS.index(letter))).otherwise(F.lit(0))


def own_mask(text: Column, limits: Limits = Limits()) -> Column:
    """The filters A to D that a text (not null) fails, as bits."""
    words = F.array_remove(F.split(F.translate(text, _SPACES, " " * len(_SPACES)), " ", -1), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    chars = F.length(text)
    capitals = chars - F.length(F.translate(text, UPPER, ""))
    return (_bit(n < limits.min_words, "A") + _bit(100 * distinct < limits.distinct_percent * n, "B")
            + _bit(100 * capitals > limits.upper_percent * chars, "C") + _bit(text.rlike(limits.symbols), "D"))


def _counters(key: Column, m: int) -> list[Column]:
    """The two counters of a text among ``m`` (a power of two)."""
    return [F.xxhash64(key, F.lit(seed)).bitwiseAND(F.lit(m - 1)) for seed in (1, 2)]


def shared_counters(rows: DataFrame, m: int) -> DataFrame:
    """Bitmap pieces (piece, bits) of the counters that reached two.

    Every task counts its own texts first, and the counts are merged by
    addition, so a text that fills the table costs one row a task.
    """
    counts = rows.select(F.explode(F.array(*_counters(F.col("key"), m))).alias("c")).groupBy("c").agg(
        F.count(F.lit(1)).alias("k")).where("k > 1")
    return counts.groupBy(F.expr("bitmap_bucket_number(c)").alias("piece")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(c))").alias("bits"))


def with_doubt(rows: DataFrame, bitmap: DataFrame, m: int) -> DataFrame:
    """The rows with ``doubt``: false if a counter of the text is its own, so that no other text is equal."""
    out = rows.withColumn("doubt", F.lit(True))
    for i, c in enumerate(_counters(F.col("key"), m)):
        side = bitmap.select(F.col("piece").alias("_piece"), F.col("bits").alias("_bits"))
        out = out.withColumn("_c", c).withColumn("_piece", F.expr("bitmap_bucket_number(_c)")).join(side, "_piece", "left")
        byte = "conv(hex(substring(_bits, cast(bitmap_bit_position(_c) div 8 as int) + 1, 1)), 16, 10)"
        bit = F.expr(f"getbit(cast({byte} as bigint), cast(bitmap_bit_position(_c) % 8 as int)) = 1")
        out = out.withColumn("doubt", F.col("doubt") & F.coalesce(bit, F.lit(False))).drop("_c", "_piece", "_bits")
    return out


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
             limits: Limits = Limits()) -> DataFrame:
    """Documents by (id, part, mask) with their number ``n``; ``mask`` has a bit for each filter failed.

    A null text counts as empty and a null part as the empty string. Rows with
    a null id neither repeat another nor are repeated, and rows that share an
    id repeat only smaller ids.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stash(docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        own_mask(text, limits).alias("mask"),
        F.concat(F.unhex(F.sha2(text, 256)), F.unhex(F.hex(F.octet_length(text).cast("long")))).alias("key")), "audit-row")
    n = rows.count()
    m = 1 << max(16, (COUNTERS * max(n, 1) - 1).bit_length())
    bitmap = broadcast_small(stash(shared_counters(rows, m), "audit-bitmap"), BITMAP_PIECES)
    rows = stash(with_doubt(rows, bitmap, m), "audit-doubt")
    maybe = rows.where("doubt and id is not null")
    least = maybe.groupBy("key").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    # A row that may repeat is no repeat if it has the least id of its text; the join key is (id, text), which no hot text fills.
    again = _bit(F.col("first").isNull(), "E")
    maybe = maybe.groupBy("id", "key", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    maybe = maybe.join(least, ["id", "key"], "left").select("id", "part", (F.col("mask") + again).alias("mask"), "n")
    clear = rows.where("not doubt or id is null").groupBy("id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    return clear.unionByName(maybe)


def mask_counts(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per (part, mask): documents ``n``, of them ``good`` (a label has quality 1) and ``toxic`` (a label has toxic 1)."""
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic"))
    n = F.col("n")
    return failed.join(marks, "id", "left").groupBy("part", "mask").agg(
        F.sum(n).alias("n"), F.sum(F.when(F.col("is_good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), n).otherwise(0)).alias("toxic"))


def interactions(counts: DataFrame) -> DataFrame:
    """Per (part, filter_order, step) what the step's filter does, from counts by mask."""
    steps = counts.withColumn("filter_order", F.explode(F.lit(ORDERS))).withColumn("step", F.explode(F.lit([1, 2, 3, 4, 5])))
    steps = steps.withColumn("filter", F.expr("substring(filter_order, step, 1)"))
    bit = sum((_bit(F.col("filter") == x, x) for x in FILTERS), F.lit(0))
    before = sum((_bit(F.instr("filter_order", x) < F.col("step"), x) for x in FILTERS), F.lit(0))
    steps = steps.withColumn("fails", F.col("mask").bitwiseAND(bit) != 0).withColumn("gone", F.col("mask").bitwiseAND(before) != 0)
    removed = F.col("fails") & ~F.col("gone")
    # A filter comes first among the filters that a document fails in an equal share of all orders.
    share = F.lit(len(ORDERS)) / F.greatest(F.bit_count("mask"), F.lit(1))
    total = lambda cond, value="n": F.sum(F.when(cond, F.col(value) if isinstance(value, str) else value).otherwise(0)).cast("long")
    return steps.groupBy("part", "filter_order", "step", "filter").agg(
        total(~F.col("fails") & ~F.col("gone")).alias("kept"), total(removed).alias("removed"),
        total(F.col("fails") & F.col("gone")).alias("redundant"), total(F.col("mask") == bit).alias("unique_fails"),
        total(removed, "good").alias("good_lost"), total(removed, "toxic").alias("toxic_lost"),
        total(F.col("fails"), F.col("n") * share.cast("long")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
          limits: Limits = Limits()) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Filters: A too few words, B too few distinct ones, C too many capitals, D
    a symbol, E a text that a smaller id has, whether removed or not. Counts
    are of rows, so repeated rows count each. Null texts are empty texts, null
    parts the empty string; a null id has no labels and no repeats. A
    document counts as good or toxic if any of its labels says so. An empty
    table has no parts and no rows. Other columns are ignored. The words of
    one text are held at once, nothing longer.
    """
    counts = stash(mask_counts(failures(docs, id_col, text_col, part_col, limits), labels, id_col), "audit-count")
    return interactions(counts)

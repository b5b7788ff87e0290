"""Conflict-constrained best-fit packing of documents into fixed-length sequences.

A document longer than a sequence fills whole sequences of its own; its rest
(or a short document as a whole) is packed with others. Bins are ordered by
residual capacity and carry two bitmaps, of the sources and of the duplicate
clusters they hold. A piece goes to the tightest bin that has room and holds
neither its source nor its cluster: a successor search from the piece's
length upward goes on until such a bin is found, else a new bin opens.
Pieces come in order of falling length.

Only ids, lengths and hashes are shuffled, never texts. Pieces are dealt by a
hash into groups of about ``GROUP`` pieces that are packed apart, so memory is
bounded and a hot source or cluster is spread over all groups.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import stash

CAPACITY = 2048
GROUP = 2048
PIECES = ("doc_id long, piece int, start long, n_tokens int, seq_id string, seq_offset int")


def token_count(text: Column) -> Column:
    """Tokens of a text by a plain rule: runs of word characters, and single other marks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]")), F.lit(0))


def cluster_key(text: Column) -> Column:
    """Exact-duplicate cluster of a text, by case and white space alike; null for null."""
    return F.md5(F.regexp_replace(F.lower(F.trim(text)), "\\s+", " "))


def best_fit(lengths, sources, clusters, capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each piece, packed in the order given; None is a source or cluster without conflicts."""
    source_bit, cluster_bit = {}, {}
    bit = lambda known, x: 0 if x is None else 1 << known.setdefault(x, len(known))
    bins, held = [], []  # (residual, bin number) in order; the two bitmaps of each bin
    out = []
    for n, s, c in zip(lengths, sources, clusters):
        sb, cb = bit(source_bit, s), bit(cluster_bit, c)
        at = bisect_left(bins, (n, -1))
        while at < len(bins) and (held[bins[at][1]][0] & sb or held[bins[at][1]][1] & cb):
            at += 1
        if at < len(bins):
            room, b = bins.pop(at)
        else:
            room, b = capacity, len(held)
            held.append([0, 0])
        held[b][0] |= sb
        held[b][1] |= cb
        out.append((b, capacity - room))
        if room > n:
            insort(bins, (room - n, b))
    return out


def _pack_group(capacity: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held = None, []

        def packed():
            f = pd.concat(held, ignore_index=True)
            none = lambda x: None if x is None or x != x else x
            bins = best_fit(f["n_tokens"].tolist(), [none(x) for x in f["source"]], [none(x) for x in f["cluster"]], capacity)
            f["seq_id"] = [f"{group}-{b}" for b, _ in bins]
            f["seq_offset"] = np.array([o for _, o in bins], dtype=np.int32)
            return f[["doc_id", "piece", "start", "n_tokens", "seq_id", "seq_offset"]]

        for f in frames:
            for g, part in f.groupby("grp", sort=False):
                if g != group and held:
                    yield packed()
                    held = []
                group = g
                held.append(part)
        if held:
            yield packed()

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         capacity: int = CAPACITY, tokens: Column | None = None, cluster: Column | None = None,
         per_group: int = GROUP) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, n_tokens, seq_id, seq_offset.

    ``tokens`` gives a document's length (default ``token_count``) and
    ``cluster`` its duplicate cluster (default ``cluster_key``). A sequence
    holds ``capacity`` tokens at most and no source or cluster twice; a null
    source or cluster conflicts with nothing. Documents without tokens (null
    or empty) give no piece. Repeated rows are packed each; an empty table
    gives no rows. Ids, lengths and digests are computed in one scan and
    written; pieces are dealt by them and by the number of the copy among equal
    rows, so the sequences do not hang on the rows' order or partitioning.
    Other columns are left out.
    """
    text = F.col(text_col)
    each = stash(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        (token_count(text) if tokens is None else tokens).cast("long").alias("n"),
        (cluster_key(text) if cluster is None else cluster).cast("string").alias("cluster"),
        F.sha1(text.cast("string")).alias("digest")).where("n > 0"), "lengths")
    groups = max(1, -(-each.count() // per_group))
    # Equal rows are counted, and come back as copies 0, 1, ...
    base = each.groupBy(*each.columns).agg(F.count(F.lit(1)).alias("copies")).withColumn(
        "row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
    c = F.lit(capacity)
    whole = F.floor(F.col("n") / c).cast("int")
    rest = (F.col("n") % c).cast("int")
    # The rest of each document, or the document itself, is packed; the whole sequences of long ones are not.
    left = base.where(rest > 0).select(
        F.pmod(F.xxhash64("doc_id", "digest", "row"), F.lit(groups)).cast("int").alias("grp"), "doc_id", whole.alias("piece"),
        (whole * c).cast("long").alias("start"), rest.alias("n_tokens"), "source", "cluster", "digest", "row")
    left = left.repartition("grp").sortWithinPartitions("grp", F.desc("n_tokens"), "doc_id", "piece", "digest", "source", "cluster", "row")
    packed = left.drop("digest", "row").mapInPandas(_pack_group(capacity), PIECES)
    # A sequence's name: id, text, source and number of the copy.
    name = F.concat_ws("-", F.lit("w"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.substring("digest", 1, 16),
                       F.hex(F.xxhash64("source", "n", "cluster")), "row")
    full = base.where(whole > 0).select("doc_id", name.alias("name"), F.explode(F.sequence(F.lit(0), whole - 1)).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * c).cast("long").alias("start"), F.lit(capacity).alias("n_tokens"),
        F.concat("name", F.lit("-"), "piece").alias("seq_id"), F.lit(0).alias("seq_offset"))
    return packed.unionByName(full)

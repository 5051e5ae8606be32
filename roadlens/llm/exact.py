"""Exact deduplication with a heavy-hitter split, in DataFrame and SQL functions only.

Two texts are equal when they are identical after every character of ``[\\x20\\x09-\\x0D]`` is
deleted. Of equal texts the row with the most code points stays, then the one with the
smallest doc_id.

1. One pass over the texts writes a narrow table of digests.
2. Frequent-items sketches (Misra-Gries counters) over that table, merged in two steps, name
   every digest with at least ``share`` of the rows. Exact aggregates over just those rows
   verify them and find their winners: at most ``1 / share`` rows, which are broadcast, so rows
   of heavy digests are settled where they are read.
3. All other digests are settled by a window behind one ordinary shuffle; none of their groups
   is larger than ``share`` of the rows (plus the sketch error, a quarter of that).

Defined results: a null text counts as empty; empty texts are one group. A null doc_id loses
ties. Repeated rows (same doc_id, equal text) count in ``group_size`` and share their flag;
``survivors`` returns one of them. Columns besides doc_id and text are never read by
``decisions``, whatever they are called. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.survivors import text_key, without_rejected
from roadlens.operators.lineage import staged
from roadlens.operators.ordered import shuffle_width

BLANKS = " \t\n\x0b\x0c\r"


def digest_columns() -> dict:
    text = F.coalesce(F.col("text"), F.lit(""))
    return {
        "text_sha256": F.sha2(F.translate(text, BLANKS, ""), 256),
        "code_points": F.char_length(text),
        "text_key": text_key(),
    }


def frequent(digests: DataFrame, share: float) -> DataFrame:
    """Digests that may hold at least ``share`` of the rows: never misses one, few are false.

    The sketch tracks 4 / share counters rounded up to a power of two, so its error stays
    under share / 3 of the rows.
    """
    counters = 1 << (int(4 / share) - 1).bit_length()
    most = int(1 / share)
    rows = digests.count()
    buckets = F.pmod(F.spark_partition_id(), F.lit(shuffle_width(digests.sparkSession)))
    parts = digests.groupBy(buckets.alias("bucket")).agg(
        F.expr(f"approx_top_k_accumulate(text_sha256, {counters})").alias("sketch")
    )
    # Grouped, so that empty partitions, whose sketch would have no type, emit nothing.
    whole = parts.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {counters})").alias("sketch"))
    items = whole.select(
        F.explode(F.expr(f"approx_top_k_estimate(sketch, {2 * most})")).alias("top")
    )
    # An estimate may be low by the sketch's error, so the line is drawn below the share.
    floor = max(2.0, share * rows / 2)
    return items.where(F.col("top.count") >= floor).select(F.col("top.item").alias("text_sha256"))


def decisions(docs: DataFrame, share: float = 1e-3) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return _decided(docs, share).drop("text_key")


def _decided(docs: DataFrame, share: float) -> DataFrame:
    digests = staged(docs.select("doc_id", *[c.alias(n) for n, c in digest_columns().items()]))
    best = F.min(F.struct(-F.col("code_points"), F.col("doc_id").isNull(), F.col("doc_id")))
    size = F.count(F.lit(1))
    heavy = F.broadcast(frequent(digests, share))  # at most 2 / share rows
    heavy_rows = digests.join(heavy, "text_sha256", "left_semi")
    winners = staged(heavy_rows.groupBy("text_sha256").agg(best.alias("best"), size.alias("group_size")))
    few = F.broadcast(winners)  # one row per heavy digest
    settled = digests.join(few, "text_sha256")
    same = Window.partitionBy("text_sha256")
    others = digests.join(few, "text_sha256", "left_anti")
    ranked = others.withColumns({"best": best.over(same), "group_size": size.over(same)})
    keep = F.col("best.doc_id")
    return settled.unionByName(ranked).select(
        "doc_id",
        keep.alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
        "text_key",
    )


def survivors(docs: DataFrame, share: float = 1e-3) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return without_rejected(docs, _decided(docs, share).select("doc_id", "text_key", "kept"))

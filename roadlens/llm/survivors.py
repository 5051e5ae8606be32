"""Taking the rows that a decision table rejects out of a table of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.operators.lineage import staged

FEW_ROWS = 500_000  # so many rejected rows of two numbers are broadcast at most; beyond, a shuffle


def text_key() -> Column:
    """Tells rows with the same doc_id apart."""
    return F.xxhash64("text")


def without_rejected(docs: DataFrame, told: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``told`` (doc_id, text_key, kept) keeps, with all their columns.

    Of rows that repeat one kept document (same doc_id and text) one stays.
    """
    told = staged(told.groupBy("doc_id", "text_key", "kept").agg(F.count(F.lit(1)).alias("n")))
    gone = told.where(~F.col("kept")).select(
        F.col("doc_id").alias("__gone_id"), F.col("text_key").alias("__gone_text")
    )
    if gone.count() <= FEW_ROWS:
        gone = F.broadcast(gone)
    own = "__own_text"
    same = F.col("doc_id").eqNullSafe(F.col("__gone_id")) & (F.col(own) == F.col("__gone_text"))
    stay = docs.withColumn(own, text_key()).join(gone, same, "left_anti")
    if not told.where(F.col("kept") & (F.col("n") > 1)).isEmpty():
        stay = stay.dropDuplicates(["doc_id", own])
    return stay.drop(own)

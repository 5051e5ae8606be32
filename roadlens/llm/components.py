"""Connected components of a table of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.operators.lineage import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of a link and the smallest node it can reach.

    ``links`` has columns a and b. Each round takes the smallest label among neighbours and then the
    label of that label, so rounds grow with the logarithm of the longest chain. Every round is
    written to the shared folder. A node with many links is pre-aggregated before the shuffle.
    """
    a, b = F.col("a"), F.col("b")
    both = links.select(F.explode(F.array(F.struct(a, b), F.struct(b.alias("a"), a.alias("b")))).alias("e"))
    edges = staged(both.select("e.a", "e.b").where(a != b).distinct())
    state = staged(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).withColumnRenamed("a", "node"))
    while True:
        labels = state.select(F.col("node").alias("b"), "root")
        heard = edges.join(labels, "b").groupBy("a").agg(F.min("root").alias("heard"))
        lower = state.join(heard.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("root").alias("old"), F.least("root", "heard").alias("root")
        )
        # Every label is a node of the same component, so its own label is at least as good.
        above = state.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = lower.join(above, "root").select("node", "old", F.least("root", "above").alias("root"))
        new = staged(jumped)
        if new.where(F.col("old") != F.col("root")).isEmpty():
            return new.select("node", "root")
        state = new.select("node", "root")

"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent between 0 (all equal) and 1 (as they are) and
normalised. The exponent is the largest that reaches the target entropy, unless a source would then be
repeated more than the limit; then it is the smallest that keeps to the limit. Both bounds are found by
sections of the interval, each an aggregate over one row per source.

A source's weight times the budget is its quota. Its documents are dealt into ``blocks`` blocks by a
hash. The quota is met by whole passes over the source, then by blocks in the order of a seeded
permutation as long as they fit, so a source misses its quota by less than one block and never exceeds
it. Every pass has a permutation of its own.

Defined results: tokens are words; a null text has none. A null source is a source of its own. Sources
without tokens have no weight, and their documents stay once. Repeated rows are rows like others; rows
with equal doc_id and text share a block. Only doc_id, source and text are read; ``realise`` returns the
columns of ``docs``. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.operators.lineage import staged

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    entropy_share: float | None = 0.9  # target entropy as a share of that of equal weights
    most_passes: float | None = 2.0  # no source is repeated more often
    budget: int | None = None  # tokens of the mix; by default those of the corpus
    blocks: int = 1_024
    seed: int = 7
    sections: int = 32
    rounds: int = 5
    few_rows: int = 200_000  # up to so many (source, block) rows are broadcast


def _block(settings: Settings):
    return F.pmod(F.xxhash64(F.lit(settings.seed), "doc_id", "text"), F.lit(settings.blocks)).cast("int")


def _figures(totals: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float, float]]:
    """Sum of powers, entropy and largest power per token, for each exponent."""
    each = totals.withColumn("x", F.explode(F.array(*[F.lit(x) for x in exponents])))
    each = each.withColumn("w", F.pow("share", F.col("x")))
    rows = each.groupBy("x").agg(
        F.sum("w").alias("z"), F.sum(F.col("w") * F.log("w")).alias("v"), F.max(F.col("w") / F.col("tokens")).alias("most")
    )
    return {r["x"]: (r["z"], math.log(r["z"]) - r["v"] / r["z"], r["most"]) for r in rows.collect()}


def exponent(totals: DataFrame, budget: int, settings: Settings) -> tuple[float, float]:
    """The exponent and the sum of the powers at it. ``totals``: source, tokens, share."""
    sources = totals.count()
    if not sources:
        return 1.0, 1.0

    def flat_enough(figures) -> bool:
        if settings.entropy_share is None:
            return False
        return figures[1] >= settings.entropy_share * math.log(sources) - 1e-12

    def within(figures) -> bool:
        return settings.most_passes is None or figures[2] / figures[0] * budget <= settings.most_passes

    def search(wanted, rising: bool) -> float:
        """The end of the exponents for which ``wanted`` holds, from 0 up or (rising) from 1 down."""
        low, high = 0.0, 1.0
        for _ in range(settings.rounds):
            line = [low + (high - low) * i / settings.sections for i in range(settings.sections + 1)]
            found = _figures(totals, line)
            good = [x for x in line if wanted(found[x])]
            if not good:
                return 1.0 if rising else 0.0
            at = line.index(min(good) if rising else max(good))
            if (rising and at == 0) or (not rising and at == len(line) - 1):
                return line[at]
            low, high = (line[at - 1], line[at]) if rising else (line[at], line[at + 1])
        return high if rising else low

    flat = 1.0 if settings.entropy_share is None else search(flat_enough, rising=False)
    x = flat
    if not within(_figures(totals, [x])[x]):
        x = max(x, search(within, rising=True))
    return x, _figures(totals, [x])[x][0]


def plan(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Staged: one row per document (doc_id, source, n_tokens, block), and one per (source, block) with
    copies, weight, quota and exponent."""
    count = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = staged(docs.select("doc_id", "source", count.alias("n_tokens"), _block(settings).alias("block")))
    blocks = staged(rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")))
    by_source = blocks.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    total = by_source.agg(F.sum("tokens")).first()[0] or 0
    budget = settings.budget or total
    totals = by_source.where(F.col("tokens") > 0).withColumn("share", F.col("tokens") / F.lit(total or 1))
    totals = staged(totals)
    x, z = exponent(totals, budget, settings)
    weight = F.pow("share", F.lit(x)) / F.lit(z)
    quota = F.floor(weight * F.lit(budget) + F.lit(1e-6))
    quotas = totals.select(
        F.col("source").alias("its"),
        weight.alias("weight"),
        quota.alias("quota"),
        F.floor(quota / F.col("tokens")).alias("passes"),
        (quota % F.col("tokens")).alias("rest"),
    )
    placed = blocks.join(quotas, F.col("source").eqNullSafe(F.col("its")), "left").drop("its")
    # A source has at most `blocks` blocks.
    order = F.xxhash64(F.lit(settings.seed), "passes", "source", "block")
    line = Window.partitionBy("source").orderBy("order", "block")
    placed = placed.withColumn("order", order).withColumn("to_here", F.sum("tokens").over(line))
    copies = F.col("passes") + (F.col("to_here") <= F.col("rest")).cast("long")
    placed = placed.select(
        "source",
        "block",
        F.coalesce(copies, F.lit(1)).cast("int").alias("copies"),
        "weight",
        "quota",
        F.lit(x).alias("exponent"),
    )
    return rows, staged(placed)


def _small(table: DataFrame, settings: Settings) -> DataFrame:
    return F.broadcast(table) if table.count() <= settings.few_rows else table


def mix(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, source, n_tokens, block, copies, weight, quota, exponent."""
    rows, placed = plan(docs, settings)
    placed = _small(placed, settings).withColumnsRenamed({"source": "its", "block": "its_block"})
    same = F.col("source").eqNullSafe(F.col("its")) & (F.col("block") == F.col("its_block"))
    return rows.join(placed, same).drop("its", "its_block")


def realise(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, each as often as its block is taken; columns unchanged."""
    _, placed = plan(docs, settings)
    placed = _small(placed, settings).select(
        F.col("source").alias("__mix_source"), F.col("block").alias("__mix_block"), F.col("copies").alias("__mix_copies")
    )
    own = docs.withColumn("__mix_own", _block(settings))
    same = F.col("source").eqNullSafe(F.col("__mix_source")) & (F.col("__mix_own") == F.col("__mix_block"))
    taken = own.join(placed, same).where(F.col("__mix_copies") > 0)
    return taken.withColumn("__mix_pass", F.explode(F.sequence(F.lit(1), "__mix_copies"))).select(
        *["`" + c.replace("`", "``") + "`" for c in docs.columns]
    )

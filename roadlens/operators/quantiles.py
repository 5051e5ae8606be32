"""Exact quantiles of whole tables or classes: bracketed by a sketch, settled by counting.

The quantile of a share is the smallest value with at least that share of the rows at or below it. One
pass takes a mergeable sketch of every column, whose points a little to the left and right of the share
bracket the wanted value. A second pass counts the rows below the bracket and the rows of each value
inside, and ranks those. A bracket that may hold too many values for that, as in very large tables, is
first cut down by further sketches of what lies inside. The counts show whether a bracket holds its rank; one
that does not is opened again, so results never rest on the sketch's error.

Every pass reads ``df`` anew and combines before its shuffle; stage what is dear to compute. The driver
holds some numbers per quantile only, so ``by`` is meant for classes. Nulls and NaN are passed over;
infinite values count as the largest finite ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 2_000  # a sketch's points are off by at most rows / ACCURACY
FEW = 1 << 14  # values of a bracket that are ranked as they are
GRID = 128  # points of a sketch inside a bracket
_MOST = 1.7976931348623157e308


@dataclass
class _Wanted:
    """One quantile: its group, column and share, and the bracket that holds it."""

    group: tuple
    column: int
    share: int
    low: float
    high: float
    rank: int  # from 1, among all rows of the group
    inside: float  # at most so many rows strictly between low and high, if the sketch keeps its word
    whole: tuple  # bracket and rows to fall back on
    value: float | None = None

    def reopen(self) -> None:
        self.low, self.high, self.inside = self.whole


def _finite(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(value.isNotNull() & ~F.isnan(value), F.greatest(F.least(value, F.lit(_MOST)), F.lit(-_MOST)))


def quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """One row (per group) with an array of quantiles for every column; null without a value."""
    spark = df.sparkSession
    groups = [f"g{i}" for i in range(len(by))]
    values = [f"v{i}" for i in range(len(columns))]
    kinds = [df.select(name).schema[0].dataType for name in by]
    table = df.select(
        *[F.col(name).alias(g) for name, g in zip(by, groups)],
        *[_finite(name).alias(v) for name, v in zip(columns, values)],
    )
    aside = 2 / ACCURACY
    points = [p for s in shares for p in (max(0.0, s - aside), min(1.0, s + aside))]
    figures = [f for v in values for f in (F.count(v), F.min(v), F.max(v), F.percentile_approx(v, points, ACCURACY))]
    known = (table.groupBy(*groups).agg(*figures) if by else table.agg(*figures)).collect()
    wanted = []
    for row in known:
        group, rest = tuple(row[: len(by)]), row[len(by) :]
        for c in range(len(columns)):
            n, least, most, bracket = rest[4 * c : 4 * c + 4]
            for s, share in enumerate(shares):
                if n:
                    rank = max(1, -int(-round(share * n, 9) // 1))
                    low, high = bracket[2 * s], bracket[2 * s + 1]
                    low, high = least if rank == 1 else low, most if rank == n else high
                    wanted.append(_Wanted(group, c, s, low, high, rank, 2 * (aside + 1 / ACCURACY) * n, (least, most, n)))
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(v).alias("v")) for i, v in enumerate(values)]))
    long = table.select(*groups, cells.alias("cell")).select(*groups, "cell.c", "cell.v")
    while open_ := [w for w in wanted if w.value is None]:
        if wide := [w for w in open_ if w.inside > FEW]:
            _narrow(wide, _with_brackets(long, wide, groups, kinds))
        else:
            _settle(open_, _with_brackets(long, open_, groups, kinds))
    found = {(w.group, w.column, w.share): w.value for w in wanted}
    rows = []
    for row in known:
        group = tuple(row[: len(by)])
        rows.append((*group, *[[found.get((group, c, s)) for s in range(len(shares))] for c in range(len(columns))]))
    fields = [T.StructField(name, kind) for name, kind in zip(by, kinds)]
    fields += [T.StructField(name, T.ArrayType(T.DoubleType())) for name in columns]
    return spark.createDataFrame(rows, T.StructType(fields))


def _with_brackets(long: DataFrame, wanted: Sequence[_Wanted], groups: Sequence[str], kinds: Sequence) -> DataFrame:
    """Rows (t, v, low, high, rank) up to the upper end of each wanted quantile's bracket."""
    fields = [T.StructField(f"_{g}", kind) for g, kind in zip(groups, kinds)]
    fields += [T.StructField(n, k) for n, k in (("t", T.IntegerType()), ("_c", T.IntegerType()), ("low", T.DoubleType()), ("high", T.DoubleType()), ("rank", T.LongType()))]
    rows = [(*w.group, t, w.column, w.low, w.high, w.rank) for t, w in enumerate(wanted)]
    # As many rows as there are quantiles to find.
    targets = F.broadcast(long.sparkSession.createDataFrame(rows, T.StructType(fields)))
    same = (F.col("c") == F.col("_c")) & (F.col("v") <= F.col("high"))
    for g in groups:
        same &= F.col(g).eqNullSafe(F.col(f"_{g}"))
    return long.join(targets, same).select("t", "v", "low", "high", "rank")


def _narrow(wanted: Sequence[_Wanted], rows: DataFrame) -> None:
    """Cut brackets down by a sketch of what lies strictly inside; a bracket's ends are settled here."""
    v, low, high = F.col("v"), F.col("low"), F.col("high")
    inside = F.when((v > low) & (v < high), v)
    grid = [i / GRID for i in range(GRID + 1)]
    seen = rows.groupBy("t").agg(
        F.count_if(v < low).alias("below"),
        F.count_if(v <= low).alias("at_low"),
        F.count(inside).alias("inside"),
        F.count(F.lit(1)).alias("at_high"),
        F.percentile_approx(inside, grid, ACCURACY).alias("points"),
    )
    for row in seen.collect():
        w = wanted[row["t"]]
        if not row["below"] < w.rank <= row["at_high"]:
            w.reopen()
        elif w.rank <= row["at_low"]:
            w.value = w.low
        elif w.rank > row["at_low"] + row["inside"]:
            w.value = w.high
        else:
            n = row["inside"]
            share = (w.rank - row["at_low"]) / n
            left = max(0, int((share - 2 / ACCURACY) * GRID))
            right = min(GRID, int((share + 2 / ACCURACY) * GRID) + 1)
            # The ends of the grid are the least and the most inside.
            w.low, w.high = row["points"][left], row["points"][right]
            w.inside = ((right - left) / GRID + 2 / ACCURACY) * n


def _settle(wanted: Sequence[_Wanted], rows: DataFrame) -> None:
    """Rank the values of the brackets, by the rows of each."""
    each = rows.groupBy("t", "rank", F.when(F.col("v") >= F.col("low"), F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    line = F.sort_array(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("v", "n"))))
    below = F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0))
    ranked = each.groupBy("t", "rank").agg(line.alias("line"), below.alias("below"))
    start = F.struct((F.col("rank") - F.col("below")).alias("left"), F.lit(None).cast("double").alias("v"))

    def take(state: Column, step: Column) -> Column:
        here = (state["left"] > 0) & (state["left"] <= step["n"])
        return F.struct((state["left"] - step["n"]).alias("left"), F.when(here, step["v"]).otherwise(state["v"]).alias("v"))

    for row in ranked.select("t", F.aggregate("line", start, take)["v"].alias("v")).collect():
        w = wanted[row["t"]]
        w.value = row["v"]
        if w.value is None:  # the sketch was wrong
            w.reopen()

"""Forests on larger tables: every task grows whole trees from all rows, which it holds as one byte per cell.

Spark grows all trees of a forest level by level over dealt rows: every task sends dense sums of every node
of a level, however few rows the node has, so deep forests are mostly sums. Here rows are binned once, each
task reads them all and grows its share of the trees; nothing is sent but finished trees. A tree is grown as
Spark grows it: a Poisson number of copies of each row, a fresh random choice of features at every node, the
split of largest gain (Gini or variance) at no more than ``maxBins`` bins, ``minInstancesPerNode`` rows a
side, and leaves that predict the same merged. The random draws are others than Spark's, and depend on the
rows alone, not on how they are dealt.

Tables of few rows keep Spark's own trees; tables too large for a task are left to Spark as well.
"""

from __future__ import annotations

import base64
import io
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.ml.boosting import bin_ends
from roadlens.operators.lineage import staging

_FEWEST = 10_000  # rows worth a task of their own per tree
_HELD = 256 << 20  # bytes of cells a task may hold
_CHUNK = 1 << 15  # rows added up at once
_NODES = 1024  # nodes added up at once
_LEAST_GAIN = 1e-18  # below this a gain is an error of rounding


@dataclass(frozen=True)
class Growth:
    """How trees are grown. ``classes`` is 0 for a regression."""

    classes: int
    trees: int
    depth: int
    bins: int
    features: int
    chosen: int  # features tried at a node
    least_rows: int
    bootstrap: bool
    seed: int


@dataclass
class Table:
    """The rows to fit: cells row by row, target (class or value), weight (None: all 1)."""

    cells: np.ndarray  # (rows, features)
    target: np.ndarray
    weight: np.ndarray | None

    @classmethod
    def of(cls, batches: list[tuple], growth: Growth) -> Table:
        """In an order that follows from the rows' content alone."""
        cells, target, weight = (np.concatenate(parts) for parts in zip(*batches))
        order = np.argsort(_digests(cells, target, weight), kind="stable")
        target, weight = target[order], weight[order]
        if growth.classes:
            target = target.astype(np.int16)
        return cls(cells[order], target, None if (weight == 1).all() else weight)


def _digests(cells: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    out = target.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ weight.view(np.uint64)
    for column in cells.T:
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + column
    return out ^ (out >> np.uint64(32))


@dataclass
class Tree:
    """Nodes of a tree: feature (-1: leaf), last bin that goes left, left child (the right one follows it)
    or, of a leaf, ~row of ``values``."""

    feature: np.ndarray
    bin: np.ndarray
    next: np.ndarray
    values: np.ndarray  # (distinct leaves, classes or 1)
    gain: np.ndarray  # per feature

    def add_values(self, cells: np.ndarray, out: np.ndarray) -> None:
        """Add the leaf's values of every row of cells."""
        flat, wide = cells.ravel(), cells.shape[1]
        place = np.zeros(len(cells), np.int32)
        open_ = np.arange(len(cells))
        while len(open_):
            at = place[open_]
            feature = self.feature[at]
            inner = feature >= 0
            open_, at, feature = open_[inner], at[inner], feature[inner]
            place[open_] = self.next[at] + (flat[open_ * wide + feature] > self.bin[at])
        out += self.values[~self.next[place]]


def grow(table: Table, growth: Growth, tree: int) -> Tree:
    """One tree, level by level; the rows of a node stay side by side."""
    draw = np.random.default_rng([growth.seed & 0xFFFFFFFF, tree])
    n, wide = table.cells.shape
    flat, kinds = table.cells.ravel(), max(growth.classes, 1)
    if growth.bootstrap:
        copies = draw.poisson(1.0, n)
        rows = np.flatnonzero(copies)
        count = copies[rows].astype(float)
    else:
        rows, count = np.arange(n), np.ones(n)
    if not len(rows):  # no row was drawn
        rows, count = np.arange(n), np.ones(n)
    weight = count if table.weight is None else count * table.weight[rows]
    target = table.target[rows]
    slot = np.zeros(len(rows), np.int64)
    own = np.array([_sums(target, weight, kinds, growth.classes)])  # (nodes, kinds) of the level
    total, held = np.array([weight.sum()]), np.array([count.sum()])

    levels, made = [], 1
    for level in range(growth.depth + 1):
        nodes = len(own)
        feature, at, child = np.full(nodes, -1, np.int16), np.zeros(nodes, np.uint8), np.zeros(nodes, np.int32)
        gain = np.zeros(nodes)
        levels.append((feature, at, child, gain, own, total))
        able = held >= 2 * growth.least_rows
        if growth.classes:
            able &= (own > 0).sum(axis=1) > 1
        if level == growth.depth or not able.any():
            break
        rows, count, weight, target, slot = _kept(able, rows, count, weight, target, slot)
        places = np.flatnonzero(able)
        best = _best_splits(flat, wide, growth, draw, len(places), rows, count, weight, target, slot, own[able], total[able], held[able])
        split = best.gain > _LEAST_GAIN
        if not split.any():
            break
        rows, count, weight, target, slot = _kept(split, rows, count, weight, target, slot)
        best, places = best.where(split), places[split]
        feature[places], at[places], gain[places] = best.feature, best.bin, best.gain
        child[places] = made + 2 * np.arange(len(places))
        made += 2 * len(places)
        right = flat.take(rows * wide + best.feature.take(slot)) > best.bin.take(slot)
        slot = 2 * slot + right
        small = 2 * len(places) <= 1 << 16  # sorted by radix
        order = np.argsort(slot.astype(np.uint16) if small else slot, kind="stable")
        whole = weight is count
        rows, count, target, slot = rows[order], count[order], target[order], slot[order]
        weight = count if whole else weight[order]
        left = (best.left, best.left_total, best.left_held)
        both = ((own[places], total[places], held[places]), left)
        own, total, held = (np.stack([part, all_ - part], 1).reshape(-1, *part.shape[1:]) for all_, part in zip(*both))
        if growth.classes:  # what is left of a weight by rounding
            own[own < 1e-12 * total[:, None]] = 0.0
    return _finished(levels, growth.classes, wide)


def _sums(target: np.ndarray, weight: np.ndarray, kinds: int, classes: int) -> np.ndarray:
    return np.bincount(target, weight, kinds) if classes else np.array([(weight * target).sum()])


def _kept(nodes: np.ndarray, rows, count, weight, target, slot) -> tuple:
    """The rows of the marked nodes, which are numbered anew."""
    if nodes.all():
        return rows, count, weight, target, slot
    here, number = nodes[slot], np.cumsum(nodes) - 1
    whole = weight is count
    rows, count, target, slot = rows[here], count[here], target[here], number[slot[here]]
    return rows, count, count if whole else weight[here], target, slot


@dataclass
class _Best:
    """The best split of every node, with the sums of its left side."""

    gain: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    left_total: np.ndarray
    left_held: np.ndarray

    def where(self, nodes: np.ndarray) -> _Best:
        return replace(self, **{name: value[nodes] for name, value in vars(self).items()})


def _best_splits(flat, wide, growth, draw, nodes, rows, count, weight, target, slot, own, total, held) -> _Best:
    kinds, bins = own.shape[1], growth.bins
    best = _Best(np.zeros(nodes), np.zeros(nodes, np.int16), np.zeros(nodes, np.uint8), np.zeros((nodes, kinds)), np.zeros(nodes), np.zeros(nodes))
    starts = np.searchsorted(slot, np.arange(nodes + 1))
    for first in range(0, nodes, _NODES):
        last = min(first + _NODES, nodes)
        shape = (growth.chosen, last - first, bins)
        if growth.chosen < wide:
            tried = np.argpartition(draw.random((last - first, wide)), growth.chosen - 1, axis=1)[:, : growth.chosen].T.copy()
        else:
            tried = np.tile(np.arange(wide)[:, None], (1, last - first))
        sums = np.zeros((*shape, kinds))
        totals = None if growth.classes else np.zeros(shape)
        helds = None if weight is count else np.zeros(shape)
        for begin in range(starts[first], starts[last], _CHUNK):
            part = slice(begin, min(begin + _CHUNK, starts[last]))
            here, begun = slot[part] - first, rows[part] * wide
            low, high = here[0], here[-1] + 1
            bin_0, size = (here - low) * bins, (high - low) * bins
            own_weight, own_target = weight[part], target[part]
            scaled = None if growth.classes else own_weight * own_target
            for j in range(growth.chosen):
                cell = bin_0 + flat.take(begun + tried[j].take(here))
                if growth.classes:
                    added = np.bincount(cell * kinds + own_target, own_weight, size * kinds)
                    sums[j, low:high] += added.reshape(high - low, bins, kinds)
                else:
                    sums[j, low:high, :, 0] += np.bincount(cell, scaled, size).reshape(high - low, bins)
                    totals[j, low:high] += np.bincount(cell, own_weight, size).reshape(high - low, bins)
                if helds is not None:
                    helds[j, low:high] += np.bincount(cell, count[part], size).reshape(high - low, bins)
        for j in range(growth.chosen):
            _improve(best, slice(first, last), tried[j], sums[j], totals if totals is None else totals[j], helds if helds is None else helds[j], growth, own, total, held)
    return best


def _improve(best: _Best, nodes: slice, feature, sums, totals, helds, growth, own, total, held) -> None:
    """Take the splits by one feature per node that gain more than those before."""
    left = np.cumsum(sums, axis=1)[:, :-1]
    left_total = left.sum(axis=2) if totals is None else np.cumsum(totals, axis=1)[:, :-1]
    left_held = left_total if helds is None else np.cumsum(helds, axis=1)[:, :-1]
    whole = total[nodes, None]
    right_total = whole - left_total
    able = (left_held >= growth.least_rows) & (held[nodes, None] - left_held >= growth.least_rows)
    # Sides without weight are not able.
    shares = left / np.where(able, left_total, 1)[..., None] - (own[nodes, None] - left) / np.where(able, right_total, 1)[..., None]
    gain = np.where(able, left_total * right_total / whole**2 * (shares**2).sum(axis=2), 0.0)
    at = gain.argmax(axis=1)
    each = np.arange(len(at))
    better = np.flatnonzero(gain[each, at] > best.gain[nodes])
    to, at = better + nodes.start, at[better]
    best.gain[to], best.feature[to], best.bin[to] = gain[better, at], feature[better], at
    best.left[to], best.left_total[to], best.left_held[to] = left[better, at], left_total[better, at], left_held[better, at]


def _finished(levels: list[tuple], classes: int, wide: int) -> Tree:
    """The nodes of all levels, without splits whose sides predict the same."""
    feature, at, child, gain, own, total = (np.concatenate(parts) for parts in zip(*levels))
    values = own / total[:, None]
    told = values.argmax(axis=1) if classes else values[:, 0]
    ends = np.cumsum([len(level[0]) for level in levels])
    for stop, size in zip(ends[::-1], [len(level[0]) for level in levels][::-1]):
        inner = np.arange(stop - size, stop)[feature[stop - size : stop] >= 0]
        a, b = child[inner], child[inner] + 1
        same = (feature[a] < 0) & (feature[b] < 0) & (told[a] == told[b])
        feature[inner[same]] = -1
    used = np.zeros(len(feature), bool)
    used[0] = True
    for stop, size in zip(ends, [len(level[0]) for level in levels]):
        inner = np.arange(stop - size, stop)[(feature[stop - size : stop] >= 0) & used[stop - size : stop]]
        used[child[inner]] = used[child[inner] + 1] = True
    number = (np.cumsum(used) - 1).astype(np.int32)
    leaf, inner = feature[used] < 0, used & (feature >= 0)
    gains = np.bincount(feature[inner], gain[inner] * total[inner], wide)
    known, place = np.unique(values[used][leaf], axis=0, return_inverse=True)
    following = number[child[used]]
    following[leaf] = ~place.ravel().astype(np.int32)
    return Tree(feature[used], at[used], following, known, gains)


_GROWN = "tree int, feature binary, bin binary, next binary, values binary, gain binary"
_KINDS = {"feature": np.int16, "bin": np.uint8, "next": np.int32, "values": np.float64, "gain": np.float64}


def _by_task(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple[int, list[tuple]]]:
    """(task, its rows); the rows of a task come one after the other."""
    task, held = None, []
    for batch in batches:
        tasks = batch.column("task").to_numpy()
        ends = [0, *np.flatnonzero(np.diff(tasks)) + 1, len(batch)]
        for begin, end in zip(ends, ends[1:]):
            if begin == end:
                continue
            if tasks[begin] != task and held:
                yield task, held
                held = []
            task, part = int(tasks[begin]), batch.slice(begin, end - begin)
            cells = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(len(part), features)
            held.append((cells, part.column("label").to_numpy(), part.column("weight").to_numpy()))
    if held:
        yield task, held


def _grown(growth: Growth, tasks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task, held in _by_task(batches, growth.features):
            table = Table.of(held, growth)
            held.clear()
            for tree in range(task, growth.trees, tasks):
                one = grow(table, growth, tree)
                columns = [pa.array([tree], pa.int32())]
                columns += [pa.array([getattr(one, name).astype(kind).tobytes()], pa.binary()) for name, kind in _KINDS.items()]
                yield pa.RecordBatch.from_arrays(columns, ["tree", *_KINDS])

    return run


def _binned(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(cuts))
            if np.isnan(values).any():
                raise ValueError("Features of rows to fit must be numbers.")
            cells = pa.array([row.tobytes() for row in to_cells(values, cuts)], pa.binary())
            yield pa.RecordBatch.from_arrays([cells, batch.column("label"), batch.column("weight")], ["cells", "label", "weight"])

    narrow = rows.select(vector_to_array("features").alias("values"), "label", "weight")
    return narrow.mapInArrow(run, "cells binary, label double, weight double")


def to_cells(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The bin of every value; one that equals a cut goes left of it."""
    cells = np.empty(values.shape, np.uint8)
    for i, own in enumerate(cuts):
        cells[:, i] = np.searchsorted(own, values[:, i], "left")
    return cells


def middles(rows: DataFrame, features: int, bins: int) -> list[np.ndarray]:
    """Per feature the middles between the ends of neighbouring bins."""
    return [(ends[:-1] + ends[1:]) / 2 for ends in bin_ends(rows, features, bins)]


def _chosen(strategy: str, features: int, trees: int, classes: int) -> int | None:
    """Features tried at a node; None for a strategy that is left to Spark."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt" if classes else "onethird"
    known = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "onethird": math.ceil(features / 3)}
    known["log2"] = max(1, math.ceil(math.log2(features)))
    return known.get(strategy)


def fit(estimator, dataset: DataFrame, classes: bool) -> ForestModel | None:
    """The estimator's forest, or None where it is Spark's to fit."""
    default = {"subsamplingRate": 1.0, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "leafCol": "", "impurity": "gini" if classes else "variance"}
    odd = any(estimator.getOrDefault(name) != value for name, value in default.items()) or estimator.getMaxBins() > 256
    if odd or (classes and estimator.isSet("thresholds")):
        return None
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    weighted = estimator.isSet("weightCol") and estimator.getWeightCol()
    spark = dataset.sparkSession
    rows = dataset.select(
        F.col(features).alias("features"),
        F.col(label).cast("double").alias("label"),
        (F.col(weighted) if weighted else F.lit(1.0)).cast("double").alias("weight"),
    )
    wide, n = F.max(F.size(vector_to_array("features"))).alias("wide"), F.count(F.lit(1)).alias("n")
    bad = F.count_if(F.col("label").isNull() | F.isnan("label") | F.col("weight").isNull() | ~(F.col("weight") > 0)).alias("bad")
    if rows.count() < _FEWEST:
        return None
    with staging(spark) as stage:
        rows = stage(rows)
        seen = rows.agg(wide, n, bad, F.max("label").alias("most"), F.min("label").alias("least")).first()
        least_class = classes and (seen["least"] is None or seen["least"] < 0)
        if seen["bad"] or least_class or not seen["wide"] or seen["n"] * seen["wide"] > _HELD:
            return None
        n_classes = int(seen["most"]) + 1 if classes else 0
        tried = _chosen(estimator.getFeatureSubsetStrategy(), seen["wide"], estimator.getNumTrees(), n_classes)
        if tried is None:
            return None
        growth = Growth(
            n_classes, estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getMaxBins(), seen["wide"], tried,
            estimator.getMinInstancesPerNode(), estimator.getBootstrap(), estimator.getSeed(),
        )
        cuts = middles(rows, growth.features, growth.bins)
        binned = stage(_binned(rows, cuts))
        tasks = min(growth.trees, spark.sparkContext.defaultParallelism)
        # Every task reads the table from one end to the other, so no row is sent on. Spark would put tables of
        # one partition into one again; the first one here, which has no rows, may have more.
        each = [binned.where("weight < 0").withColumn("task", F.lit(-1))]
        each += [binned.coalesce(1).withColumn("task", F.lit(task)) for task in range(tasks)]
        grown = reduce(DataFrame.unionAll, each).mapInArrow(_grown(growth, tasks), _GROWN).collect()
    trees = []
    for row in sorted(grown, key=lambda row: row["tree"]):
        parts = {name: np.frombuffer(row[name], kind) for name, kind in _KINDS.items()}
        trees.append(Tree(**parts | {"values": parts["values"].reshape(-1, max(n_classes, 1))}))
    names = {"features": features, "prediction": estimator.getPredictionCol()}
    if classes:
        names |= {"probability": estimator.getProbabilityCol(), "raw": estimator.getRawPredictionCol()}
    return ForestModel.of(trees, cuts, names)


class ForestClassifier(RandomForestClassifier):
    """Spark's forest, grown by whole trees where the table is large and a task can hold it."""

    def _fit(self, dataset: DataFrame):
        return fit(self, dataset, True) or super()._fit(dataset)


class ForestRegressor(RandomForestRegressor):
    """See ForestClassifier."""

    def _fit(self, dataset: DataFrame):
        return fit(self, dataset, False) or super()._fit(dataset)


class ForestModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds prediction, and for classes rawPrediction and probability, to rows with a features vector."""

    parts = Param(Params._dummy(), "parts", "trees, cuts and column names, packed", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._held: tuple | None = None
        self._sent = None

    @classmethod
    def of(cls, trees: list[Tree], cuts: list[np.ndarray], names: dict[str, str]) -> ForestModel:
        model = cls()
        model._held = (trees, cuts, names)
        return model

    def _known(self) -> tuple:
        if self._held is None:
            with np.load(io.BytesIO(base64.b64decode(self.getOrDefault(self.parts)))) as packed:
                trees = [Tree(*(packed[f"{name}_{t}"] for name in _KINDS)) for t in range(int(packed["trees"]))]
                cuts = [packed[f"cuts_{i}"] for i in range(int(packed["features"]))]
                self._held = (trees, cuts, dict(packed["names"].tolist()))
        return self._held

    def write(self):
        trees, cuts, names = self._known()
        arrays = {f"{name}_{t}": getattr(tree, name) for t, tree in enumerate(trees) for name in _KINDS}
        arrays |= {f"cuts_{i}": own for i, own in enumerate(cuts)}
        packed = io.BytesIO()
        np.savez_compressed(packed, **arrays, trees=len(trees), features=len(cuts), names=np.array(list(names.items())))
        self._set(parts=base64.b64encode(packed.getvalue()).decode())
        return super().write()

    def copy(self, extra=None) -> ForestModel:
        copied = super().copy(extra)
        copied._held, copied._sent = self._held, self._sent
        return copied

    @property
    def featureImportances(self) -> DenseVector:
        each = np.array([tree.gain / tree.gain.sum() for tree in self._known()[0] if tree.gain.sum() > 0])
        total = each.sum(axis=0) if len(each) else np.zeros(len(self._known()[1]))
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, cuts, names = self._known()
        if self._sent is None:
            self._sent = dataset.sparkSession.sparkContext.broadcast((trees, cuts))
        sent = self._sent

        @F.pandas_udf("array<double>")
        def votes(features):
            import pandas as pd

            if not len(features):
                return pd.Series([], dtype=object)
            trees, cuts = sent.value
            cells = to_cells(np.stack(features.to_numpy()), cuts)
            out = np.zeros((len(cells), trees[0].values.shape[1]))
            for tree in trees:
                tree.add_values(cells, out)
            return pd.Series(list(out))

        scored = dataset.withColumn("_votes", votes(vector_to_array(names["features"])))
        raw = F.col("_votes")
        if "raw" not in names:
            return scored.withColumn(names["prediction"], raw[0] / len(trees)).drop("_votes")
        # The first of equal classes.
        best = (F.array_position(raw, F.array_max(raw)) - 1).cast("double")
        total = F.aggregate(raw, F.lit(0.0), lambda a, b: a + b)
        added = {names["raw"]: array_to_vector(raw), names["probability"]: array_to_vector(F.transform(raw, lambda vote: vote / total))}
        return scored.withColumns(added | {names["prediction"]: best}).drop("_votes")

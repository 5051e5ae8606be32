"""Boosted trees for several classes, by softmax: every round adds one regression tree per class.

A round's trees are grown level by level, all classes at once, and so are the trees of several members: the
same booster with another step size, or without the rows of one fold. A level is one job. Every partition
adds up its rows' residuals by tree, node, feature and bin; Spark merges these sums, first per group of
partitions, and the best split of every node comes back: a few numbers per node. Scores of the rows are
written down every few rounds; in between the new trees are walked again.

A member's first rounds are the member with fewer rounds, so one fit serves every number of rounds of a
grid. Features are binned at their quantiles. Leaf values are Newton steps on the multinomial loss.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.operators.lineage import staging

_GROUPS = 64  # partitions are merged in so many groups first
_WALKED = 8  # rounds between two written scores


@dataclass(frozen=True)
class Member:
    step: float
    without: int | None = None  # rows of this fold are left out


@dataclass
class Trees:
    """Trees as complete binary heaps: feature (-1: leaf), bin that still goes left, value."""

    feature: np.ndarray  # (trees, nodes)
    bin: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, trees: int, depth: int) -> Trees:
        shape = (trees, 2 ** (depth + 1) - 1)
        return cls(np.full(shape, -1, np.int16), np.zeros(shape, np.uint8), np.zeros(shape))

    def places(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Node of every row after ``depth`` levels, per tree."""
        rows = np.arange(len(bins))
        out = np.zeros((len(self.feature), len(bins)), np.int32)
        for t, place in enumerate(out):
            for _ in range(depth):
                feature = self.feature[t, place]
                right = bins[rows, np.maximum(feature, 0)] > self.bin[t, place]
                place[:] = np.where(feature >= 0, 2 * place + 1 + right, place)
        return out

    def scores(self, bins: np.ndarray, depth: int) -> np.ndarray:
        return np.take_along_axis(self.value, self.places(bins, depth), axis=1)


@dataclass
class Fit:
    """Fitted members: starting scores and trees of every round."""

    members: list[Member]
    classes: int
    depth: int
    cuts: list[np.ndarray]  # per feature: the largest value of every bin but the last
    start: np.ndarray  # (members, classes)
    rounds: list[Trees] = field(default_factory=list)
    gains: list[np.ndarray] = field(default_factory=list)  # per round: (members, features)

    def since(self, done: int) -> Fit:
        """What workers need to bring scores after ``done`` rounds up to date."""
        return Fit(self.members, self.classes, self.depth, [], self.start, self.rounds[done:])

    def model(self, member: int, rounds: int) -> SoftmaxBoostedModel:
        own = slice(member * self.classes, (member + 1) * self.classes)
        kept = self.rounds[:rounds]
        parts = {
            "step": self.members[member].step,
            "depth": self.depth,
            "start": self.start[member].tolist(),
            "feature": [t.feature[own].tolist() for t in kept],
            "threshold": [_thresholds(t, own, self.cuts) for t in kept],
            "value": [np.round(t.value[own], 12).tolist() for t in kept],
            "gain": sum((g[member] for g in self.gains[:rounds]), np.zeros(len(self.cuts))).tolist(),
        }
        return SoftmaxBoostedModel(json.dumps(parts))


def _thresholds(trees: Trees, own: slice, cuts: list[np.ndarray]) -> list[list[float]]:
    feature, at = trees.feature[own], trees.bin[own]
    out = np.zeros(feature.shape)
    for place in np.argwhere(feature >= 0):
        out[tuple(place)] = cuts[feature[tuple(place)]][at[tuple(place)]]
    return out.tolist()


def _softmax(scores: np.ndarray, axis: int) -> np.ndarray:
    top = np.exp(scores - scores.max(axis=axis, keepdims=True))
    return top / top.sum(axis=axis, keepdims=True)


@dataclass
class _Rows:
    """One batch of the staged rows."""

    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    fold: np.ndarray
    scores: np.ndarray  # (members * classes, rows)

    @classmethod
    def of(cls, batch: pa.RecordBatch, features: int, trees: int) -> _Rows:
        n = len(batch)
        flat = b"".join(batch.column("bins").to_pylist())
        scores = b"".join(batch.column("scores").to_pylist())
        return cls(
            np.frombuffer(flat, np.uint8).reshape(n, features),
            batch.column("label").to_numpy(),
            batch.column("weight").to_numpy(),
            batch.column("fold").to_numpy(),
            np.frombuffer(scores, np.float64).reshape(n, trees).T.copy(),
        )

    def advance(self, fit: Fit) -> None:
        """Scores after the rounds that were fitted since they were written."""
        steps = np.repeat([m.step for m in fit.members], fit.classes)[:, None]
        for trees in fit.rounds:
            self.scores += steps * trees.scores(self.bins, fit.depth)

    def member_weights(self, fit: Fit) -> np.ndarray:
        return np.array([self.weight * (self.fold != (-1 if m.without is None else m.without)) for m in fit.members])


def _batch(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


_SUMS = "tree int, slot int, part int, place array<int>, sums array<double>"
_SPLITS = "tree int, slot int, feature int, bin int, gain double, own double, left double, right double"


def _level_sums(fit: Fit, growing: Trees, level: int, features: int):
    """Residual sums of one level by tree, node, feature and bin, only where rows are.

    A task adds its batches up in one dense table per tree and node, so it sends a row for each.
    """
    first, wide = 2**level - 1, features << 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, {}
        for batch in batches:
            if not len(batch):
                continue
            rows = _Rows.of(batch, features, len(growing.feature))
            rows.advance(fit)
            weights = rows.member_weights(fit)
            places = growing.places(rows.bins, level)
            part = int(batch.column("part")[0].as_py()) if part is None else part
            own = (np.arange(features) << 8) + rows.bins
            for m in range(len(fit.members)):
                chances = _softmax(rows.scores[m * fit.classes : (m + 1) * fit.classes], 0)
                for k in range(fit.classes):
                    tree = m * fit.classes + k
                    rest = (rows.label == k) - chances[k]
                    for node in np.unique(places[tree][(places[tree] >= first) & (weights[m] > 0)]):
                        here = np.flatnonzero((places[tree] == node) & (weights[m] > 0))
                        w, r, cells = weights[m][here], rest[here], own[here].ravel()
                        stats = (w, w * r, w * np.abs(r) * (1 - np.abs(r)), None)
                        sums = [np.bincount(cells, None if s is None else np.repeat(s, features), wide) for s in stats]
                        held[tree, int(node) - first] = held.get((tree, int(node) - first), 0.0) + np.array(sums, float)
        out: dict[str, list] = {"tree": [], "slot": [], "part": [], "place": [], "sums": []}
        for (tree, slot), sums in held.items():
            used = np.flatnonzero(sums[3])
            for name, value in zip(out, (tree, slot, part, used.astype(np.int32), sums[:, used].ravel())):
                out[name].append(value)
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()))
        yield _batch({name: (v, t) for (name, v), t in zip(out.items(), kinds)})

    return run


def _added(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places and sums (four rows) of all rows of a group together."""
    places = np.concatenate([np.asarray(p.values) for p in table["place"]])
    sums = np.concatenate([np.asarray(s.values).reshape(4, -1) for s in table["sums"]], axis=1)
    used, back = np.unique(places, return_inverse=True)
    return used, np.array([np.bincount(back, s, len(used)) for s in sums])


def _merge(table: pa.Table) -> pa.Table:
    used, sums = _added(table)
    return table.slice(0, 1).select(["tree", "slot", "part"]).append_column(
        "place", pa.array([used.astype(np.int32)], pa.list_(pa.int32()))
    ).append_column("sums", pa.array([sums.ravel()], pa.list_(pa.float64())))


def _newton(sums: np.ndarray, classes: int) -> float:
    return 0.0 if sums[2] < 1e-150 else (classes - 1) / classes * sums[1] / sums[2]


def _best_split(classes: int, features: int, least_rows: int):
    def run(table: pa.Table) -> pa.Table:
        used, found = _added(table)
        sums = np.zeros((4, features << 8))
        sums[:, used] = found
        sums = sums.reshape(4, features, 256)
        whole = sums[:, 0].sum(axis=1)
        left = np.cumsum(sums, axis=2)[:, :, :-1]
        right = whole[:, None, None] - left
        able = (left[3] >= least_rows - 0.5) & (right[3] >= least_rows - 0.5)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - whole[1] ** 2 / whole[0]
        gain = np.where(able & np.isfinite(gain), gain, -1.0)
        feature, at = np.unravel_index(int(gain.argmax()), gain.shape)
        best = float(gain[feature, at])
        row = table.slice(0, 1).select(["tree", "slot"]).to_pylist()[0]
        own = _newton(whole, classes)
        if best <= 1e-12:
            row |= {"feature": -1, "bin": 0, "gain": 0.0, "own": own, "left": 0.0, "right": 0.0}
        else:
            row |= {"feature": int(feature), "bin": int(at), "gain": best, "own": own}
            row |= {"left": _newton(left[:, feature, at], classes), "right": _newton(right[:, feature, at], classes)}
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * 4]
        return pa.table({name: pa.array([row[name]], t) for name, t in zip([s.split()[0] for s in _SPLITS.split(", ")], kinds)})

    return run


def feature_cuts(rows: DataFrame, features: int, bins: int) -> list[np.ndarray]:
    """Per feature the largest value of every bin but the last."""
    return [ends[:-1] for ends in bin_ends(rows, features, bins)]


def bin_ends(rows: DataFrame, features: int, bins: int) -> list[np.ndarray]:
    """Per feature the largest value of every bin: all values where there are as few as bins, else quantiles."""
    cells = F.posexplode(vector_to_array("features")).alias("feature", "value")
    counted = rows.select(cells).distinct()
    shares = [(i + 1) / bins for i in range(bins)]
    known = counted.groupBy("feature").agg(F.count(F.lit(1)).alias("values"))
    few = counted.join(F.broadcast(known.where(F.col("values") <= bins).select("feature")), "feature")
    cuts = {r["feature"]: r["all"] for r in few.groupBy("feature").agg(F.collect_set("value").alias("all")).collect()}
    wide = [i for i in range(features) if i not in cuts]
    if wide:
        values = vector_to_array("features")
        table = rows.select(*[values[i].alias(f"f{i}") for i in wide])
        points = table.agg(*[F.percentile_approx(f"f{i}", shares, 20 * bins) for i in wide]).first()
        cuts |= dict(zip(wide, points))
    return [np.unique(np.array(cuts[i])) for i in range(features)]


def fit(
    rows: DataFrame,
    classes: int,
    members: Sequence[Member],
    rounds: int,
    depth: int,
    weight: str | None = None,
    fold: str | None = None,
    bins: int = 256,
    least_rows: int = 1,
) -> Fit:
    """Grow all members together. ``rows`` has a features vector and a label from 0."""
    spark = rows.sparkSession
    with staging(spark) as stage:
        chosen = stage(
            rows.select(
                "features",
                F.col("label").cast("int").alias("label"),
                (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"),
                (F.col(fold) if fold else F.lit(-2)).cast("int").alias("fold"),
            )
        )
        features = chosen.select(F.max(F.size(vector_to_array("features")))).first()[0] or 0
        if not features:
            raise ValueError("There are no rows to fit.")
        fitted = Fit(list(members), classes, depth, feature_cuts(chosen, features, bins), np.zeros((len(members), classes)))
        totals = {(r["fold"], r["label"]): r["w"] for r in chosen.groupBy("fold", "label").agg(F.sum("weight").alias("w")).collect()}
        for m, member in enumerate(members):
            own = np.array([sum(w for (f, c), w in totals.items() if c == k and f != member.without) for k in range(classes)])
            fitted.start[m] = np.log(np.maximum(own, 1e-12) / max(own.sum(), 1e-12))
        table = stage(_binned(chosen, fitted, features))
        trees, since = len(members) * classes, 0
        for done in range(rounds):
            if done - since >= _WALKED:
                table, since = stage(_advanced(table, fitted.since(since), features, trees)), done
            growing = Trees.empty(trees, depth)
            gains = np.zeros((len(members), features))
            for level in range(depth):
                sums = table.mapInArrow(_level_sums(fitted.since(since), growing, level, features), _SUMS)
                merged = sums.groupBy("tree", "slot", "part").applyInArrow(_merge, _SUMS)
                best = merged.groupBy("tree", "slot").applyInArrow(_best_split(classes, features, least_rows), _SPLITS).collect()
                if not _grow(growing, level, best, gains, classes):
                    break
            fitted.rounds.append(growing)
            fitted.gains.append(gains)
    return fitted


def _grow(growing: Trees, level: int, best: Sequence, gains: np.ndarray, classes: int) -> bool:
    """Write the splits of a level into the trees; whether there were any."""
    any_split = False
    for row in best:
        t, node = row["tree"], 2**level - 1 + row["slot"]
        if level == 0:
            growing.value[t, 0] = row["own"]
        if row["feature"] < 0:
            continue
        any_split = True
        growing.feature[t, node], growing.bin[t, node] = row["feature"], row["bin"]
        growing.value[t, 2 * node + 1], growing.value[t, 2 * node + 2] = row["left"], row["right"]
        gains[t // classes, row["feature"]] += row["gain"]
    return any_split


def _binned(chosen: DataFrame, fitted: Fit, features: int) -> DataFrame:
    cuts, start = fitted.cuts, fitted.start.ravel().astype("<f8").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), features)
            bins = np.empty(values.shape, np.uint8)
            for i, own in enumerate(cuts):
                bins[:, i] = np.searchsorted(own, values[:, i], "left")
            columns = [pa.array([b.tobytes() for b in bins], pa.binary()), *(batch.column(n) for n in ("label", "weight", "fold", "part"))]
            columns.append(pa.array([start] * len(batch), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["bins", "label", "weight", "fold", "part", "scores"])

    part = F.pmod(F.spark_partition_id(), F.lit(_GROUPS)).cast("int").alias("part")
    narrow = chosen.select(vector_to_array("features").alias("values"), "label", "weight", "fold", part)
    return narrow.mapInArrow(run, "bins binary, label int, weight double, fold int, part int, scores binary")


def _advanced(table: DataFrame, recent: Fit, features: int, trees: int) -> DataFrame:
    """The rows with scores after all rounds so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows = _Rows.of(batch, features, trees)
            rows.advance(recent)
            scores = pa.array([s.tobytes() for s in np.ascontiguousarray(rows.scores.T)], pa.binary())
            yield batch.set_column(batch.schema.get_field_index("scores"), "scores", scores)

    return table.mapInArrow(run, table.schema)


class SoftmaxBoostedModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds rawPrediction, probability and prediction to rows with a features vector."""

    parts = Param(Params._dummy(), "parts", "the trees, as JSON", TypeConverters.toString)

    def __init__(self, parts: str | None = None):
        super().__init__()
        if parts is not None:
            self._set(parts=parts)

    @property
    def featureImportances(self) -> DenseVector:
        gain = np.array(json.loads(self.getOrDefault(self.parts))["gain"])
        return Vectors.dense(gain / gain.sum() if gain.sum() else gain)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        read = _Walker(json.loads(self.getOrDefault(self.parts)))

        @F.pandas_udf("array<double>")
        def raw(features):
            import pandas as pd

            return pd.Series(list(read.scores(np.stack(features.to_numpy())))) if len(features) else pd.Series([], dtype=object)

        def softmax(scores):
            top = F.array_max(scores)
            each = F.transform(scores, lambda s: F.exp(s - top))
            return F.transform(each, lambda e: e / F.aggregate(each, F.lit(0.0), lambda a, b: a + b))

        scored = dataset.withColumn("_raw", raw(vector_to_array("features")))
        scored = scored.withColumn("_chances", softmax(F.col("_raw")))
        # The first of equal classes.
        best = (F.array_position("_raw", F.array_max("_raw")) - 1).cast("double")
        return scored.withColumns(
            {"rawPrediction": array_to_vector("_raw"), "probability": array_to_vector("_chances"), "prediction": best}
        ).drop("_raw", "_chances")


class _Walker:
    def __init__(self, parts: dict):
        self.depth, self.step, self.start = parts["depth"], parts["step"], np.array(parts["start"])
        self.feature = [np.array(t, np.int16) for t in parts["feature"]]
        self.threshold = [np.array(t) for t in parts["threshold"]]
        self.value = [np.array(t) for t in parts["value"]]

    def scores(self, values: np.ndarray) -> np.ndarray:
        out = np.repeat(self.start[None, :], len(values), axis=0)
        rows = np.arange(len(values))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            for k in range(len(self.start)):
                place = np.zeros(len(values), np.int32)
                for _ in range(self.depth):
                    f = feature[k, place]
                    right = values[rows, np.maximum(f, 0)] > threshold[k, place]
                    place = np.where(f >= 0, 2 * place + 1 + right, place)
                out[:, k] += self.step * value[k, place]
        return out


def held_out_counts(rows: DataFrame, fitted: Fit, rounds: Sequence[int], fold: str) -> DataFrame:
    """(member, rounds, actual, predicted, n) over the rows each member was fitted without."""
    wanted = [(m, member.without, r) for m, member in enumerate(fitted.members) if member.without is not None for r in rounds]
    walkers = [_Walker(json.loads(fitted.model(m, r).getOrDefault("parts"))) for m, _, r in wanted]
    narrow = rows.select(vector_to_array("features").alias("values"), F.col("label").cast("int").alias("label"), F.col(fold).cast("int").alias("fold"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            values = np.stack([np.asarray(v.values) for v in batch.column("values")])
            label, folds = batch.column("label").to_numpy(), batch.column("fold").to_numpy(zero_copy_only=False)
            for (m, without, r), walker in zip(wanted, walkers):
                own = folds == without
                if not own.any():
                    continue
                predicted = walker.scores(values[own]).argmax(axis=1)
                pairs, n = np.unique(label[own] * fitted.classes + predicted, return_counts=True)
                size = len(pairs)
                yield _batch(
                    {
                        "member": ([m] * size, pa.int32()),
                        "rounds": ([r] * size, pa.int32()),
                        "actual": (pairs // fitted.classes, pa.int32()),
                        "predicted": (pairs % fitted.classes, pa.int32()),
                        "n": (n, pa.int64()),
                    }
                )

    counted = narrow.mapInArrow(run, "member int, rounds int, actual int, predicted int, n long")
    return counted.groupBy("member", "rounds", "actual", "predicted").agg(F.sum("n").alias("n"))

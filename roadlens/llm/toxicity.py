"""Toxicity from class-conditional Kneser-Ney models.

A bounded sample of labelled documents trains two character models over words, one of toxic and
one of ordinary text. Each predicts a character from up to ``order - 1`` characters before it in
its word. The highest order of a class is its own, by absolute discounting; below it both classes
share one Kneser-Ney back-off whose counts are distinct words of the pooled vocabulary, so a rare
expression is told apart by the part of it that one class has seen.

The score compares length-normalised log-likelihoods: per character of the whole text, and of the
most telling window of ``window`` words. A logistic curve turns the two differences into a
probability; it is fitted on every second text of the sample, by models of the others, and then moved
from the sample's odds to those of all labelled rows, so a score means the same at every size.

Defined results: a null or empty text, or one without words, has no differences (both 0) and gets
the curve's value there. Without labelled rows of both classes every score is 0. Rows with a null
doc_id are never sampled and are scored like others. Repeated rows are scored row by row. Of the
documents only doc_id and text are read, of the labels doc_id and toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.workers import give_back

WORD = re.compile(r"[^\x20\x09-\x0D]+")
START, END = "\x02", "\x03"


@dataclass(frozen=True)
class Settings:
    order: int = 5
    discount: float = 0.75
    window: int = 2
    # The sample: at most so many rows of each class, none longer than so many characters.
    rows_per_class: int = 1_000
    longest: int = 20_000
    threshold: float = 0.3


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text has the given remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[list[tuple[int, str]], dict[int, int]]:
    """(label, text) of the training rows with the smallest id hashes of each class, and all rows by label."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    # About one and a half times the wanted rows, so that long ones can be left out.
    wanted = F.lit(False)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    for label, n in counts.items():
        line = int((1 << 40) * min(1.0, 1.5 * settings.rows_per_class / n))
        wanted = wanted | ((F.col("toxic") == label) & (place < line))
    some = F.broadcast(known.where(wanted))  # about 3 * rows_per_class ids
    rows = docs.select("doc_id", "text").join(some, "doc_id")
    rows = rows.where(F.col("text").isNotNull() & (F.char_length("text") <= settings.longest))
    rows = rows.select("toxic", place.alias("place"), F.xxhash64("text").alias("tie"), "text")
    got = []
    for label in (0, 1):
        # A bounded top-k: never more than rows_per_class rows of bounded length reach the driver.
        first = rows.where(F.col("toxic") == label).orderBy("place", "tie")
        got += [(label, r["text"]) for r in first.limit(settings.rows_per_class).collect()]
    return got, counts


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Model:
    """Counts of both classes, and the back-off they share."""

    def __init__(self, tables: tuple[dict, dict], shared: dict, settings: Settings):
        self.tables, self.shared, self.settings = tables, shared, settings
        self.lower: dict[str, float] = {}

    @classmethod
    def fit(cls, rows: Sequence[tuple[int, str]], settings: Settings) -> Model:
        counts = (Counter(), Counter())
        for label, text in rows:
            counts[label].update(words_of(text))
        tables = (defaultdict(Counter), defaultdict(Counter))
        for table, words in zip(tables, counts):
            for word, n in words.items():
                for history, char in _steps(word, settings.order):
                    table[history][char] += n
        shared: dict = defaultdict(Counter)
        for word in counts[0].keys() | counts[1].keys():
            grams = {
                (history[cut:], char)
                for history, char in _steps(word, settings.order)
                for cut in range(len(history) + 1)
            }
            for history, char in grams:
                shared[history][char] += 1
        plain = [{h: (dict(c), sum(c.values())) for h, c in t.items()} for t in (*tables, shared)]
        return cls((plain[0], plain[1]), plain[2], settings)

    def _mixed(self, table: dict, history: str, char: str, lower: float) -> float:
        found = table.get(history)
        if found is None:
            return lower
        followers, total = found
        d = self.settings.discount
        return (max(followers.get(char, 0) - d, 0.0) + d * len(followers) * lower) / total

    def backed_off(self, gram: str) -> float:
        """Shared probability of the last character after those before it."""
        value = self.lower.get(gram)
        if value is None:
            below = self.backed_off(gram[1:]) if len(gram) > 1 else 1 / 65_536
            value = self.lower[gram] = self._mixed(self.shared, gram[:-1], gram[-1], below)
        return value

    def step(self, history: str, char: str) -> float:
        lower = self.backed_off(history + char)
        ordinary, toxic = (self._mixed(t, history, char, lower) for t in self.tables)
        return math.log(toxic / ordinary)

    def compiled(self) -> Ratios:
        """All that scoring needs: the back-off cancels out of every step neither class has seen."""
        seen, rest = {}, {}
        d = self.settings.discount
        for history in self.tables[0].keys() | self.tables[1].keys():
            kept = []
            for table in self.tables:
                followers, total = table.get(history, ({}, 0))
                kept.append(math.log(d * len(followers) / total) if total else 0.0)
                for char in followers:
                    seen[history + char] = 0.0
            rest[history] = kept[1] - kept[0]
        for gram in seen:
            seen[gram] = self.step(gram[:-1], gram[-1])
        return Ratios(seen, rest, self.settings)


class Ratios:
    """Log-likelihood ratios of words, toxic over ordinary."""

    def __init__(self, seen: dict[str, float], rest: dict[str, float], settings: Settings):
        self.seen, self.rest, self.settings = seen, rest, settings
        self.known: dict[str, float] = {}

    def ratio(self, word: str) -> float:
        marked, seen, total = START + word + END, self.seen, 0.0
        back = self.settings.order - 1
        for i in range(1, len(marked)):
            gram = marked[max(0, i - back) : i + 1]
            value = seen.get(gram)
            total += self.rest.get(gram[:-1], 0.0) if value is None else value
        return total

    def differences(self, text: str | None) -> tuple[float, float]:
        """Per character: of the whole text, and of its most telling window."""
        words = words_of(text)
        if not words:
            return 0.0, 0.0
        if len(self.known) > 100_000:
            self.known.clear()
        known = self.known
        ratios = []
        for word in words:
            value = known.get(word)
            if value is None:
                value = known[word] = self.ratio(word)
            ratios.append(value)
        sums = np.concatenate(([0.0], np.cumsum(ratios)))
        chars = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words])))
        size = min(self.settings.window, len(words))
        most = ((sums[size:] - sums[:-size]) / (chars[size:] - chars[:-size])).max()
        return float(sums[-1] / chars[-1]), float(most)


def _steps(word: str, order: int) -> Iterator[tuple[str, str]]:
    marked = START + word + END
    for i in range(1, len(marked)):
        yield marked[max(0, i - order + 1) : i], marked[i]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic curve, bias last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    pull = ridge * np.array([1.0] * (x.shape[1] - 1) + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + pull * w
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(pull + 1e-9)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Scorer:
    model: Ratios | None
    weights: np.ndarray

    @classmethod
    def fit(cls, rows: Sequence[tuple[int, str]], counts: dict[int, int], settings: Settings) -> Scorer:
        if len({label for label, _ in rows}) < 2:
            return cls(None, np.zeros(3))
        half = Model.fit(rows[::2], settings).compiled()
        x = np.array([half.differences(text) for _, text in rows[1::2]])
        y = np.array([label for label, _ in rows[1::2]], float)
        weights = logistic(x, y)
        if 0 < y.sum() < len(y):  # from the sample's odds to those of all labelled rows
            weights[2] += math.log(counts[1] / counts[0]) - math.log(y.mean() / (1 - y.mean()))
        return cls(Model.fit(rows, settings).compiled(), weights)

    def forget(self) -> None:
        """Give up the words met so far."""
        if self.model is not None:
            self.model.known.clear()
        give_back()

    def score(self, text: str | None) -> float:
        if self.model is None:
            return 0.0
        z = float(np.dot(self.weights[:2], self.model.differences(text)) + self.weights[2])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def predict(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    # Bounded by the sample: at most 2 * rows_per_class texts of at most `longest` characters.
    scorer = spark.sparkContext.broadcast(Scorer.fit(*sample(docs, labels, settings), settings))
    narrow = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = scorer.value
        for batch in batches:
            scores = [model.score(text.as_py()) for text in batch.column(2)]
            predicted = [int(s >= settings.threshold) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array(predicted, pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return narrow.mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    spark = docs.sparkSession
    scorer = spark.sparkContext.broadcast(Scorer.fit(*sample(docs, labels, settings), settings))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = scorer.value
        for batch in batches:
            stay = [model.score(text.as_py()) < settings.threshold for text in batch.column(at)]
            yield batch.filter(pa.array(stay, pa.bool_()))
        model.forget()

    # Plain names on the way: a name may hold a dot.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)

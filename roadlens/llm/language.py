"""Language identification by cross-parsing entropy.

A bounded sample of labelled text per language becomes a suffix automaton. A text is parsed
against each: a phrase is the longest match of what is left with any place of the sample, and the
next phrase starts behind it. Every letter of a sample is told apart. Each phrase costs about log2 of the sample's length, so the cost per
character is the cross-parsing entropy; the language that needs the fewest normalised phrases wins.
Texts are parsed in segments of ``segment`` characters, all of them, side by side; whatever is
not a letter counts as the same blank.

Defined results: ``und`` with score 0 for a null text, a text without a letter, and when nothing
could be learned. The score of others is the winner's share of ``2 ** (-sharpness * entropy)``. Ties
go to the first language in order. Of the documents to label only doc_id and text are read. Rows
with a null doc_id, lang or text teach nothing. Repeated rows are labelled row by row.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.toxicity import held_out
from roadlens.operators.lineage import staged

LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    # The sample of a language: rows with the smallest id hashes, none longer than `longest`
    # characters, until `chars` characters are reached; at most `rows` of them.
    rows: int = 400
    longest: int = 20_000
    chars: int = 120_000
    # Letters of a language with a column in its table, and a blank; rarer ones have sorted edges.
    letters: int = 62
    segment: int = 256
    sharpness: float = 6.0


def sample(docs: DataFrame, lang: Column, settings: Settings) -> dict[str, str]:
    """Text to learn from, by language: whole rows up to the bound.

    A row teaches its own language its own text, whatever other rows share its id; equal rows teach once.
    """
    place, words = F.xxhash64("doc_id"), F.xxhash64("text")
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select(
        "doc_id", lang.alias("lang"), F.char_length("text").alias("n"), place.alias("place"), words.alias("words")
    )
    rows = rows.where(F.col("lang").isNotNull() & F.col("n").between(1, settings.longest))
    # About twice the wanted rows by a line through the hashes of the ids, then exact ranks among those.
    # One row per language, written down: its size is known when the join is planned, so rows are
    # not dealt by language before they are filtered.
    counts = staged(rows.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("of")))
    share = F.least(F.lit(1.0), F.lit(2.0 * settings.rows) / F.col("of"))
    below = F.pmod("place", F.lit(1 << 40)) < share * F.lit(float(1 << 40))
    order = Window.partitionBy("lang").orderBy("place", "doc_id", "words")
    rows = rows.join(counts, "lang").where(below).drop("of").distinct().withColumn("rank", F.row_number().over(order))
    before = F.coalesce(F.sum(F.col("n") + 1).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.where(F.col("rank") <= settings.rows).withColumn("before", before)
    # At most `rows` rows per language, and less than `chars` characters but for the last of them.
    some = F.broadcast(rows.where(F.col("before") < settings.chars).select("doc_id", "lang", "words", "rank"))
    texts = docs.select("doc_id", lang.alias("lang"), words.alias("words"), "text").join(some, ["doc_id", "lang", "words"])
    once = texts.groupBy("lang", "rank").agg(F.min("text").alias("text"))
    line = F.sort_array(F.collect_list(F.struct("rank", "text")))
    whole = F.array_join(F.transform(line, lambda row: F.concat(row["text"], F.lit("\n"))), "")
    return {row["lang"]: row["text"].lower() for row in once.groupBy("lang").agg(whole.alias("text")).collect()}



def transitions(codes: Sequence[int]) -> list[dict[int, int]]:
    """Next states of every state of the suffix automaton, by code."""
    link, length, moves = [-1], [0], [{}]
    last = 0
    for code in codes:
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        moves.append({})
        at = last
        while at != -1 and code not in moves[at]:
            moves[at][code] = new
            at = link[at]
        if at != -1:
            to = moves[at][code]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                twin = len(link)
                link.append(link[to])
                length.append(length[at] + 1)
                moves.append(dict(moves[to]))
                while at != -1 and moves[at].get(code) == to:
                    moves[at][code] = twin
                    at = link[at]
                link[to] = link[new] = twin
        last = new
    return moves


def automaton(codes: Sequence[int], letters: int) -> np.ndarray:
    """Transitions of the suffix automaton, one row per state; -1 where there is none."""
    return _table(transitions(codes), letters)


def _table(moves: list[dict[int, int]], letters: int) -> np.ndarray:
    """One row per state, with the codes below ``letters``."""
    table = np.full((len(moves), letters), -1, np.int32)
    for state, row in enumerate(moves):
        for code, to in row.items():
            if code < letters:
                table[state, code] = to
    return table


class Automaton:
    """Steps of one language. A move holds the next state (as a row offset) times four, plus the
    phrases that end with it. The commonest letters of the sample have a column in a table, all
    others of it an edge among sorted ones; letters that the sample lacks share one column."""

    def __init__(self, codes: np.ndarray, blank: int, pad: int, columns: int):
        counts = np.bincount(codes, minlength=pad + 1)
        own = np.flatnonzero(counts[:blank])
        own = own[np.argsort(-counts[own], kind="stable")]
        common, rare = own[:columns], own[columns:]
        self.width = width = len(common) + 3  # a blank, a letter without a column, and padding
        self.column = np.full(pad + 1, len(common) + 1, np.int32)
        self.column[common] = np.arange(len(common))
        self.column[blank], self.column[pad] = len(common), len(common) + 2
        self.rare = np.full(pad + 1, -1, np.int32)
        self.rare[rare] = np.arange(len(rare))
        self.n_rare = len(rare)
        rows = transitions(np.where(self.rare >= 0, self.rare + width, self.column)[codes].tolist())
        table = _table(rows, width)
        start = np.broadcast_to(table[0], table.shape)
        # No move: the phrase ends, and the next begins with this letter if it is known.
        fallen = np.where(start >= 0, start * width * 4 + 1, 2)
        fallen[0] = np.where(table[0] >= 0, 0, 1)
        moves = np.where(table >= 0, table * width * 4, fallen)
        moves[:, len(common) + 2] = np.arange(len(table)) * width * 4  # stays where it is
        self.moves = moves.astype(np.int32).ravel()
        edges = [(s * len(rare) + c - width, to) for s, row in enumerate(rows) for c, to in row.items() if c >= width]
        edges = np.array(sorted(edges), np.int64).reshape(-1, 2)
        self.edges, self.targets = edges[:, 0].copy(), (edges[:, 1] * width * 4).astype(np.int32)

    def rare_steps(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Moves by letters without a column. The first edges are those of the start, one per letter."""
        wanted = (state // self.width).astype(np.int64) * self.n_rare + letter
        place = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
        return np.where(self.edges[place] == wanted, self.targets[place], self.targets[letter] + 1)

    def phrases(self, segments: np.ndarray) -> np.ndarray:
        """Phrases of each column of codes."""
        state = np.zeros(segments.shape[1], np.int32)
        ended = np.ones(segments.shape[1], np.int32)  # the phrase open at the end
        for codes in segments:
            step = self.moves[state + self.column[codes]]
            if self.n_rare:
                letter = self.rare[codes]
                at = np.flatnonzero(letter >= 0)
                if len(at):
                    step[at] = self.rare_steps(state[at], letter[at])
            ended += step & 3
            state = step >> 2
        return ended - (state == 0)  # no phrase is open behind an unknown letter


class Parser:
    """Phrases of many segments at once, in every language."""

    def __init__(self, texts: dict[str, str], settings: Settings):
        self.settings = settings
        self.langs = sorted(texts)
        known = sorted({c for text in texts.values() for c in text if c.isalpha()})
        blank, other, self.pad = len(known), len(known) + 1, len(known) + 2
        points = range(sys.maxunicode + 1)
        letter = np.fromiter(map(str.isalpha, map(chr, points)), bool, len(points))
        self.codes = np.where(letter, other, blank).astype(np.int32)
        self.codes[[ord(c) for c in known]] = np.arange(len(known))
        self.automata, self.bits = [], []
        for lang in self.langs:
            codes = self._encode(texts[lang])
            self.automata.append(Automaton(codes, blank, self.pad, settings.letters - 1))
            self.bits.append(np.log2(len(codes) + 2))

    def _encode(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.codes[points]

    def phrases(self, segments: np.ndarray) -> np.ndarray:
        """Phrases per language of each column of codes."""
        totals = np.empty((len(self.langs), segments.shape[1]), np.int64)
        for row, learned in zip(totals, self.automata):
            row[:] = learned.phrases(segments)
        return totals

    def entropies(self, texts: Sequence[str]) -> np.ndarray:
        """Bits per character of each text (row) in each language."""
        size = self.settings.segment
        lower = [text.lower() for text in texts]
        lengths = np.array([len(text) for text in lower])
        totals = np.zeros((len(lower), len(self.langs)))
        pieces: list[str] = []
        owners: list[int] = []
        held = 0

        def flush() -> None:
            codes = self._encode("".join(pieces))
            n = np.array([len(p) for p in pieces])
            parts = -(-n // size)
            grid = np.full((parts.sum(), size), self.pad, np.int32)
            first = np.concatenate(([0], np.cumsum(parts)[:-1])) * size
            starts = np.concatenate(([0], np.cumsum(n)[:-1]))
            grid.ravel()[np.arange(n.sum()) + np.repeat(first - starts, n)] = codes
            found = self.phrases(np.ascontiguousarray(grid.T))
            np.add.at(totals, np.repeat(np.array(owners), parts), found.T)

        for owner, text in enumerate(lower):
            for start in range(0, len(text), 4_096 * size):
                piece = text[start : start + 4_096 * size]
                pieces.append(piece)
                owners.append(owner)
                held += len(piece)
                if held >= 4_096 * size:
                    flush()
                    pieces, owners, held = [], [], 0
        if pieces:
            flush()
        return totals * np.array(self.bits) / np.maximum(lengths, 1)[:, None]

    def label(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        real = [i for i, text in enumerate(texts) if text and LETTER.search(text)]
        if not real or not self.langs:
            return langs, scores
        bits = self.entropies([texts[i] for i in real])
        best = bits.argmin(axis=1)
        weights = np.exp2(-self.settings.sharpness * (bits - bits.min(axis=1, keepdims=True)))
        share = 1 / weights.sum(axis=1)
        for i, lang, score in zip(real, best, share):
            langs[i], scores[i] = self.langs[lang], float(score)
        return langs, scores


_PARSERS: dict[int, tuple[dict, Parser]] = {}  # of this worker process, the latest one only


def _parser(texts: dict[str, str], settings: Settings) -> Parser:
    key = hash((tuple(sorted(texts.items())), settings))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = (texts, Parser(texts, settings))
    return _PARSERS[key][1]


def predict(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    texts = sample(docs, F.col("lang"), settings)
    # Bounded: `chars` and one more text per language.
    shared = docs.sparkSession.sparkContext.broadcast(texts)
    narrow = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = None
        for batch in batches:
            parser = parser or _parser(shared.value, settings)
            langs, scores = parser.label(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return narrow.mapInArrow(run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")

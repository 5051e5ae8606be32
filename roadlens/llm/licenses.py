"""Fuzzy search for short license notices.

A text is read as its words (runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased)
with one space between them. A notice with at most e errors, cut into e + 1 pieces, must show one piece
unchanged: an Aho-Corasick automaton finds the pieces of all notices in one pass. Round every such seed
the regex library looks for the whole notice with at most e inserted, deleted or replaced characters, best
match first, beginning and ending with a word. Numbers at the end of a notice allow no error. Windows that
were tried before are remembered.

A span is a place where a notice stands. Of overlapping spans of one notice the one with fewest errors
stays, then the first. Places without any error are found whatever else stands near them.

Defined results: a null text is empty; texts without words have no spans, score 0 and null words. Repeated
rows and null doc_ids are searched row by row. Only doc_id and text are read. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.hashing import LOWER, blocks, runs, text_bytes

_WORD = np.zeros(256, bool)  # bytes of words, A-Z lower-cased before
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_BLOCK = 1 << 20
_REMEMBERED = 1 << 14  # windows
_MARGIN = 4  # bytes of the longest character

# The phrases whose exact places every scan counts.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Well-known short notices beside them.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons zero": "cc0",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}


@dataclass(frozen=True)
class Notice:
    """A notice, its label, and how many errors its words may have."""

    text: str
    label: str
    base: bool = False
    free: int = 5  # characters that allow no error
    per_error: int = 8  # further characters for each error
    most: int = 4

    @cached_property
    def head(self) -> str:
        """All but numbers at the end."""
        words = self.text.split()
        while len(words) > 1 and words[-1].isdigit():
            words.pop()
        head = " ".join(words)
        return head if head == self.text else head + " "

    @cached_property
    def errors(self) -> int:
        return max(0, min(self.most, (len(self.head) - self.free) // self.per_error))

    def seeds(self) -> list[tuple[str, int]]:
        """Pieces of the head and where they begin; one of them stands unchanged in every match."""
        parts = self.errors + 1
        bounds = [len(self.head) * i // parts for i in range(parts + 1)]
        return [(self.head[a:b], a) for a, b in zip(bounds[:-1], bounds[1:])]

    def pattern(self):
        import regex

        head, tail = regex.escape(self.head), regex.escape(self.text[len(self.head) :])
        # Spans begin and end with a whole word. Blanks stand round the text that is searched: the library
        # takes nothing for inserted at the very beginning.
        return regex.compile(rf"(?b)(?<= )(?=[^ ])(?:{head}){{e<={self.errors}}}{tail}(?<=[^ ])(?= )")


def notices() -> list[Notice]:
    base = [Notice(text, label, True) for text, label in BASE.items()]
    return base + [Notice(text, label) for text, label in NOTICES.items()]


class Scanner:
    def __init__(self, wanted: Sequence[Notice]):
        import ahocorasick

        self.notices = list(wanted)
        self.patterns = [notice.pattern() for notice in self.notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(self.notices):
            for seed, at in notice.seeds():
                seeds.setdefault(seed, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.automaton.add_word(seed, (len(seed), places))
        if seeds:
            self.automaton.make_automaton()
        self.known: dict[tuple[int, str], tuple[int, int, int] | None] = {}

    def _best(self, i: int, window: str) -> tuple[int, int, int] | None:
        """Start, end (bytes of the window) and errors of the best match in a window of whole words."""
        key = (i, window)
        if key not in self.known:
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            text = " " + window.encode("latin-1").decode() + " "
            found = self.patterns[i].search(text)
            if found is None:
                self.known[key] = None
            else:
                start = len(text[1 : found.start()].encode())
                end = start + len(found.group().encode())
                self.known[key] = (start, end, sum(found.fuzzy_counts))
        return self.known[key]

    def spans(self, normal: str, begin: int, end: int, hits: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, errors) in one text, normal[begin:end]; ``hits``: (place, notice, at)."""
        found: dict[int, set[tuple[int, int, int]]] = {}
        for place, i, at in hits:
            notice = self.notices[i]
            start = place - at
            stop = start + len(notice.text)
            if (
                begin <= start
                and stop <= end
                and normal.startswith(notice.text, start)
                and (start == begin or normal[start - 1] == " ")
                and (stop == end or normal[stop] == " ")
            ):
                found.setdefault(i, set()).add((0, start, stop))
                continue
            if not notice.errors:
                continue
            # The window holds every match round this seed; words cut by its edges cannot begin or end one.
            reach = _MARGIN * (notice.errors + 1)
            low, high = max(begin, start - reach), min(end, stop + reach)
            if low > begin and normal[low - 1] != " ":
                blank = normal.find(" ", low, place)
                if blank < 0:
                    continue
                low = blank + 1
            if high < end and normal[high] != " ":
                high = normal.rfind(" ", place, high)
                if high < 0:
                    continue
            best = self._best(i, normal[low:high])
            if best is not None:
                found.setdefault(i, set()).add((best[2], low + best[0], low + best[1]))
        out = []
        for i, places in found.items():
            starts: list[int] = []
            stops: list[int] = []
            for errors, start, stop in sorted(places):
                at = bisect_left(starts, start)
                if (at and stops[at - 1] > start) or (at < len(starts) and starts[at] < stop):
                    continue
                starts.insert(at, start)
                stops.insert(at, stop)
                out.append((start, stop, i, errors))
        return sorted(out)

    def block(self, column: pa.Array) -> tuple[np.ndarray, list[list[tuple]]]:
        """Words per text, and its spans: (notice, errors, first word, words, start, end), the last two in
        characters of the text."""
        data, offsets = text_bytes(column)
        low = LOWER[data]
        starts, ends, bounds = runs(_WORD[low], offsets)
        lengths = ends - starts
        stops = np.cumsum(lengths + 1)  # behind the blank after every word
        begins = stops - lengths - 1
        out = np.full(int(stops[-1]) if len(stops) else 0, 0x20, np.uint8)
        places = np.arange(int(lengths.sum()))
        word = np.repeat(np.arange(len(starts)), lengths)
        out[places + word] = low[places - (begins - np.arange(len(starts)))[word] + starts[word]]
        texts = len(offsets) - 1
        last = bounds[1:][np.diff(bounds) > 0] - 1  # last words of texts
        out[stops[last] - 1] = 0x0A
        normal = out.tobytes().decode("latin-1")  # a character for each byte
        spans: list[list[tuple]] = [[] for _ in range(texts)]
        hits: dict[int, list[tuple[int, int, int]]] = {}
        text_ends = stops[last].tolist()
        owners = np.flatnonzero(np.diff(bounds) > 0).tolist()
        for end, (length, seeds) in self.automaton.iter(normal) if len(self.automaton) else ():
            place = end - length + 1
            mine = hits.setdefault(bisect_left(text_ends, place + 1), [])
            mine += [(place, i, at) for i, at in seeds]
        for k, mine in hits.items():
            begin, end = text_ends[k - 1] if k else 0, text_ends[k] - 1
            text = owners[k]
            base = offsets[text]
            whole = data[base : offsets[text + 1]]
            marks = np.cumsum((whole & 0xC0) != 0x80)  # characters up to each byte
            for start, stop, i, errors in self.spans(normal, begin, end, mine):
                a = int(np.searchsorted(begins, start))
                b = int(np.searchsorted(stops, stop))  # last word
                spans[text].append(
                    (i, errors, a - int(bounds[text]), b - a + 1, int(marks[starts[a] - base]) - 1, int(marks[ends[b] - 1 - base]))
                )
        return np.diff(bounds), spans


_SPAN = "struct<label:string,notice:string,base:boolean,errors:int,first_word:bigint,words:bigint,start:bigint,end:bigint>"


def search(docs: DataFrame, wanted: Sequence[Notice] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, spans (in order of their places)."""
    wanted = notices() if wanted is None else list(wanted)
    narrow = docs.select("doc_id", "text")
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Scanner(wanted)
        kinds = (pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        names = ("label", "notice", "base", "errors", "first_word", "words", "start", "end")
        for batch in batches:
            for block in blocks(batch, 1, _BLOCK):
                n_words, spans = work.block(block.column(1))
                flat = [(work.notices[i].label, work.notices[i].text, work.notices[i].base, *rest) for own in spans for i, *rest in own]
                columns = zip(*flat) if flat else [()] * len(kinds)
                values = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], list(names))
                places = np.concatenate(([0], np.cumsum([len(own) for own in spans]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [block.column(0), pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(places, values)],
                    ["doc_id", "n_words", "spans"],
                )

    return narrow.mapInArrow(run, f"doc_id {id_type}, n_words bigint, spans array<{_SPAN}>")


def spans(docs: DataFrame, wanted: Sequence[Notice] | None = None) -> DataFrame:
    """One row per span: doc_id, label, notice, base, errors, first_word, words, start, end."""
    return search(docs, wanted).select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")


def scan(docs: DataFrame, wanted: Sequence[Notice] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    exact = F.filter("spans", lambda s: s["base"] & (s["errors"] == 0))
    starts = F.transform(exact, lambda s: s["first_word"])

    def joined(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    alike = F.transform("spans", lambda s: F.lit(1.0) - s["errors"] / F.length(s["notice"]))
    return search(docs, wanted).select(
        "doc_id",
        "n_words",
        F.size(exact).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(exact).alias("base_labels"),
        joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(alike), F.lit(0.0)).alias("score"),
    )

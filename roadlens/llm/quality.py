"""Quality rules: word statistics and zstandard compression bands.

Text that repeats itself compresses too well, noise hardly at all. The ratio of compressed to
plain UTF-8 bytes is taken over the whole document and over consecutive chunks of
``chunk_bytes``; each is held against limits that depend on its length, because short text
never compresses well. A document fails when its whole ratio leaves its band, or when more
than ``bad_share`` of its chunks (by bytes) leave theirs.

Defined results: a null text has no words and counts as empty; an empty text has ratio 1 and no
chunks. Columns besides doc_id and text are not read. Repeated rows are judged row by row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
COLUMNS = (
    ("n_words", "long"),
    ("word_chars", "long"),
    ("n_symbols", "long"),
    ("n_dup_lines", "long"),
    ("n_repeat_words", "long"),
    ("base_failed", "boolean"),
    ("kept", "boolean"),
    ("ratio", "double"),
    ("bad_chunk_share", "double"),
)


@dataclass(frozen=True)
class Bands:
    """(longest length in bytes, lowest ratio, highest ratio), by length; the last has no end."""

    limits: tuple[tuple[float, float, float], ...] = (
        (256, 0.30, 1.10),
        (1_024, 0.22, 0.95),
        (4_096, 0.18, 0.85),
        (16_384, 0.15, 0.80),
        (float("inf"), 0.10, 0.75),
    )
    chunk_bytes: int = 4_096
    bad_share: float = 0.5
    level: int = 3

    def inside(self, n: int, ratio: float) -> bool:
        for longest, low, high in self.limits:
            if n <= longest:
                return low <= ratio <= high
        return True


def repeated_words(words: list[str]) -> int:
    """Words inside a 3-word window that occurs twice or more in the list."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered = up_to = 0  # words before up_to are already counted
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered += i + 3 - max(i, up_to)
            up_to = i + 3
    return covered


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(lines) - len(set(lines))


def compression(raw: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Whole ratio, share of the bytes in chunks outside their band, and whether both are fine."""
    if not raw:
        return 1.0, 0.0, True
    whole = len(packer.compress(raw)) / len(raw)
    bad = 0
    if len(raw) > bands.chunk_bytes:
        for start in range(0, len(raw), bands.chunk_bytes):
            chunk = raw[start : start + bands.chunk_bytes]
            if not bands.inside(len(chunk), len(packer.compress(chunk)) / len(chunk)):
                bad += len(chunk)
    share = bad / len(raw)
    return whole, share, bands.inside(len(raw), whole) and share <= bands.bad_share


def judge(text: str | None, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    repeated = repeated_words(words)
    failed = n < 50 or 100 * repeated > 50 * n
    ratio, share, fine = compression(text.encode(), bands, packer)
    return (
        n,
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        duplicate_lines(text),
        repeated,
        failed,
        fine and not failed,
        ratio,
        share,
    )


def score(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document: doc_id and COLUMNS."""
    narrow = docs.select("doc_id", "text")
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, " + ", ".join(f"{name} {kind}" for name, kind in COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        for batch in batches:
            rows = [judge(text.as_py(), bands, packer) for text in batch.column(1)]
            columns = [[row[i] for row in rows] for i in range(len(COLUMNS))]
            arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, COLUMNS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], ["doc_id", *[name for name, _ in COLUMNS]]
            )

    return narrow.mapInArrow(run, schema)

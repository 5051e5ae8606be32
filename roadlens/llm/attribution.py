"""Token counts of sections and fields, from one encoding of the whole document.

A document is encoded once. Its sections divide its text; every token is held against them by its span,
and a token that crosses a boundary is given to one of them by ``rule``:

- ``first``: the section of its first character (the default),
- ``last``: the section of its last character,
- ``most``: the section with most of it, the earlier one of equals,
- ``split``: every section, by its part of the token; counts are then fractions.

Tokens without a character of their own go where they stand. Counts of a document's sections always add
up to its tokens. Byte-level tokenizers give spans in bytes, so a token may begin inside a character;
others give them in characters.

Defined results: a null text has no sections and gives no row; an empty text is one section without
tokens. In ``of_fields`` a null field is an empty one. Repeated rows give repeated rows. Only the named
columns are read. Sections are numbered from 0; a separator belongs to the section before it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.hashing import blocks, text_bytes
from roadlens.llm.tokens import Encoder, encoder

RULES = ("first", "last", "most", "split")


def interval_counts(bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section. Section i spans bounds[i] to bounds[i + 1]; tokens are in order."""
    n = len(bounds) - 1
    # Of sections that begin at one place only the last can hold anything.
    first = np.clip(np.searchsorted(bounds[:-1], starts, side="right") - 1, 0, None)
    last = np.searchsorted(bounds[:-1], np.maximum(ends - 1, starts), side="right") - 1
    last = np.maximum(last, first)
    if rule in ("first", "last"):
        return np.bincount(first if rule == "first" else last, minlength=n)
    inside = first == last
    counts = np.bincount(first[inside], minlength=n).astype(float)
    for token in np.flatnonzero(~inside):
        sections = np.arange(first[token], last[token] + 1)
        low = np.maximum(bounds[sections], starts[token])
        parts = np.minimum(bounds[sections + 1], ends[token]) - low
        if rule == "most":
            counts[sections[parts.argmax()]] += 1
        else:
            counts[sections] += parts / parts.sum()
    return counts


def _spans(work: Encoder, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all tokens, and the length of each text, in bytes or characters.

    Positions run on from text to text.
    """
    lengths = work.id_bytes()
    if lengths is not None:
        ids, _ = work.encode(column)
        ends = np.cumsum(lengths[ids])
        _, offsets = text_bytes(column)
        return ends - lengths[ids], ends, offsets
    texts = [t or "" for t in column.to_pylist()]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    done = work.tokenizer.encode_batch(texts, add_special_tokens=False)
    spans = [np.array(e.offsets, np.int64).reshape(-1, 2) + at for e, at in zip(done, offsets)]
    both = np.concatenate([np.zeros((0, 2), np.int64), *spans])
    return both[:, 0], both[:, 1], offsets


def _breaks(work: Encoder, column: pa.Array, separator: str) -> list[np.ndarray]:
    """Where the sections of each text begin, from the start of the text."""
    out = []
    whole = work.id_bytes() is not None
    for text in column.to_pylist():
        text = text or ""
        body, mark = (text.encode(), separator.encode()) if whole else (text, separator)
        lengths = np.array([len(part) for part in body.split(mark)], np.int64) + len(mark)
        out.append(np.cumsum(lengths) - lengths)
    return out


def of_sections(docs: DataFrame, tokenizer: str, separator: str = "\n", rule: str = "first") -> DataFrame:
    """One row per section: doc_id, section, start and length (bytes or characters), n_tokens."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    narrow = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    kind, number = (pa.float64(), "double") if rule == "split" else (pa.int64(), "bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(tokenizer)
        for batch in batches:
            for block in blocks(batch, 1, 1 << 20):
                begins = _breaks(work, block.column(1), separator)
                starts, ends, offsets = _spans(work, block.column(1))
                sizes = np.array([len(b) for b in begins])
                line = np.concatenate(begins) + np.repeat(offsets[:-1], sizes)
                bounds = np.append(line, offsets[-1])
                counts = interval_counts(bounds, starts, ends, rule)
                number_in = np.arange(len(line)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                owners = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column(0).take(owners),
                        pa.array(number_in, pa.int64()),
                        pa.array(np.concatenate(begins), pa.int64()),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(counts.astype(kind.to_pandas_dtype()), kind),
                    ],
                    ["doc_id", "section", "start", "length", "n_tokens"],
                )

    schema = f"doc_id {id_type}, section bigint, start bigint, length bigint, n_tokens {number}"
    return narrow.mapInArrow(run, schema)


def of_fields(
    rows: DataFrame, key: str, fields: Sequence[str], tokenizer: str, joiner: str = "\n\x00\n", rule: str = "first"
) -> DataFrame:
    """One row per row and field: doc_id (the key), field, start, length, n_tokens.

    The fields are joined and encoded as one text. ``joiner`` must not occur in them.
    """
    text = F.concat_ws(joiner, *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])
    counted = of_sections(rows.select(F.col(key).alias("doc_id"), text.alias("text")), tokenizer, joiner, rule)
    names = F.array(*[F.lit(f) for f in fields])
    return counted.withColumn("field", F.element_at(names, (F.col("section") + 1).cast("int"))).select(
        "doc_id", "field", "start", "length", "n_tokens"
    )

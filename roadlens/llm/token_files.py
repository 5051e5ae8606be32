"""Token ids in directly addressable files.

An id is split into chunks of ``WIDTHS`` bits, lowest first. Level 0 holds the first chunk of every
token; a continuation bitmap tells which tokens go on, and level 1 holds the next chunks of just
those, and so on. A rank directory counts the bitmap's ones up to every 512th token, so the place of
a token on the next level, and with it any id or range of ids, is read without decoding others.

A table of segments is the file: each row holds whole documents, in ascending doc_id order over
(part, seq), with their ids, starts and levels. Spark writes it, so it lies wherever Spark can
write, and a lost task leaves no half-written file behind.

Defined results: a null text is an empty one; every document gets the end id, so an empty one has one
token. Null doc_ids come first. Rows with the same doc_id follow each other in the order of a hash of
their texts. Only doc_id and text are read. An empty table gives a table without segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.llm.hashing import blocks
from roadlens.llm.tokens import encoder, with_end

WIDTHS = (10, 6, 8, 8)
RANK_STEP = 512
SEGMENT_TOKENS = 1 << 18  # a segment is closed at the first document that reaches it
_LEVEL = "struct<width:int,chunks:binary,more:binary,ranks:binary>"


def _pack(values: np.ndarray, width: int) -> bytes:
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def _unpack(data: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Values ``start`` to ``stop`` of a packed level; reads only their bytes."""
    first = start * width // 8
    raw = np.frombuffer(data, np.uint8, -(-stop * width // 8) - first, first)
    skip = start * width - first * 8
    bits = np.unpackbits(raw, bitorder="little")[skip : skip + (stop - start) * width]
    weights = np.uint32(1) << np.arange(width, dtype=np.uint32)
    return (bits.reshape(-1, width) * weights).sum(axis=1, dtype=np.uint32)


def _ones(data: bytes, start: int, stop: int) -> np.ndarray:
    first = start // 8
    raw = np.frombuffer(data, np.uint8, -(-stop // 8) - first, first)
    return np.unpackbits(raw, bitorder="little")[start - first * 8 : stop - first * 8].astype(bool)


def encode_levels(ids: np.ndarray, widths: Sequence[int] = WIDTHS) -> list[dict]:
    levels = []
    rest = ids.astype(np.uint32)
    for i, width in enumerate(widths):
        more = rest >> np.uint32(width) if width < 32 else np.zeros_like(rest)
        goes_on = more > 0
        if i == len(widths) - 1 and goes_on.any():
            raise ValueError(f"Ids need more than {sum(widths)} bits.")
        ones = np.concatenate(([0], np.cumsum(goes_on)))
        levels.append(
            {
                "width": width,
                "chunks": _pack(rest & np.uint32((1 << width) - 1), width),
                "more": np.packbits(goes_on, bitorder="little").tobytes(),
                "ranks": ones[::RANK_STEP].astype("<u4").tobytes(),
            }
        )
        rest = more[goes_on]
        if not len(rest):
            break
    return levels


def _rank(level: dict, place: int) -> int:
    """Tokens before ``place`` that go on: one directory entry and less than 512 bits."""
    step = place // RANK_STEP
    known = int(np.frombuffer(level["ranks"], "<u4", 1, 4 * step)[0])
    return known + int(_ones(level["more"], step * RANK_STEP, place).sum())


def read_range(levels: Sequence[dict], start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a segment."""
    ids = np.zeros(max(0, stop - start), np.uint32)
    owners = np.arange(len(ids))
    shift = 0
    for depth, level in enumerate(levels):
        if start >= stop:
            break
        ids[owners] |= _unpack(level["chunks"], level["width"], start, stop) << np.uint32(shift)
        if depth + 1 == len(levels):
            break
        owners = owners[_ones(level["more"], start, stop)]
        start = _rank(level, start)
        stop = start + len(owners)
        shift += level["width"]
    return ids


def write(docs: DataFrame, tokenizer: str, end: int, path: str, widths: Sequence[int] = WIDTHS) -> None:
    """Encode every text and write the segments to ``path``."""
    tie = F.xxhash64("text")
    line = docs.select("doc_id", "text", tie.alias("tie")).repartitionByRange("doc_id", "tie")
    line = line.sortWithinPartitions("doc_id", "tie").drop("tie")
    id_type = line.schema["doc_id"].dataType.simpleString()
    schema = f"part int, seq int, n_tokens bigint, doc_ids array<{id_type}>, starts array<bigint>, levels array<{_LEVEL}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        work = encoder(tokenizer)
        doc_ids, lengths, held, total = [], [], [], 0

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(held)
            starts = np.concatenate(([0], np.cumsum(lengths)))
            level = pa.struct(
                [("width", pa.int32()), ("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())]
            )
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([seq], pa.int32()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([doc_ids], pa.list_(id_kind)),
                    pa.array([starts.tolist()], pa.list_(pa.int64())),
                    pa.array([encode_levels(ids, widths)], pa.list_(level)),
                ],
                ["part", "seq", "n_tokens", "doc_ids", "starts", "levels"],
            )

        for batch in batches:
            id_kind = batch.schema.field(0).type
            for block in blocks(batch, 1, 1 << 20):
                ids, offsets = with_end(*work.encode(block.column(1)), end)
                for i, doc_id in enumerate(block.column(0).to_pylist()):
                    doc_ids.append(doc_id)
                    held.append(ids[offsets[i] : offsets[i + 1]])
                    lengths.append(len(held[-1]))
                    total += lengths[-1]
                    if total >= SEGMENT_TOKENS:
                        yield segment()
                        doc_ids, lengths, held, total = [], [], [], 0
                        seq += 1
        if doc_ids:
            yield segment()

    # Packed bits do not get smaller.
    line.mapInArrow(run, schema).write.option("compression", "none").parquet(path)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, before): tokens of all segments before this one."""
    sizes = spark.read.parquet(path).select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row per partition that was written.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    placed = sizes.withColumn("local", local).join(parts, "part")
    return placed.select("part", "seq", (F.col("part_start") + F.col("local")).alias("before"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32."""
    table = spark.read.parquet(path)
    id_type = table.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                starts = row["starts"]
                ids = read_range(row["levels"], 0, starts[-1])
                parts = [ids[a:b].astype("<u4").tobytes() for a, b in zip(starts, starts[1:])]
                n = len(parts)
                kind = batch.schema.field("doc_ids").type.value_type
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["seq"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], kind),
                        pa.array(starts[:-1], pa.int64()),
                        pa.array(np.diff(starts), pa.int64()),
                        pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    ],
                    ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    schema = f"part int, seq int, doc_id {id_type}, local bigint, n_tokens bigint, ids_crc32 bigint"
    rows = table.mapInArrow(run, schema).join(segment_starts(spark, path), ["part", "seq"])
    return rows.select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")

"""Harmonic packing of token ids into sequences of a fixed capacity.

Lengths are classed by the reciprocals of the capacity: a piece of class k fills one k-th of a
sequence (up to ``slack`` of it), and a sequence of class k holds exactly k such pieces. A document is
cut into full sequences, then into the largest classes that fit what is left. Three steps fill them:

1. Every worker fills the sequences of each class on its own, while it encodes its documents.
2. What a worker is left with, fewer than k pieces per class, is numbered through over all workers
   by counts per (class, worker), and filled up k by k.
3. Fewer than k pieces per class then remain in the whole corpus, however large it is. Their ids run
   on through the last sequences, cut at their ends, so only the very last one is padded.

Defined results: a null text is an empty one; every document gets the end id, so it has at least one
piece. Repeated rows and null doc_ids are packed row by row. Only doc_id and text are read. An empty
table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.hashing import blocks
from roadlens.llm.tokens import encoder, with_end
from roadlens.llm.workers import give_back
from roadlens.operators.lineage import staged

_SECOND, _LAST = 1 << 62, (1 << 62) + (1 << 61)  # sequence numbers of steps 2 and 3


def class_counts(capacity: int) -> list[int]:
    """Pieces per sequence: 1 to 16, then eight per octave, up to single ids."""
    counts = list(range(1, 17))
    while counts[-1] < capacity:
        step = 1 << (counts[-1].bit_length() - 4)
        counts.append(min(capacity, counts[-1] + step))
    return [k for k in counts if k <= capacity]


def cuts(n: int, capacity: int, counts: list[int], slack: float) -> Iterator[tuple[int, int]]:
    """(length, class) of the pieces of a document of ``n`` ids."""
    for _ in range(n // capacity):
        yield capacity, 1
    left = n % capacity
    while left:
        k = next(k for k in counts if capacity // k <= left or left * k >= (1 - slack) * capacity and left * k <= capacity)
        length = min(left, capacity // k)
        yield length, k
        left -= length


def pack(
    docs: DataFrame, tokenizer: str, end: int, capacity: int = 2_048, slack: float = 1 / 256
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (unsigned little-endian 32 bits), doc_tokens,
    sequence_id, offset."""
    counts = class_counts(capacity)
    narrow = docs.select("doc_id", "text")
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, work = TaskContext.get().partitionId(), encoder(tokenizer)
        sequences = 0
        open_pieces: dict[int, list[tuple]] = {k: [] for k in counts}
        rows: list[tuple] = []

        def emit() -> pa.RecordBatch:
            kinds = (id_kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "class", "part", "place")
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], list(names))

        for batch in batches:
            id_kind = batch.schema.field(0).type
            for block in blocks(batch, 1, 1 << 20):
                ids, offsets = with_end(*work.encode(block.column(1)), end)
                raw = ids.astype("<u4").tobytes()
                bounds = offsets.tolist()
                for i, doc_id in enumerate(block.column(0).to_pylist()):
                    first, n, start = bounds[i], bounds[i + 1] - bounds[i], 0
                    for length, k in cuts(n, capacity, counts, slack):
                        at = 4 * (first + start)
                        waiting = open_pieces[k]
                        waiting.append((doc_id, start, length, raw[at : at + 4 * length], n))
                        start += length
                        if len(waiting) == k:
                            offset = 0
                            for piece in waiting:
                                rows.append((*piece, (part << 32) + sequences, offset, k, part, None))
                                offset += piece[2]
                            sequences += 1
                            waiting.clear()
                if rows:
                    yield emit()
                    rows.clear()
        for k, waiting in open_pieces.items():
            rows.extend((*piece, None, None, k, part, i) for i, piece in enumerate(waiting))
        if rows:
            yield emit()
        give_back()

    schema = f"doc_id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, class int, part int, place int"
    pieces = staged(narrow.mapInArrow(run, schema))
    return _finish(pieces, capacity)


def _finish(pieces: DataFrame, capacity: int) -> DataFrame:
    """Steps 2 and 3."""
    out = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    done = pieces.where(F.col("sequence_id").isNotNull()).select(*out)
    rest = pieces.where(F.col("sequence_id").isNull()).drop("sequence_id", "offset")
    held = rest.groupBy("class", "part").agg(F.count(F.lit(1)).alias("n"))  # a row per class and worker
    earlier = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        "class",
        "part",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("class")).alias("total"),
    )
    # Each worker holds less than k pieces of class k, so no (class, part) is large.
    numbered = rest.join(held, ["class", "part"]).withColumn("number", F.col("before") + F.col("place"))
    bin_ = F.floor(F.col("number") / F.col("class"))
    numbered = numbered.withColumn("bin", bin_)
    full = F.col("bin") < F.floor(F.col("total") / F.col("class"))
    ahead = Window.partitionBy("class", "bin").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    second = numbered.where(full).withColumns(
        {
            "sequence_id": F.lit(_SECOND) + F.shiftleft(F.col("class").cast("long"), 48) + F.col("bin"),
            "offset": F.coalesce(F.sum("length").over(ahead), F.lit(0)),
        }
    )
    # Fewer than k pieces per class: a fixed number for any corpus, so one task may order them.
    line = Window.orderBy("class", "number").rowsBetween(Window.unboundedPreceding, -1)
    last = numbered.where(~full).withColumn("at", F.coalesce(F.sum("length").over(line), F.lit(0)))
    room = F.lit(capacity) - F.col("at") % capacity
    last = last.withColumn(
        "cut",
        F.explode(
            F.when(
                F.col("length") > room,
                F.array(
                    F.struct(F.lit(0).cast("long").alias("skip"), room.alias("take")),
                    F.struct(room.alias("skip"), (F.col("length") - room).alias("take")),
                ),
            ).otherwise(F.array(F.struct(F.lit(0).cast("long").alias("skip"), F.col("length").alias("take"))))
        ),
    )
    skip, take = F.col("cut.skip"), F.col("cut.take")
    last = last.select(
        "doc_id",
        (F.col("start") + skip).alias("start"),
        take.alias("length"),
        F.substring("ids", (4 * skip + 1).cast("int"), (4 * take).cast("int")).alias("ids"),
        "doc_tokens",
        (F.lit(_LAST) + F.floor((F.col("at") + skip) / capacity)).alias("sequence_id"),
        ((F.col("at") + skip) % capacity).alias("offset"),
    )
    return done.unionByName(second.select(*out)).unionByName(last)

"""Language-model scores by deleted interpolation.

Words are scored by a mix of bigram, unigram and uniform estimates. The mix depends on how often the
context was seen: contexts are put into buckets by the logarithm of their count, and the weights of a
bucket are learned by expectation-maximisation on a held-out fold of the training documents, whose own
counts are deleted from the counts they are predicted with. Scoring uses all training counts.

Counts cover every training document and are never held in one place. Documents are read in blocks. For
each block the distinct unigrams and bigrams go to buckets of hash values (packed, 8 and 6 bytes a
key), each bucket adds up the blocks' counts, and each block gets the totals of its own keys back. A
frequent word is one key per block, so no bucket is large because of it; the number of buckets follows
the bytes of text. Blocks are cut twice from the same input, once to send keys and once to meet the
counts; a block carries a checksum, and one that does not find its counts stops the job. The weights are
learned from a histogram of quantised estimates over all rows of the fold, whose size is fixed.

Defined results: tokens are words with A-Z lower-cased, then one end token. A null or empty text, or one
without words, is that end token alone. Rows with a null doc_id are training rows. Repeated rows count
and are scored as often as they come. Without training rows every score is that of a uniform
distribution over one unknown word, 0. Only doc_id and text are read. Words are
told apart by 64-bit hashes, bigrams by 48 bits and their bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.hashing import LOWER, blocks, hash_runs, mixed, text_bytes, words
from roadlens.operators.lineage import staged

_GOLD = np.uint64(0x9E3779B97F4A7C15)
END = np.uint64(0x5EED)  # the hash of the end token
WORDS, PAIRS, TOTALS, TEXTS = 1, 2, 3, 4  # kinds of rows
_ROWS = "block string, kind int, bucket int, keys binary, counts binary"
_ZERO = 1_023  # the quantised value of an estimate of zero
_EQUAL = 512  # and of one equal to the uniform estimate


@dataclass(frozen=True)
class Settings:
    folds: int = 7
    test_fold: int = 2  # never learned from
    weight_fold: int = 3  # training rows whose counts are deleted to learn the weights
    block_bytes: int = 8 << 20
    bucket_bytes: int = 16 << 20  # bytes of text per hash bucket
    steps_per_octave: int = 8
    context_buckets: int = 24
    rounds: int = 100


def squeeze(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), -1).T if len(values) else values.view(np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expand(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def pack_keys(kind: int, keys: np.ndarray) -> bytes:
    return keys.tobytes() if kind == WORDS else keys.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack_keys(kind: int, data: bytes) -> np.ndarray:
    if kind == WORDS:
        return np.frombuffer(data, np.uint64)
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


class Block:
    """Tokens of some documents, and their distinct words and bigrams in order of hash."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        starts, ends, bounds = words(data, offsets)
        self.sizes = np.diff(bounds) + 1
        self.stops = np.cumsum(self.sizes)  # behind the end token of each document
        stream = np.full(self.stops[-1], END, np.uint64)
        inner = np.ones(len(stream), bool)
        inner[self.stops - 1] = False
        stream[inner] = hash_runs(LOWER[data], starts, ends)
        before = self.shifted(stream)
        self.words, self.word = np.unique(stream, return_inverse=True)
        self.pairs, self.pair = np.unique(mixed(mixed(before) * _GOLD ^ stream), return_inverse=True)

    def shifted(self, values: np.ndarray) -> np.ndarray:
        """The value of the token before; before the first token stands the end token."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.stops - self.sizes] = values[self.stops - 1]
        return out


def bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets begin in sorted hashes; bucket by the upper 32 bits."""
    own = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(own, np.arange(buckets + 1, dtype=np.uint64))


def _cut(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Named blocks of documents: the same names whenever the same partition is read."""
    place = 0
    for batch in batches:
        for block in blocks(batch, 2, settings.block_bytes):
            data, offsets = text_bytes(block.column(2))
            part = block.column(3)[0].as_py()
            yield f"{part}-{place}-{zlib.crc32(data, len(offsets))}", block
            place += 1


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["block", "kind", "bucket", "keys", "counts"]
    )


def _sent_keys(narrow: DataFrame, buckets: int, settings: Settings) -> DataFrame:
    """Keys of each block per bucket, with their counts in training and in the weight fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, part in _cut(batches, settings):
            block = Block(part.column(2))
            fold = np.repeat(part.column(1).to_numpy(), block.sizes)
            rows = []
            for kind, keys, place in ((WORDS, block.words, block.word), (PAIRS, block.pairs, block.pair)):
                known = np.bincount(place[fold != settings.test_fold], minlength=len(keys))
                held = np.bincount(place[fold == settings.weight_fold], minlength=len(keys))
                edges = bounds(keys, buckets)
                for bucket in np.flatnonzero(np.diff(edges)).tolist():
                    cell = slice(edges[bucket], edges[bucket + 1])
                    both = np.concatenate((known[cell], held[cell])).astype(np.uint32)
                    rows.append((name, kind, bucket, pack_keys(kind, keys[cell]), squeeze(both)))
            yield _rows(rows)

    return narrow.mapInArrow(run, _ROWS)


def _added_up(table: pa.Table) -> pa.Table:
    """Of one bucket: every block's keys with the counts of all blocks, and the totals."""
    kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
    keys = [unpack_keys(kind, k) for k in table.column("keys").to_pylist()]
    ends = np.cumsum([len(k) for k in keys])
    counts = [expand(c, np.uint32).reshape(2, -1) for c in table.column("counts").to_pylist()]
    values, place = np.unique(np.concatenate(keys), return_inverse=True)
    known, held = (
        np.bincount(place, weights=np.concatenate([c[i] for c in counts]), minlength=len(values)).astype(np.int64)
        for i in (0, 1)
    )
    rows = []
    for name, start, stop in zip(table.column("block").to_pylist(), ends - [len(k) for k in keys], ends):
        own = place[start:stop]
        rows.append((name, kind, bucket, None, squeeze(np.concatenate((known[own], held[own])))))
    if kind == WORDS:
        figures = [known.sum(), (known > 0).sum(), (known - held).sum(), (known > held).sum()]
        rows.append((f"totals {bucket}", TOTALS, bucket, None, ",".join(map(str, figures)).encode()))
    return pa.Table.from_batches([_rows(rows)])


def _sent_texts(narrow: DataFrame, settings: Settings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for name, part in _cut(batches, settings):
            yield _rows([(name, TEXTS, -1, None, packer.compress(_to_bytes(part.select([0, 1, 2]))))])

    return narrow.mapInArrow(run, _ROWS)


def _to_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_bytes(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


_COUNTED = "kind int, totals binary, ids binary, sizes binary, word binary, pair binary, word_less binary, pair_less binary"
_COUNTED_TYPES = [pa.int32()] + [pa.binary()] * 7
_COUNTED_NAMES = [c.split()[0] for c in _COUNTED.split(", ")]


def _met(weight_fold: int):
    """Of one block: its documents with the counts of every token, in text order."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("kind", "ascending"), ("bucket", "ascending")]).to_pylist()
        out: list = [None] * len(_COUNTED_NAMES)
        if rows[0]["kind"] == TOTALS:
            out[:2] = [TOTALS, rows[0]["counts"]]
        else:
            if rows[-1]["kind"] != TEXTS:
                raise ValueError("The input changed between two readings; write it to a table first.")
            part = _from_bytes(zstandard.ZstdDecompressor().decompress(rows[-1]["counts"]))
            block = Block(part.column(2))
            fold = np.repeat(part.column(1).to_numpy(), block.sizes) == weight_fold
            out[0] = TEXTS
            out[2] = _to_bytes(part.select([0, 1]))
            out[3] = squeeze(block.sizes.astype(np.int64))
            for at, kind, keys, place in (
                (4, WORDS, block.words, block.word),
                (5, PAIRS, block.pairs, block.pair),
            ):
                got = [expand(r["counts"], np.int64).reshape(2, -1) for r in rows if r["kind"] == kind]
                known, held = np.concatenate(got, axis=1)
                if len(known) != len(keys):
                    raise ValueError("The input changed between two readings; write it to a table first.")
                out[at] = squeeze(known[place])
                out[at + 2] = squeeze((known - held)[place[fold]])
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(out, _COUNTED_TYPES)], _COUNTED_NAMES)

    return run


def counted(docs: DataFrame, settings: Settings) -> DataFrame:
    """Staged: one row per block with the counts of its tokens, one per bucket with totals."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    fold = F.coalesce(crc % settings.folds, F.lit(-1)).cast("int").alias("fold")
    narrow = docs.select("doc_id", fold, "text", F.spark_partition_id().alias("part"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // settings.bucket_bytes))
    keys = _sent_keys(narrow, buckets, settings)
    replies = keys.groupBy("kind", "bucket").applyInArrow(_added_up, _ROWS)
    rows = replies.unionByName(_sent_texts(narrow, settings))
    return staged(rows.groupBy("block").applyInArrow(_met(settings.weight_fold), _COUNTED))


class Estimates:
    """Bigram, unigram and uniform estimates of tokens from their counts."""

    def __init__(self, tokens: int, distinct: int, settings: Settings):
        self.tokens, self.distinct, self.settings = tokens, distinct, settings
        self.uniform = 1 / (distinct + 1)

    def of(self, before: np.ndarray, pair: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Context bucket, bigram estimate, unigram estimate."""
        bucket = np.zeros(len(before), np.int64)
        seen = before > 0
        bucket[seen] = 1 + np.log2(before[seen]).astype(np.int64)
        bucket = np.minimum(bucket, self.settings.context_buckets - 1)
        return bucket, np.where(seen, pair / np.maximum(before, 1), 0.0), word / max(1, self.tokens)

    def steps(self, estimate: np.ndarray) -> np.ndarray:
        """Logarithm over the uniform estimate in fixed steps; _ZERO for zero."""
        with np.errstate(divide="ignore"):
            step = np.rint(np.log2(estimate / self.uniform) * self.settings.steps_per_octave)
        # In eighths of octaves from 2 ** -64 to 2 ** 63 times the uniform estimate, so none is clipped.
        return np.where(estimate > 0, np.clip(step + _EQUAL, 0, _ZERO - 1), _ZERO).astype(np.int64)

    def value(self, step: np.ndarray) -> np.ndarray:
        return np.where(step == _ZERO, 0.0, self.uniform * 2.0 ** ((step - _EQUAL) / self.settings.steps_per_octave))


def _shift(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    stops = np.cumsum(sizes)
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[stops - sizes] = values[stops - 1]
    return out


def learned_weights(table: DataFrame, estimates: Estimates, settings: Settings) -> np.ndarray:
    """Weights (bigram, unigram, uniform) per context bucket, from the deleted fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fold = _from_bytes(row["ids"]).column(1).to_numpy()
                sizes = expand(row["sizes"], np.int64)[fold == settings.weight_fold]
                if not len(sizes):
                    continue
                word, pair = expand(row["word_less"], np.int64), expand(row["pair_less"], np.int64)
                bucket, two, one = estimates.of(_shift(word, sizes), pair, word)
                code = (bucket << 20) | (estimates.steps(two) << 10) | estimates.steps(one)
                codes, n = np.unique(code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["code", "n"])

    # At most context_buckets * 2 ** 20 cells; estimates of n tokens lie within 8 * log2(n) steps each, so far fewer.
    cells = table.select("ids", "sizes", "word_less", "pair_less").mapInArrow(run, "code bigint, n bigint")
    rows = cells.groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    code, n = rows["code"].to_numpy(np.int64), rows["n"].to_numpy(float)
    bucket = code >> 20
    parts = np.stack(
        [estimates.value((code >> 10) & 1_023), estimates.value(code & 1_023), np.full(len(code), estimates.uniform)]
    )
    weights = np.tile([[0.4], [0.4], [0.2]], settings.context_buckets)
    weights[:, 0] = [0.0, 0.5, 0.5]
    for _ in range(settings.rounds):
        share = parts * weights[:, bucket]
        share *= n / np.maximum(share.sum(axis=0), 1e-300)
        sums = np.stack([np.bincount(bucket, weights=s, minlength=settings.context_buckets) for s in share])
        known = sums.sum(axis=0) > 0
        weights[:, known] = sums[:, known] / sums[:, known].sum(axis=0)
    weights = np.maximum(weights, [[0.0], [1e-6], [1e-6]])  # no token is impossible
    return weights / weights.sum(axis=0)


def score(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    table = counted(docs, settings)
    # One row per hash bucket: four numbers each, added up by Spark.
    figures = table.where(F.col("kind") == TOTALS).select(
        *[F.split(F.col("totals").cast("string"), ",")[i].cast("long").alias(f"n{i}") for i in range(4)]
    )
    n, v, less_n, less_v = (x or 0 for x in figures.agg(*[F.sum(f"n{i}") for i in range(4)]).first())
    texts = table.where(F.col("kind") == TEXTS)
    weights = learned_weights(texts, Estimates(less_n, less_v, settings), settings)
    estimates = Estimates(n, v, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = _from_bytes(row["ids"])
                sizes = expand(row["sizes"], np.int64)
                word, pair = expand(row["word"], np.int64), expand(row["pair"], np.int64)
                bucket, two, one = estimates.of(_shift(word, sizes), pair, word)
                mix = weights[0, bucket] * two + weights[1, bucket] * one + weights[2, bucket] * estimates.uniform
                starts = np.cumsum(sizes) - sizes
                base = np.log10((word + 1) / (n + v + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(part.column(1).to_numpy() == settings.test_fold),
                        pa.array(sizes),
                        pa.array(np.add.reduceat((word > 0).astype(np.int64), starts)),
                        pa.array(np.full(len(sizes), n, np.int64)),
                        pa.array(np.add.reduceat(base, starts)),
                        pa.array(np.add.reduceat(np.log10(mix), starts)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return texts.select("ids", "sizes", "word", "pair").mapInArrow(run, schema)

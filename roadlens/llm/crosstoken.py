"""Cross-tokenizer alignment by inverted pair bitmaps.

Tokenizer A reads a space and the text, tokenizer B the text, to which it adds that space itself. Tokens
are runs of the same bytes then. Offsets where tokens of both end cut a document into groups; an A and a
B token that share a byte are a link. Every worker gathers documents into chunks. A chunk holds, for each
pair of ids linked in it, a compressed bitmap of its documents, and multiplicity planes: bitmap j has the
documents where bit j of the number of links is set. Blocks of documents are OR-merged into their chunk.
Popcounts give documents and links per pair of a chunk; chunks never share documents, so Spark adds them up
over the corpus. Counts come back to the chunks that hold the pair, whose postings turn them into a score
per document: links whose pair is (one of) the A id's commonest, and the sum of counts over links.

Defined results: a text that is null, empty, or not given back byte for byte by both tokenizers has no
tokens: all figures 0, groups_sha256 ''. Repeated rows and null doc_ids are documents like others. Only
doc_id and text are read. An empty table gives no rows. A chunk closes at ``postings`` pairs; a longer
document is a chunk of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.hashing import blocks, text_bytes
from roadlens.llm.tokens import Encoder, PieceEncoder, encoder, piece_encoder
from roadlens.operators.lineage import staged


@dataclass(frozen=True)
class Settings:
    postings: int = 1_500_000  # (document, pair) entries of a chunk
    documents: int = 1 << 16  # of a chunk
    block: int = 1 << 20  # bytes of text aligned at once


_COMMA, _BAR, _SEMICOLON = 0x2C, 0x7C, 0x3B
_SHIFT = np.uint64(16)  # B ids have up to 16 bits
_LOW = np.uint64(0xFFFF)


def spaced(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a space and the text for every text that is not empty, and the offsets of the texts."""
    data, offsets = text_bytes(column)
    lengths = np.diff(offsets)
    full = lengths > 0
    before = np.cumsum(full)  # spaces up to and with this text's
    out = np.full(len(data) + int(full.sum()), 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(before, lengths)] = data
    return out, np.concatenate(([0], offsets[1:] + before))


def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of all ids below ``most``, and how many there are."""
    ids = np.arange(most)
    width = len(str(most))
    table = np.zeros((most, width), np.uint8)
    counts = np.array([len(str(i)) for i in range(most)], np.int64)
    for at in range(width):
        place = counts - 1 - at
        real = place >= 0
        table[real, at] = 0x30 + ids[real] // 10 ** place[real] % 10
    return table, counts


class Aligner:
    """Both encoders of a worker, and the tables that depend on their vocabularies."""

    def __init__(self, a: Encoder, b: PieceEncoder):
        self.a, self.b = a, b
        self.size_a, self.size_b = a.id_bytes(), b.id_bytes()
        if self.size_a is None:
            raise ValueError("Tokenizer A must be byte-level.")
        if len(self.size_b) > 1 << 16:
            raise ValueError("Tokenizer B has more than 65,536 ids.")
        self.digits, self.widths = _digits(max(len(self.size_a), len(self.size_b)))

    def block(self, column: pa.Array) -> Aligned:
        data, offsets = spaced(column)
        ids_a, off_a, good_a = self.a.exact(data, offsets)
        ids_b, off_b, good_b = self.b.exact(data, offsets)
        good = good_a & good_b
        if not good.all():
            ids_a, off_a = _without(ids_a, off_a, good)
            ids_b, off_b = _without(ids_b, off_b, good)
        return Aligned(self, ids_a, off_a, ids_b, off_b)


def _without(ids: np.ndarray, offsets: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(offsets)
    ids = ids[np.repeat(good, counts)]
    return ids, np.concatenate(([0], np.cumsum(np.where(good, counts, 0))))


class Aligned:
    """Groups and links of the documents of a block."""

    def __init__(self, work: Aligner, ids_a: np.ndarray, off_a: np.ndarray, ids_b: np.ndarray, off_b: np.ndarray):
        self.work, self.ids_a, self.off_a, self.ids_b, self.off_b = work, ids_a, off_a, ids_b, off_b
        end_a, end_b = np.cumsum(work.size_a[ids_a]), np.cumsum(work.size_b[ids_b])
        total = int(end_a[-1]) if len(end_a) else 0
        ends = np.zeros(total + 1, np.uint8)
        ends[end_a] = 1
        ends[end_b] |= 2
        self.last_a = ends[end_a] == 3  # tokens that end a group
        self.last_b = ends[end_b] == 3
        # Every stretch between two neighbouring ends lies in one token of A and one of B: a link.
        stretches = np.flatnonzero(ends)
        of_a, of_b = (ends[stretches] & 1).astype(bool), (ends[stretches] & 2).astype(bool)
        self.link_a = np.cumsum(of_a) - of_a
        self.link_b = np.cumsum(of_b) - of_b
        self.link_doc = np.searchsorted(off_a, self.link_a, "right") - 1

    def counts(self) -> tuple[np.ndarray, ...]:
        """n_a, n_b, n_groups, n_links per document."""
        groups = np.concatenate(([0], np.cumsum(self.last_a)))
        links = np.bincount(self.link_doc, minlength=len(self.off_a) - 1)
        return np.diff(self.off_a), np.diff(self.off_b), np.diff(groups[self.off_a]), links

    def postings(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct (document, pair) keys, documents in the upper 32 bits, and their links."""
        a, b = self.ids_a[self.link_a].astype(np.uint64), self.ids_b[self.link_b].astype(np.uint64)
        keys = np.sort(self.link_doc.astype(np.uint64) << np.uint64(32) | a << _SHIFT | b)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.diff(np.append(first, len(keys)))

    def group_texts(self) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of all documents one after another, and the offsets of the documents.

        Each text is followed by one separator, which its offsets leave out of account.
        """
        group_a = np.cumsum(self.last_a) - self.last_a
        group_b = np.cumsum(self.last_b) - self.last_b
        place = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        ids = np.concatenate((self.ids_a, self.ids_b))[place]
        mark = np.concatenate((np.where(self.last_a, _BAR, _COMMA), np.where(self.last_b, _SEMICOLON, _COMMA)))[place]
        widths = self.work.widths[ids]
        ends = np.cumsum(widths + 1)
        starts = ends - widths - 1
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
        for at in range(self.work.digits.shape[1]):
            real = np.flatnonzero(widths > at) if at else slice(None)
            out[starts[real] + at] = self.work.digits[ids[real], at]
        out[ends - 1] = mark
        return out.tobytes(), np.concatenate(([0], ends))[self.off_a + self.off_b]

    def digests(self) -> list[str]:
        text, offsets = self.group_texts()
        view, bounds = memoryview(text), offsets.tolist()
        return [hashlib.sha256(view[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(bounds[:-1], bounds[1:])]


def bitmaps(keys: np.ndarray, links: np.ndarray, planes: int) -> tuple[np.ndarray, np.ndarray]:
    """Word-aligned bitmaps: keys (pair, word of 64 documents), and a row of words for each: presence,
    then the planes. ``keys`` are (pair, document) keys in order, pairs in the upper 32 bits."""
    bit = np.uint64(1) << (keys & np.uint64(63))
    words = keys >> np.uint64(6)
    first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
    rows = np.zeros((planes + 1, len(first)), np.uint64)
    rows[0] = np.bitwise_or.reduceat(bit, first)
    for j in range(planes):
        held = np.where((links >> j) & 1 > 0, bit, np.uint64(0))
        rows[j + 1] = np.bitwise_or.reduceat(held, first)
    return words[first], rows


class Chunk:
    """Bitmaps of the pairs of some consecutive documents of a worker."""

    def __init__(self):
        self.documents = self.entries = 0
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.facts: list[tuple] = []

    def add(self, ids: list, aligned: Aligned) -> None:
        keys, links = aligned.postings()
        if len(keys):
            document = (keys >> np.uint64(32)) + np.uint64(self.documents)
            keys = (keys & np.uint64(0xFFFFFFFF)) << np.uint64(32) | document
            order = np.argsort(keys)
            self.parts.append(bitmaps(keys[order], links[order], int(links.max()).bit_length()))
        self.facts += zip(ids, *(c.tolist() for c in aligned.counts()), aligned.digests())
        self.documents += len(ids)
        self.entries += len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        """All parts OR-ed into one."""
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros((1, 0), np.uint64)
        deep = max(rows.shape[0] for _, rows in self.parts)
        words = np.concatenate([w for w, _ in self.parts])
        order = np.argsort(words, kind="stable")
        words = words[order]
        first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        out = np.zeros((deep, len(first)), np.uint64)
        for j in range(deep):
            plane = np.concatenate([r[j] if j < len(r) else np.zeros(r.shape[1], np.uint64) for _, r in self.parts])
            out[j] = np.bitwise_or.reduceat(plane[order], first)
        return words[first], out


def _pack(words: np.ndarray, rows: np.ndarray) -> bytes:
    """Differences of the keys and the used words of every plane, compressed."""
    steps = np.diff(words, prepend=np.uint64(0)).astype("<u8")
    parts = [np.array([len(words), len(rows)], "<u8").tobytes(), _by_byte(steps)]
    for row in rows:
        used = row != 0
        parts += [np.packbits(used).tobytes(), np.array([used.sum()], "<u8").tobytes(), _by_byte(row[used].astype("<u8"))]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _by_byte(values: np.ndarray) -> bytes:
    """First bytes of all values, then second ones and so on: mostly zeros stand together."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, deep = (int(x) for x in data[:16].view("<u8"))
    at = 16

    def values(count: int) -> np.ndarray:
        nonlocal at
        part = data[at : at + 8 * count].reshape(8, count).T.copy().view("<u8").ravel().astype(np.uint64)
        at += 8 * count
        return part

    words = np.cumsum(values(n), dtype=np.uint64)
    rows = np.zeros((deep, n), np.uint64)
    for j in range(deep):
        width = (n + 7) // 8
        used = np.unpackbits(data[at : at + width], count=n).astype(bool)
        at += width
        count = int(data[at : at + 8].copy().view("<u8")[0])
        at += 8
        rows[j, used] = values(count)
    return words, rows


def popcounts(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, where their words begin, their documents and their links."""
    pairs = words >> np.uint64(26)  # a document has 32 bits, 6 of them within a word
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1]))) if len(pairs) else np.zeros(0, np.int64)
    if not len(first):
        none = np.zeros(0, np.int64)
        return none, first, none, none
    documents = np.add.reduceat(np.bitwise_count(rows[0]).astype(np.int64), first)
    links = np.zeros(len(words), np.int64)
    for j in range(1, len(rows)):
        links += np.bitwise_count(rows[j]).astype(np.int64) << (j - 1)
    return pairs[first].astype(np.int64), first, documents, np.add.reduceat(links, first)


_SLICE = 1 << 15  # words whose bits are laid open together


def scores(blob: bytes, documents: int, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n_best and count_sum of every document of a chunk, from its postings and the pairs' counts."""
    n_best, count_sum = np.zeros(documents, np.int64), np.zeros(documents, np.int64)
    words, rows = _unpack(blob)
    if not len(words):
        return n_best, count_sum
    order = np.argsort(pairs)
    place = order[np.searchsorted(pairs, (words >> np.uint64(26)).astype(np.int64), sorter=order)]
    count, good = counts[place], best[place].astype(np.int64)
    start = ((words & np.uint64((1 << 26) - 1)) << np.uint64(6)).astype(np.int64)
    for j in range(1, len(rows)):
        used = np.flatnonzero(rows[j])
        for at in range(0, len(used), _SLICE):
            some = used[at : at + _SLICE]
            bits = np.unpackbits(rows[j][some].astype("<u8").view(np.uint8), bitorder="little")
            on = np.flatnonzero(bits)
            word = some[on >> 6]
            document = start[word] + (on & 63)
            np.add.at(count_sum, document, count[word] << (j - 1))
            np.add.at(n_best, document, good[word] << (j - 1))
    return n_best, count_sum


_FACTS = ("n_a", "n_b", "n_groups", "n_links")


def index(docs: DataFrame, path_a: str, path_b: str, settings: Settings = Settings()) -> DataFrame:
    """Staged: one row per chunk with its documents' facts, its bitmaps, and counts per pair."""
    narrow = docs.select("doc_id", "text")
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Aligner(encoder(path_a), piece_encoder(path_b))
        part, number = TaskContext.get().partitionId(), 0
        chunk = Chunk()

        def closed() -> pa.RecordBatch:
            words, rows = chunk.merged()
            pairs, _, documents, links = popcounts(words, rows)
            ids, *facts, digests = zip(*chunk.facts)
            lists = [pa.array([list(ids)], pa.list_(id_kind))]
            lists += [pa.array([list(f)], pa.list_(pa.int64())) for f in facts]
            lists += [pa.array([list(digests)], pa.list_(pa.string()))]
            counts = [pa.ListArray.from_arrays([0, len(c)], pa.array(c, pa.int64())) for c in (pairs, documents, links)]
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number], pa.int64()), *lists, *counts, pa.array([_pack(words, rows)], pa.binary())],
                ["chunk", "doc_ids", *_FACTS, "digests", "pairs", "documents", "links", "bitmaps"],
            )

        for batch in batches:
            id_kind = batch.schema.field(0).type
            for block in blocks(batch, 1, settings.block):
                if chunk.documents + len(block) > settings.documents and chunk.documents:
                    yield closed()
                    chunk, number = Chunk(), number + 1
                chunk.add(block.column(0).to_pylist(), work.block(block.column(1)))
                if chunk.entries >= settings.postings or chunk.documents >= settings.documents:
                    yield closed()
                    chunk, number = Chunk(), number + 1
        if chunk.documents:
            yield closed()

    def longs(*names: str) -> str:
        return ", ".join(f"{name} array<bigint>" for name in names)

    schema = f"chunk bigint, doc_ids array<{id_type}>, {longs(*_FACTS)}, digests array<string>, "
    return staged(narrow.mapInArrow(run, schema + longs("pairs", "documents", "links") + ", bitmaps binary"))


def _pairs(chunks: DataFrame) -> DataFrame:
    """(pair, documents, links, best) over all chunks; every pair of an A id is in one window."""
    cells = chunks.select(F.explode(F.arrays_zip("pairs", "documents", "links")).alias("c"))
    sums = cells.groupBy(F.col("c.pairs").alias("pair")).agg(
        F.sum("c.documents").alias("documents"), F.sum("c.links").alias("links")
    )
    most = F.max("documents").over(Window.partitionBy(F.shiftright("pair", 16)))
    return sums.withColumn("best", F.col("documents") == most)


def pair_table(chunks: DataFrame) -> DataFrame:
    """One row per pair of linked ids: a, b, documents, links, best (commonest of its A id)."""
    pair = F.col("pair")
    return _pairs(chunks).select(
        F.shiftright(pair, 16).cast("int").alias("a"),
        pair.bitwiseAND(F.lit(0xFFFF)).cast("int").alias("b"),
        "documents",
        "links",
        "best",
    )


def align(docs: DataFrame, path_a: str, path_b: str, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    return of_documents(index(docs, path_a, path_b, settings))


def of_documents(chunks: DataFrame) -> DataFrame:
    """The rows of ``align`` from an index."""
    counts = staged(_pairs(chunks).select("pair", "documents", "best"))
    asked = chunks.select("chunk", F.explode("pairs").alias("pair"))
    told = asked.join(counts, "pair").groupBy("chunk").agg(
        F.collect_list(F.struct("pair", "documents", "best")).alias("told")
    )
    held = chunks.drop("pairs", "documents", "links").join(told, "chunk", "left")
    id_type = chunks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                facts = [row.column(n).flatten() for n in ("doc_ids", *_FACTS)]
                told = row.column("told").flatten()
                pairs, counts, best = (told.field(n).to_numpy(zero_copy_only=False) for n in ("pair", "documents", "best"))
                n_best, count_sum = scores(row.column("bitmaps")[0].as_py(), len(facts[0]), pairs, counts, best)
                yield pa.RecordBatch.from_arrays(
                    [*facts, pa.array(n_best), pa.array(count_sum), row.column("digests").flatten().cast(pa.string())],
                    ["doc_id", *_FACTS, "n_best", "count_sum", "groups_sha256"],
                )

    figures = ", ".join(f"{n} bigint" for n in (*_FACTS, "n_best", "count_sum"))
    return held.mapInArrow(run, f"doc_id {id_type}, {figures}, groups_sha256 string")

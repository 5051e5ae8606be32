"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian pruning, exact links.

A document's set holds its distinct shingles of ``words`` words (A-Z lower-cased); with fewer words
the whole sequence is its one shingle. Documents with equal sets are one node. Nodes are linked when
the Jaccard similarity of their sets reaches ``percent``; components of links are the groups.

Every node has ``bands * rows`` MinHash values. Nodes that share a band are candidates; at 80 % a pair
shares none of 64 bands of 8 with probability 8e-6. Candidates are compared in batches of signature
bytes; after each batch a pair goes when the posterior probability (uniform prior, one byte equal by
chance in 256) that it reaches the similarity is under ``miss``. Survivors are checked on full sets.

A bucket is never turned into all its pairs. First each member is held against the smallest node of its
bucket. Only buckets that then still hold several components go on, and there only members of
different components are compared, in blocks of ``block`` members that stay inside a task: once for
the most similar pair of each two components, then for all pairs that are left.

Defined results: a null or empty text, or one without words, has no shingles and is a component of its
own. component_id is the smallest doc_id of the component; null ids are passed over, and where all are
null it is null and every row is kept. Repeated rows share their flag; ``survivors`` returns one.
Only doc_id and text are read. Nodes are 64-bit digests of sets, shingles 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.components import components
from roadlens.llm.hashing import LOWER, blocks, hash_runs, mixed, text_bytes, words
from roadlens.llm.survivors import text_key, without_rejected
from roadlens.operators.lineage import staged

_GOLD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    words: int = 4
    percent: int = 80
    bands: int = 64
    rows: int = 8
    batch: int = 64
    miss: float = 1e-4
    block: int = 512
    # Up to so many ids are broadcast to pick candidate texts; beyond, the join is shuffled.
    few_ids: int = 500_000


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    data, offsets = text_bytes(column)
    starts, ends, bounds = words(data, offsets)
    hashes = hash_runs(LOWER[data], starts, ends)
    folded = hashes.copy()
    for j in range(1, min(k, len(hashes))):  # a block may hold fewer words than a shingle
        folded[: len(hashes) - j] = mixed(folded[: len(hashes) - j] * _GOLD ^ hashes[j:])
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            sets.append(np.unique(folded[a : b - k + 1]))
        elif b > a:
            whole = xxhash.xxh3_64_intdigest(hashes[a:b].tobytes(), seed=b - a)
            sets.append(np.array([whole], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


class Hasher:
    def __init__(self, n: int):
        seeds = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * _GOLD)
        self.xor = (seeds[:n] >> np.uint64(32)).astype(np.uint32)[:, None]
        self.odd = ((seeds[n:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """Smallest value of every hash function; long sets piece by piece."""
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.xor), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(short), 1_024):
            values = short[at : at + 1_024] ^ self.xor
            values *= self.odd
            np.minimum(least, values.min(axis=1), out=least)
        return least


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit bucket per band; the band's number is part of it."""
    n, size = signatures.shape
    pieces = signatures.reshape(n, bands, size // bands).astype(np.uint64)
    keys = np.broadcast_to(mixed(np.arange(bands, dtype=np.uint64) + _GOLD), (n, bands)).copy()
    for j in range(pieces.shape[2]):
        keys = mixed(keys * _GOLD ^ pieces[:, :, j])
    return keys.view(np.int64)


def needed_matches(settings: Settings) -> list[tuple[int, int]]:
    """(bytes compared, fewest equal bytes with which a pair goes on)."""
    t = settings.percent / 100
    p = t + (1 - t) / 256
    out, total = [], settings.bands * settings.rows
    for n in range(settings.batch, total + 1, settings.batch):
        # Posterior of the match rate is Beta(m + 1, n - m + 1); its tail above p is the
        # probability of at most m successes in n + 1 trials at p.
        tail, least = 0.0, 0
        for m in range(n + 1):
            tail += comb(n + 1, m) * p**m * (1 - p) ** (n + 1 - m)
            if tail >= settings.miss:
                least = m
                break
        out.append((n, least))
    return out


def compared(left: np.ndarray, right: np.ndarray, needed: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows that survive every look, and their equal bytes."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int64)
    done = 0
    for n, least in needed:
        equal[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
        alive = alive[equal[alive] >= least]
        done = n
    return alive, equal[alive]


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """Staged: doc_id, text_key, node, n_shingles, keys, sig."""
    narrow = docs.select("doc_id", text_key().alias("text_key"), "text")
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(settings.bands * settings.rows)
        for batch in batches:
            for block in blocks(batch, 2, 1 << 20):
                sets = shingle_sets(block.column(2), settings.words)
                sizes = np.array([len(s) for s in sets])
                whole = np.stack([hasher.signature(s) for s in sets])
                keys = band_keys(whole, settings.bands)
                real = sizes > 0
                nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64)
                ends = np.concatenate(([0], np.cumsum(np.where(real, settings.bands, 0))))
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column(0),
                        block.column(1),
                        pa.array(nodes.view(np.int64), pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[real].ravel(), pa.int64())),
                        pa.array([s.tobytes() for s in whole.astype(np.uint8)], pa.binary()),
                    ],
                    ["doc_id", "text_key", "node", "n_shingles", "keys", "sig"],
                )

    schema = f"doc_id {id_type}, text_key bigint, node bigint, n_shingles bigint, keys array<bigint>, sig binary"
    return staged(narrow.mapInArrow(run, schema))


def _shared(table: DataFrame) -> DataFrame:
    """Staged (key, node, leader): members of buckets with at least two nodes."""
    members = table.select("node", F.explode("keys").alias("key"))
    least = members.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
    least = least.where(F.col("leader") != F.col("last")).drop("last")
    return staged(members.join(least, "key").distinct())


def _candidates(docs: DataFrame, table: DataFrame, shared: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Staged (node, n, sig, keys) and (node, set) of the nodes in ``shared``."""
    nodes = staged(shared.select("node").distinct())
    few = nodes.count() <= settings.few_ids
    own = table.join(F.broadcast(nodes) if few else nodes, "node", "left_semi")
    one = own.groupBy("node").agg(
        F.min(F.struct("text_key", "doc_id")).alias("one"),
        F.first("n_shingles").alias("n"),
        F.first("sig").alias("sig"),
        F.first("keys").alias("keys"),
    )
    one = staged(one)
    which = one.select(F.col("one.text_key").alias("text_key"), F.col("one.doc_id").alias("which"))
    if few:
        which = F.broadcast(which)  # at most few_ids rows of two numbers
    texts = docs.select("doc_id", text_key().alias("text_key"), "text").join(which, "text_key")
    texts = texts.where(F.col("doc_id").eqNullSafe(F.col("which"))).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, 0, 1 << 20):
                sets = shingle_sets(block.column(0), settings.words)
                nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes.view(np.int64)), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["node", "set"],
                )

    sets = texts.mapInArrow(run, "node bigint, set binary").dropDuplicates(["node"])
    return one.select("node", "n", "sig", "keys"), staged(sets)


def _with_both(pairs: DataFrame, table: DataFrame, *names: str) -> DataFrame:
    """Columns of the table for a (name_a) and b (name_b)."""
    for side in ("a", "b"):
        renamed = table.select(F.col("node").alias(side), *[F.col(n).alias(f"{n}_{side}") for n in names])
        pairs = pairs.join(renamed, side)
    return pairs


def pruned(pairs: DataFrame, sigs: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) whose signatures leave the similarity possible."""
    needed, width = needed_matches(settings), settings.bands * settings.rows
    few, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    sized = _with_both(pairs, sigs, "n", "sig").where(100 * few >= settings.percent * most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive, _ = compared(_bytes(batch.column(2), width), _bytes(batch.column(3), width), needed)
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links: pairs (a, b) whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= settings.percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _with_both(pairs, sets, "set").select("a", "b", "set_a", "set_b").mapInArrow(run, "a bigint, b bigint")


def _across(shared: DataFrame, roots: DataFrame, sigs: DataFrame, settings: Settings, best_only: bool) -> DataFrame:
    """Pairs of nodes in one bucket but different components that signatures leave possible."""
    labelled = shared.join(roots, "node", "left").select(
        "key", "node", F.coalesce("root", "node").alias("root")
    )
    open_ = labelled.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("members")
    )
    open_ = open_.where(F.col("low") != F.col("high")).select("key", "members")
    rows = labelled.join(open_, "key").join(sigs, "node")
    parts = F.ceil(F.col("members") / settings.block).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.withColumns({"parts": parts, "own": own}).withColumn("other", other)
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    needed = needed_matches(settings)
    names = ["key", "i", "j", "own", "node", "root", "n", "sig", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows of a group may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            line = [held.column(c).to_numpy() for c in names[:3]]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in line], axis=0)) + 1
            if len(new):
                yield _compare(held.slice(0, new[-1]), np.concatenate(([0], new)), needed, settings, best_only)
                held = held.slice(new[-1])
        if held is not None and len(held):
            yield _compare(held, np.array([0, len(held)]), needed, settings, best_only)

    # Groups hold at most about twice `block` rows, so any number of them fits a partition.
    dealt = rows.select(*names).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def _compare(
    table: pa.Table, bounds: np.ndarray, needed: list[tuple[int, int]], settings: Settings, best_only: bool
) -> pa.RecordBatch:
    """Possible pairs across components within each group of rows, each in its first common bucket only.

    ``i`` and ``j`` name the two blocks of a group; members of one block meet only in the group
    where both are that block. The members of the largest component are only ever partners.
    """
    width, percent = settings.bands * settings.rows, settings.percent
    column = {c: table.column(c).to_numpy() for c in ("i", "j", "own", "node", "root", "n")}
    sigs = _bytes(table.column("sig"), width)
    keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, settings.bands)
    bucket = table.column("key").to_numpy()
    found_a, found_b = [], []
    first = needed[0][0]
    for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        part = slice(start, stop)
        node, root, own, size = (column[c][part] for c in ("node", "root", "own", "n"))
        sig, key, same = sigs[part], keys[part], column["i"][start] == column["j"][start]
        values, counts = np.unique(root, return_counts=True)
        if len(values) == 1:
            continue
        main = root == values[counts.argmax()]
        xs, ys, equals = [], [], []
        for x in np.flatnonzero(~main).tolist():
            # Of two members outside the main component the first one meets the second.
            rest = main.copy()
            rest[x + 1 :] = True
            rest &= root != root[x]
            if not same:
                rest &= own != own[x]
            y = np.flatnonzero(rest)
            y = y[100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x])]
            y = y[(sig[y, :first] == sig[x, :first]).sum(axis=1) >= needed[0][1]]
            if not len(y):
                continue
            alive, equal = compared(np.broadcast_to(sig[x], (len(y), width)), sig[y], needed)
            y = y[alive]
            here = key[x][(key[y] == key[x]).argmax(axis=1)] == bucket[start]
            if here.any():
                xs.append(np.full(here.sum(), x))
                ys.append(y[here])
                equals.append(equal[here])
        if not xs:
            continue
        x, y, equal = map(np.concatenate, (xs, ys, equals))
        if best_only:
            order = np.argsort(-equal, kind="stable")
            x, y = x[order], y[order]
            ends = np.sort(np.stack((root[x], root[y])), axis=0)
            _, best = np.unique(ends, axis=1, return_index=True)
            x, y = x[best], y[best]
        found_a.append(np.minimum(node[x], node[y]))
        found_b.append(np.maximum(node[x], node[y]))
    none = [np.zeros(0, np.int64)]
    pair = [np.concatenate(none + f) for f in (found_a, found_b)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in pair], ["a", "b"])


def groups(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """The staged signature table, and (node, root) of all linked nodes."""
    table = signatures(docs, settings)
    shared = _shared(table)
    sigs, sets = _candidates(docs, table, shared, settings)
    stars = shared.where(F.col("node") != F.col("leader"))
    pairs = stars.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    tried = staged(pruned(pairs, sigs, settings))
    links = staged(verified(tried, sets, settings))
    roots = components(links)
    members = shared.select("key", "node")
    for best_only in (True, False):
        new = _across(members, roots, sigs, settings, best_only).join(tried, ["a", "b"], "left_anti")
        new = staged(new)
        if new.isEmpty():  # the best pairs may all be tried ones; others of their components are not
            continue
        links = staged(links.unionByName(verified(new, sets, settings)))
        tried = tried.unionByName(new)
        roots = components(links)
    return table, roots


def decisions(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, component_id, kept."""
    table, roots = groups(docs, settings)
    narrow = table.select("doc_id", "text_key", "n_shingles", "node")
    placed = narrow.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    real = placed.where(F.col("n_shingles") > 0)
    # Written down, so that the join has an exchange of its own on both sides, which AQE can split.
    least = staged(real.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    alone = placed.where(F.col("n_shingles") == 0).withColumn("component_id", F.col("doc_id"))
    out = real.join(least, "root").unionByName(alone)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", "text_key", "n_shingles", "component_id", kept.alias("kept"))


def survivors(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return without_rejected(docs, decisions(docs, settings).select("doc_id", "text_key", "kept"))

"""Source divergence audit: how far the sources of a language differ in the terms they use.

Terms are runs of ASCII letters and characters beyond ASCII, with only A-Z lower-cased. Each worker runs
its texts through Arrow compute functions (``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode``,
hash ``group_by``) and hands out partial counts per (lang, source, term): occurrences, and documents with
the term. Spark adds them up. A language keeps the terms in at least ``least_documents`` of its documents;
each kept term with its counts by source is one row of a columnar table, dealt into shards by a hash of
the term. A shard is a matrix of terms and sources with about ``cells`` cells at most (one term at least), and
gives its part of every divergence.

With V kept terms of the language, N their occurrences in a group, and count those of one term, a group
gives the term ``1 + floor(scale * (count + prior) / (N + prior * V))``, exact in whole numbers. Part
``pair``: the sum of absolute differences of two sources over all kept terms. Part ``term``: the kept
terms that a source uses and prefers most over its whole language.

Defined results: null text, lang and source are ''. A group without terms, or of a language without kept
terms, still has its pairs (then with value 0). Repeated rows and null doc_ids count row by row. Ties go
by the UTF-8 order of the item. Only text, lang and source are read; an empty table gives no rows. Counts
up to 9e15 are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.hashing import blocks, text_bytes
from roadlens.llm.workers import bound_batches, give_back
from roadlens.operators.lineage import staged

NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Settings:
    least_documents: int = 30
    prior: int = 5
    scale: int = 1_000_000_000  # a power of 1,000
    top: int = 50  # ranks of part `term`
    cells: int = 1 << 22  # of the matrix of a shard at most, and a 32nd of it at least


_BLOCK = 1 << 20  # bytes of text counted at once
_HELD = 1 << 17  # partial counts a worker adds up before it hands them out
_PARTIAL = "lang string, source string, term string, n long, documents long"
_KEYS = ["lang", "source", "term"]


def _count(block: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents per (lang, source, term) of a block of lang, source, text."""
    # A fresh array: ascii_lower gives wrong offsets for a slice of a longer one.
    data, offsets = text_bytes(block.column(2))
    text = pa.LargeStringArray.from_buffers(len(block), pa.py_buffer(offsets), pa.py_buffer(data))
    lists = pc.split_pattern_regex(pc.ascii_lower(text), NO_TERM)
    rows = pc.list_parent_indices(lists)
    terms = pc.list_flatten(lists)
    real = pc.greater(pc.binary_length(terms), 0)  # texts may begin and end with no term
    rows, terms = rows.filter(real), terms.filter(real).dictionary_encode()
    per_text = pa.table({"row": rows, "code": terms.indices}).group_by(["row", "code"]).aggregate([([], "count_all")])
    row = per_text["row"].combine_chunks()
    lang, source = block.column(0).dictionary_encode(), block.column(1).dictionary_encode()
    counts = pa.table(
        {
            "lang": lang.indices.take(row),
            "source": source.indices.take(row),
            "code": per_text["code"],
            "n": per_text["count_all"],
        }
    )
    counts = counts.group_by(["lang", "source", "code"]).aggregate([("n", "sum"), ([], "count_all")]).combine_chunks()

    def named(values: pa.DictionaryArray, codes: pa.ChunkedArray) -> pa.Array:
        return values.dictionary.cast(pa.large_string()).take(codes)

    return pa.table(
        [named(lang, counts["lang"]), named(source, counts["source"]), named(terms, counts["code"]), counts["n_sum"], counts["count_all"]],
        names=[*_KEYS, "n", "documents"],
    )


def _added(parts: list[pa.Table]) -> pa.Table:
    if len(parts) == 1:
        return parts[0]
    sums = pa.concat_tables(parts).group_by(_KEYS).aggregate([("n", "sum"), ("documents", "sum")])
    return sums.select([*_KEYS, "n_sum", "documents_sum"]).rename_columns([*_KEYS, "n", "documents"])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("documents", pa.int64())])
    parts: list[pa.Table] = []
    held = settled = 0
    for batch in batches:
        for block in blocks(batch, 2, _BLOCK):
            parts.append(_count(block))
            held += parts[-1].num_rows
            if held < 2 * settled + (_HELD >> 2):
                continue
            parts = [_added(parts)]
            held = settled = parts[0].num_rows
            if held > _HELD:
                yield from parts[0].cast(schema).to_batches(max_chunksize=1 << 16)
                parts, held, settled = [], 0, 0
    if parts:
        yield from _added(parts).cast(schema).to_batches(max_chunksize=1 << 16)
    give_back()


def term_counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, term, n, documents) over all documents."""
    bound_batches(docs.sparkSession)
    narrow = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = narrow.mapInArrow(_partial_counts, _PARTIAL)
    return partial.groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def _shares(count: np.ndarray, total: np.ndarray, kept: int, settings: Settings) -> np.ndarray:
    """1 + floor(scale * (count + prior) / (total + prior * kept)), three digits at a time."""
    below = total + settings.prior * kept
    left = count + settings.prior
    out = np.zeros(np.broadcast(left, below).shape, np.int64)
    digits = settings.scale
    while digits > 1:
        left = left * 1_000
        out = out * 1_000 + left // below
        left = left % below
        digits //= 1_000
    return out + 1


def _shard(table: pa.Table, settings: Settings, row_type: pa.Schema) -> pa.Table:
    """Divergences of one shard of a language.

    Rows with a null term tell the totals of each source, those with a null source too the language's;
    the others are terms with the sources that use them.
    """
    lang = table["lang"][0].as_py()
    named = table["term"].is_null()
    totals = table.filter(named)
    whole = totals.filter(totals["source"].is_null())
    total, kept = whole["total"][0].as_py(), whole["kept"][0].as_py()
    totals = totals.filter(totals["source"].is_valid()).sort_by("source")
    sources = totals["source"].to_pylist()
    place = {s: i for i, s in enumerate(sources)}
    sizes = totals["total"].to_numpy()
    rest = table.filter(pc.invert(named))
    terms = rest["term"].combine_chunks()
    cells = rest["cells"].combine_chunks()
    flat = pc.list_flatten(cells)
    counts = np.zeros((len(sources), len(terms)), np.int64)
    if len(terms):
        at = np.fromiter((place[s] for s in flat.field("source").to_pylist()), np.int64, len(flat))
        counts[at, pc.list_parent_indices(cells).to_numpy()] = flat.field("n").to_numpy()
    p = _shares(counts, sizes[:, None], kept, settings) if kept else counts
    q = _shares(counts.sum(axis=0), np.int64(total), kept, settings) if kept else counts.sum(axis=0)
    source_out, part_out, item_out, value_out = [], [], [], []
    for i, source in enumerate(sources):
        apart = np.abs(p - p[i]).sum(axis=1)
        others = [j for j in range(len(sources)) if j != i]
        source_out += [source] * len(others)
        part_out += ["pair"] * len(others)
        item_out += [sources[j] for j in others]
        value_out += apart[others].tolist()
        liked = np.flatnonzero((counts[i] > 0) & (p[i] > q))
        if len(liked) > settings.top:  # every one that may be among the first of the whole language
            gain = p[i][liked] - q[liked]
            liked = liked[gain >= np.partition(gain, len(gain) - settings.top)[len(gain) - settings.top]]
        source_out += [source] * len(liked)
        part_out += ["term"] * len(liked)
        item_out += terms.take(pa.array(liked)).to_pylist()
        value_out += (p[i][liked] - q[liked]).tolist()
    columns = [[lang] * len(source_out), source_out, part_out, item_out, value_out]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, row_type)], schema=row_type)


def divergences(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows (lang, source, part, item, value, rank); see the module's text."""
    used = term_counts(docs).groupBy("lang", "term").agg(
        F.sum("documents").alias("documents"), F.collect_list(F.struct("source", "n")).alias("cells")
    )
    kept = staged(used.where(F.col("documents") >= settings.least_documents).select("lang", "term", "cells"))
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sizes = kept.select("lang", F.explode("cells").alias("c")).groupBy("lang", F.col("c.source").alias("source"))
    sizes = groups.join(sizes.agg(F.sum("c.n").alias("total")), ["lang", "source"], "left")
    sizes = staged(sizes.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    langs = sizes.groupBy("lang").agg(F.sum("total").alias("total"), F.count(F.lit(1)).alias("sources"))
    count = F.coalesce("kept", F.lit(0))
    langs = langs.join(terms, "lang", "left").select("lang", "total", "sources", count.alias("kept"))
    # A shard gives a row per pair of sources, so it should not have fewer cells than that.
    cells = F.least(F.lit(settings.cells), F.greatest(F.lit(settings.cells / 32), 4 * F.col("sources") * F.col("sources")))
    shards = F.greatest(F.lit(1), F.ceil(F.col("kept") * F.col("sources") / cells))
    langs = staged(langs.withColumn("shards", shards))

    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard")
    no_term, no_cells = F.lit(None).cast("string").alias("term"), F.lit(None).cast(kept.schema["cells"].dataType).alias("cells")
    zero = F.lit(0).cast("long")
    of_lang = langs.select("lang", every, no_term, no_cells, F.lit(None).cast("string").alias("source"), "total", "kept")
    of_source = sizes.join(langs.select("lang", "shards"), "lang").select(
        "lang", every, no_term, no_cells, "source", "total", zero.alias("kept")
    )
    # Terms of a hot language are spread over its shards only behind this join; a row is small.
    of_term = kept.join(langs.select("lang", "shards"), "lang").select(
        "lang",
        F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard"),
        "term",
        "cells",
        F.lit(None).cast("string").alias("source"),
        zero.alias("total"),
        zero.alias("kept"),
    )
    row_type = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        return _shard(table, settings, row_type)

    parts = of_term.unionByName(of_source).unionByName(of_lang).groupBy("lang", "shard")
    parts = parts.applyInArrow(run, "lang string, source string, part string, item string, value long")
    parts = staged(parts)
    line = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(line)
    pairs = parts.where(F.col("part") == "pair").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    first = parts.where(F.col("part") == "term").withColumn("rank", rank).where(F.col("rank") <= settings.top)
    return pairs.withColumn("rank", rank).unionByName(first).select("lang", "source", "part", "item", "value", "rank")

"""Token ids, files, packing and attribution against the tokenizers library itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from edges import edge_docs, edge_rows, no_docs
from pyspark.sql import functions as F

from roadlens.llm import attribution, packing, token_files
from roadlens.llm.tokens import Encoder, public_file
from roadlens.operators.lineage import new_folder

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"


def library_ids(name, texts):
    encoder = Encoder(public_file(name))
    done = encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids for e in done]


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_pieces_give_the_ids_of_whole_texts(name):
    rng = random.Random(5)
    chars = list("abzAZ's 'tll  \n\n\t.,!-09é×ßÉ \x1c\x85 　中\U0001F600<|>") + ["it's ", "≠", "Σ", "İ", "́", "the ", "<|endoftext|>"]
    texts = ["".join(rng.choices(chars, k=rng.randrange(30))) for _ in range(4000)] + [None, ""]
    encoder = Encoder(public_file(name))
    assert encoder.kind != "whole"
    for _ in range(2):  # new pieces, then known ones
        ids, offsets = encoder.encode(pa.array(texts))
        got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
        assert got == library_ids(name, texts)


def test_levels_round_trip_and_random_access():
    rng = np.random.default_rng(2)
    for ids in (np.zeros(0, np.uint32), rng.integers(0, 1 << 17, 5000).astype(np.uint32), np.full(3, 1023, np.uint32)):
        levels = token_files.encode_levels(ids)
        assert (token_files.read_range(levels, 0, len(ids)) == ids).all()
        for _ in range(50 if len(ids) else 0):
            a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
            assert (token_files.read_range(levels, a, b) == ids[a:b]).all()
    with pytest.raises(ValueError):
        token_files.encode_levels(np.array([1 << 16], np.uint32), (10, 6))


def check_files(spark, docs, rows):
    path = new_folder(spark, "test-tokens")
    token_files.write(docs, public_file(WORD), 1, path)
    got = sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r.start)
    want = defaultdict(list)
    for (doc_id, _), ids in zip(rows, library_ids(WORD, [t for _, t in rows])):
        data = np.array([*ids, 1], "<u4").tobytes()
        want[doc_id].append((len(ids) + 1, zlib.crc32(data)))
    start = 0
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order) and len(got) == len(rows)
    for row in got:
        assert row.start == start
        want[row.doc_id].remove((row.n_tokens, row.ids_crc32))
        start += row.n_tokens


def test_files(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    check_files(spark, documents.repartition(5), rows)
    check_files(spark, edge_docs(spark), [r[:2] for r in edge_rows()])
    path = new_folder(spark, "test-tokens")
    token_files.write(no_docs(spark), public_file(WORD), 1, path)
    assert token_files.read_documents(spark, path).collect() == []


def check_pieces(pieces, rows, capacity, waste):
    want = sorted((np.array([*ids, 1], "<u4").tobytes() for ids in library_ids(BYTE, [t for _, t in rows])))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length * 4 == len(p.ids) and p.length > 0
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    # Pieces of rows with one id are told apart by following their starts.
    texts = []
    for own in by_doc.values():
        own = sorted(own, key=lambda p: (p.start, p.ids))
        while own:
            data, at = b"", 0
            while at < own[0].doc_tokens or not data:
                found = next(p for p in own if p.start == at)
                own.remove(found)
                data += found.ids
                at += found.length
                if not own or at >= found.doc_tokens:
                    break
            texts.append(data)
    assert sorted(texts) == want
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    assert len(by_sequence) * capacity <= sum(p.length for p in pieces) * (1 + waste) + capacity


def test_packing(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    for parts in (1, 7):
        pieces = packing.pack(documents.repartition(parts), public_file(BYTE), 1).collect()
        check_pieces(pieces, rows, 2048, 1 / 200)


def test_packing_edges(spark):
    distinct = edge_docs(spark).where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    rows = [(r.doc_id, r.text) for r in distinct.collect()]
    check_pieces(packing.pack(distinct, public_file(BYTE), 1, 64).collect(), rows, 64, 1 / 50)
    every = packing.pack(edge_docs(spark), public_file(BYTE), 1).collect()
    ids = library_ids(BYTE, [r[1] for r in edge_rows()])
    assert sum(p.length for p in every) == sum(map(len, ids)) + len(ids)
    assert packing.pack(no_docs(spark), public_file(BYTE), 1).collect() == []


def test_cuts_are_classes():
    counts = packing.class_counts(2048)
    assert counts[:16] == list(range(1, 17)) and counts[-1] == 2048
    for n in range(1, 5000):
        parts = list(packing.cuts(n, 2048, counts, 1 / 256))
        assert sum(length for length, _ in parts) == n
        assert all((1 - 1 / 256) * 2048 - k < length * k <= 2048 for length, k in parts)
        assert len(parts) <= n // 2048 + 6


def plain_counts(text, spans, rule):
    """Tokens per line by the offsets the library gives, for ASCII text."""
    lines, at = [], 0
    for line in text.split("\n"):
        lines.append((at, at + len(line) + 1))
        at += len(line) + 1
    counts = [0.0] * len(lines)
    for a, b in spans:
        parts = [max(0, min(b, y) - max(a, x)) for x, y in lines]
        hit = [i for i, p in enumerate(parts) if p]
        if rule == "split":
            for i in hit:
                counts[i] += parts[i] / (b - a)
        else:
            counts[{"first": hit[0], "last": hit[-1], "most": int(np.argmax(parts))}[rule]] += 1
    return counts


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution(spark, rule):
    rng = random.Random(4)
    texts = ["".join(rng.choices(["ab", " the", "\n", "\n\n\n", ".", "\n \n", "1"], k=40)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = defaultdict(dict)
    for r in attribution.of_sections(docs, public_file(BYTE), rule=rule).collect():
        got[r.doc_id][r.section] = r.n_tokens
    done = Encoder(public_file(BYTE)).tokenizer.encode_batch(texts, add_special_tokens=False)
    for i, (text, encoding) in enumerate(zip(texts, done)):
        want = plain_counts(text, encoding.offsets, rule)
        assert [got[i][k] for k in range(len(want))] == pytest.approx(want)


def test_attribution_edges(spark):
    docs = edge_docs(spark)
    rows = attribution.of_sections(docs, public_file(BYTE)).collect()
    ids = library_ids(BYTE, [r[1] for r in edge_rows()])
    assert sum(r.n_tokens for r in rows) == sum(map(len, ids))
    assert [r.n_tokens for r in rows if r.doc_id == 4] == [0] and not [r for r in rows if r.doc_id == 3]
    assert attribution.of_sections(no_docs(spark), public_file(BYTE)).collect() == []
    # A tokenizer whose ids are no runs of bytes: spans in characters, from the library.
    words = attribution.of_sections(docs, public_file(WORD)).collect()
    assert sum(r.n_tokens for r in words) == sum(map(len, library_ids(WORD, [r[1] for r in edge_rows()])))
    fields = attribution.of_fields(docs, "doc_id", ["text", "lang", "source"], public_file(BYTE)).collect()
    assert len(fields) == 3 * docs.count()
    with pytest.raises(ValueError):
        attribution.of_sections(docs, public_file(BYTE), rule="nearest")

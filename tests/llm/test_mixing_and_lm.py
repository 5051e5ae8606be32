"""Mixing, language-model scores and the pipeline against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from edges import edge_docs, no_docs
from pyspark.sql import functions as F

from roadlens.llm import lm, mixing, neardup, toxicity

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FOLDER = "/root/testdata/sf0.001"


def sources(spark, sizes):
    rows, i = [], 0
    for name, n in sizes.items():
        for _ in range(n):
            rows.append((i, "w " * (1 + i % 7), name))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mixing_meets_the_entropy(spark):
    docs = sources(spark, {"big": 900, "mid": 300, "small": 100, None: 60})
    settings = mixing.Settings(entropy_share=0.9, most_passes=None)
    rows = mixing.mix(docs, settings).collect()
    assert len(rows) == docs.count()
    weights = {r.source: r.weight for r in rows}
    entropy = -sum(w * math.log(w) for w in weights.values())
    assert entropy == pytest.approx(0.9 * math.log(4), abs=1e-5)
    tokens, taken, quota, block = Counter(), Counter(), {}, Counter()
    for r in rows:
        tokens[r.source] += r.n_tokens
        taken[r.source] += r.copies * r.n_tokens
        block[(r.source, r.block)] += r.n_tokens
        quota[r.source] = r.quota
    total = sum(tokens.values())
    exponent = rows[0].exponent
    powers = {s: (n / total) ** exponent for s, n in tokens.items()}
    for s in tokens:
        assert weights[s] == pytest.approx(powers[s] / sum(powers.values()))
        assert quota[s] - max(n for (o, _), n in block.items() if o == s) < taken[s] <= quota[s]


def test_mixing_keeps_to_the_limit(spark):
    docs = sources(spark, {"big": 900, "small": 30})
    rows = mixing.mix(docs, mixing.Settings(entropy_share=1.0, most_passes=3.0)).collect()
    tokens, quota = Counter(), {}
    for r in rows:
        tokens[r.source] += r.n_tokens
        quota[r.source] = r.quota
    assert quota["small"] / tokens["small"] == pytest.approx(3, abs=0.02)
    assert max(r.copies for r in rows) <= 3


def test_equal_sources_stay_as_they_are(spark, documents):
    out = mixing.realise(documents, mixing.Settings(entropy_share=None, most_passes=None))
    assert out.columns == documents.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in documents.collect())


def test_mixing_edges(spark):
    docs = edge_docs(spark)
    assert mixing.mix(docs).count() == docs.count()
    out = mixing.realise(docs)
    assert out.columns == docs.columns and out.count() > 0
    assert mixing.mix(no_docs(spark)).collect() == []
    assert mixing.realise(no_docs(spark)).collect() == []


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)) + ["\0"]


def test_lm_counts_match_brute_force(spark, documents):
    settings = lm.Settings(block_bytes=20_000, bucket_bytes=30_000)
    fixed = np.array([[0.0] + [0.5] * 23, [0.7] + [0.3] * 23, [0.3] + [0.2] * 23])
    learned, lm.learned_weights = lm.learned_weights, lambda *_: fixed
    try:
        rows = lm.score(documents.repartition(3), settings).collect()
    finally:
        lm.learned_weights = learned
    texts = {r.doc_id: tokens_of(r.text) for r in documents.collect()}
    fold = {k: zlib.crc32(str(k).encode()) % 7 for k in texts}
    one, two = Counter(), Counter()
    for k, words in texts.items():
        if fold[k] != 2:
            one.update(words)
            two.update(zip(["\0", *words], words))
    n, v = sum(one.values()), len(one)
    assert len(rows) == len(texts)
    for r in rows:
        words = texts[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (fold[r.doc_id] == 2, len(words), n)
        assert r.n_known == sum(one[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((one[w] + 1) / (n + v + 1)) for w in words))
        total = 0
        for a, w in zip(["\0", *words], words):
            weight = fixed[:, 0 if not one[a] else min(23, 1 + int(math.log2(one[a])))]
            parts = (two[(a, w)] / one[a] if one[a] else 0, one[w] / n, 1 / (v + 1))
            total += math.log10(sum(x * y for x, y in zip(weight, parts)))
        assert r.score == pytest.approx(total)


def test_lm_weights_raise_the_deleted_likelihood(spark, documents):
    """EM on quantised estimates comes close to EM on the exact ones."""
    settings = lm.Settings(block_bytes=50_000, bucket_bytes=100_000)
    table = lm.counted(documents, settings)
    texts = {r.doc_id: tokens_of(r.text) for r in documents.collect()}
    fold = {k: zlib.crc32(str(k).encode()) % 7 for k in texts}
    one, two = Counter(), Counter()
    for k, words in texts.items():
        if fold[k] not in (2, 3):
            one.update(words)
            two.update(zip(["\0", *words], words))
    n, v = sum(one.values()), len(one)
    estimates = lm.Estimates(n, v, settings)
    weights = lm.learned_weights(table.where(F.col("kind") == lm.TEXTS), estimates, settings)
    assert weights.sum(axis=0) == pytest.approx(np.ones(24))
    events = defaultdict(list)
    for k, words in texts.items():
        if fold[k] == 3:
            for a, w in zip(["\0", *words], words):
                bucket = 0 if not one[a] else min(23, 1 + int(math.log2(one[a])))
                events[bucket].append((two[(a, w)] / one[a] if one[a] else 0, one[w] / n, 1 / (v + 1)))
    for bucket, parts in events.items():
        parts = np.array(parts)
        best = np.array([0.4, 0.4, 0.2]) if bucket else np.array([0, 0.5, 0.5])
        for _ in range(100):
            share = parts * best
            best = (share / share.sum(axis=1, keepdims=True)).mean(axis=0)
        likelihood = np.log(parts @ weights[:, bucket]).mean()
        assert likelihood > np.log(parts @ best).mean() - 0.01


def test_lm_estimates_far_under_the_uniform_one_are_kept():
    for tokens, distinct in ((10**9, 10**5), (10**12, 10**8), (100, 90)):
        estimates = lm.Estimates(tokens, distinct, lm.Settings())
        exact = np.array([1, 2, 50, tokens]) / tokens
        assert estimates.value(estimates.steps(exact)) == pytest.approx(exact, rel=0.05)
    assert estimates.value(estimates.steps(np.zeros(1))) == [0]


def test_lm_edges(spark):
    docs = edge_docs(spark)
    rows = lm.score(docs).collect()
    assert len(rows) == docs.count()
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert lm.score(no_docs(spark)).collect() == []
    unseen = lm.score(docs.where("doc_id = 9")).collect()  # 9 may be a test row alone
    assert all(math.isfinite(r.score) for r in unseen)


def test_squeezed_numbers_come_back():
    for values in (np.zeros(0, np.uint32), np.arange(1000, dtype=np.uint32) ** 2, np.array([2**40], np.int64)):
        assert (lm.expand(lm.squeeze(values), values.dtype) == values).all()


def near_by_hand(rows, k=5, percent=80):
    """Smallest ids of the components over all pairs of sets of k-word shingles."""
    sets = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        grams = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())
        sets[doc_id] = grams
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [d for d in ids if find(d) == d]


def test_near_copies_of_the_pipeline_share_five_words(spark):
    """Three scattered edits in 120 words: linked on four words, not on five."""
    words = [f"w{i}" for i in range(120)]
    edited = [w if i not in (20, 60, 100) else w + "x" for i, w in enumerate(words)]
    twice = [w if i != 60 else w + "x" for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(twice)), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r.doc_id for r in corpus_pipeline.remove_near_copies(spark, docs, FOLDER).collect())
    assert kept == near_by_hand(rows)
    assert near_by_hand(rows[:2]) == [1, 2] and near_by_hand(rows[:2], 4) == [1]


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_edge_rows(spark, tmp_path, empty):
    docs = no_docs(spark) if empty else edge_docs(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(6, 0), (7, 0), (9, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, str(tmp_path)).cache()
        assert seen.columns == docs.columns
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(p.length for p in pieces if p.start == 0) <= sum(p.doc_tokens for p in pieces)
    assert {p.doc_id for p in pieces} == {r.doc_id for r in seen.collect()}
    assert bool(pieces) != empty


def test_pipeline(spark):
    """Every stage keeps whole rows, and what it drops is what its operator rejects."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.predict(docs, labels).collect() if r.predicted}
    seen = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, FOLDER).cache()
        assert seen.columns == docs.columns
        kept[name] = [r.doc_id for r in seen.collect()]
    assert set(kept["toxicity"]) == {r.doc_id for r in docs.collect()} - toxic
    rest = docs.where(F.col("doc_id").isin(kept["toxicity"]))
    groups = defaultdict(list)
    for r in rest.collect():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append((-len(r.text or ""), r.doc_id))
    assert sorted(kept["exact_dedup"]) == sorted(min(g)[1] for g in groups.values())
    rest = docs.where(F.col("doc_id").isin(kept["exact_dedup"]))
    assert sorted(kept["near_dedup"]) == near_by_hand([(r.doc_id, r.text) for r in rest.collect()])
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    assert {p.doc_id for p in pieces} == set(kept["mixing"])
    assert corpus_pipeline.ORACLE_SQL is None

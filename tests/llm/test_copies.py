"""Exact and near deduplication against brute force."""

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from edges import edge_docs, edge_rows, no_docs

from roadlens.llm import exact, neardup
from roadlens.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        text = text or ""
        groups[re.sub(r"[\x20\x09-\x0D]", "", text)].append((-len(text), doc_id is None, doc_id))
    return sorted(
        ((d, min(g)[2], len(g), d == min(g)[2]) for g in groups.values() for _, _, d in g), key=repr
    )


@pytest.mark.parametrize("share", [0.5, 0.05, 1e-3])
def test_exact_matches_brute_force(spark, documents, share):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    rows += [(10**6 + i, "hot  text" if i % 3 else "hot text") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact.decisions(docs, share).collect()
    assert sorted((tuple(r[:4]) for r in got), key=repr) == plain_exact(rows)


def test_exact_edges(spark):
    docs = edge_docs(spark)
    got = exact.decisions(docs).collect()
    assert sorted((tuple(r[:4]) for r in got), key=repr) == plain_exact([r[:2] for r in edge_rows()])
    stay = exact.survivors(docs)
    assert stay.columns == docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in stay.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in edge_rows()})
    assert exact.decisions(no_docs(spark)).collect() == []
    assert exact.survivors(no_docs(spark)).collect() == []


def plain_near(rows):
    sets = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
        grams = {tuple(words[i : i + 4]) for i in range(len(words) - 3)} if len(words) > 3 else {tuple(words)} - {()}
        sets.append((doc_id, grams))
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(root(i))) for i, (d, s) in enumerate(sets)), key=repr)


def near_rows():
    """A group of copies with every amount of edits, so that many pairs lie about the similarity."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(4000)]
    origin = list(rng.choice(words, 150))
    rows = [(i, " ".join(rng.choice(words, 80))) for i in range(40)]
    for i in range(60):
        copy = list(origin)
        for at in rng.integers(0, 150, rng.integers(0, 14)):
            copy[at] = str(rng.choice(words))
        rows.append((1000 - i, " ".join(copy)))
    return rows


def test_near_matches_brute_force(spark):
    rows = near_rows() + [r[:2] for r in edge_rows() if r[0] != 1]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for settings in (neardup.Settings(), neardup.Settings(block=5, few_ids=0)):
        got = neardup.decisions(docs, settings).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain_near(rows)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def family_of_three():
    """A leader, a copy linked to it, and a text that is near enough to the copy only, by one shingle.

    By its signature the text is nearer to the leader, and every bucket it shares with the copy holds that.
    """
    base = [f"w{i}" for i in np.random.default_rng(125).permutation(10_000)[:300]]
    copy = ["first", *base[1:-2], "other", base[-1]]
    text = [base[0], *copy[1:]]
    for at in range(20, 260, 30):
        text[at] = f"x{at}"
    return [(i, " ".join(words)) for i, words in enumerate((base, copy, text))]


def test_near_links_beside_a_refused_best_pair(spark):
    rows = family_of_three()
    sets = neardup.shingle_sets(pa.array([text for _, text in rows]), 4)
    signatures = np.stack([neardup.Hasher(512).signature(s) for s in sets]).astype(np.uint8)
    equal = (signatures[:2] == signatures[2]).sum(axis=1)
    assert equal[0] > equal[1]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.decisions(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_near(rows)
    assert {r.component_id for r in got} == {0}


def test_near_short_text_alone_in_its_block(spark):
    for k in (4, 5):
        for n in range(k + 1):
            (alone,) = neardup.shingle_sets(pa.array(["one two three four five"[: [0, 3, 7, 13, 18, 23][n]]]), k)
            beside = neardup.shingle_sets(pa.array(["one two three four five"[: [0, 3, 7, 13, 18, 23][n]], "x " * 9]), k)
            assert len(alone) == (n > 0) and (alone == beside[0]).all()
    rows = [(1, "two words"), (2, "word" * 300_000 + " end"), (3, "Two  words")]
    for parts in (rows[:1], rows):
        docs = spark.createDataFrame(parts, "doc_id long, text string").coalesce(1)
        got = neardup.decisions(docs).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_near(parts)


def test_near_edges(spark):
    docs = edge_docs(spark)
    stay = neardup.survivors(docs)
    assert stay.columns == docs.columns
    # One of the four equal bodies; all others differ, and texts without words stay.
    assert sorted((r.doc_id for r in stay.collect()), key=repr) == [1, 3, 4, 5, 6, 7, 8, 9, None]
    assert neardup.decisions(no_docs(spark)).collect() == []


def test_signature_estimates_similarity():
    hasher = neardup.Hasher(512)
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 1000).astype(np.uint64)
    for same in (500, 800, 950):
        a, b = base[:1000], np.concatenate((base[:same], rng.integers(0, 2**63, 1000 - same).astype(np.uint64)))
        share = (hasher.signature(a) == hasher.signature(b)).mean()
        assert abs(share - same / (2000 - same)) < 0.08


def test_posterior_bounds_rise():
    needed = neardup.needed_matches(neardup.Settings())
    assert [n for n, _ in needed] == list(range(64, 513, 64))
    assert all(0.4 < least / n < 0.8 for n, least in needed)
    assert all(a / m <= b / n for (m, a), (n, b) in zip(needed, needed[1:]))


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (100, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def test_shingles_do_not_cross_texts():
    sets = neardup.shingle_sets(pa.array(["a b c d", "a b c", "A B C D", None, "e a b c d"]), 4)
    assert [len(s) for s in sets] == [1, 1, 1, 0, 2]
    assert sets[0] == sets[2] and sets[0][0] in sets[4] and sets[0] != sets[1]

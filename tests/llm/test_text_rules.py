"""Language, toxicity, quality: learned models against held-out rows, rules against brute force."""

import re
import zlib

import numpy as np
import pytest
import zstandard
from edges import edge_docs, no_docs
from pyspark.sql import functions as F

from roadlens.llm import language, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_automaton_accepts_exactly_the_substrings():
    text = [0, 1, 1, 0, 2, 0, 1, 2, 1, 1, 0]
    table = language.automaton(text, 4)
    parts = {tuple(text[a:b]) for a in range(len(text)) for b in range(a, len(text) + 1)}
    for code in range(4**4):
        word = tuple(code // 4**i % 4 for i in range(4))
        state = 0
        for letter in word:
            state = table[state, letter] if state >= 0 else -1
        assert (state >= 0) == (word in parts)


def phrases(text, sample):
    """Greedy longest matches, one character at least."""
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at += size
        n += 1
    return n


def test_phrases_match_brute_force():
    settings = language.Settings(segment=16)
    samples = {"x": "the cat sat on the mat\n", "y": "le chat est sur la table\n"}
    parser = language.Parser(samples, settings)
    rng = np.random.default_rng(1)
    letters = np.array(list("abcdehlmnostu "))
    texts = ["".join(rng.choice(letters, n)) for n in (1, 5, 15, 16, 17, 40, 100)]
    bits = parser.entropies(texts)
    for text, row in zip(texts, bits):
        for lang, cost, found in zip(parser.langs, parser.bits, row):
            blank = re.sub(r"[^a-z]", " ", samples[lang])
            parts = [text[i : i + 16] for i in range(0, len(text), 16)]
            assert found == pytest.approx(cost * sum(phrases(p, blank) for p in parts) / len(text))


def test_all_letters_of_the_samples_are_told_apart():
    """Two languages of one large script, in other orders, beside three alphabets that fill a table."""
    rng = np.random.default_rng(2)
    script = [chr(0x4E00 + i) for i in range(150)] + [chr(0x20000 + i) for i in range(50)]
    orders = {lang: "".join(rng.permutation(script)) for lang in ("p", "q")}
    samples = {lang: "".join(order[i : i + 9] + " " for i in rng.integers(0, 190, 90)) for lang, order in orders.items()}
    samples |= {
        lang: "".join(chr(first + i) for i in rng.integers(0, 26, 3000)) + "\n"
        for lang, first in (("latin", 0x61), ("greek", 0x3B1), ("cyrillic", 0x430))
    }
    parser = language.Parser(samples, language.Settings(segment=64))
    texts = {lang: " ".join(order[i : i + 7] for i in range(0, 180, 13)) for lang, order in orders.items()}
    bits = parser.entropies([*texts.values(), "".join(script)])
    for text, row in zip([*texts.values(), "".join(script)], bits):
        parts = [text[i : i + 64] for i in range(0, len(text), 64)]
        for lang, cost, found in zip(parser.langs, parser.bits, row):
            sample = samples[lang].replace("\n", " ")
            assert found == pytest.approx(cost * sum(phrases(p, sample) for p in parts) / len(text))
    assert parser.label(list(texts.values()))[0] == ["p", "q"]


def test_language_held_out(spark, documents):
    rows = language.predict(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == documents.count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
    held = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert np.mean(held) > 0.9


def test_language_edges(spark):
    rows = {(r.doc_id, r.lang_pred): r.score for r in language.predict(edge_docs(spark)).collect()}
    for doc_id in (3, 4, 5):
        assert rows[(doc_id, "und")] == 0
    assert language.predict(no_docs(spark)).collect() == []


def test_kneser_ney_is_a_distribution():
    rows = [(0, "abab ab ba"), (1, "abba bab aab")]
    model = toxicity.Model.fit(rows, toxicity.Settings(order=3))
    seen = {char for table in model.tables for _, (chars, _) in table.items() for char in chars}
    for history in [toxicity.START, toxicity.START + "a", "ab", "ba"]:
        for table in model.tables:
            of = {c: model._mixed(table, history, c, model.backed_off(history + c)) for c in [*seen, "?"]}
            assert sum(of[c] for c in seen) + (65_536 - len(seen)) * of["?"] == pytest.approx(1)


def test_compiled_ratios_equal_the_models():
    rows = [(0, "abab ab ba abc"), (1, "abba bab aab cab"), (0, "bbb")]
    settings = toxicity.Settings(order=4)
    model = toxicity.Model.fit(rows, settings)
    compiled = model.compiled()
    for word in ("ab", "abab", "zab", "cabz", "aabb", "b", "zz"):
        steps = toxicity._steps(word, 4)
        assert compiled.ratio(word) == pytest.approx(sum(model.step(h, c) for h, c in steps))


def test_toxicity_finds_planted_words(spark, documents, labels):
    docs = documents.select("doc_id", "text").join(labels, "doc_id", "left")
    planted = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    text = F.when(planted, F.concat("text", F.lit(" vilescum rotter vilescum "))).otherwise(F.col("text"))
    docs = docs.select("doc_id", text.alias("text"), planted.cast("int").alias("toxic"))
    rows = toxicity.predict(docs, docs.select("doc_id", "toxic")).join(docs.select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.9
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_toxicity_does_not_depend_on_the_size_of_the_sample(spark):
    def probed(toxic, ordinary):
        """Six of ten toxic texts and three of ten others hold the one telling word."""
        rows = []
        for label, n, share in ((1, toxic, 6), (0, ordinary, 3)):
            for i in range(n):
                rows.append((len(rows), f"plain text {'blurgh' if i % 10 < share else 'of words'} here", label))
        docs = spark.createDataFrame([*rows, (-1, "plain text blurgh here", None)], "doc_id long, text string, toxic int")
        found = toxicity.predict(docs, docs.select("doc_id", "toxic")).where("doc_id = -1").collect()
        return found[0].score, found[0].predicted

    few, many, more_ordinary = probed(120, 960), probed(1200, 9600), probed(120, 9600)
    # One in nine rows is toxic, so one in five with that word: whatever the sample holds of each class.
    assert few[0] == pytest.approx(0.2, abs=0.06)
    assert many[0] == pytest.approx(few[0], abs=0.06)
    assert few[1] == many[1] == more_ordinary[1] == 0
    assert more_ordinary[0] < few[0] / 4  # ten times the ordinary rows, about a tenth of the odds


def test_toxicity_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (7, None), (8, 0)], "doc_id long, toxic int")
    assert toxicity.predict(docs, labels).count() == docs.count()
    none = toxicity.predict(docs, labels.where("toxic = 0"))
    assert {r.score for r in none.collect()} == {0.0}
    assert toxicity.predict(no_docs(spark), labels).collect() == []
    kept = toxicity.clean(docs, labels.where("toxic = 0"))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def plain_quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    duplicates = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, duplicates, len(covered), failed


def test_quality_matches_brute_force(spark, documents):
    short = documents.where("n_chars < 6000")
    texts = {r.doc_id: r.text for r in short.collect()}
    rows = quality.score(short).collect()
    assert len(rows) == len(texts)
    packer = zstandard.ZstdCompressor(level=3)
    for r in rows:
        assert tuple(r[1:7]) == plain_quality(texts[r.doc_id])
        raw = texts[r.doc_id].encode()
        assert r.ratio == pytest.approx(len(packer.compress(raw)) / len(raw) if raw else 1)
        assert not (r.base_failed and r.kept)


def test_quality_bands(spark):
    noise = "".join(f"{b:02x} " for b in np.random.default_rng(0).integers(0, 256, 3000))
    raw = bytes(np.random.default_rng(1).integers(33, 127, 9000).astype(np.uint8)).decode()
    raw = " ".join(raw[i : i + 9] for i in range(0, 9000, 9))
    docs = spark.createDataFrame([(1, "same words all over again and again " * 300), (2, raw), (3, noise)], "doc_id long, text string")
    rows = {r.doc_id: r for r in quality.score(docs).collect()}
    assert not rows[1].kept
    assert not rows[2].base_failed and not rows[2].kept  # incompressible


def test_quality_edges(spark):
    docs = edge_docs(spark)
    rows = quality.score(docs).collect()
    assert len(rows) == docs.count()
    assert quality.score(no_docs(spark)).collect() == []


def test_language_sample_keeps_rows_apart(spark):
    """Rows that share an id teach their own language their own text."""
    kept = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 4 != 2)
    rows = [(kept, "aaa bbb", "en"), (kept, "ccc ddd", None), (kept, "eee fff", "de"), (kept, "eee fff", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.sample(docs, F.col("lang"), language.Settings())
    assert found == {"en": "aaa bbb\n", "de": "eee fff\n"}


def test_language_of_one_id_is_learned(spark):
    for kept in [i for i in range(30) if zlib.crc32(str(i).encode()) % 4 != 2][:8]:
        docs = spark.range(300).select(F.lit(kept).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("en").alias("lang"))
        found = language.sample(docs, F.col("lang"), language.Settings(rows=20, chars=90))
        assert 90 <= len(found["en"]) < 110


def test_language_sample_is_bounded(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("word "), F.col("id")), 30).alias("text"),
        F.element_at(F.array(F.lit("en"), F.lit("de")), (F.col("id") % 2 + 1).cast("int")).alias("lang"),
    )
    found = language.sample(docs, F.col("lang"), language.Settings(rows=50, chars=2_000))
    assert set(found) == {"en", "de"} and all(2_000 <= len(t) < 2_400 for t in found.values())

"""License notices, token alignment and source divergence against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from edges import edge_docs, edge_rows, no_docs

from roadlens.llm import crosstoken, divergence, licenses, queries
from roadlens.llm.tokens import Encoder, PieceEncoder, public_file

FOLDER = "/root/testdata/sf0.001"
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# Notices


def notice_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def fewest_errors(notice, words):
    """Over all runs of words, by edit distance; None above the notice's limit."""
    tail, least = notice.text[len(notice.head) :], None
    for a in range(len(words)):
        rest = " ".join(words[a:])
        column = list(range(len(notice.head) + 1))
        for n in range(min(len(rest), len(notice.text) + 8) + 1):
            if n:
                new = [column[0] + 1]
                for i, h in enumerate(notice.head):
                    new.append(min(column[i] + (h != rest[n - 1]), column[i + 1] + 1, new[i] + 1))
                column = new
            end = n + len(tail)
            whole = end and end <= len(rest) and rest[end - 1] != " " and rest[end : end + 1] in ("", " ")
            if column[-1] <= notice.errors and whole and rest[n:].startswith(tail):
                least = column[-1] if least is None else min(least, column[-1])
    return least


def test_notices_against_edit_distance():
    rng = random.Random(5)
    notices = licenses.notices()
    fill = "under license the mit public gnu version 3 2 é 中文 apache creative commons cc by nc x reserved all".split()
    texts = []
    for _ in range(250):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts += [rng.choice(fill) for _ in range(rng.randrange(5))]
            letters = list(rng.choice(notices).text)
            for _ in range(rng.randrange(6)):
                at = rng.randrange(len(letters))
                kind = rng.randrange(3)
                letters[at : at + (kind < 2)] = [rng.choice("abcdefgh é中")] if kind else []
            parts.append("".join(letters))
        texts.append(rng.choice([" ", ", ", "\n", "--"]).join(parts))
    counts, found = licenses.Scanner(notices).block(pa.array(texts))
    total = 0
    for text, count, spans in zip(texts, counts, found):
        words = notice_words(text)
        assert count == len(words)
        got = {}
        for i, errors, first, n, start, end in spans:
            got[i] = min(errors, got.get(i, 99))
            assert notice_words(text[start:end]) == words[first : first + n]
        want = {i: e for i, n in enumerate(notices) if (e := fewest_errors(n, words)) is not None}
        assert got == want, text
        total += len(want)
    assert total > 200


def base_places(text):
    words = notice_words(text)
    places = []
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return words, places


def check_base(rows):
    for text, row in rows:
        words, places = base_places(text)
        starts = [i for i, _ in places]
        assert row["n_words"] == len(words) and row["n_base"] == len(places)
        assert row["first_word"] == min(starts, default=None) and row["last_word"] == max(starts, default=None)
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        labels = row["labels"].split(",") if row["labels"] else []
        assert labels == sorted(set(labels)) and {label for _, label in places} <= set(labels)
        assert 0 <= row["score"] <= 1 and (row["score"] == 1) >= bool(places)


def test_base_places_of_the_tables(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op11_license_notices(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    check_base([(texts[r["doc_id"]], r) for r in rows])
    assert sum(r["n_base"] for r in rows)


def test_many_places_and_strange_neighbours(spark):
    texts = [
        "Under the MIT license. " * 500 + "under the MIT licence",
        "underthe mit license; under\nthe\tMIT-License_under the mit license",
        "thunder the mit license, under the mit licenses",
        "CC BY-NC, cc by nc cc by nc; CC-BY-ND",
        "x" * 300 + "under the mit license" + "y" * 300,
        "Apache License, Version 3.0", "Apache Licence, Version 2.0", "é under the mit license é",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    rows = sorted(licenses.scan(docs).collect(), key=lambda r: r["doc_id"])
    check_base(list(zip(texts, rows)))
    assert [r["n_base"] for r in rows] == [500, 2, 0, 3, 0, 0, 0, 1]
    assert [r["labels"] for r in rows] == ["mit", "mit", "mit", "cc-by-nc", "", "", "apache-2", "mit"]
    spans = licenses.spans(docs).where("doc_id = 6").collect()
    assert [(texts[6][s["start"] : s["end"]], s["errors"]) for s in spans] == [("Apache Licence, Version 2", 1)]


def test_notices_on_edge_rows(spark):
    rows = licenses.scan(edge_docs(spark)).collect()
    assert len(rows) == len(edge_rows())
    assert {r["score"] for r in rows} == {0.0} and {r["first_word"] for r in rows} == {None}
    assert sorted(r["n_words"] for r in rows) == sorted(len(notice_words(r[1])) for r in edge_rows())
    assert licenses.scan(no_docs(spark)).count() == 0
    assert licenses.scan(edge_docs(spark), []).count() == len(edge_rows())


# Alignment


def aligned(text, a, b):
    """Ids of both, links, and groups as text; None for a text without tokens."""
    if not text:
        return None
    ids = [a.tokenizer.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)]
    parts = [[work.names()[i] for i in own] for work, own in zip((a, b), ids)]
    if any(b"".join(p) != (" " + text).encode() for p in parts):
        return None
    ends = []
    for part in parts:
        at, line = 0, []
        for p in part:
            at += len(p)
            line.append(at)
        ends.append(line)
    i = j = 0
    links, groups, group = [], [], ([], [])
    while i < len(ids[0]):
        links.append((ids[0][i], ids[1][j]))
        x, y = ends[0][i], ends[1][j]
        if x <= y:
            group[0].append(str(ids[0][i]))
            i += 1
        if y <= x:
            group[1].append(str(ids[1][j]))
            j += 1
        if x == y:
            groups.append(",".join(group[0]) + "|" + ",".join(group[1]))
            group = ([], [])
    return (*ids, links, groups)


def by_hand(texts):
    a, b = Encoder(public_file(A)), PieceEncoder(public_file(B))
    each = [aligned(text, a, b) for text in texts]
    documents, links = Counter(), Counter()
    for row in each:
        if row:
            documents.update(set(row[2]))
            links.update(row[2])
    most = defaultdict(int)
    for (x, _), n in documents.items():
        most[x] = max(most[x], n)
    rows = []
    for row in each:
        if row is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(documents[p] == most[p[0]] for p in row[2])
        digest = hashlib.sha256(";".join(row[3]).encode()).hexdigest()
        rows.append((len(row[0]), len(row[1]), len(row[3]), len(row[2]), best, sum(documents[p] for p in row[2]), digest))
    pairs = {(x, y, n, links[x, y], n == most[x]) for (x, y), n in documents.items()}
    return rows, pairs


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

STRANGE = [
    None, "", " ", "  ", "a", " a  b ", "\n\n  z\t\t", "<s>hi</s> <|endoftext|> <0x0A> <unk>", "the ▁ mark", "▁",
    "é中\U0001F600  x　y", "\x00 nul", "don't 12,345.6", "word " * 3_000, "x" * 5_000, "한국어 텍스트 עברית",
]


def aligned_rows(docs, **settings):
    chunks = crosstoken.index(docs, public_file(A), public_file(B), crosstoken.Settings(**settings))
    pairs = {tuple(r) for r in crosstoken.pair_table(chunks).collect()}
    return crosstoken.of_documents(chunks).collect(), pairs


@pytest.mark.parametrize("settings", [{}, {"postings": 500, "block": 4_000}, {"documents": 7, "block": 900}])
def test_alignment_against_brute_force(spark, documents, settings):
    table = documents.select("doc_id", "text").limit(120).collect()
    texts = [r["text"] for r in table] + STRANGE + STRANGE[4:8]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want, pairs = by_hand(texts)
    rows, got_pairs = aligned_rows(docs, **settings)
    got = {r["doc_id"]: tuple(r[f] for f in FIGURES) for r in rows}
    assert len(rows) == len(texts) and got == dict(enumerate(want))
    assert got_pairs == pairs


def test_alignment_of_the_table(spark, documents):
    rows = queries.op12_tokenizer_alignment(spark, FOLDER).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    want, _ = by_hand(list(texts.values()))
    assert {r["doc_id"]: tuple(r[f] for f in FIGURES) for r in rows} == dict(zip(texts, want))


def test_alignment_on_edge_rows(spark):
    rows, pairs = aligned_rows(edge_docs(spark))
    want, want_pairs = by_hand([r[1] for r in edge_rows()])
    assert sorted(tuple(r[f] for f in FIGURES) for r in rows) == sorted(want) and pairs == want_pairs
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert aligned_rows(no_docs(spark)) == ([], set())
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {tuple(r) for r in aligned_rows(nothing)[0]} == {(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")}


# Divergence


def divergences_by_hand(rows, least, prior=5, scale=10**9, top=50):
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))
        counts[lang, source].update(terms)
        documents[lang].update(set(terms))
    out = set()
    for lang, n in documents.items():
        kept = [t for t, d in n.items() if d >= least]
        sources = [s for x, s in counts if x == lang]

        def shares(own):
            whole = sum(own[t] for t in kept)
            return {t: 1 + scale * (own[t] + prior) // (whole + prior * len(kept)) for t in kept}

        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                out |= {(lang, s, part, o, -v, i + 1) for i, (v, o) in enumerate(found[:most])}
    return out


def test_divergences_against_brute_force(spark):
    rng = random.Random(11)
    stock = ["Word", "word", "é", "É", "x", "ab1cd", "12", "中文", "\U0001F600", "tie", "tied", "rare"]
    rows = []
    for _ in range(300):
        text = rng.choice([" ", ", ", "\n"]).join(rng.choices(stock, k=rng.randrange(9)))
        rows.append((rng.choice(["en", "de", None]), rng.choice(["s", "s", "s", "t", "u", "ü", None]), rng.choice([text, text, text, None, ""])))
    rows += [("quiet", "a", None), ("quiet", "b", "12 34"), ("alone", "only", "one")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string")
    plain = [tuple(x or "" for x in r) for r in rows]
    for settings in (dict(least_documents=10), dict(least_documents=3, cells=8, top=2), dict(least_documents=1, prior=1, scale=1_000)):
        got = [tuple(r) for r in divergence.divergences(docs.repartition(4), divergence.Settings(**settings)).collect()]
        want = divergences_by_hand(plain, settings["least_documents"], settings.get("prior", 5), settings.get("scale", 10**9), settings.get("top", 50))
        assert len(got) == len(set(got)) and set(got) == want


def test_terms_of_slices(monkeypatch):
    """Counts do not depend on how a batch is cut into blocks, nor on when partial counts are added up."""
    texts = [f"É word{i % 7} äé Word{i % 3} " * (i % 5) + "中" * (i % 4) for i in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de"] * 100), pa.array(["s", "t", "u", "v"] * 50), pa.array(texts)], ["lang", "source", "text"])
    want = Counter()
    for i, text in enumerate(texts):
        want.update((("en", "de")[i % 2], "stuv"[i % 4], t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text)))
    for block, held in ((1 << 22, 1 << 19), (300, 1 << 19), (300, 16)):
        monkeypatch.setattr(divergence, "_BLOCK", block)
        monkeypatch.setattr(divergence, "_HELD", held)
        got = Counter()
        for part in divergence._partial_counts(iter([batch.slice(0, 90), batch.slice(90)])):
            part.validate(full=True)
            for row in part.to_pylist():
                got[row["lang"], row["source"], row["term"]] += row["n"]
        assert got == want


def test_divergences_on_edge_rows(spark):
    plain = [(r[2] or "", r[3] or "", r[1] or "") for r in edge_rows()]
    got = {tuple(r) for r in divergence.divergences(edge_docs(spark), divergence.Settings(least_documents=1)).collect()}
    assert got == divergences_by_hand(plain, 1)
    assert divergence.divergences(no_docs(spark)).count() == 0
    # Without kept terms every pair is there, at 0.
    assert {r["value"] for r in divergence.divergences(edge_docs(spark)).collect()} == {0}

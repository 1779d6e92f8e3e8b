"""License scans, toxicity, quality network and language model against plain Python or planted cases."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import licenses, pitman_yor, quality_model, toxicity

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def base_places(text):
    w = words(text)
    return sorted(
        (i, label)
        for phrase, label in licenses.BASE_PHRASES.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    )


LICENSED = [
    (1, "Released UNDER the MIT-License. under the mit license, under the under the mit license", "s"),
    (2, "Apache License, Version 2.0; apache license version 3; É apache license version 2é", "s"),
    (3, "cc by-nc CC BY NC cc by\x00nc ccby nc", "s"),
    (4, "Permission is hereby granted, free of charge, to any person; not to deal in the software", "s"),
    (5, licenses.TEMPLATES[3].text.upper(), "s"),
    (6, "This work is licensed under the GNU General Public License, version 3.", "s"),
]


@pytest.mark.parametrize("table", ["documents", "odd_docs", "clashing", "no_docs", "licensed"])
def test_base_places_of_licenses(request, spark, table):
    if table == "licensed":
        docs = spark.createDataFrame(LICENSED, "doc_id bigint, text string, places string")
    else:
        docs = request.getfixturevalue(table)
    got = collections.Counter(
        (r.doc_id, r.n_words, tuple(sorted((p["first"], p.label) for p in r.places if p.base)))
        for r in licenses.scan(docs).collect()
    )
    expected = collections.Counter(
        (r.doc_id, len(words(r.text)), tuple(base_places(r.text))) for r in docs.select("doc_id", "text").collect()
    )
    assert got == expected


def test_templates_need_all_their_key_phrases(spark):
    docs = spark.createDataFrame(LICENSED, "doc_id bigint, text string, places string")
    found = licenses.scan(docs).select("doc_id", licenses.labels_of(F.col("places")).alias("l")).collect()
    assert {r.doc_id: r.l for r in found} == {1: "mit", 2: "apache-2", 3: "cc-by-nc", 4: "", 5: "mit", 6: "gpl-3"}


def test_every_place_is_found_whatever_the_rarity():
    rng = np.random.default_rng(4)
    vocabulary = sorted({w for t in licenses.TEMPLATES[:3] for w in t.text.encode().split()})
    for round_ in range(200):
        index = licenses.Index(licenses.TEMPLATES, {w: float(rng.random()) for w in vocabulary})
        text = [vocabulary[i] for i in rng.integers(0, len(vocabulary), 60)]
        for t in licenses.TEMPLATES[:3]:
            at = int(rng.integers(0, 50))
            text[at:at] = t.text.encode().split()
        got = sorted((p[1], p[0]) for p in index.places(text) if p[3])
        assert got == base_places(b" ".join(text).decode())


def toxic_corpus(n=1500, seed=1):
    """Toxic when an insult stands with a group; neither alone is."""
    rng = np.random.default_rng(seed)
    docs, marks = [], []
    for i in range(n):
        text = [f"w{k}" for k in rng.integers(0, 300, 30)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        text += ["awful"] * insult + ["tribe"] * group
        docs.append((i, " ".join(text)))
        marks.append((i, 1, int(insult and group)))
    return docs, marks


def test_pairs_weigh_more_than_their_terms(spark):
    docs, marks = toxic_corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(frame, labels).collect()}
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(i for i, r in got.items() if r.held_out) == held
    right = sum((got[i].score >= 0.5) == bool(marks[i][2]) for i in held)
    assert right / len(held) > 0.95
    machine = toxicity.learn(frame, labels)
    at = [np.searchsorted(machine.names, toxicity.word_terms(w)[0]) for w in (b"awful", b"tribe")]
    assert machine.factors[at[0]] @ machine.factors[at[1]] > 0.5


def test_held_out_labels_are_not_used(spark):
    docs, marks = toxic_corpus(400)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    schema = "doc_id bigint, quality int, toxic int"
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in marks]
    a = toxicity.score(frame, spark.createDataFrame(marks, schema)).orderBy("doc_id").collect()
    b = toxicity.score(frame, spark.createDataFrame(turned, schema)).orderBy("doc_id").collect()
    assert a == b


@pytest.mark.parametrize("operator", [toxicity, quality_model])
def test_scores_of_odd_rows(operator, clashing, no_docs, labels, no_labels):
    for marks in (labels, no_labels):
        rows = operator.score(clashing, marks).collect()
        assert len(rows) == clashing.count()
        assert all(0 <= r.score <= 1 for r in rows)
        assert all(r.held_out is not None for r in rows)
    assert {r.score for r in rows} == {0.5}
    assert operator.score(no_docs, labels).count() == 0


def test_toxicity_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.score(docs, labels).where("held_out").join(labels, "doc_id").select("score", "toxic").collect()
    caught = [r for r in rows if r.score >= 0.5]
    assert sum(r.toxic for r in caught) >= 0.95 * len(caught)
    assert len(caught) >= 0.75 * sum(r.toxic for r in rows)


def test_quality_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality_model.score(docs, labels).where("held_out").join(labels, "doc_id").select("score", "quality").collect()
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert np.mean(np.array(good) >= 0.7) > 0.97
    assert np.mean(np.array(bad) < 0.7) > 0.9


def test_word_vectors_add_the_index_vectors_around_a_word(spark):
    texts = ["a b c b a d", None, "", "b a"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = quality_model.context_counts(frame)
    where, sign = quality_model.index_table()
    bucket = quality_model.Buckets()
    expected = np.zeros((quality_model.BUCKETS + 1, quality_model.WIDTH))
    for text in texts:
        ids = [bucket[t] for t in quality_model.tokens(text)]
        for i, a in enumerate(ids):
            for b in ids[max(0, i - 2) : i] + ids[i + 1 : i + 3]:
                for k in range(2):
                    expected[a, where[k][b]] += sign[k][b]
    norm = np.linalg.norm(expected, axis=1, keepdims=True)
    assert np.allclose(got, expected / np.maximum(norm, 1e-9), atol=1e-6)


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 5))
    p = 1 / (1 + np.exp(-2 * x[:, 0]))
    y = (rng.random(4000) < p).astype(float)
    net = quality_model.fit(x, y)
    s = net.score(x)
    for low, high in ((0.1, 0.3), (0.4, 0.6), (0.7, 0.9)):
        inside = (s > low) & (s < high)
        assert abs(s[inside].mean() - y[inside].mean()) < 0.06


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


@pytest.mark.parametrize("table", ["documents", "odd_docs", "clashing", "no_docs"])
@pytest.mark.parametrize("frequent", [5, 1 << 17])
def test_base_score(request, monkeypatch, table, frequent):
    monkeypatch.setattr(pitman_yor, "FREQUENT", frequent)
    docs = request.getfixturevalue(table)
    rows = docs.select("doc_id", "text").collect()
    held = lambda r: r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0
    counts = collections.Counter(w for r in rows if not held(r) for w in tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (
            str(r.doc_id),
            held(r),
            len(tokens(r.text)),
            sum(w in counts for w in tokens(r.text)),
            n,
            round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(r.text)), 4),
        )
        for r in rows
    )
    got = pitman_yor.score(docs).collect()
    assert sorted((str(r[0]), *r[1:5], round(r.base_score, 4)) for r in got) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_common_and_joined_words_score_alike(documents, monkeypatch):
    few = {r.doc_id: r.score for r in pitman_yor.score(documents).collect()}
    monkeypatch.setattr(pitman_yor, "FREQUENT", 7)
    for r in pitman_yor.score(documents).collect():
        assert r.score == pytest.approx(few[r.doc_id], rel=1e-5)


def test_spelling_is_a_distribution():
    found = [b"ab", b"abc", b"ba", b"", b"abab", b"\xc3\xa9", b"abcabcabc"]
    codes, n = np.unique(pitman_yor.grams(found), return_counts=True)
    direct = {}
    for order, part in ((pitman_yor.ORDER, codes % 2 == 0), (2, codes % 2 == 1)):
        short, at = np.unique(codes[part] % 257 ** (order + 1), return_inverse=True)
        direct[order] = (short, np.bincount(at, n[part]).astype(np.int64))
    spelling = pitman_yor.fit_spelling(direct)
    # Whatever the context, seen or not, the next letter's probabilities sum to one.
    for context in {*(codes // 257), 0, 5 * 257**3 + 97}:
        for p in spelling.letters(context * 257 + np.arange(257)):
            assert p.sum() == pytest.approx(1)
    assert spelling.log10(found)[0] > spelling.log10([b"zq"])[0]


def test_grams_do_not_reach_across_words():
    end = pitman_yor.END
    got = pitman_yor.grams([b"ab", b"", b"c"]).tolist()

    def code(*digits):
        out = 0
        for d in [*[end] * (pitman_yor.ORDER + 1 - len(digits)), *digits]:
            out = out * 257 + d
        return out

    assert got == [code(97), code(97, 98), code(97, 98, end), code(end), code(99), code(99, end)]


def test_predictive_probabilities_sum_to_one():
    rng = np.random.default_rng(6)
    counts = rng.integers(0, 9, (40, pitman_yor.CONTEXTS))
    counts = counts[counts.sum(axis=1) > 0]
    spelled = rng.dirichlet(np.ones(len(counts))) * 0.7
    totals = pitman_yor.Totals(
        counts.sum(axis=0).astype(float), np.full(pitman_yor.CONTEXTS, 0.6), 0.5, [], []
    )
    for sweep in range(3):
        if not sweep:
            t, s = (counts > 0).astype(int), np.ones(len(counts), int)
        else:
            *_, (t, s) = pitman_yor.sweeps_of(counts, spelled, totals, sweep, [1, 2])
        totals.tables.append(t.sum(axis=0).astype(float))
        totals.root_tables.append(float(s.sum()))
        p = pitman_yor.predictive(counts, spelled, totals, sweep, t, s)
        root = (0.5 * s.sum() + 1) / (1 + t.sum())
        unseen = (1 + 0.6 * t.sum(axis=0)) / (1 + counts.sum(axis=0)) * root * 0.3
        assert np.allclose(p.sum(axis=0) + unseen, 1)


def test_tables_follow_the_restaurant_rule():
    """Mean tables of many seatings against the exact recursion for one dish."""
    n, prior, d, mass = 30, 0.2, 0.5, 4.0
    rng = np.random.default_rng(3)
    got = pitman_yor.seat(np.full(20_000, n), np.full(20_000, prior), d, mass, rng).mean()
    chance = {1: 1.0}
    for seated in range(1, n):
        after = collections.defaultdict(float)
        for t, p in chance.items():
            new = mass * prior / (seated - d * t + mass * prior)
            after[t + 1] += p * new
            after[t] += p * (1 - new)
        chance = after
    assert got == pytest.approx(sum(t * p for t, p in chance.items()), rel=0.06)


def test_repeated_text_is_more_likely_than_new_text(spark):
    rows = [(i, "the cat sat on the mat. the dog sat on the log.") for i in range(50)]
    rows += [(1000, "zyx wvu tsr qpo nml kji"), (1001, "the cat sat on the log.")]
    got = {r.doc_id: r.score / r.n_tokens for r in pitman_yor.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1001] > got[1000] + 1


def test_the_preceding_word_makes_the_context(spark):
    """Words of one kind lead to different words; each is likely after its own alone."""
    rows = [(i, "north wind " * 4 if i % 2 else "south rain " * 4) for i in range(300)]
    ids = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows += [(ids[0], "north wind"), (ids[1], "north rain"), (ids[2], "never rain")]
    got = {r.doc_id: r for r in pitman_yor.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[ids[0]].base_score == pytest.approx(got[ids[1]].base_score, abs=0.1)
    assert got[ids[0]].score > got[ids[1]].score + 1
    assert math.isfinite(got[ids[2]].score)


@pytest.mark.parametrize("frequent", [3, 1 << 17])
def test_pair_probabilities_follow_the_restaurants(spark, monkeypatch, frequent):
    """What training texts score is c - d t and the share left to the kind, for pairs seen once and more often."""
    monkeypatch.setattr(pitman_yor, "FREQUENT", frequent)
    monkeypatch.setattr(pitman_yor, "PAIRS", 2)
    texts = ["a b a b a c", "a b d", "", None, "e f g a b", "c c c a"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    made, learn = [], pitman_yor.learn

    def learned(*given):
        model = learn(*given)
        made.extend([model, model.table.collect(), model.seats.collect()])  # gone when the scores are there
        return model

    monkeypatch.setattr(pitman_yor, "learn", learned)
    got = {r.doc_id: r for r in pitman_yor.score(docs).collect()}
    model = made[0]
    table = {r.h: r for r in made[1]}
    tables = {(r.w, r.u): r.t for r in made[2]}
    own = lambda w: table[pitman_yor.word_hashes([w])[0].item()]
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 10]
    counts = collections.Counter(p for i in train for p in zip([b"", *tokens(texts[i])], tokens(texts[i])))
    d = model.pair_discount
    after = collections.defaultdict(list)
    for (u, w), c in counts.items():
        after[own(u).u].append((own(w).h, c, tables.get((own(w).h, own(u).u), 1)))
    for i in range(len(texts)):
        want = 0.0
        for u, w in zip([b"", *tokens(texts[i])], tokens(texts[i])):
            kind = pitman_yor.context(u) if u else 0
            room = after.get(own(u).u, [])
            assert own(u).v == sum(t for _, _, t in room) and own(u).c == sum(c for _, c, _ in room)
            _, c, t = next((x for x in room if x[0] == own(w).h), (0, 0, 0))
            want += math.log10((c - d * t + (1 + d * own(u).v) * 10 ** own(w)[f"p{kind}"]) / (1 + own(u).c))
        assert got[i].score == pytest.approx(want, rel=1e-5)


def test_every_sweep_seats_the_pairs_anew(spark):
    """Tables of pairs change from sweep to sweep, and are the mean over the sweeps kept."""
    texts = [" ".join(f"w{(i * j) % 17} x{(i + j) % 5}" for j in range(40)) for i in range(60)]
    docs = spark.createDataFrame([(False, t) for t in texts], "held_out boolean, text string")

    def tables(sweeps, kept):
        model = pitman_yor.learn(docs, sweeps, kept)
        own = {r.u: r.v for r in model.table.collect()}
        seats = {(r.w, r.u): (r.n, r.t) for r in model.seats.collect()}
        alone = collections.Counter(r.u for r in model.rest.collect())
        for u, v in own.items():
            assert v == pytest.approx(alone[u] + sum(t for (_, x), (_, t) in seats.items() if x == u))
        assert all(1 <= t <= n for n, t in seats.values())
        return {k: t for k, (_, t) in seats.items()}

    first, third, mean = tables(1, 1), tables(3, 1), tables(3, 2)
    assert first.keys() == third.keys() == mean.keys()
    assert sum(first[k] != third[k] for k in first) > len(first) / 20
    assert any(t % 1 == 0.5 for t in mean.values())

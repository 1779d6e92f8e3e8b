"""Near-duplicates, mixing, packing and nearest neighbours against brute force."""

import collections
import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskloom.llm import mixing, nearest, packing, ranks, simhash


def fingerprint(text, k=4):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids, radius):
    prints = np.array(prints, dtype=np.uint64)
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= radius):
            a, b = find(i), find(int(j))
            label[max(a, b)] = min(a, b)
    groups = collections.defaultdict(list)
    for i in range(len(prints)):
        groups[find(i)].append(i)
    out = [None] * len(prints)
    for members in groups.values():
        named = [ids[i] for i in members if ids[i] is not None]
        for i in members:
            out[i] = min(named, default=None)
    return out


@pytest.mark.parametrize("table", ["documents", "odd_docs", "clashing", "no_docs"])
def test_groups(request, table):
    docs = request.getfixturevalue(table)
    rows = docs.select("doc_id", "text").collect()
    prints = [fingerprint(r.text) for r in rows]
    groups = components(prints, [r.doc_id for r in rows], 4)
    expected = collections.Counter(zip((r.doc_id for r in rows), prints, groups))
    got = simhash.near_duplicates(docs).collect()
    assert collections.Counter((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got) == expected


@pytest.mark.parametrize("agree", [1, 2, 3])
@pytest.mark.parametrize("chunk", [3, 4096])
def test_links_connect_all_close_prints(spark, agree, chunk):
    rng = np.random.default_rng(agree)
    centers = rng.integers(0, 2**63, 12)
    prints = {int(c) for c in centers}
    for c in centers:
        for _ in range(25):
            at = int(c)
            for b in rng.choice(64, rng.integers(1, 9), replace=False):
                at ^= 1 << int(b)
            prints.add(at)
    prints = sorted(prints)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    links = simhash.near_links(frame, 4, chunk, agree).collect()
    own = {p: p for p in signed}

    def find(p):
        while own[p] != p:
            p = own[p]
        return p

    for u, v in links:
        own[find(u)] = find(v)
    expected = components(prints, list(range(len(prints))), 4)
    firsts = {}
    got = [firsts.setdefault(find(p), i) for i, p in enumerate(signed)]
    assert got == expected


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
    prints = np.concatenate([base, near, base ^ np.uint64(0b1111)])
    label = simhash._forest(np.zeros(len(prints)), np.zeros(len(prints)), prints, radius)
    assert label.tolist() == components(prints, list(range(len(prints))), radius)


def test_connected_follows_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(500, 501)], "u bigint, v bigint")
    got = {r.node: r.root for r in simhash.connected(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_one_of_each_group_stays(clashing):
    out = simhash.keep_one_of_each(clashing)
    assert out.columns == clashing.columns
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert ids.count(10) == 1
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(clashing).collect()}
    assert sorted(i for i in ids if i is not None) == sorted({c for d, c in groups.items() if c is not None})
    assert simhash.keep_one_of_each(clashing.where("doc_id is null and lang is null")).count() == 1


def waterfill(sizes, weights, most):
    """The same shares by bisection on the level."""
    total, low, high = sum(sizes), 0.0, 1e12
    for _ in range(300):
        mid = (low + high) / 2
        if sum(min(most * s, mid * w) for s, w in zip(sizes, weights)) < total:
            low = mid
        else:
            high = mid
    return [min(most * s, high * w) for s, w in zip(sizes, weights)]


@pytest.mark.parametrize("sizes", [[10, 100, 1000], [5, 0, 7, 900], [1], [0, 0], [3, 3, 3, 3, 3000]])
def test_targets(sizes):
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, weights)
    assert got == pytest.approx(waterfill(sizes, weights, 3), abs=1e-6)
    assert sum(got) == pytest.approx(sum(sizes))


@pytest.mark.parametrize("seed", range(6))
def test_budget_is_met_as_well_as_any_subset(seed):
    rng = np.random.default_rng(seed)
    sizes = np.unique(rng.integers(3, 60, 6))
    counts = rng.integers(0, 4, len(sizes))
    total = int((sizes * counts).sum())
    reach = {0}
    for s, c in zip(sizes, counts):
        reach = {r + int(s) * k for r in reach for k in range(c + 1)}
    for budget in (0, 1, total // 3, total // 2, total, total + 5):
        # Nothing is fixed before the knapsack when even shares round to nothing.
        take = mixing.fit_budget(sizes, counts, budget)
        assert ((0 <= take) & (take <= counts)).all()
        words = int((take * sizes).sum())
        assert words <= max(0, budget)
        if (counts <= 1).all():
            assert words == max(r for r in reach if r <= budget)


def test_mix(documents):
    got = mixing.mix(documents).join(documents.select("doc_id", "source"), "doc_id").collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
    for rows in by.values():
        assert sum(r.size for r in rows) == rows[0].source_size
        taken = sum(r.size * r.copies for r in rows)
        assert abs(taken - rows[0].target) <= max(r.size for r in rows)
        assert max(r.copies for r in rows) <= 3
    again = mixing.mix(documents).select("doc_id", "copies").collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter((r.doc_id, r.copies) for r in got)


def test_mix_of_odd_rows(clashing, no_docs):
    rows = mixing.mix(clashing).collect()
    assert len(rows) == clashing.count()
    assert mixing.mix(no_docs).count() == 0
    out = mixing.mixed(clashing)
    assert out.columns == clashing.columns
    assert out.count() == sum(r.copies for r in rows)
    assert mixing.mixed(no_docs).count() == 0


def test_rows_that_differ_by_the_place_of_a_null_are_kept_apart(spark):
    rows = [(1, "a b c", "en", None, 5), (1, "a b c", None, "en", 5), (1, None, "a b c", "en", 5), (2, "d e f", "en", None, 5), (2, "d e f", "en", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    copies = collections.Counter((r.doc_id, r.text, r.lang, r.source) for r in mixing.mixed(docs).collect())
    assert sum(copies.values()) == sum(r.copies for r in mixing.mix(docs).collect())
    # The source "en" has one row with words, which alone makes up its share.
    assert copies[1, "a b c", None, "en"] == 3
    times = collections.Counter(rows)
    assert all(n <= 3 * times[(*row, 5)] for row, n in copies.items())
    for part in (docs.limit(0), docs.where("lang is null")):
        assert mixing.mixed(part).columns == docs.columns


@pytest.mark.parametrize("table", ["documents", "odd_docs", "clashing", "no_docs"])
def test_packing_is_a_round_trip(request, table):
    docs = request.getfixturevalue(table)
    rows = packing.pack(docs, capacities=(16, 64, 256)).collect()
    tokens = collections.Counter(
        (r.doc_id, len((r.text or "").encode().split()) + 1) for r in docs.select("doc_id", "text").collect()
    )
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.size))
    for doc in {d for d, _ in tokens}:
        expected = collections.Counter()
        for (d, n), times in tokens.items():
            if d == doc:
                for at in range(0, n, 256):
                    expected[(at, min(256, n - at))] += times
        assert collections.Counter(pieces[doc]) == expected
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for members in bins.values():
        members.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in members:
            assert r.bin_offset == at
            at += r.size
        assert {r.capacity for r in members} == {min(c for c in (16, 64, 256) if c >= at)}


@pytest.mark.parametrize("seed", range(5))
def test_plan_holds_every_item_and_fits(seed):
    rng = np.random.default_rng(seed)
    counts = {int(s): int(n) for s, n in zip(rng.integers(1, 4097, 300), rng.integers(1, 200, 300))}
    bins = packing.plan(counts)
    held = collections.Counter()
    for b in bins:
        for s, m in b.sizes:
            held[s] += m * b.count
        assert b.used <= b.capacity == min(c for c in packing.CAPACITIES if c >= b.used)
    assert held == counts
    words = sum(s * n for s, n in counts.items())
    assert words / sum(b.capacity * b.count for b in bins) > 0.9


def test_least_cost_capacity_is_opened():
    assert {b.capacity for b in packing.plan({500: 3})} == {512}
    assert {b.capacity for b in packing.plan({1500: 1})} == {2048}


@pytest.mark.parametrize("size, capacity, times", [(300, 1024, 3), (520, 2048, 3), (1030, 4096, 3)])
def test_one_length_opens_what_it_fills(size, capacity, times):
    bins = packing.plan({size: 3_000})
    assert [(b.capacity, b.count, b.sizes) for b in bins] == [(capacity, 1_000, ((size, times),))]
    # One left over does not keep a bin made for three.
    assert sorted(b.capacity for b in packing.plan({size: 4})) == [min(c for c in packing.CAPACITIES if c >= size), capacity]


def test_equal_bins_are_filled_one_by_one():
    bins = packing.plan({2096: 100, 500: 150}, (4096,))
    assert sorted((b.count, b.sizes) for b in bins) == [
        (1, ((2096, 1), (500, 2))), (37, ((2096, 1), (500, 4))), (62, ((2096, 1),))
    ]


def test_ranks_of_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(ranks, "ROWS_PER_PIECE", 10)
    rows = spark.range(2000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 5).alias("k"), F.xxhash64("id").alias("h"))
    got = ranks.ranked(rows, ["k"], "h").collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.k].append((r.h, r["rank"]))
    for members in by.values():
        # Pieces follow the unsigned order of the hash.
        members.sort(key=lambda x: x[0] % 2**64 >> 56)
        assert sorted(r for _, r in members) == list(range(len(members)))


def brute(vectors, query, k):
    (name, v), out = query, []
    for other, u in vectors:
        if other != name:
            out.append((math.sqrt(sum((a - b) ** 2 for a, b in zip(u, v))), other))
    return sorted(out)[:k]


def test_neighbours_recall_and_scores(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in frame.collect()}
    ids = np.array(sorted(rows))
    matrix = np.stack([rows[i] for i in ids])
    got = collections.defaultdict(list)
    for r in nearest.search(frame, F.col("vec_id") % 100 == 0).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((matrix - rows[q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 11))
        for _, v, s in mine:
            assert s == pytest.approx(float(np.sqrt(((rows[v] - rows[q]) ** 2).sum())), rel=1e-12)
        hits += len(set(best) & {v for _, v, _ in mine})
        total += 10
    assert hits / total >= 0.9


def test_neighbours_of_odd_vectors(spark):
    rows = [(i, [float(i % 7), 1.0, float(i)], 1) for i in range(20)]
    rows += [(100 + i, [5.0, 5.0, 5.0], 1) for i in range(30)]
    rows += [(100, [5.0, 5.0, 5.0], 1), (200, None, 1), (300, [0.0, 0.0, 0.0], 1), (400, [float("nan"), 1.0, 1.0], 1)]
    rows += [(500, [float("inf"), 1.0, 1.0], 1), (600, [None, 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0], 1), (700, [], 1)]
    rows += [(800, [1.0, 2.0], 1), (900, [-0.0, 1.0, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score int")
    usable = {i: v for i, v, _ in rows if i is not None and v and len(v) == 3 and i not in (300, 400, 500, 600)}
    got = collections.defaultdict(list)
    for r in nearest.search(frame, F.col("vec_id") % 100 == 0).collect():
        got[r.query_id].append((r["rank"], r.score, r.vec_id))
    assert set(got) == {0, 100, 900}
    for q, found in got.items():
        expected = brute(list(usable.items()), (q, usable[q]), 10)
        assert [(s, v) for _, s, v in sorted(found)] == expected


def test_few_and_no_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, [4.0, 2.0])], "vec_id bigint, embedding array<float>")
    got = nearest.search(frame, F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 1, 1.0), (2, 2, 3.0)]
    assert nearest.search(frame.where("vec_id < 0"), F.col("vec_id") == 0).collect() == []


def test_scan_abandons_and_keeps_the_nearest():
    rng = np.random.default_rng(0)
    v, q = rng.normal(size=(3000, 64)), rng.normal(size=(20, 64))
    a, b = nearest.adaptive_scan(q, v, 11, nearest.rotation(64))
    assert len(a) < 0.1 * 20 * 3000
    hits = 0
    for i in range(20):
        best = np.argsort(((v - q[i]) ** 2).sum(axis=1))[:11]
        hits += len(set(best) & set(b[a == i]))
    assert hits >= 0.95 * 220

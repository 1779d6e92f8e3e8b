"""Near-duplicates by SimHash, compared bit-sliced.

A text's fingerprint is the bitwise majority of its shingles' hashes. Two
fingerprints link when they differ in at most ``radius`` bits, and groups are
the connected components of those links, exactly: no link is missed.

Candidates come from the pigeonhole principle. The 64 bits are cut in
``radius + agree`` blocks; two linked fingerprints agree on at least ``agree``
of them, so they meet in one of the C(radius + agree, agree) tables keyed by
the bits of ``agree`` blocks. Inside a bucket the fingerprints are stored as
bit planes (one 64-bit word holds one bit of 64 fingerprints); a query flips
each plane and adds it to carry-save counters, so that one word operation
advances 64 distances, and words in which all 64 exceed the radius are dropped.

Equal fingerprints are merged first. A bucket larger than ``chunk`` is cut in
pieces that are compared pairwise in separate tasks. A bucket yields a spanning
forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.session import stage

SHINGLE = 4
RADIUS = 4
CHUNK = 4096
# Pairs of a query and a word of 64 candidates that are compared at once.
PAIRS_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text; 0 for a null text or one without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(joined, 42)], dtype=np.uint64)
    else:
        ends = list(accumulate(map(len, words), lambda at, n: at + n + 1))
        starts = [0, *(e + 1 for e in ends)]
        hashes = np.fromiter(
            (digest(joined[s:e], 42) for s, e in zip(starts, ends[shingle - 1 :])),
            dtype=np.uint64,
            count=len(words) - shingle + 1,
        )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without the text, with ``fingerprint`` as a signed bigint.

    The other columns are carried along and must not be called ``fingerprint``.
    """
    carried = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(carried)).cast(pa.binary())
            values = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in texts), dtype=np.uint64, count=batch.num_rows
            )
            columns = [batch.column(i) for i in range(len(carried))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values.view(np.int64))], [*carried, "fingerprint"])

    plain = docs.select(*carried, text_col)
    schema = docs.select(*carried, F.lit(0).cast("bigint").alias("fingerprint")).schema
    return plain.mapInArrow(run, schema)


def _exceeds(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is above the radius."""
    above, equal = over.copy(), ~over
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            equal &= counter[k]
        else:
            above |= equal & counter[k]
            equal &= ~counter[k]
    return above


def _near(planes: np.ndarray, valid: np.ndarray, queries: np.ndarray, words: np.ndarray, radius: int):
    """For (query value, word of 64 lanes) pairs: which pairs survive, and their linked lanes."""
    at = np.arange(len(queries))
    counter = [np.zeros(len(queries), np.uint64) for _ in range(max(1, radius.bit_length()))]
    over = np.zeros(len(queries), np.uint64)
    alive = valid[words]
    for step in range(0, 64, 8):
        for b in range(step, step + 8):
            flip = np.uint64(0) - ((queries >> np.uint64(b)) & np.uint64(1))
            carry = planes[b][words] ^ flip
            for k in range(len(counter)):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            over |= carry
        alive = valid[words] & ~_exceeds(counter, over, radius)
        keep = np.flatnonzero(alive)
        if len(keep) < 0.7 * len(at):
            at, queries, words, alive, over = at[keep], queries[keep], words[keep], alive[keep], over[keep]
            counter = [c[keep] for c in counter]
        if not len(at):
            break
    return at, alive


def _forest(group: np.ndarray, side: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """Row index of the smallest row each row is linked to, links being followed inside the rows given.

    Rows are sorted by group. ``side`` is 0 where a group is compared with
    itself; 1 and 2 mark two pieces that are compared with each other.
    """
    n = len(prints)
    label = np.arange(n)
    if not n:
        return label
    # Candidates (sides 0 and 2) are laid out in whole words of 64 lanes per group.
    rows = np.flatnonzero(side != 1)
    if not len(rows):
        return label
    _, first, sizes = np.unique(group[rows], return_index=True, return_counts=True)
    width = -(-sizes // 64)
    offset = np.concatenate([[0], np.cumsum(width)])
    which = np.repeat(np.arange(len(sizes)), sizes)
    lane = offset[which] * 64 + (np.arange(len(rows)) - first[which])
    row_at = np.full(offset[-1] * 64, -1, np.int64)
    row_at[lane] = rows
    padded = np.zeros(offset[-1] * 64, np.uint64)
    padded[lane] = prints[rows]
    pack = lambda bits: np.packbits(bits, bitorder="little").view(np.uint64)
    planes = np.stack([pack((padded >> np.uint64(b)) & np.uint64(1) != 0) for b in range(64)])
    valid = pack(row_at >= 0)
    # Queries are sides 0 and 1, against all words of their group.
    asking = np.flatnonzero(side != 2)
    names = group[rows][first]
    of = np.searchsorted(names, group[asking])
    known = (of < len(names)) & (names[np.minimum(of, len(names) - 1)] == group[asking])
    asking, of = asking[known], of[known]
    todo = np.concatenate([[0], np.cumsum(width[of])])
    start = 0
    while start < len(asking):
        stop = max(start + 1, int(np.searchsorted(todo, todo[start] + PAIRS_AT_ONCE, side="right")) - 1)
        reps = width[of[start:stop]]
        q = np.repeat(asking[start:stop], reps)
        w = np.repeat(offset[of[start:stop]] - (todo[start:stop] - todo[start]), reps) + np.arange(len(q))
        at, alive = _near(planes, valid, prints[q], w, radius)
        bits = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        pair, bit = np.nonzero(bits)
        a, b = q[at[pair]], row_at[w[at[pair]] * 64 + bit]
        differ = a != b
        a, b = a[differ], b[differ]
        while len(a):
            before = label.copy()
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            label = label[label]
            if np.array_equal(before, label):
                break
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
        start = stop
    while not np.array_equal(label, label[label]):
        label = label[label]
    return label


def _compare(radius: int):
    """Turn rows (bucket, piece, other, side, fingerprint) sorted by the first three into forest links."""

    def links(keys, sides, prints):
        change = np.any(keys[1:] != keys[:-1], axis=1)
        label = _forest(np.concatenate([[0], np.cumsum(change)]), sides, prints, radius)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(prints[moved].view(np.int64)), pa.array(prints[label[moved]].view(np.int64))], ["u", "v"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
            sides = batch.column(4).to_numpy(zero_copy_only=False).astype(np.int8)
            prints = batch.column(5).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            if held is not None:
                keys = np.concatenate([held[0], keys])
                sides = np.concatenate([held[1], sides])
                prints = np.concatenate([held[2], prints])
            # The last group may go on in the next batch.
            last = np.flatnonzero(np.any(keys != keys[-1], axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = (keys[cut:], sides[cut:], prints[cut:])
            if cut:
                yield links(keys[:cut], sides[:cut], prints[:cut])
        if held is not None and len(held[0]):
            yield links(*held)

    return run


def blocks_for(count: int, radius: int, chunk: int) -> int:
    """How many blocks must agree so that a bucket holds about ``chunk`` of ``count`` random fingerprints."""
    agree = 1
    while agree < 6 and count / 2 ** (64 * agree / (radius + agree)) > chunk:
        agree += 1
    return agree


def _table_keys(prints: Column, radius: int, agree: int) -> list[Column]:
    """One key per table: the bits of the agreeing blocks, other bits 0."""
    n = radius + agree
    edges = [round(64 * i / n) for i in range(n + 1)]
    masks = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(n)]
    keys = []
    for chosen in combinations(range(n), agree):
        mask = sum(masks[i] for i in chosen)
        keys.append(prints.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint")))
    return keys


def near_links(prints: DataFrame, radius: int = RADIUS, chunk: int = CHUNK, agree: int | None = None) -> DataFrame:
    """Links (u, v) between the distinct fingerprints in ``prints``, enough to connect what is connected."""
    if agree is None:
        agree = blocks_for(prints.count(), radius, chunk)
    keys = _table_keys(F.col("fingerprint"), radius, agree)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), k.alias("key")) for i, k in enumerate(keys)])
    rows = prints.select("fingerprint", F.explode(tables).alias("b")).select("b.t", "b.key", "fingerprint")
    large = rows.groupBy("t", "key").count().where(F.col("count") > chunk)
    pieces = large.select("t", "key", F.ceil(F.col("count") / chunk).cast("int").alias("pieces"))
    k = F.coalesce("pieces", F.lit(1))
    cut = rows.join(pieces, ["t", "key"], "left").select(
        "t", "key", "fingerprint", k.alias("pieces"), F.pmod(F.xxhash64("fingerprint"), k).cast("int").alias("own")
    )
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        "t",
        "key",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
        "fingerprint",
    )
    together = paired.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
    return together.mapInArrow(_compare(radius), "u bigint, v bigint").distinct()


def connected(links: DataFrame, label: str = "links") -> DataFrame:
    """``node, root`` for every node of ``links(u, v)``; the root is the smallest node reachable.

    Large-star and small-star steps in turn, each written to the shared folder,
    until the links no longer change. Every step is made of aggregates and joins.
    """

    def mark(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    links = stage(links.where("u <> v"), label)
    seen = mark(links)
    while True:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(low, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        links = stage(small, label)
        now = mark(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per document: ``doc_id, row_key, fingerprint, component_id``.

    ``component_id`` is the smallest id reachable over links, the document's own
    included; ``row_key`` is a hash of id and text. Null texts and texts without
    words have fingerprint 0. A null id is no candidate for the smallest id, so
    a group of null ids alone has a null ``component_id``. Repeated rows stay.
    Other columns of ``docs`` are not read.
    """
    plain = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"),
        F.col(text_col).alias("text"),
    )
    prints = stage(with_fingerprint(plain, "text", shingle), "fingerprints")
    firsts = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = connected(near_links(firsts.select("fingerprint"), radius, chunk))
    rooted = firsts.join(roots, firsts["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = rooted.join(names, "root").select("fingerprint", "component_id", "root")
    return prints.join(groups, "fingerprint").select("doc_id", "row_key", "fingerprint", "component_id", "root")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay when every group keeps its document of smallest id.

    Null ids come after all others; ties (repeated rows) keep one row. All columns
    of ``docs`` are returned unchanged, whatever their names.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    kept = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("kept")
    )
    keys = kept.select(F.col("kept.row_key").alias("__row_key")).distinct()
    named = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("__row_key"), F.struct("*").alias("__row"))
    once = Window.partitionBy("__row_key").orderBy(F.lit(0))
    return (
        named.join(keys, "__row_key", "left_semi")
        .withColumn("__n", F.row_number().over(once))
        .where("__n = 1")
        .select("__row.*")
    )

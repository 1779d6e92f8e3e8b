"""Approximate nearest neighbours by an adaptive scan of dimensions.

Vectors are grouped in lists around centroids fitted on a bounded sample. A
query probes its nearest lists, as many as the sample's own nearest neighbours
need for the wanted recall (in a sample neighbours lie farther away, so this
errs on the side of more lists). Inside a list the vectors are rotated by one
random orthogonal matrix and stored in blocks of columns; after each block the
partial distance, scaled to all dimensions, is compared with the distance that
still matters, and candidates that are very likely farther are abandoned. What
is left is measured exactly, in double precision, on the original vectors.

Equal vectors are searched once, as a class that knows its smallest ids, so a
vector that fills a third of the table is one candidate. A list longer than
PIECE is cut in pieces that are scanned in separate tasks. Every vector is in a
list. The lists' centroids and sizes are bounded and sent to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.samples import hash_sample
from riskloom.session import stage

NEIGHBOURS = 10
# Vectors that centroids and probes are fitted on (about), their components, and the lists, at most.
MOST_FITTED = 20_000
MOST_COMPONENTS = 4_000_000
MOST_LISTS = 4096
# Vectors of a list, about, and of a piece of a long list.
LIST = 512
PIECE = 2048
# Share of the sample's nearest neighbours that the probed lists must hold.
RECALL = 0.95
# Columns of a block, and how sure a test must be to abandon a candidate.
BLOCK = 16
SURE = 2.1
# Candidates measured in full after the first block, times the neighbours kept.
SEEDS = 4


def usable(vector: Column) -> Column:
    """Not null or empty, not zero, all components finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(width: int, seed: int = 31) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 13) -> np.ndarray:
    """k-means; an empty list keeps its centroid."""
    rng = np.random.default_rng(seed)
    lists = min(lists, len(sample))
    out = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        own = nearest_lists(sample, out, 1)[:, 0]
        counts = np.bincount(own, minlength=len(out))
        order = np.argsort(own, kind="stable")
        used = np.flatnonzero(counts)
        starts = np.concatenate([[0], np.cumsum(counts[used])[:-1]])
        out[used] = np.add.reduceat(sample[order], starts, axis=0) / counts[used, None]
    return out


def nearest_lists(x: np.ndarray, centers: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centers of each row, nearest first."""
    n = min(n, len(centers))
    out = np.empty((len(x), n), np.int64)
    norms = (centers**2).sum(axis=1)
    for at in range(0, len(x), 2048):
        d = norms - 2 * x[at : at + 2048] @ centers.T
        part = np.argpartition(d, n - 1, axis=1)[:, :n] if n < len(centers) else np.tile(np.arange(n), (len(d), 1))
        order = np.argsort(np.take_along_axis(d, part, axis=1), axis=1, kind="stable")
        out[at : at + 2048] = np.take_along_axis(part, order, axis=1)
    return out


def probes_for(sample: np.ndarray, centers: np.ndarray, neighbours: int, recall: float, asked: int = 400) -> int:
    """Lists to probe so that they hold ``recall`` of the nearest neighbours of sample rows in the sample."""
    if len(sample) <= neighbours + 1:
        return len(centers)
    own = nearest_lists(sample, centers, 1)[:, 0]
    norms, ranks = (sample**2).sum(axis=1), []
    for i in range(min(asked, len(sample))):
        d = norms - 2 * sample @ sample[i]
        d[i] = np.inf
        near = np.argpartition(d, neighbours)[:neighbours]
        order = np.empty(len(centers), np.int64)
        order[nearest_lists(sample[i : i + 1], centers, len(centers))[0]] = np.arange(len(centers))
        ranks.extend(order[own[near]])
    return int(np.quantile(ranks, recall, method="higher")) + 1


def adaptive_scan(queries: np.ndarray, vectors: np.ndarray, keep: int, turn: np.ndarray, sure: float = SURE) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, vector row) that may be among the ``keep`` nearest of a query in this list.

    After the first block the candidates of least partial distance, a few times
    ``keep``, are measured in full; the ``keep``-th of these bounds what still matters.
    """
    width = queries.shape[1]
    if len(vectors) <= keep:
        pair = np.indices((len(queries), len(vectors))).reshape(2, -1)
        return pair[0], pair[1]
    q, v = queries @ turn, vectors @ turn
    blocks = [slice(i, min(i + BLOCK, width)) for i in range(0, width, BLOCK)]
    v_blocks = [np.ascontiguousarray(v[:, b]) for b in blocks]
    q_blocks = [np.ascontiguousarray(q[:, b]) for b in blocks]
    partial = (
        (q_blocks[0] ** 2).sum(1)[:, None] + (v_blocks[0] ** 2).sum(1)[None, :] - 2 * q_blocks[0] @ v_blocks[0].T
    )
    tried = min(SEEDS * keep, len(v))
    seeds = np.argpartition(partial, tried - 1, axis=1)[:, :tried]
    full = ((q[:, None, :] - v[seeds]) ** 2).sum(axis=2)
    best = np.argpartition(full, keep - 1, axis=1)[:, :keep]
    bound = np.take_along_axis(full, best, axis=1).max(axis=1)
    seeds = np.take_along_axis(seeds, best, axis=1)
    seen = blocks[0].stop
    test = lambda n: (n / width) * (1 + sure / np.sqrt(n)) ** 2
    a, b = np.nonzero(partial <= bound[:, None] * (test(seen) if seen < width else 1) + 1e-9)
    so_far = partial[a, b]
    for block, qb, vb in zip(blocks[1:], q_blocks[1:], v_blocks[1:]):
        so_far = so_far + ((qb[a] - vb[b]) ** 2).sum(axis=1)
        seen = block.stop
        good = so_far <= bound[a] * (test(seen) if seen < width else 1) + 1e-9 * (1 + bound[a])
        a, b, so_far = a[good], b[good], so_far[good]
    # The seeds are candidates whatever the tests said.
    both = np.unique(np.concatenate([a * len(v) + b, np.repeat(np.arange(len(q)), keep) * len(v) + seeds.reshape(-1)]))
    return both // len(v), both % len(v)


def _scan_piece(keep: int, turn: np.ndarray):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy(bool)
        queries, vectors = pdf[asks], pdf[~asks]
        out = {"query": [], "class_id": [], "score": []}
        if len(queries) and len(vectors):
            v = np.array(vectors["vector"].tolist(), dtype=np.float64)
            names = vectors["class_id"].to_numpy(np.int64)
            for at in range(0, len(queries), 256):
                part = queries.iloc[at : at + 256]
                q = np.array(part["vector"].tolist(), dtype=np.float64)
                a, b = adaptive_scan(q, v, keep, turn)
                for i in range(0, len(a), 100_000):
                    exact = np.sqrt(((q[a[i : i + 100_000]] - v[b[i : i + 100_000]]) ** 2).sum(axis=1))
                    out["score"].append(exact)
                out["query"].append(part["class_id"].to_numpy(np.int64)[a])
                out["class_id"].append(names[b])
        frame = pd.DataFrame({k: np.concatenate([*v, np.zeros(0)]) for k, v in out.items()})
        frame = frame.sort_values(["query", "score", "class_id"])
        frame = frame[frame.groupby("query").cumcount() < keep]
        return frame.astype({"query": "int64", "class_id": "int64"})

    return run


def search(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    neighbours: int = NEIGHBOURS,
    recall: float = RECALL,
    most_fitted: int = MOST_FITTED,
    seed: int = 13,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the nearest vectors found for every query, nearest first.

    ``is_query`` is a condition on the column ``vec_id``. Vectors that are null,
    empty, zero or hold a null or non-finite component take no part, neither do
    null ids. Vectors are compared with those of the most frequent length (the
    smaller one on ties); others take no part. Rows that repeat id and vector
    count once; a row is no neighbour of a query of its own id. Ties go to the
    smaller id. An empty table returns no rows.
    """
    spark = vectors.sparkSession
    plain = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    plain = plain.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    # -0.0 equals 0.0, so equal vectors have equal hashes.
    plain = plain.withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))
    rows = stage(plain.distinct().withColumn("asks", F.coalesce(is_query, F.lit(False))), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    width = lengths["n"]
    rows = rows.where(F.size("vector") == width)
    keep = neighbours + 1
    # Classes of equal vectors, with the ids that can be among anyone's nearest.
    first = Window.partitionBy("vector").orderBy("vec_id")
    members = rows.withColumn("at", F.row_number().over(first)).where(F.col("at") <= keep)
    classes = stage(
        members.groupBy("vector").agg(F.min("vec_id").alias("class_id"), F.collect_list("vec_id").alias("members")),
        "vector-classes",
    )
    count = classes.count()
    lists = int(np.clip(count // LIST, 1, MOST_LISTS))
    most = min(most_fitted, max(1, MOST_COMPONENTS // width))
    chosen = hash_sample(classes.select("class_id", "vector"), "class_id", most, seed).toPandas()
    # A handful of vectors may all miss the share.
    if not len(chosen):
        chosen = classes.select("class_id", "vector").limit(1).toPandas()
    sample = np.array(chosen.sort_values("class_id")["vector"].tolist(), dtype=np.float64)
    centers = centroids(sample, lists, seed=seed)
    probes = probes_for(sample, centers, neighbours, recall)
    del sample

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            own = nearest_lists(x, centers, 1)[:, 0] if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own.astype(np.int32))], ["class_id", "vector", "list"])

    listed = stage(
        classes.select("class_id", "vector").mapInArrow(assign, "class_id bigint, vector array<double>, list int"), "lists"
    )
    sizes = np.zeros(len(centers), np.int64)
    for r in listed.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    pieces = np.maximum(1, -(-sizes // PIECE))
    # A class asks if any of its ids is a query, not only the smallest ones.
    asking = stage(rows.where("asks").select("vec_id", "vector"), "queries")
    asked = asking.groupBy("vector").agg(F.min("vec_id").alias("any"))
    named = asked.join(classes, "vector").select("class_id", "vector")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            if not len(x):
                continue
            near = nearest_lists(x, centers, len(centers))
            # More lists than asked for where those hold too few vectors.
            reached = np.cumsum(sizes[near], axis=1)
            enough = (np.arange(near.shape[1]) < probes) | (reached - sizes[near] < keep)
            who, where = np.nonzero(enough & (sizes[near] > 0))
            found = near[who, where]
            reps = pieces[found]
            who, found = np.repeat(who, reps), np.repeat(found, reps)
            piece = np.arange(len(who)) - np.repeat(np.cumsum(reps) - reps, reps)
            for at in range(0, len(who), 10_000):
                part = who[at : at + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(part)),
                        batch.column(1).take(pa.array(part)),
                        pa.array(found[at : at + 10_000].astype(np.int32)),
                        pa.array(piece[at : at + 10_000].astype(np.int32)),
                    ],
                    ["class_id", "vector", "list", "piece"],
                )

    fields = "class_id bigint, vector array<double>, list int, piece int"
    probing = named.mapInArrow(probe, fields).withColumn("asks", F.lit(True))
    cut = F.element_at(F.lit([int(p) for p in pieces]), F.col("list") + 1)
    stored = listed.withColumn("piece", F.pmod(F.xxhash64("class_id"), cut).cast("int")).withColumn("asks", F.lit(False))
    scanned = (
        probing.select("list", "piece", "asks", "class_id", "vector")
        .union(stored.select("list", "piece", "asks", "class_id", "vector"))
        .groupBy("list", "piece")
        .applyInPandas(_scan_piece(keep, rotation(width)), "query bigint, class_id bigint, score double")
    )
    best = Window.partitionBy("query").orderBy("score", "class_id")
    top = scanned.withColumn("at", F.row_number().over(best)).where(F.col("at") <= keep).select("query", "class_id", "score")
    near = top.join(classes.select("class_id", F.explode("members").alias("vec_id")), "class_id")
    ids = asking.join(classes.select("class_id", "vector"), "vector").select(
        F.col("vec_id").alias("query_id"), F.col("class_id").alias("query")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        ids.join(near.select("query", "vec_id", "score"), "query")
        .where("vec_id <> query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )

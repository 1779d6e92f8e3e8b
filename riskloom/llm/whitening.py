"""Whitening of embeddings by a bit-sliced scatter matrix.

Entries become integers. The sums of products of every two dimensions come from
bit planes: a block's entries, less their smallest value in the dimension, are
cut into bits, each bit of a dimension is packed over the rows into words, and
sum(x*y) is the sum of popcounts of ANDed planes, weighted by their powers of
two. Shift and totals are put right in whole numbers, so the scatter matrix is
exact and centred before a single rounding; its eigenvectors are the components.

Rows whose vector is null, empty, holds null or non-finite entries, or entries
of 2**56 and more (whose integers do not fit a long), take no part. Where
vectors have several lengths, those of the commonest length take part (the
longest of equally common ones). The fit list holds each distinct integer vector
once, so repeated rows change nothing. A component without variance has a null
``whitened``, and so has ``explained`` where nothing varies; a ``deviation`` beyond
a long is null. No rows give no rows. Null keys are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.session import stage
from riskloom.sources.csv_files import quoted

STEPS = 64
ORIGIN = 1_000_000
LIMIT = float(2**56)

# Entries per block; bounds the memory of the planes.
BLOCK_ENTRIES = 1 << 20

# Whole numbers travel as three limbs, which longs can add over any number of tasks.
LIMB = 40


def integers(vectors: DataFrame, vector: str = "embedding", carry: Sequence[str] = ("vec_id",)) -> DataFrame:
    """``row`` (the carried columns) and ``x`` (array of long) of the rows that take part."""
    entries = quoted(vector)
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < LIMIT))
    x = F.transform(entries, lambda c: F.floor(c.cast("double") * STEPS) + ORIGIN)
    rows = vectors.where(entries.isNotNull() & (F.size(entries) > 0)).where(fine)
    rows = rows.select(F.struct(*[quoted(c).alias(c) for c in carry]).alias("row"), x.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    return rows.where(F.size("x") == (most[0]["length"] if most else 0))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bit planes of non-negative columns: packed words, and dimension and bit of each plane."""
    rows, dimensions = y.shape
    bits = [int(m).bit_length() for m in y.max(axis=0)]
    words = -(-rows // 64)
    packed, of, power = [], [], []
    for p in range(max(bits, default=0)):
        has = [d for d in range(dimensions) if bits[d] > p]
        bit = np.packbits(((y[:, has] >> p) & 1).astype(np.uint8), axis=0)
        plane = np.zeros((len(has), words * 8), dtype=np.uint8)
        plane[:, : bit.shape[0]] = bit.T
        packed.append(plane.view(np.uint64))
        of += has
        power += [p] * len(has)
    order = np.lexsort((power, of))
    slices = np.concatenate(packed)[order] if packed else np.zeros((0, words), dtype=np.uint64)
    return slices, np.array(of, dtype=np.int64)[order], np.array(power, dtype=np.int64)[order]


def products(y: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of non-negative columns, as whole numbers."""
    slices, of, power = planes(y)
    total = len(slices)
    counts = np.zeros((total, total), dtype=np.int64)
    for p in range(total):
        counts[p, p:] = np.bitwise_count(slices[p] & slices[p:]).sum(axis=1, dtype=np.int64)
    counts = np.triu(counts) + np.triu(counts, 1).T
    small = 2 * int(power.max(initial=0)) + 2 + len(y).bit_length() < 62
    weight = (np.int64(1) << power) if small else np.array([1 << int(p) for p in power], dtype=object)
    weighted = (counts if small else counts.astype(object)) * weight[:, None] * weight[None, :]
    out = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    if total:
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        sums = np.add.reduceat(np.add.reduceat(weighted, starts, axis=0), starts, axis=1)
        out[np.ix_(of[starts], of[starts])] = sums.astype(object)
    return out


def scattered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of the columns and of products of all pairs of columns of a block."""
    least = x.min(axis=0)
    y = x - least
    low = least.astype(object)
    sums = np.array([sum(c.tolist()) for c in y.T], dtype=object)
    crossed = products(y) + np.outer(low, sums) + np.outer(sums, low) + len(x) * np.outer(low, low)
    return sums + len(x) * low, crossed


def limbs(value: int) -> tuple[int, int, int]:
    rest, low = divmod(value, 1 << LIMB)
    high, mid = divmod(rest, 1 << LIMB)
    return low, mid, high


def scatter(fit: DataFrame, dimensions: int) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums and sums of products of ``fit`` (column ``x``): a task sends one number per pair."""
    step = max(64, BLOCK_ENTRIES // dimensions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dimensions, dtype=object)
        crossed = np.zeros((dimensions, dimensions), dtype=object)
        for batch in batches:
            x = matrix(batch.column("x"), dimensions)
            for at in range(0, len(x), step):
                s, c = scattered(x[at : at + step])
                n, sums, crossed = n + len(x[at : at + step]), sums + s, crossed + c
        if n:
            cells = [(-1, -1, n), *((-1, i, int(sums[i])) for i in range(dimensions))]
            cells += [(i, j, int(crossed[i, j])) for i in range(dimensions) for j in range(i, dimensions)]
            parts = list(zip(*[(i, j, *limbs(v)) for i, j, v in cells]))
            yield pa.record_batch(
                [pa.array(parts[0], pa.int32()), pa.array(parts[1], pa.int32()), *[pa.array(p, pa.int64()) for p in parts[2:]]],
                names=["i", "j", "low", "mid", "high"],
            )

    cells = fit.select("x").mapInArrow(run, "i int, j int, low long, mid long, high long")
    found = {}
    for r in cells.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("low", "mid", "high")]).collect():
        found[r.i, r.j] = r.low + (r.mid << LIMB) + (r.high << 2 * LIMB)
    if not found:
        return 0, [], []
    crossed = [[found[min(i, j), max(i, j)] for j in range(dimensions)] for i in range(dimensions)]
    return found[-1, -1], [found[-1, i] for i in range(dimensions)], crossed


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: rows and sums of the fit list, components by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # dimensions x components
    scales: np.ndarray  # 1 / sqrt(eigenvalue); NaN where nothing varies
    explained: np.ndarray  # share of the trace; NaN where nothing varies

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, in longs where they suffice."""
        sums = np.array(self.sums, dtype=object)
        most = self.n * max(int(np.abs(x).max(initial=0)), 1) + max(abs(s) for s in self.sums)
        return x * self.n - (sums.astype(np.int64) if most < 2**62 else sums) if most < 2**62 else x.astype(object) * self.n - sums

    def projected(self, moved: np.ndarray) -> np.ndarray:
        return (moved.astype(np.float64) / self.n) @ (self.components * self.scales)


def decompose(n: int, sums: Sequence[int], crossed: Sequence[Sequence[int]], components: int) -> Whitening:
    """The eigenvectors of the covariance; an eigenvector's largest entry is positive."""
    size = len(sums)
    exact = [[n * crossed[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)]
    values, vectors = np.linalg.eigh(np.array([[v / (n * n) for v in row] for row in exact]))
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    trace = sum(exact[i][i] for i in range(size)) / (n * n)
    varies = values > size * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
    scales = np.where(varies, 1.0 / np.sqrt(np.where(varies, values, 1.0)), np.nan)
    explained = np.maximum(values, 0.0) / trace if trace > 0 else np.full(len(order), np.nan)
    return Whitening(n, tuple(sums), vectors * signs, scales, explained)


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """The largest difference between the covariance of the whitened fit list and the identity."""
    kept = np.flatnonzero(~np.isnan(model.scales))
    size, dimensions = len(kept), len(model.sums)
    if not size:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            w = model.projected(model.centred(matrix(batch.column("x"), dimensions)))[:, kept]
            w = np.column_stack([np.ones(len(w)), w])
            total += w.T @ w
        a, b = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield pa.record_batch([pa.array(a), pa.array(b), pa.array(total.ravel())], names=["a", "b", "v"])

    total = np.zeros((size + 1, size + 1))
    for r in fit.select("x").mapInArrow(run, "a int, b int, v double").groupBy("a", "b").agg(F.sum("v").alias("v")).collect():
        total[r.a, r.b] = r.v
    mean = total[0, 1:] / model.n
    return float(np.abs(total[1:, 1:] / model.n - np.outer(mean, mean) - np.eye(size)).max())


def fit_whitening(rows: DataFrame, components: int = 16) -> tuple[Whitening | None, float | None]:
    """The whitening of ``rows`` (column ``x`` of :func:`integers`) and its identity error; None without rows."""
    first = rows.select(F.size("x").alias("length")).first()
    if first is None:
        return None, None
    fit = stage(rows.select("x").distinct(), "whitening")
    n, sums, crossed = scatter(fit, first["length"])
    model = decompose(n, sums, crossed, components)
    return model, identity_error(fit, model)


def whiten(vectors: DataFrame, vector: str = "embedding", carry: Sequence[str] = ("vec_id",), components: int = 16) -> DataFrame:
    """One row per vector and component: ``row``, ``component`` (from 1), ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``.

    The scatter matrix, a number per pair of dimensions, is gathered by the
    driver; the fit list is staged and read twice, the vectors once more.
    """
    rows = integers(vectors, vector, carry)
    model, error = fit_whitening(rows, components)
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    fields = [T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([rows.schema["row"], *[T.StructField(c, f) for c, f in zip(names, fields)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None or not batch.num_rows:
                continue
            dimensions, k = len(model.sums), len(model.scales)
            moved = model.centred(matrix(batch.column("x"), dimensions))
            fits = moved.dtype != object and int(np.abs(moved).max()) ** 2 * dimensions < 2**63
            if fits:
                deviation = pa.array((moved * moved).sum(axis=1)).to_pylist()
            else:
                exact = (moved.astype(object) ** 2).sum(axis=1)
                deviation = [int(d) if d < 2**63 else None for d in exact]
            size = len(moved)
            each = np.repeat(np.arange(size), k)
            columns = [
                np.tile(np.arange(1, k + 1), size),
                np.full(size * k, model.n),
                None,
                model.projected(moved).ravel(),
                np.tile(model.explained, size),
                np.full(size * k, np.nan if error is None else error),
            ]
            arrays = [pa.array(c, kind, from_pandas=True) if c is not None else pa.array(deviation, kind).take(pa.array(each)) for c, kind in zip(columns, kinds)]
            yield pa.record_batch([batch.column("row").take(pa.array(each)), *arrays], names=["row", *names])

    return rows.mapInArrow(run, schema)

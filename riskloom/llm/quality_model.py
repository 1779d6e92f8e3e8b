"""Quality scores: random-indexing word vectors, pooled, and a small network.

Every word has a sparse random index vector, fixed by its hash. A word's vector
is the sum of the index vectors around it over all documents (words share
BUCKETS rows by hash, so the table has a fixed size). A document is the mean of
its words' vectors, with a few shape figures. A two-layer network is fitted on a
bounded sample of labelled documents; its temperature is set on a part of that
sample which did not train it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.samples import held_out, labelled_sample

BUCKETS = 1 << 14
WIDTH = 32
WINDOW = 2
# Labelled documents to fit on, about; all if there are fewer.
MOST_FITTED = 20_000
CACHED_WORDS = 300_000
# Tokens whose contexts are counted at once.
TOKENS_AT_ONCE = 1 << 20
EXTRA = 6

_TOKEN = re.compile(r"\w+|[^\w\s]")


def index_table() -> tuple[np.ndarray, np.ndarray]:
    """Two positions and two signs per bucket: its index vector."""
    rng = np.random.default_rng(97)
    where = rng.integers(0, WIDTH, (2, BUCKETS))
    return where, rng.choice(np.array([-1.0, 1.0]), (2, BUCKETS))


class Buckets(dict):
    """Bucket of a token, remembered. Numbers share one; so do words in capitals, and signs have their own."""

    def __missing__(self, token: str) -> int:
        if token.isdigit():
            name = "\x00number"
        elif len(token) > 1 and token.isupper():
            name = "\x00capitals"
        else:
            name = token.lower()
        if len(self) > CACHED_WORDS:
            self.clear()
        found = self[token] = xxhash.xxh64_intdigest(name.encode(), 3) % BUCKETS
        return found


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text or "")


def figures(text: str | None, found: list[str]) -> list[float]:
    """Shape of a document: size, repeats, capitals, signs, lines."""
    n = len(found)
    if not n:
        return [0.0] * EXTRA
    pairs = len(set(pairwise(found)))
    lines = text.split("\n")
    return [
        float(np.log1p(n)),
        len(set(found)) / n,
        pairs / max(1, n - 1),
        sum(1 for t in found if len(t) > 1 and t.isupper()) / n,
        sum(1 for t in found if not t[0].isalnum()) / n,
        1 - len(set(lines)) / len(lines),
    ]


def context_counts(docs: DataFrame) -> np.ndarray:
    """The word vectors (BUCKETS x WIDTH) from all texts of ``docs(text)``; unit length, zero for unused buckets."""
    columns = [f"c{i}" for i in range(WIDTH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, sign = index_table()
        # One more bucket stands between documents and takes part in nothing.
        where = np.concatenate([where, np.zeros((2, 1), np.int64)], axis=1)
        sign = np.concatenate([sign, np.zeros((2, 1))], axis=1)
        table = np.zeros((BUCKETS + 1) * WIDTH)
        bucket = Buckets()

        def add(ids: np.ndarray) -> None:
            for gap in range(1, WINDOW + 1):
                left, right = ids[:-gap], ids[gap:]
                for a, b in ((left, right), (right, left)):
                    for k in range(2):
                        spot = a * WIDTH + where[k][b]
                        table[:] += np.bincount(spot, sign[k][b], len(table))

        held: list[int] = []
        for batch in batches:
            for t in batch.column(0):
                found = tokens(t.as_py())
                for at in range(0, len(found), TOKENS_AT_ONCE):
                    held.extend(map(bucket.__getitem__, found[at : at + TOKENS_AT_ONCE]))
                    if len(held) >= TOKENS_AT_ONCE:
                        add(np.array(held, dtype=np.int64))
                        # The next stretch of a long text sees the words before it.
                        held = held[-WINDOW:] if at + TOKENS_AT_ONCE < len(found) else []
                held.extend([BUCKETS] * WINDOW)
        if len(held) > WINDOW:
            add(np.array(held, dtype=np.int64))
        whole = table.reshape(-1, WIDTH)[:BUCKETS].astype(np.int64)
        used = np.flatnonzero(whole.any(axis=1))
        for at in range(0, len(used), 4096):
            rows = used[at : at + 4096]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), *(pa.array(whole[rows, i]) for i in range(WIDTH))], ["bucket", *columns]
            )

    schema = "bucket bigint, " + ", ".join(f"{c} bigint" for c in columns)
    summed = docs.select("text").mapInArrow(run, schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns])
    found = summed.toPandas()
    out = np.zeros((BUCKETS + 1, WIDTH), np.float32)
    rows = found[columns].to_numpy(np.float64)
    out[found["bucket"].to_numpy(np.int64)] = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    return out


def pooled(texts: list[str | None], vectors: np.ndarray, bucket: Buckets) -> np.ndarray:
    """One row per text: the mean word vector and the figures; zeros for a text without tokens."""
    out = np.zeros((len(texts), WIDTH + EXTRA), np.float32)
    for i, text in enumerate(texts):
        found = tokens(text)
        if found:
            ids = np.fromiter(map(bucket.__getitem__, found), np.int64, len(found))
            counts = np.bincount(ids, minlength=0)
            used = np.flatnonzero(counts)
            out[i, :WIDTH] = counts[used] @ vectors[used] / len(found)
            out[i, WIDTH:] = figures(text, found)
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) / self.temperature, -30, 30)))


def _loss(raw: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, raw) - y * raw))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60, rate: float = 3e-3, batch: int = 128, seed: int = 9) -> Network:
    """Adam on four fifths of the rows, the temperature on the rest. One label only gives its constant rate."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    share = float((y.sum() + 0.5) / (len(y) + 1)) if n else 0.5
    bias = float(np.log(share / (1 - share)))
    mean = x.mean(axis=0) if n else np.zeros(d)
    scale = np.maximum(x.std(axis=0), 1e-3) if n else np.ones(d)
    net = Network(mean, scale, rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), np.zeros(hidden), bias)
    if n < 10 or y.min() == y.max():
        return net
    order = rng.permutation(n)
    check, train = order[: n // 5], order[n // 5 :]
    z = (x - mean) / scale
    weights = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    best, best_loss = None, np.inf
    for _ in range(epochs):
        rng.shuffle(train)
        for at in range(0, len(train), batch):
            rows = train[at : at + batch]
            h = np.tanh(z[rows] @ weights[0] + weights[1])
            p = 1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3][0], -30, 30)))
            error = (p - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - h * h)
            slopes = [z[rows].T @ back + 1e-4 * weights[0], back.sum(0), h.T @ error + 1e-4 * weights[2], np.array([error.sum()])]
            step += 1
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        raw = np.tanh(z[check] @ weights[0] + weights[1]) @ weights[2] + weights[3][0]
        if _loss(raw, y[check]) < best_loss:
            best, best_loss = [w.copy() for w in weights], _loss(raw, y[check])
    net.w1, net.b1, net.w2, net.b2 = best[0], best[1], best[2], float(best[3][0])
    raw = net.raw(x[check])
    net.temperature = float(min(np.geomspace(0.25, 8, 101), key=lambda t: _loss(raw / t, y[check])))
    return net


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_FITTED, seed: int = 9
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score``.

    Null and empty texts have a zero vector and the score of that. Scores depend
    on the text only; repeated rows have equal scores; a null id is not held out
    and has no label. Without labels all scores are 0.5.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    vectors = context_counts(plain)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Buckets()
        for batch in batches:
            found = pooled(batch.column(1).to_pylist(), vectors, bucket)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.astype("<f4").tobytes() for r in found], pa.binary()), batch.column(2)],
                ["doc_id", "x", "y"],
            )

    sample = labelled_sample(plain, labels, "quality", 4, 2, most, seed)
    key = sample.schema["doc_id"].dataType.simpleString()
    got = sample.mapInArrow(features, f"doc_id {key}, x binary, y int").toPandas().sort_values("doc_id")
    x = np.array([np.frombuffer(r, "<f4") for r in got["x"]], dtype=np.float64).reshape(-1, WIDTH + EXTRA)
    network = fit(x, got["y"].to_numpy(np.float64), seed=seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Buckets()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                p = network.score(pooled(part.column(2).to_pylist(), vectors, bucket).astype(np.float64))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(p)], ["doc_id", "held_out", "score"])

    rows = plain.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {key}, held_out boolean, score double")

"""Toxicity scores by a factorization machine over hashed terms.

A document is the set of its hashed terms: words, and the leading bytes of longer
words, since inflected forms share a stem. The machine adds a weight per term
and the product of two latent vectors per pair of terms, so that an insult next
to the mention of a group can weigh more than both alone. It is fitted on a
bounded sample of labelled documents, over the terms that are associated with
the label there; every document is then scored in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.licenses import words
from riskloom.llm.samples import held_out, labelled_sample
from riskloom.session import stage

# Labelled documents to fit on, about; all if there are fewer.
MOST_FITTED = 20_000
MOST_TERMS = 4096
CACHED_WORDS = 300_000


STEMS = (4, 5, 6)


def word_terms(word: bytes, digest=xxhash.xxh32_intdigest) -> list[int]:
    """32-bit hashes of a word and of its stems."""
    return [digest(word), *(digest(word[:n], n) for n in STEMS if len(word) > n)]


def terms(text: bytes | None) -> np.ndarray:
    """Distinct hashed terms of a text."""
    return np.unique(np.fromiter((h for w in set(words(text)) for h in word_terms(w)), dtype=np.uint32))


@dataclass
class FactorizationMachine:
    names: np.ndarray  # sorted hashes of the terms that count
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def score(self, index: list[np.ndarray]) -> np.ndarray:
        """Probabilities of documents given as arrays of positions in ``names``."""
        if not len(index):
            return np.zeros(0)
        owner = np.repeat(np.arange(len(index)), [len(x) for x in index])
        flat = np.concatenate([*index, np.zeros(0, np.int64)]).astype(np.int64)
        raw = self.bias + np.bincount(owner, self.weight[flat], len(index))
        v = self.factors[flat]
        for f in range(v.shape[1]):
            total = np.bincount(owner, v[:, f], len(index))
            raw += 0.5 * (total * total - np.bincount(owner, v[:, f] ** 2, len(index)))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def associated(sample: DataFrame, most: int = MOST_TERMS, least_z: float = 3.0, least_docs: int = 4) -> np.ndarray:
    """Sorted hashes of the terms whose share differs between the labels, the clearest ``most`` of them.

    ``sample`` has ``terms`` (array of int) and ``y``.
    """
    n, rate = sample.agg(F.count(F.lit(1)), F.avg("y")).first()
    if not n or rate in (0.0, 1.0):
        return np.zeros(0, np.uint32)
    spread = F.sqrt(F.col("n") * rate * (1 - rate))
    counted = (
        sample.select("y", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positive"))
        .where(F.col("n") >= least_docs)
        .withColumn("z", F.abs(F.col("positive") - F.col("n") * rate) / spread)
        .where(F.col("z") >= least_z)
    )
    chosen = counted.orderBy(F.desc("z"), "term").limit(most).select("term").collect()
    return np.sort(np.array([r["term"] for r in chosen], dtype=np.int32).view(np.uint32))


def fit(
    index: list[np.ndarray],
    y: np.ndarray,
    names: np.ndarray,
    factors: int = 4,
    epochs: int = 30,
    rate: float = 0.1,
    decay: float = 2e-4,
    batch: int = 256,
    seed: int = 5,
) -> FactorizationMachine:
    """Logistic loss, AdaGrad steps over shuffled batches; ``index`` has positions in ``names``.

    One label only gives its constant rate.
    """
    y = y.astype(np.float64)
    share = float((y.sum() + 0.5) / (len(y) + 1))
    bias = float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    m = FactorizationMachine(names, bias, np.zeros(len(names)), rng.normal(0, 0.05, (len(names), factors)))
    if not len(names):
        return m
    seen_w, seen_v, seen_b = np.full(len(names), 1e-6), np.full(m.factors.shape, 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            part = [index[i] for i in rows]
            error = (m.score(part) - y[rows]) / len(rows)
            owner = np.repeat(np.arange(len(rows)), [len(x) for x in part])
            flat = np.concatenate([*part, np.zeros(0, np.int64)]).astype(np.int64)
            v = m.factors[flat]
            total = np.stack([np.bincount(owner, v[:, f], len(rows)) for f in range(factors)], axis=1)
            slope = np.bincount(flat, error[owner], len(names)) + decay * m.weight
            steep = decay * m.factors
            push = error[owner][:, None] * (total[owner] - v)
            for f in range(factors):
                steep[:, f] += np.bincount(flat, push[:, f], len(names))
            seen_w += slope**2
            seen_v += steep**2
            seen_b += error.sum() ** 2
            m.weight -= rate * slope / np.sqrt(seen_w)
            m.factors -= 0.3 * rate * steep / np.sqrt(seen_v)
            m.bias -= rate * error.sum() / np.sqrt(seen_b)
    return m


def learn(
    docs: DataFrame, labels: DataFrame, most: int = MOST_FITTED, most_terms: int = MOST_TERMS, seed: int = 5, **options
) -> FactorizationMachine:
    """Fit on about ``most`` labelled documents that are not held out.

    Terms are chosen by an aggregate over the sample; the driver gets the chosen
    ones of each document.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(t.as_py()).view(np.int32) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int32())), batch.column(2)], ["doc_id", "terms", "y"]
            )

    sample = labelled_sample(docs, labels, "toxic", 5, 0, most, seed)
    key = sample.schema["doc_id"].dataType.simpleString()
    found = stage(sample.mapInArrow(find, f"doc_id {key}, terms array<int>, y int"), "labelled-terms")
    names = associated(found, most_terms)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(1):
                own = np.array(t.as_py(), dtype=np.int32).view(np.uint32)
                at = np.searchsorted(names, own)
                at, own = at[at < len(names)], own[at < len(names)]
                out.append(at[names[at] == own].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.list_(pa.int32())), batch.column(2)], ["doc_id", "terms", "y"]
            )

    chosen = found.mapInArrow(choose, f"doc_id {key}, terms array<int>, y int").toPandas().sort_values("doc_id")
    index = [np.asarray(t, dtype=np.int64) for t in chosen["terms"]]
    return fit(index, chosen["y"].to_numpy(np.float64), names, seed=seed, **options)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``doc_id, held_out, score``.

    Null and empty texts get the score of a document without known terms. Scores
    depend on the text only, so repeated rows have equal scores; a null id is
    not held out and has no label. Without labels all scores are 0.5.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    machine = learn(plain, labels, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {int(h): i for i, h in enumerate(machine.names)}
        at: dict[bytes, list[int]] = {}
        for batch in batches:
            index = []
            for t in batch.column(2).cast(pa.binary()):
                if len(at) > CACHED_WORDS:
                    at.clear()
                found = set()
                for w in set(words(t.as_py())):
                    own = at.get(w)
                    if own is None:
                        own = at[w] = [known[h] for h in word_terms(w) if h in known]
                    if own:
                        found.update(own)
                index.append(np.array(sorted(found), dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(machine.score(index))], ["doc_id", "held_out", "score"]
            )

    rows = plain.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "text")
    key = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {key}, held_out boolean, score double")

"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import crc_bucket


def held_out(key: Column, buckets: int, bucket: int) -> Column:
    """Whether a row is kept from learning; a null key is not."""
    return F.coalesce(crc_bucket(key, buckets) == bucket, F.lit(False))


def hash_sample(rows: DataFrame, key: str, most: int, seed: int) -> DataFrame:
    """About ``most`` rows, by a seeded hash of their key; all rows if there are no more."""
    share = most / max(1, rows.count())
    if share >= 1:
        return rows
    return rows.where(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, buckets: int, bucket: int, most: int, seed: int
) -> DataFrame:
    """``doc_id, text, y`` of about ``most`` labelled rows, or all if fewer, that are not held out.

    ``docs`` has ``doc_id`` and ``text``. An id is taken if its seeded hash is in
    the share that is wanted, so no sort is needed and the driver sees none of
    them. An id with several labels has their maximum; null ids and null labels
    are left out. The chosen ids, about ``most`` pairs of numbers, are broadcast,
    so the texts are filtered where they are read.
    """
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(~held_out(F.col("doc_id"), buckets, bucket))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("y"))
    )
    chosen = hash_sample(marks, "doc_id", most, seed)
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")

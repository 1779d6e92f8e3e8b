"""Small helpers of the text operators."""

from __future__ import annotations

from collections.abc import Callable

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The six ASCII blanks that part words, as a Java pattern.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once per row.

    A lambda that names an outer expression may evaluate it once per element;
    bound as a variable of an enclosing lambda it is computed once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text (runs of anything but ASCII blanks); none for null or blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS, -1))


def crc_bucket(key: Column, buckets: int) -> Column:
    """crc32 of the key as text, modulo ``buckets``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % buckets


def word_hash(word: bytes, hasher=xxhash.xxh64_intdigest) -> int:
    """XXH64 with seed 42, which equals Spark's xxhash64 of the same bytes (unsigned here)."""
    return hasher(word, 42)

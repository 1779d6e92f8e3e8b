"""Reproducible pseudo-random numbers derived from a key.

They depend on the key and the seed only, so a split stays the same after a
repartition, a retry or in another engine.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_number(key: Column, seed: int, digits: int = 8) -> Column:
    """The first ``digits`` hex digits of md5(key, seed) as a bigint."""
    text = F.concat(key.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")

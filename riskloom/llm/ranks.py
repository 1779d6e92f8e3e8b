"""Exact ranks inside groups of any size, without a task that holds a whole group."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

ROWS_PER_PIECE = 4_000


def ranked(rows: DataFrame, keys: list[str], hash_col: str) -> DataFrame:
    """``rows`` with ``rank``: the position from 0 by ``hash_col`` (a bigint hash) inside each group.

    Groups are cut at the leading bits of the hash, so many pieces that an even
    group of all rows has about ROWS_PER_PIECE in each; a piece is ranked by
    itself and moved by the counted rows of the pieces before it. ``rows`` is
    read twice and should be staged. Equal hashes are ranked in any order. Null
    keys form a group of their own; keys must not be called ``piece`` or ``rank``.
    """
    bits = min(30, max(1, math.ceil(math.log2(max(2, rows.count() / ROWS_PER_PIECE)))))
    pieces = rows.withColumn("piece", F.shiftrightunsigned(hash_col, 64 - bits))
    sizes = pieces.groupBy(*keys, "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy(*keys, "piece").orderBy(hash_col)
    placed = pieces.withColumn("at", F.row_number().over(inside))
    a, b = placed.alias("a"), starts.alias("b")
    same = F.col("a.piece") == F.col("b.piece")
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return a.join(b, same).select(
        *[F.col(f"a.{c}") for c in rows.columns], (F.col("b.first") + F.col("a.at") - 1).alias("rank")
    )

"""Mix sources to target weights by fitting subset sums.

Documents are counted by source and exact length. A source takes whole passes
over itself, then the rest of its budget is fitted on these counts: an even
share of every length, large lengths until a window remains, and a bounded
knapsack by dynamic programming over that window. Which documents of a length
are taken follows from a seeded hash. Only one row per source reaches the
driver; the counts of a source (one row per distinct length) are fitted in a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import words_of
from riskloom.llm.ranks import ranked
from riskloom.session import stage
from riskloom.sources.csv_files import quoted

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
# Words of the budget that the knapsack fits exactly, after even shares and large lengths.
WINDOW = 20_000


def targets(sizes: list[int], weights: list[float], most: float = MOST_TIMES) -> list[float]:
    """Words to take from each source: shares of the total by weight, at most ``most`` times its size.

    What exceeds a limit is shared again among the others by weight until none is above.
    """
    out = [0.0] * len(sizes)
    free = [i for i in range(len(sizes))]
    rest = float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if rest * weights[i] / total > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = rest * weights[i] / total
            break
        for i in over:
            out[i] = float(most * sizes[i])
        rest -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, window: int = WINDOW) -> np.ndarray:
    """How many documents of each size to take so that the words come to ``budget`` or just below.

    ``sizes`` are distinct and positive, ``counts`` are the documents there are.
    """
    sizes, counts = sizes.astype(np.int64), counts.astype(np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or not total:
        return np.zeros_like(counts)
    if budget >= total:
        return counts.copy()
    # Even shares in whole numbers; Python integers, since the products may pass 64 bits.
    take = np.array([int(n) * budget // total for n in counts], dtype=np.int64)
    rest = budget - int((sizes * take).sum())
    for i in np.argsort(-sizes):
        more = min(int(counts[i] - take[i]), max(0, rest - window) // int(sizes[i]))
        take[i] += more
        rest -= more * int(sizes[i])
    # Bounded knapsack over what is left: a count is split in powers of two, and
    # each reachable sum remembers the part that first reached it.
    reach = np.zeros(rest + 1, dtype=bool)
    reach[0] = True
    parts: list[tuple[int, int, int]] = []
    first = np.full(rest + 1, -1, dtype=np.int64)
    for i in np.argsort(-sizes):
        size, left = int(sizes[i]), min(int(counts[i] - take[i]), rest // int(sizes[i]))
        copies = 1
        while left > 0 and not reach[rest]:
            k = min(copies, left)
            weight = k * size
            if weight <= rest:
                fresh = np.zeros_like(reach)
                fresh[weight:] = reach[: rest + 1 - weight]
                fresh &= ~reach
                if fresh.any():
                    first[fresh] = len(parts)
                    reach |= fresh
                    parts.append((i, k, weight))
            left -= k
            copies *= 2
    at = int(np.flatnonzero(reach)[-1])
    while at:
        i, k, weight = parts[first[at]]
        take[i] += k
        at -= weight
    return take


def _fit_source(window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size")
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        passes = int(target / size + 1e-9) if size else 0
        real = (pdf["size"] > 0).to_numpy()
        take = np.zeros(len(pdf), dtype=np.int64)
        budget = round(target - passes * size)
        take[real] = fit_budget(pdf["size"].to_numpy()[real], pdf["n"].to_numpy()[real], budget, window)
        return pd.DataFrame({"sid": pdf["sid"], "size": pdf["size"], "passes": passes, "take": take})

    return run


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_TIMES,
    seed: int = 7,
    window: int = WINDOW,
    key: Column | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, row_key, size, source_size, target, copies``.

    ``size`` counts the words; null texts have 0. Sources in code-point order,
    null last, get the weights in turn. ``copies`` says how often the mix takes
    the document; documents without words are taken in whole passes only, and
    never when their source has no words. Repeated rows count each for itself.
    The per-source totals (one row per source) are collected.
    """
    hashed = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col), F.col(source_col))
    rows = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.size(words_of(F.col(text_col))).cast("bigint").alias("size"),
            (hashed if key is None else key).alias("row_key"),
            hashed.alias("h"),
        ),
        "sizes",
    )
    counts = stage(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "length-counts")
    per_source = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("s")).collect()
    ordered = sorted(per_source, key=lambda r: (r["source"] is None, r["source"] or ""))
    goals = targets([r["s"] for r in ordered], [weights[i % len(weights)] for i in range(len(ordered))], most)
    plan = rows.sparkSession.createDataFrame(
        [(i, r["source"], int(r["s"]), goals[i]) for i, r in enumerate(ordered)],
        "sid int, source string, source_size bigint, target double",
    )

    def named(df: DataFrame) -> DataFrame:
        same = df["source"].eqNullSafe(plan["source"])
        return df.join(plan, same).select(
            "sid", "source_size", "target", *[df[c] for c in df.columns if c != "source"]
        )

    fitted = named(counts).groupBy("sid").applyInPandas(
        _fit_source(window), "sid int, size bigint, passes bigint, take bigint"
    )
    placed = ranked(stage(named(rows), "named-sizes"), ["sid", "size"], "h")
    copies = F.col("passes") + F.when(F.col("rank") < F.col("take"), 1).otherwise(0)
    return placed.join(fitted, ["sid", "size"]).select(
        "doc_id", "row_key", "size", "source_size", "target", copies.cast("int").alias("copies")
    )


def row_identity(docs: DataFrame) -> Column:
    """Two 64-bit hashes of all columns and of where they are null; equal for equal rows only.

    A hash alone passes over nulls, so rows that differ by the place of a null would be one.
    """
    columns = [quoted(c) for c in docs.columns]
    holes = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    return F.struct(*[F.xxhash64(F.lit(salt), holes, *columns).alias(f"h{salt}") for salt in (1, 2)])


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them; all columns unchanged.

    No row comes more often than the limit of its source, rows that are equal in
    every column counting each for itself.
    """
    key = row_identity(docs)
    found = mix(docs, id_col, text_col, source_col, key=key, **options)
    times = found.groupBy("row_key").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    # Rows of one key are equal in every column; the copies are shared out among them.
    numbered = docs.select(key.alias("row_key"), F.struct("*").alias("__row"))
    joined = numbered.join(times.where("copies > 0"), "row_key")
    once = Window.partitionBy("row_key").orderBy(F.lit(0))
    single = joined.withColumn("__n", F.row_number().over(once)).where("__n = 1")
    return single.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("__row.*")

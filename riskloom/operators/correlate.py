"""Pearson correlations over the rows where both columns are present."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.sources.csv_files import quoted

AGGREGATES_PER_SCAN = 400


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The full matrix in long form ``(a, b, r)``; NULL where a column does not vary.

    A first scan takes mean, extent and missing cells of each column. The
    second sums products of centred values. A pair of complete columns needs
    one sum more; only pairs with missing cells take sums of their own.
    """
    columns = list(columns)
    first = _column_facts(df, columns)
    centred = {c: quoted(c).cast("double") - F.lit(first[c]["mean"]) for c in columns}

    scans: list[list[tuple[str, str]]] = [[]]
    used = 0
    for a, b in combinations(columns, 2):
        cost = 1 if first[a]["complete"] and first[b]["complete"] else 10
        if used + cost > AGGREGATES_PER_SCAN:
            scans.append([])
            used = 0
        scans[-1].append((a, b))
        used += cost

    parts = [_pairs(df, pairs, centred, first) for pairs in scans if pairs]
    diagonal = [(c, c, None if first[c]["constant"] else 1.0) for c in columns]
    out = df.sparkSession.createDataFrame(diagonal, "a string, b string, r double")
    for part in parts:
        out = out.unionByName(part)
    return out


def _column_facts(df: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        x = quoted(c).cast("double")
        aggs += [
            F.count(x).alias(f"n{i}"),
            F.avg(x).alias(f"m{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
        ]
    row = df.agg(*aggs).first()
    return {
        c: {
            "mean": row[f"m{i}"] if row[f"m{i}"] is not None else 0.0,
            "complete": row[f"n{i}"] == row["rows"],
            "constant": row[f"lo{i}"] == row[f"hi{i}"],
        }
        for i, c in enumerate(columns)
    }


def _pairs(df: DataFrame, pairs, centred: dict[str, Column], facts: dict[str, dict]) -> DataFrame:
    aggs: dict[str, Column] = {}
    names = {c: f"c{i}" for i, c in enumerate(centred)}
    rows = []
    for a, b in pairs:
        x, y, tag = centred[a], centred[b], f"{names[a]}_{names[b]}"
        aggs[f"xy_{tag}"] = F.sum(x * y)
        if facts[a]["complete"] and facts[b]["complete"]:
            for c in (a, b):
                aggs[f"s_{names[c]}"] = F.sum(centred[c])
                aggs[f"q_{names[c]}"] = F.sum(centred[c] * centred[c])
            aggs["n"] = F.count(F.lit(1))
            n = F.col("n")
            sx, qx = F.col(f"s_{names[a]}"), F.col(f"q_{names[a]}")
            sy, qy = F.col(f"s_{names[b]}"), F.col(f"q_{names[b]}")
            varies = F.lit(not (facts[a]["constant"] or facts[b]["constant"]))
        else:
            both = x.isNotNull() & y.isNotNull()
            aggs[f"n_{tag}"] = F.count(F.when(both, F.lit(1)))
            for side, v in (("x", x), ("y", y)):
                w = F.when(both, v)
                aggs[f"s{side}_{tag}"] = F.sum(w)
                aggs[f"q{side}_{tag}"] = F.sum(w * w)
                aggs[f"lo{side}_{tag}"] = F.min(w)
                aggs[f"hi{side}_{tag}"] = F.max(w)
            n = F.col(f"n_{tag}")
            sx, qx = F.col(f"sx_{tag}"), F.col(f"qx_{tag}")
            sy, qy = F.col(f"sy_{tag}"), F.col(f"qy_{tag}")
            varies = (F.col(f"lox_{tag}") < F.col(f"hix_{tag}")) & (F.col(f"loy_{tag}") < F.col(f"hiy_{tag}"))
        top = F.col(f"xy_{tag}") - F.try_divide(sx * sy, n)
        bottom = F.sqrt((qx - F.try_divide(sx * sx, n)) * (qy - F.try_divide(sy * sy, n)))
        r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(top, bottom)))
        r = F.when(varies & (bottom > 0), r)
        for left, right in ((a, b), (b, a)):
            rows.append(F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), r.alias("r")))
    totals = df.agg(*[e.alias(n) for n, e in aggs.items()])
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

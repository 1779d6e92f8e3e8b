"""Box-plot summaries, fences, outlier treatment and histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.numeric import count_where
from riskloom.functions.order_statistics import quantiles
from riskloom.operators.profile import per_column
from riskloom.sources.csv_files import quoted

MAX_CLASSES = 20


@dataclass(frozen=True)
class Fence:
    """Quartiles of one column and the limits 1.5 interquartile ranges outside them."""

    q1: float | None
    median: float | None
    q3: float | None

    @property
    def low(self) -> float | None:
        return None if self.q1 is None else self.q1 - 1.5 * (self.q3 - self.q1)

    @property
    def high(self) -> float | None:
        return None if self.q1 is None else self.q3 + 1.5 * (self.q3 - self.q1)


def fit_fences(df: DataFrame, columns: Sequence[str]) -> dict[str, Fence]:
    q = quantiles(df, {c: quoted(c) for c in columns})
    return {c: Fence(*q[c]) for c in columns}


def outlier_counts(df: DataFrame, fences: Mapping[str, Fence]) -> DataFrame:
    """Rows below and above the fences, with the quartiles that replace them."""

    def beyond(c: str, side: str) -> Column:
        f = fences[c]
        if f.q1 is None:
            return count_where(F.lit(False))
        return count_where(quoted(c) < f.low if side == "low" else quoted(c) > f.high)

    return per_column(
        df,
        list(fences),
        {
            "q1": lambda c: F.lit(fences[c].q1).cast("double"),
            "q3": lambda c: F.lit(fences[c].q3).cast("double"),
            "below": lambda c: beyond(c, "low"),
            "above": lambda c: beyond(c, "high"),
        },
        constants=("q1", "q3"),
    )


def treat_outliers(df: DataFrame, fences: Mapping[str, Fence]) -> DataFrame:
    """Values below the low fence become Q1, values above the high fence Q3."""

    def treated(c: str) -> Column:
        x, f = quoted(c).cast("double"), fences[c]
        if f.q1 is None:
            return x
        return F.when(x < f.low, F.lit(f.q1)).when(x > f.high, F.lit(f.q3)).otherwise(x)

    return df.withColumns({c: treated(c) for c in fences})


def classes_of(df: DataFrame, column: str, limit: int = MAX_CLASSES) -> list:
    """The distinct values of a class column; more than ``limit`` is an error.

    A class is an expression in one scan, so the limit, which callers may raise,
    bounds the size of the plan.
    """
    value = quoted(column)
    rows = df.filter(value.isNotNull()).select(value.alias("v")).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} classes")
    return sorted(r["v"] for r in rows)


def _by_class(df: DataFrame, columns: Sequence[str], by: str, max_classes: int):
    classes = classes_of(df, by, max_classes)
    return {(k, c): F.when(quoted(by) == k, quoted(c)) for k in classes for c in columns}


def _rows(df: DataFrame, series: Mapping, aggregates, fields) -> DataFrame:
    """One row per (class, column) from a single scan over class-restricted columns."""
    aggs, structs = [], []
    for i, (key, x) in enumerate(series.items()):
        named = {m: e.alias(f"{m}_{i}") for m, e in aggregates(key, x).items()}
        aggs += named.values()
        structs.append(fields(key, {m: F.col(f"{m}_{i}") for m in named}))
    return df.agg(*aggs).select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def box_summary(df: DataFrame, columns: Sequence[str], by: str, max_classes: int = MAX_CLASSES) -> DataFrame:
    """Quartiles, whiskers and outliers of each column per class.

    A whisker ends at the farthest value within 1.5 interquartile ranges.
    """
    series = _by_class(df, columns, by, max_classes)
    boxes = {k: Fence(*v) for k, v in quantiles(df, {k: x for k, x in series.items()}).items()}

    def aggregates(key, x: Column) -> dict[str, Column]:
        f = boxes[key]
        if f.q1 is None:
            none = F.first(F.lit(None).cast("double"))
            return {"lo": none, "hi": none, "out": count_where(F.lit(False))}
        inside = (x >= f.low) & (x <= f.high)
        value = F.when(inside, x.cast("double"))
        return {"lo": F.min(value), "hi": F.max(value), "out": count_where(~inside)}

    def fields(key, col: dict[str, Column]) -> Column:
        k, c = key
        f = boxes[key]
        return F.struct(
            F.lit(k).alias(by),
            F.lit(c).alias("column"),
            F.lit(f.q1).cast("double").alias("q1"),
            F.lit(f.median).cast("double").alias("median"),
            F.lit(f.q3).cast("double").alias("q3"),
            col["lo"].alias("whisker_low"),
            col["hi"].alias("whisker_high"),
            col["out"].alias("outliers"),
        )

    return _rows(df, series, aggregates, fields)


def five_numbers(df: DataFrame, column: str, by: str, max_classes: int = MAX_CLASSES) -> DataFrame:
    """Min, Q1, Median, Q3 and Max of a column per class, one row per figure."""
    series = _by_class(df, [column], by, max_classes)
    q = quantiles(df, series)

    def aggregates(key, x: Column) -> dict[str, Column]:
        return {"min": F.min(x).cast("double"), "max": F.max(x).cast("double")}

    def fields(key, col: dict[str, Column]) -> Column:
        figures = {"Min": col["min"], "Max": col["max"]}
        figures |= {n: F.lit(v).cast("double") for n, v in zip(("Q1", "Median", "Q3"), q[key])}
        stats = [F.struct(F.lit(n).alias("stat"), figures[n].alias("value"))
                 for n in ("Min", "Q1", "Median", "Q3", "Max")]
        return F.struct(F.lit(key[0]).alias(by), F.array(*stats).alias("stats"))

    return _rows(df, series, aggregates, fields).select(by, F.explode("stats").alias("s")).select(by, "s.*")


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Counts in equal-width bins over [min, max]; every bin appears, the last is closed.

    Each row also carries the mean of the column, the line drawn over the bars.
    """
    x = quoted(column).cast("double")
    low, high, mean = df.agg(F.min(x), F.max(x), F.avg(x)).first()
    low, high = (0.0, 1.0) if low is None else (low, high)
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins

    def edge(i: Column) -> Column:
        return F.lit(low) + i * F.lit(step)

    guess = F.least(F.lit(bins - 1), F.floor((x - F.lit(low)) / F.lit(high - low) * bins)).cast("int")
    guessed = df.filter(x.isNotNull()).select(x.alias("x"), guess.alias("g"))
    # The quotient can be off by one bin at an edge; the edges decide.
    g = F.col("g")
    bin_ = (
        F.when(F.col("x") < edge(g), g - 1)
        .when((F.col("x") >= edge(g + 1)) & (g < bins - 1), g + 1)
        .otherwise(g)
    )
    counts = guessed.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        frame.join(counts, "bin", "left")
        .select(
            "bin",
            edge(F.col("bin")).alias("low"),
            F.when(F.col("bin") == bins - 1, F.lit(high)).otherwise(edge(F.col("bin") + 1)).alias("high"),
            F.coalesce("count", F.lit(0)).alias("count"),
            F.lit(mean).cast("double").alias("mean"),
        )
    )

"""Descriptions of a table: counts, nulls, moments, quantiles, levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskloom.functions.numeric import count_where, ratio
from riskloom.functions.order_statistics import quantiles
from riskloom.sources.csv_files import quoted

TARGETS = ("PD", "LGD", "EAD")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def per_column(
    df: DataFrame, columns: Sequence[str], measures: dict, key: str = "column", constants: Sequence[str] = ()
) -> DataFrame:
    """One row per column from a single scan.

    ``measures`` maps a result field to a function from a column name to an
    aggregate, or to a plain value if the field is one of ``constants``.
    """
    aggs, structs = [], []
    for i, c in enumerate(columns):
        fields = [F.lit(c).alias(key)]
        for m, make in measures.items():
            if m in constants:
                fields.append(make(c).alias(m))
                continue
            aggs.append(make(c).alias(f"{m}_{i}"))
            fields.append(F.col(f"{m}_{i}").alias(m))
        structs.append(F.struct(*fields))
    return df.agg(*aggs).select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def columns_by_kind(df: DataFrame, exclude: Sequence[str] = TARGETS) -> DataFrame:
    """The columns with their type, kind (numeric, text, target or other) and non-missing cells."""
    return table_info(df, exclude).select("position", "column", "type", "kind", "non_null")


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    q = quantiles(df, {c: quoted(c) for c in columns})

    def constant(i: int):
        return lambda c: F.lit(q[c][i]).cast("double")

    return per_column(
        df,
        columns,
        {
            "count": lambda c: F.count(quoted(c)),
            "mean": lambda c: F.avg(quoted(c)),
            "std": lambda c: F.stddev_samp(quoted(c)),
            "min": lambda c: F.min(quoted(c)).cast("double"),
            "q25": constant(0),
            "q50": constant(1),
            "q75": constant(2),
            "max": lambda c: F.max(quoted(c)).cast("double"),
        },
        constants=("q25", "q50", "q75"),
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None, top: int | None = 15) -> DataFrame:
    """Missing cells per column, most first."""
    out = per_column(df, columns or df.columns, {"nulls": lambda c: count_where(quoted(c).isNull())})
    out = out.orderBy(F.desc("nulls"), "column")
    return out.limit(top) if top else out


def null_rates(df: DataFrame, columns: Sequence[str] | None = None, top: int | None = 15) -> DataFrame:
    """Share of missing cells per column, largest first."""
    out = per_column(
        df,
        columns or df.columns,
        {"null_rate": lambda c: ratio(count_where(quoted(c).isNull()).cast("double"), F.count(F.lit(1)))},
    )
    out = out.orderBy(F.desc("null_rate"), "column")
    return out.limit(top) if top else out


def table_info(df: DataFrame, exclude: Sequence[str] = TARGETS) -> DataFrame:
    """Column order, name, non-missing cells, type and kind."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    numeric, text = numeric_columns(df, exclude), text_columns(df, exclude)

    def kind(name: str) -> str:
        if name in exclude:
            return "target"
        return "numeric" if name in numeric else "text" if name in text else "other"

    position = {c: i for i, c in enumerate(df.columns)}
    return per_column(
        df,
        df.columns,
        {
            "position": lambda c: F.lit(position[c]),
            "non_null": lambda c: F.count(quoted(c)),
            "type": lambda c: F.lit(types[c]),
            "kind": lambda c: F.lit(kind(c)),
        },
        constants=("position", "type", "kind"),
    )


def shape(df: DataFrame) -> DataFrame:
    n = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(n).cast("bigint").alias("columns"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; missing cells are not counted."""
    value = quoted(column)
    return (
        df.filter(value.isNotNull())
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "value")
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Distinct non-missing values per column."""
    measure = F.count_distinct if exact else F.approx_count_distinct
    return per_column(df, columns, {"distinct": lambda c: measure(quoted(c))})


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows of both classes, positives per hundred negatives, and the default rate."""
    y = quoted(label)
    counted = df.agg(
        count_where(y == 1).alias("positives"),
        count_where(y == 0).alias("negatives"),
        F.avg(y).alias("default_rate"),
    )
    imbalance = 100 * ratio(F.col("positives").cast("double"), F.col("negatives"))
    return counted.select("positives", "negatives", imbalance.alias("imbalance_ratio_pct"), "default_rate")


def imbalance_by_column(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Non-missing cells of positive rows per hundred of negative rows, for each column."""
    y = quoted(label)

    def pct(c: str) -> Column:
        present = quoted(c).isNotNull()
        return 100 * ratio(count_where(present & (y == 1)).cast("double"), count_where(present & (y == 0)))

    return per_column(df, columns, {"imbalance_ratio_pct": pct})


def class_table(df: DataFrame, label: str, names: Sequence[str] = ("No Default", "Default")) -> DataFrame:
    """Class, rows and share of all rows; the name goes with the class value, not its rank."""
    y = quoted(label)
    counted = df.agg(
        count_where(y == 0).alias("n0"), count_where(y == 1).alias("n1"), F.count(y).alias("n")
    )
    rows = [
        F.struct(F.lit(name).alias("class"), F.col(n).alias("count"),
                 F.round(100 * ratio(F.col(n).cast("double"), F.col("n")), 2).alias("pct"))
        for name, n in zip(names, ("n0", "n1"))
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def headline(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Rows, number of features, default rate."""
    return df.agg(F.count(F.lit(1)).alias("total_loans"), F.avg(quoted(label)).alias("default_rate")).select(
        "total_loans", F.lit(len(features)).cast("bigint").alias("features"), "default_rate"
    )


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """The first rows by key."""
    return df.orderBy(key).limit(rows)

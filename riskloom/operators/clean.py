"""Cleaning: drops, fills, derived targets, filters and the by-key joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.numeric import ratio
from riskloom.operators.profile import text_columns
from riskloom.sources.csv_files import quoted

# Columns known only after the outcome.
LEAKAGE_COLUMNS = [
    "princ_rec",
    "interest_rec",
    "late_fees_rec",
    "paym_rec_for_tot_amnt_fund",
    "remaining_princ_for_tot_amnt_fund",
]

# Columns where a missing cell means none, so 0.
ZERO_FILL_COLUMNS = [
    "mths_since_recent_bankcard_delinq",
    "mths_since_recent_revol_delinq",
    "mths_since_last_delinq",
    "mths_since_last_installment_acc_op",
    "bal_to_cred_lim",
    "num_installment_acc_op_in_12mths",
    "num_installment_acc_op_in_24mths",
    "num_open_trades_in_6mths",
    "num_rev_trades_op_in_12mths",
    "max_bal_owed",
    "num_rev_trades_op_in_24mths",
    "num_inq",
]

LGD_LIMIT = 300.0


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"no such column: {', '.join(absent)}")


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop named columns; an absent one is an error, not silently passed over."""
    require_columns(df, columns)
    return df.drop(*columns)


def wide_text_columns(df: DataFrame, max_levels: int) -> list[str]:
    """Text columns with more than ``max_levels`` distinct values.

    One scan estimates all columns; only those whose estimate is near the limit
    are counted exactly, and these have few values to shuffle.
    """
    names = text_columns(df)
    if not names:
        return []
    row = df.agg(*[F.approx_count_distinct(quoted(c), 0.02).alias(f"n{i}") for i, c in enumerate(names)]).first()
    estimate = {c: row[f"n{i}"] for i, c in enumerate(names)}
    wide = [c for c in names if estimate[c] > 1.2 * max_levels]
    near = [c for c in names if 0.8 * max_levels < estimate[c] <= 1.2 * max_levels]
    if near:
        row = df.agg(*[F.count_distinct(quoted(c)).alias(f"n{i}") for i, c in enumerate(near)]).first()
        wide += [c for i, c in enumerate(near) if row[f"n{i}"] > max_levels]
    return [c for c in names if c in wide]


def drop_wide_text(df: DataFrame, max_levels: int) -> DataFrame:
    return df.drop(*wide_text_columns(df, max_levels))


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    require_columns(df, [old])
    return df.withColumnRenamed(old, new)


def fill_zero(df: DataFrame, columns: Sequence[str] = tuple(ZERO_FILL_COLUMNS)) -> DataFrame:
    require_columns(df, columns)
    return df.fillna(0, subset=list(columns))


def derive_lgd(df: DataFrame) -> DataFrame:
    """Largest balance owed as a percentage of the funded amount."""
    return df.withColumn("LGD", ratio(100 * F.col("max_bal_owed"), F.col("funded_amnt")))


def derive_ead(df: DataFrame) -> DataFrame:
    return df.withColumn("EAD", F.col("funded_amnt"))


def keep_bounded_lgd(df: DataFrame, limit: float = LGD_LIMIT) -> DataFrame:
    """Rows with an LGD strictly below ``limit``; a missing LGD is dropped."""
    return df.filter(F.col("LGD") < limit)


def defaulted(df: DataFrame, label: str = "PD") -> DataFrame:
    return df.filter(quoted(label) == 1)


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("loan_id", "PD", "LGD", "EAD")) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def join_by_key(
    features: DataFrame, target: DataFrame, key: str, strict: bool = False
) -> DataFrame:
    """All rows of both sides, matched on the key; the unmatched side is NULL.

    ``strict`` makes a differing number of rows an error.
    """
    if strict and features.count() != target.count():
        raise ValueError("features and target have different numbers of rows")
    return features.join(target, key, "full_outer")


def lookup(rows: DataFrame, loans: DataFrame, column: str, key: str = "loan_id") -> DataFrame:
    """Fetch ``column`` of the loans for the given rows by key."""
    return rows.join(loans.select(key, column), key, "inner")

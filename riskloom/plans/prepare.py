"""From raw loans to the cleaned and encoded table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from riskloom.operators.clean import (
    LEAKAGE_COLUMNS,
    ZERO_FILL_COLUMNS,
    derive_ead,
    derive_lgd,
    drop_columns,
    fill_zero,
    keep_bounded_lgd,
    rename,
)
from riskloom.operators.encode import MAX_LEVELS, Vocabulary, fit_vocabulary, one_hot
from riskloom.operators.profile import TARGETS, numeric_columns, text_columns
from riskloom.operators.spread import fit_fences, treat_outliers


def clean_loans(
    raw: DataFrame,
    label: str = "y",
    leakage: Sequence[str] | None = None,
    zero_fill: Sequence[str] | None = None,
    drop: Sequence[str] = ("emp_title",),
) -> DataFrame:
    """Drop what leaks, fill, derive LGD and EAD, keep LGD below its limit.

    Without lists of its own it uses those of the fixed lists that are present.
    The fill comes before the LGD: a loan without a balance has LGD 0.
    """
    present = set(raw.columns)
    leakage = [c for c in LEAKAGE_COLUMNS if c in present] if leakage is None else leakage
    zero_fill = [c for c in ZERO_FILL_COLUMNS if c in present] if zero_fill is None else zero_fill
    df = drop_columns(raw, list(leakage))
    df = rename(df, label, "PD")
    df = fill_zero(df, list(zero_fill))
    df = keep_bounded_lgd(derive_ead(derive_lgd(df)))
    return drop_columns(df, list(drop))


def encoded_loans(
    clean: DataFrame,
    key: str = "loan_id",
    vocabulary: Vocabulary | None = None,
    cap_outliers: bool = False,
    exclude_target_inputs: bool = False,
    null_category: bool = False,
    max_levels: int = MAX_LEVELS,
) -> DataFrame:
    """The table models are trained on: text columns become 0/1 columns.

    ``cap_outliers`` replaces values outside the fences by the quartiles;
    ``exclude_target_inputs`` drops the two columns LGD is computed from;
    ``null_category`` gives missing texts a column of their own; a text column
    with more than ``max_levels`` values is refused.
    """
    df = clean
    if cap_outliers:
        columns = [c for c in numeric_columns(df, TARGETS) if c != key]
        df = treat_outliers(df, fit_fences(df, columns))
    if vocabulary is None:
        vocabulary = fit_vocabulary(df, text_columns(df, [key]), max_levels)
    df = one_hot(df, vocabulary, null_category)
    if exclude_target_inputs:
        df = drop_columns(df, ["max_bal_owed", "funded_amnt"])
    return df

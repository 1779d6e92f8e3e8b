"""Train/test split and folds that depend on the key and the seed only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.keys import hash_number
from riskloom.functions.order_statistics import Survey, order_statistics, survey
from riskloom.operators.spread import MAX_CLASSES, classes_of
from riskloom.sources.csv_files import quoted

# 52 bits: as fine as a double can hold, so equal numbers are very rare.
RANK_DIGITS = 13


def is_test(key: str, seed: int = 42, one_in: int = 5) -> Column:
    """True for about one key in ``one_in``; needs no pass over the data. A missing key is not a test key."""
    return F.coalesce(hash_number(quoted(key), seed) % one_in == 0, F.lit(False))


def train_test_split(
    df: DataFrame, key: str = "loan_id", seed: int = 42, one_in: int = 5
) -> tuple[DataFrame, DataFrame]:
    test = is_test(key, seed, one_in)
    return df.filter(~test), df.filter(test)


def _groups(df: DataFrame, key: str, seed: int, stratify: str | None, max_classes: int = MAX_CLASSES) -> dict:
    """The hash number of the rows of each class, or of all rows."""
    number = hash_number(quoted(key), seed, RANK_DIGITS)
    if not stratify:
        return {"all": number}
    return {k: F.when(quoted(stratify) == k, number) for k in classes_of(df, stratify, max_classes)}


def _first_rows(df: DataFrame, key: str, groups: dict, cuts: dict, seen: Survey) -> dict:
    """For each wanted cut, the condition "among the first ``rank`` rows of its group".

    Rows are ordered by hash number, then by key. The cut number is found by
    counting, without a sort; keys matter only among rows with the cut number
    itself, hardly ever more than one.
    """
    ranks = {g: [r - 1 for r in rs if r > 0] for g, rs in cuts.items()}
    found = order_statistics(df, groups, ranks, seen)
    wanted = [(g, r, found[(g, r - 1)]) for g, rs in cuts.items() for r in rs if r > 0]
    sums = []
    for i, (g, _, v) in enumerate(wanted):
        sums.append(F.count(F.when(groups[g] < v, 1)).alias(f"u{i}"))
        sums.append(F.count(F.when(groups[g] == v, 1)).alias(f"a{i}"))
    row = df.agg(*sums).first() if sums else None
    conditions = {(g, r): F.lit(False) for g, rs in cuts.items() for r in rs}
    for i, (g, r, v) in enumerate(wanted):
        take = r - row[f"u{i}"]
        if take == row[f"a{i}"]:
            conditions[(g, r)] = groups[g] <= v
        else:
            ties = df.filter(groups[g] == v).select(quoted(key).alias("k")).orderBy("k")
            last = ties.limit(take).agg(F.max("k")).first()[0]
            conditions[(g, r)] = (groups[g] < v) | ((groups[g] == v) & (quoted(key) <= F.lit(last)))
    return conditions


def exact_train_test_split(
    df: DataFrame,
    key: str = "loan_id",
    seed: int = 42,
    test_share: float = 0.2,
    stratify: str | None = None,
    max_classes: int = MAX_CLASSES,
) -> tuple[DataFrame, DataFrame]:
    """A split with exactly ``ceil(test_share * n)`` test rows, per class if stratified."""
    groups = _groups(df, key, seed, stratify, max_classes)
    seen = survey(df, groups)
    cuts = {g: [math.ceil(test_share * seen.counts[g])] for g in groups}
    conditions = _first_rows(df, key, groups, cuts, seen)
    test = F.lit(False)
    for condition in conditions.values():
        test = test | F.coalesce(condition, F.lit(False))
    return df.filter(~test), df.filter(test)


def with_folds(
    df: DataFrame,
    folds: int = 2,
    key: str = "loan_id",
    seed: int = 42,
    stratify: str | None = None,
    name: str = "fold",
    max_classes: int = MAX_CLASSES,
) -> DataFrame:
    """Number rows 0 … folds-1 in random order; per class, fold sizes differ by one at most.

    The folds are the ``folds`` equal stretches of the rows ordered by hash.
    Only the cut numbers are looked for, so no class is brought to one task.
    """
    groups = _groups(df, key, seed, stratify, max_classes)
    seen = survey(df, groups)
    cuts = {g: [_stretch(seen.counts[g], folds, i) for i in range(1, folds)] for g in groups}
    conditions = _first_rows(df, key, groups, cuts, seen)
    fold: Column = F.lit(None).cast("int")
    for g, x in groups.items():
        inner: Column = F.lit(folds - 1)
        for i in range(folds - 1, 0, -1):
            inner = F.when(conditions[(g, cuts[g][i - 1])], i - 1).otherwise(inner)
        fold = F.when(x.isNotNull(), inner).otherwise(fold)
    return df.withColumn(name, fold)


def _stretch(n: int, folds: int, i: int) -> int:
    """Rows in the first ``i`` folds: the first ``n % folds`` folds have one row more."""
    return (n // folds) * i + min(i, n % folds)

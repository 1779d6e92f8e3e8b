import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import split as S


@pytest.fixture(scope="module")
def loans(spark):
    return spark.range(1003).select(
        F.col("id").alias("loan_id"), F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("PD")
    )


def ids(df):
    return sorted(r["loan_id"] for r in df.collect())


def test_split_is_disjoint_complete_and_stable(loans):
    train, test = S.train_test_split(loans)
    assert sorted(ids(train) + ids(test)) == list(range(1003))
    again = S.train_test_split(loans.repartition(7).orderBy(F.desc("loan_id")))[1]
    assert ids(test) == ids(again)
    assert 0.15 < len(ids(test)) / 1003 < 0.25
    assert ids(S.train_test_split(loans, seed=7)[1]) != ids(test)


# With one hex digit nearly all rows share their number, and keys decide.
@pytest.mark.parametrize("digits", [13, 1])
def test_exact_split(loans, digits, monkeypatch):
    monkeypatch.setattr(S, "RANK_DIGITS", digits)
    train, test = S.exact_train_test_split(loans)
    assert len(ids(test)) == math.ceil(0.2 * 1003)
    assert sorted(ids(train) + ids(test)) == list(range(1003))
    _, by_class = S.exact_train_test_split(loans, stratify="PD")
    n1 = loans.filter("PD = 1").count()
    assert by_class.filter("PD = 1").count() == math.ceil(0.2 * n1)
    assert by_class.filter("PD = 0").count() == math.ceil(0.2 * (1003 - n1))


@pytest.mark.parametrize("digits", [13, 1])
@pytest.mark.parametrize("folds", [2, 3, 5])
def test_folds(loans, digits, folds, monkeypatch):
    monkeypatch.setattr(S, "RANK_DIGITS", digits)
    for stratify, groups in ((None, ["PD >= 0"]), ("PD", ["PD = 0", "PD = 1"])):
        numbered = S.with_folds(loans, folds, stratify=stratify).cache()
        for g in groups:
            sizes = [r["count"] for r in numbered.filter(g).groupBy("fold").count().collect()]
            assert len(sizes) == folds and max(sizes) - min(sizes) <= 1
        moved = S.with_folds(loans.repartition(6), folds, stratify=stratify)
        assert moved.exceptAll(numbered).count() == 0


def test_a_row_without_a_key_is_not_lost(spark):
    from riskloom.operators.split import train_test_split

    df = spark.createDataFrame([(1,), (2,), (None,), (14,)], "loan_id bigint")
    train, test = train_test_split(df)
    assert train.count() + test.count() == 4 and test.filter("loan_id is null").count() == 0

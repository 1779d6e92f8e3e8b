"""Operators against small tables with worked answers."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import clean as C
from riskloom.operators import evaluate as E
from riskloom.operators import leaderboard as B
from riskloom.operators import loss as X
from riskloom.operators import profile as P
from riskloom.operators import spread as S
from riskloom.operators.correlate import correlation
from riskloom.operators.encode import fit_vocabulary, one_hot
from riskloom.operators.scale import feature_stage, fit_scale, scaled
from riskloom.plans.prepare import encoded_loans

near = lambda x: pytest.approx(x, abs=1e-6)


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_profile(ten_loans):
    got = by(P.numeric_profile(ten_loans, ["funded_amnt", "interest_rate"]), "column")
    f = got["funded_amnt"]
    assert f["count"] == 9
    assert (f["mean"], f["std"]) == (near(5666.666667), near(6344.288770))
    assert (f["min"], f["q50"], f["q75"], f["max"]) == (0, 4000, 8000, 20000)
    assert got["interest_rate"]["mean"] == near(20.888889)
    assert got["interest_rate"]["std"] == near(29.531527)


def test_null_counts_put_the_most_first(ten_loans):
    rows = P.null_counts(ten_loans, top=4).collect()
    assert [(r["column"], r["nulls"]) for r in rows] == [
        ("emp_length", 2), ("funded_amnt", 1), ("interest_rate", 1), ("max_bal_owed", 1),
    ]
    assert P.null_rates(ten_loans, top=1).first()["null_rate"] == 0.2


def test_balance_and_classes(ten_loans):
    r = P.class_balance(ten_loans, "y").first()
    assert (r["positives"], r["negatives"], r["default_rate"]) == (4, 6, 0.4)
    assert r["imbalance_ratio_pct"] == near(66.666667)
    assert [(c["class"], c["count"], c["pct"]) for c in P.class_table(ten_loans, "y").collect()] == [
        ("No Default", 6, 60.0), ("Default", 4, 40.0),
    ]


def test_value_counts_leave_missing_out(ten_loans):
    got = [(r["value"], r["count"]) for r in P.value_counts(ten_loans, "emp_length").collect()]
    assert got == [("10+ years", 3), ("2 years", 3), ("< 1 year", 2)]
    assert P.distinct_counts(ten_loans, ["emp_length"]).first()["distinct"] == 3


def test_lgd_and_filter(ten_loans, kept_loans):
    filled = C.derive_lgd(C.fill_zero(ten_loans, ["max_bal_owed"]))
    lgd = {r["loan_id"]: r["LGD"] for r in filled.collect()}
    assert lgd == {1: 50, 2: 0, 3: 100, 4: 200, 5: 25, 6: 300, 7: None, 8: None, 9: 300, 10: 5}
    assert sorted(r["loan_id"] for r in kept_loans.collect()) == [1, 2, 3, 4, 5, 10]


def test_absent_columns_are_errors(ten_loans):
    for act in (
        lambda: C.drop_columns(ten_loans, ["nothing"]),
        lambda: C.rename(ten_loans, "nothing", "x"),
        lambda: C.fill_zero(ten_loans, ["nothing"]),
    ):
        with pytest.raises(ValueError, match="nothing"):
            act()


def test_outlier_treatment(kept_loans):
    fences = S.fit_fences(kept_loans, ["interest_rate"])
    f = fences["interest_rate"]
    assert (f.q1, f.q3, f.low, f.high) == (7.5, 12.5, 0.0, 20.0)
    counts = S.outlier_counts(kept_loans, fences).first()
    assert (counts["below"], counts["above"]) == (0, 1)
    once = S.treat_outliers(kept_loans, fences)
    assert [r["interest_rate"] for r in once.orderBy("loan_id").collect()] == [5, 7, 9, 11, 13, 12.5]
    twice = S.treat_outliers(once, fences)
    assert twice.exceptAll(once).count() == 0


def test_one_hot(kept_loans):
    vocabulary = fit_vocabulary(kept_loans, ["emp_length"])
    assert vocabulary == {"emp_length": ["10+ years", "2 years", "< 1 year"]}
    wide = one_hot(kept_loans, vocabulary)
    assert wide.columns[-2:] == ["emp_length_2 years", "emp_length_< 1 year"]
    rows = by(wide, "loan_id")
    assert [tuple(list(rows[i].values())[-2:]) for i in (1, 2, 3, 4)] == [(0, 0), (0, 1), (0, 0), (1, 0)]
    assert one_hot(kept_loans, vocabulary, null_category=True).columns[-1] == "emp_length_nan"
    with pytest.raises(ValueError, match="more than 2"):
        fit_vocabulary(kept_loans, ["emp_length"], max_levels=2)


def test_unseen_category_is_all_zeros(kept_loans):
    wide = one_hot(kept_loans, {"emp_length": ["10+ years", "2 years"]})
    assert by(wide, "loan_id")[2]["emp_length_2 years"] == 0


def test_wide_text_columns(kept_loans):
    assert C.wide_text_columns(kept_loans, 2) == ["emp_length"]
    assert C.wide_text_columns(kept_loans, 3) == []


def test_encoded_options(kept_loans):
    assert "funded_amnt" not in encoded_loans(kept_loans, exclude_target_inputs=True).columns
    capped = encoded_loans(kept_loans, cap_outliers=True)
    assert capped.agg(F.max("interest_rate")).first()[0] == 13


def test_correlation(kept_loans, spark):
    r = {(x["a"], x["b"]): x["r"] for x in correlation(
        kept_loans, ["funded_amnt", "max_bal_owed", "interest_rate"]).collect()}
    assert r[("funded_amnt", "max_bal_owed")] == near(-0.108385838)
    assert r[("interest_rate", "funded_amnt")] == near(0.960018208)
    assert r[("max_bal_owed", "interest_rate")] == near(-0.212181935)
    assert r[("funded_amnt", "funded_amnt")] == 1.0 and len(r) == 9


def test_correlation_with_missing_cells_and_constants(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 0.1, None), (2.0, 4.5, 0.1, 1.0), (3.0, None, 0.1, 1.0), (4.0, 8.0, 0.1, 1.0), (9.0, 1.0, 0.1, None)],
        "a double, b double, c double, d double",
    )
    r = {(x["a"], x["b"]): x["r"] for x in correlation(df, ["a", "b", "c", "d"]).collect()}
    assert r[("a", "b")] == near(df.filter("b is not null").corr("a", "b"))
    # c is constant, d is constant where it is present
    assert r[("a", "c")] is None and r[("c", "c")] is None and r[("b", "d")] is None and r[("d", "d")] is None


def test_box_and_five_numbers(kept_loans):
    boxes = {(r["PD"], r["column"]): r for r in S.box_summary(kept_loans, ["interest_rate"], "PD").collect()}
    b = boxes[(0, "interest_rate")]  # 5, 7, 13, 99
    assert (b["q1"], b["median"], b["q3"]) == (6.5, 10.0, 34.5)
    assert (b["whisker_low"], b["whisker_high"], b["outliers"]) == (5, 13, 1)
    five = {(r["PD"], r["stat"]): r["value"] for r in S.five_numbers(kept_loans, "interest_rate", "PD").collect()}
    assert [five[(0, s)] for s in ("Min", "Q1", "Median", "Q3", "Max")] == [5, 6.5, 10, 34.5, 99]


def test_histogram(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.0, 5.0, 10.0)] + [(None,)], "x double")
    rows = S.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [3, 0, 1, 1]
    assert (rows[0]["low"], rows[3]["high"], rows[0]["mean"]) == (0, 10, 3.6)
    same = S.histogram(df.filter("x = 5"), "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in same] == [0, 0, 1, 0]


def test_scaling(spark):
    train = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0), (4.0, 7.0)], "x double, c double")
    fit = fit_scale(train, ["x", "c"])
    assert [r["x"] for r in scaled(train, fit).orderBy("x").collect()] == near(
        [-1.341641, -0.447214, 0.447214, 1.341641])
    new = spark.createDataFrame([(5.0, 9.0)], "x double, c double")
    assert tuple(scaled(new, fit).first()) == near((2.236068, 2.0))
    staged = feature_stage(["x", "c"], ["x_z", "c_z"], fit).transform(new).first()
    assert (staged["x_z"], staged["c_z"]) == near((2.236068, 2.0))


SWEEP = [  # threshold, tp, fp, fn, precision, recall, f1, flagged/actual
    (0.05, 4, 3, 0, 0.571, 1.0, 0.727, 1.75),
    (0.10, 3, 2, 1, 0.6, 0.75, 0.667, 1.25),
    (0.30, 2, 1, 2, 0.667, 0.5, 0.571, 0.75),
    (0.50, 1, 0, 3, 1.0, 0.25, 0.4, 0.25),
    (0.95, 0, 0, 4, 0.0, 0.0, 0.0, 0.0),
]


def test_sweep(eight_scores):
    ts = [s[0] for s in SWEEP]
    counts = E.threshold_counts(eight_scores, ts).orderBy("threshold").collect()
    assert [tuple(r) for r in counts] == [s[:4] for s in SWEEP]
    sweep = E.threshold_sweep(eight_scores, ts)
    assert [tuple(r) for r in sweep.orderBy("threshold").collect()] == [(s[0], *s[4:7]) for s in SWEEP]
    assert tuple(E.operating_point(sweep).first()) == (0.1, 0.6, 0.75, 0.667)
    assert E.choose_threshold(E.threshold_counts(eight_scores, ts), 0.7).first()["threshold"] == 0.1
    for t, *_, share in SWEEP:
        flagged = E.flagged(eight_scores, threshold=t)
        assert E.flagged_against_actual(flagged).first()["flagged_to_actual_ratio"] == share


def test_no_thresholds_mean_the_default(eight_scores):
    assert E.threshold_sweep(eight_scores, []).count() == 10
    recalls = [r["recall"] for r in E.threshold_sweep(eight_scores).orderBy("threshold").collect()]
    assert recalls == sorted(recalls, reverse=True)


def test_confusion_metrics_report(eight_scores):
    df = E.flagged(eight_scores, threshold=0.3)
    assert tuple(E.confusion(df).first()) == (3, 1, 2, 2)
    m = E.binary_metrics(df).first()
    assert tuple(m) == near((0.625, 2 / 3, 0.5, 4 / 7))
    rep = by(E.classification_report(df), "row")
    assert (rep["No Default"]["precision"], rep["No Default"]["recall"]) == near((0.6, 0.75))
    assert rep["accuracy"]["f1"] == 0.625 and rep["accuracy"]["support"] == 8
    assert rep["macro avg"]["recall"] == near(0.625)
    assert rep["weighted avg"]["precision"] == near((0.6 * 4 + 2 / 3 * 4) / 8)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(10.0, 12.0), (20.0, 18.0), (30.0, 33.0), (40.0, 36.0)], "LGD double, lgd_hat double")
    assert tuple(E.regression_metrics(df).first()) == near((2.75, 2.872281, 0.934))
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "LGD double, lgd_hat double")
    assert E.regression_metrics(flat).first()["r2"] == 1.0
    assert E.regression_metrics(flat.withColumn("lgd_hat", F.lit(2.0))).first()["r2"] == 0.0
    assert E.regression_metrics(flat.limit(1)).first()["r2"] is None


def test_expected_loss(spark):
    df = spark.createDataFrame(
        [(1, 0.1, 50.0, 1000.0), (2, 0.5, -10.0, 2000.0), (3, 0.9, 150.0, 3000.0), (4, 0.2, 100.0, 4000.0)],
        "loan_id bigint, p double, lgd_hat double, EAD double",
    )
    el = X.expected_loss(df)
    assert [r["el"] for r in el.orderBy("loan_id").collect()] == near([50, 0, 2700, 800])
    assert tuple(X.loss_summary(el).first()) == near((10000, 3550, 0.355, 0))
    assert tuple(X.summary_texts(X.loss_summary(el)).first()) == ("$10,000.00", "$3,550.00", "35.50%")
    parts = by(X.composition(el), "part")
    assert parts["Safe Capital"]["amount"] == near(6450) and parts["Expected Loss"]["share_pct"] == near(35.5)
    top = X.riskiest(el, 2).collect()
    assert [(r["loan"], r["el_pct"]) for r in top] == [("L-3", 90.0), ("L-4", 20.0)]
    unknown = X.expected_loss(df.withColumn("lgd_hat", F.lit(None).cast("double")))
    assert unknown.first()["el"] is None


def test_leaderboard_choices(spark):
    board = spark.createDataFrame(
        [("b", 0.8, 1.0), ("a", 0.8, 3.0), ("c", 0.7, 9.0)], "model string, roc_auc double, mae double"
    )
    assert B.best_model(board, "roc_auc").first()["model"] == "a"
    assert B.best_model(board, "roc_auc", order=["b", "a", "c"]).first()["model"] == "b"
    assert B.below(board, "mae", 5).count() == 2
    best = by(B.best_per_measure(board, largest=["roc_auc"], smallest=["mae"]), "measure")
    assert (best["roc_auc"]["best"], best["mae"]["best"], best["mae"]["value"]) == ("a", "b", 1.0)


def test_join_by_key(spark):
    x = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "loan_id int, x string")
    y = spark.createDataFrame([(1, 0), (2, 1)], "loan_id int, y int")
    got = by(C.join_by_key(x, y, "loan_id"), "loan_id")
    assert got[3]["y"] is None and len(got) == 3
    with pytest.raises(ValueError):
        C.join_by_key(x, y, "loan_id", strict=True)


def test_a_missing_prediction_makes_the_totals_unknown(spark):
    df = spark.createDataFrame([(100.0, 5.0), (900.0, None)], "EAD double, el double")
    assert tuple(X.loss_summary(df).first()) == (1000.0, None, None, 1)


def test_an_empty_table_keeps_names_and_types(spark):
    from riskloom.operators import profile

    empty = spark.createDataFrame([], "a int, b string")
    rows = [tuple(r) for r in profile.table_info(empty).orderBy("position").collect()]
    assert [r[:2] for r in rows] == [("a", 0), ("b", 1)] and {r[3] for r in rows} == {"int", "string"}
    assert tuple(profile.shape(empty).first()) == (0, 2)

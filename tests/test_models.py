import json

import pytest
from compare import TABLES
from pyspark.sql import functions as F

from riskloom.operators import training as M
from riskloom.operators.leaderboard import lgd_leaderboard, pd_leaderboard
from riskloom import session
from riskloom.plans.catalog import FILL, clean
from riskloom.plans.credit_run import credit_run, prepare_training
from riskloom.plans.jobs import load_cleaned, prepare_job, profile_job, run_job
from riskloom.plans.prepare import encoded_loans
from riskloom.session import stage

FEW = {
    M.GBT: {"n_estimators": 5, "max_depth": 3},
    M.FOREST: {"n_estimators": 10, "max_depth": 8},
    M.TREE: {"max_depth": 8},
}


@pytest.fixture(scope="module")
def encoded(spark):
    return stage(encoded_loans(stage(clean(spark, TABLES), "clean")), "encoded")


@pytest.fixture(scope="module")
def data(encoded):
    return prepare_training(encoded, fill=FILL)


def test_features_are_scaled_for_pd_only(data):
    from pyspark.ml.functions import vector_to_array

    x = data.pd_train.select(vector_to_array("features")[0].alias("x"))
    m, s = x.agg(F.avg("x"), F.stddev_pop("x")).first()
    assert m == pytest.approx(0, abs=1e-9) and s == pytest.approx(1)
    raw = data.lgd_train.join(data.train, "loan_id").select(vector_to_array("features")[0].alias("x"), "funded_amnt")
    assert raw.filter("x <> funded_amnt").count() == 0
    assert data.pd_train.join(data.pd_test, "loan_id").count() == 0


def test_pd_models(data):
    fitted = M.fit_default(data.pd_train, "pd", params=FEW)
    scores = M.pd_scores(fitted, data.pd_test, ["loan_id", "PD"])
    n = data.pd_test.count()
    assert scores.count() == 4 * n
    assert scores.filter("p < 0 or p > 1 or p is null").count() == 0
    board = pd_leaderboard(scores).collect()
    assert [r["model"] for r in board] == [
        r["model"] for r in sorted(board, key=lambda r: (-r["roc_auc"], r["model"]))
    ]
    assert max(r["roc_auc"] for r in board) > 0.5


def test_lgd_trees_beat_the_line(data):
    fitted = M.fit_default(data.lgd_train, "lgd", params={**FEW, M.GBT: {"n_estimators": 10}})
    mae = {r["model"]: r["mae"] for r in lgd_leaderboard(
        M.lgd_scores(fitted, data.lgd_test, ["loan_id", "LGD"])).collect()}
    assert len(mae) == 4 and mae[M.TREE] < mae[M.OLS] and mae[M.FOREST] < mae[M.OLS]


def test_parameters():
    assert {n: len(M.grid_points(g)) for n, g in M.PD_GRIDS.items()} == {M.GBT: 18, M.LOGISTIC: 8, M.FOREST: 8, M.TREE: 12}
    assert {n: len(M.grid_points(g)) for n, g in M.LGD_GRIDS.items()} == {M.GBT: 18, M.FOREST: 8, M.TREE: 12}
    for asked in ({"min_samples_split": 2}, {"solver": "saga"}):
        with pytest.raises(ValueError, match="no counterpart"):
            M.classifier(M.FOREST, 10, **asked)
    with pytest.raises(ValueError, match="no parameter"):
        M._spark_params(M.FOREST, {"leaves": 3}, 10)
    with pytest.raises(ValueError, match="no PD model"):
        M.classifier(M.GBT, 10)


def test_parameter_mapping(spark):
    deep = M.classifier(M.FOREST, 1000, max_depth=None, min_samples_leaf=4)
    assert (deep.getMaxDepth(), deep.getMinInstancesPerNode()) == (30, 4)
    # What is asked for is fitted, however many rows there are.
    for rows in (10, 10**7, 2**40):
        for leaf in (1, 4):
            for make in (M.classifier, M.regressor):
                assert make(M.FOREST, rows, min_samples_leaf=leaf).getMinInstancesPerNode() == leaf
    assert not M.regressor(M.FOREST, 10**3, cache_node_ids=False).getCacheNodeIds()
    assert M.regressor(M.FOREST, 10**3).getFeatureSubsetStrategy() == "all"


def test_grid_search(data):
    grids = {M.TREE: {"max_depth": [2, 6]}, M.LOGISTIC: {"C": [0.01, 1.0], "penalty": ["l2"]}}
    found = M.grid_search(data.pd_train, "pd", grids)
    assert set(found) == set(grids)
    assert set(found[M.TREE].params) == {"max_depth"} and 0 < found[M.TREE].score < 1
    table = {r["model"]: r for r in M.search_table(data.pd_train, found).collect()}
    assert json.loads(table[M.LOGISTIC]["best_params"]["penalty"]) == "l2"
    assert set(found[M.LOGISTIC].params) == {"C", "penalty"} and found[M.LOGISTIC].candidates == 2
    lgd = M.grid_search(data.lgd_train, "lgd", {M.TREE: {"max_depth": [1, 8]}})
    assert lgd[M.TREE].params == {"max_depth": 8} and lgd[M.TREE].score > 0


def test_numbers_of_trees_are_judged_by_prefixes(data):
    """A search over numbers of trees scores each as a search of that number alone does."""
    few = {M.GBT: {"learning_rate": [0.1, 0.3], "max_depth": [3], "n_estimators": [2, 5]}, M.FOREST: {"n_estimators": [3, 8], "max_depth": [4]}}
    whole = M.fit_models(data.lgd_train, "lgd", [M.GBT], {M.GBT: {"n_estimators": 4}}, few)
    assert whole.searches[M.GBT].candidates == 4 and whole.searches[M.FOREST].candidates == 2
    alone = [
        M.grid_search(data.lgd_train, "lgd", {M.GBT: {"learning_rate": [rate], "max_depth": [3], "n_estimators": [n]}})[M.GBT]
        for rate in (0.1, 0.3) for n in (2, 5)
    ]
    best = min(alone, key=lambda s: s.score)
    assert whole.searches[M.GBT].params == best.params and whole.searches[M.GBT].score == pytest.approx(best.score, rel=1e-9)
    assert whole.searches[M.GBT].model.getNumTrees == best.params["n_estimators"] + 1  # the start is a tree of its own
    assert whole.base[M.GBT].getNumTrees == 5
    assert whole.searches[M.FOREST].model.getNumTrees == whole.searches[M.FOREST].params["n_estimators"]


def test_fit_does_not_depend_on_the_partitioning(data):
    few = {M.FOREST: {"n_estimators": 5, "max_depth": 6}, M.GBT: {"n_estimators": 3}}
    scores = []
    for n in (1, 3):
        fitted = M.fit_default(data.pd_train.repartition(n), "pd", [M.FOREST, M.GBT], few)
        rows = M.pd_scores(fitted, data.pd_test, ["loan_id"]).orderBy("loan_id", "model").collect()
        scores.append([r["p"] for r in rows])
    assert scores[0] == scores[1]


def test_bounded_rows(data):
    n = data.pd_train.count()
    some = M.bounded_rows(data.pd_train, "loan_id", n // 2)
    assert 0.35 * n < some.count() < 0.65 * n
    assert M.bounded_rows(data.pd_train, "loan_id", n) is data.pd_train
    assert M.bounded_rows(data.pd_train, "loan_id", None) is data.pd_train


def test_any_feature_name_will_do(spark):
    from riskloom.operators.scale import fit_scale

    names = ["a.b", "c `d`", "St. x"]
    rows = spark.createDataFrame([(i, i % 2, float(i), 2.0 * i, 1.0) for i in range(20)], "loan_id int, PD int, x double, y double, z double")
    df = rows.toDF("loan_id", "PD", *names)
    for scale in (None, fit_scale(df, names)):
        features = M.assemble(names, scale)
        model = M.fit_default(features.transform(df), "pd", [M.TREE], {M.TREE: {"max_depth": 2}})[M.TREE]
        assert M.pd_scores({M.TREE: model}, features.transform(df), ["loan_id"]).count() == 20


def test_missing_features_are_refused_or_filled(encoded):
    open_ = encoded.withColumn("num_inq", F.when(F.col("loan_id") % 7 != 0, F.col("num_inq")))
    with pytest.raises(ValueError, match="num_inq"):
        prepare_training(open_, fill=FILL)
    assert prepare_training(open_, fill={**FILL, "num_inq": 1}).train.filter("num_inq is null").count() == 0


def test_exact_and_stratified_split_of_a_run(encoded):
    data = prepare_training(encoded, fill=FILL, stratify="PD")
    for k in (0, 1):
        n = encoded.filter(F.col("PD") == k).count()
        assert data.pd_test.filter(F.col("PD") == k).count() == -(-n // 5)


@pytest.mark.parametrize("select_by", ["test", "cv"])
def test_run(encoded, select_by):
    grids = {M.TREE: {"max_depth": [3, 6]}}
    run = credit_run(encoded, pd_grids=grids, lgd_grids=grids, select_by=select_by, params=FEW, fill=FILL)
    total, loss, share, unscored = run.summary.first()
    assert unscored == 0
    assert run.pd_base_board.count() == 4 and run.lgd_base_board.count() == 4
    assert run.pd_report.filter("model = 'Decision Tree'").count() == 5 and run.pd_confusion.count() == 1
    assert run.flagged.first()["flagged"] == run.scored.filter("p >= 0.1").count()
    sums = run.scored.agg(F.sum("EAD"), F.sum("el")).first()
    assert (total, loss) == pytest.approx(tuple(sums)) and share == pytest.approx(loss / total)
    assert run.scored.filter("el < 0 or el > EAD * p + 1e-9").count() == 0
    meta = run.metadata.first()
    assert len(run.metadata.columns) == 20
    assert (meta["pd_model"], meta["pd_threshold"], meta["positive_class"]) == (M.TREE, 0.1, 1)
    assert meta["expected_loss_pct"] == round(share, 4)
    if meta["lgd_model"] == M.OLS:
        assert meta["lgd_best_params"] == {}


def scratch_files(spark):
    """The folders that are staged at the moment."""
    from pathlib import Path

    return {p.name for p in Path(session.scratch_dir(spark), "riskloom").glob("*")}


def test_jobs(spark, tmp_path):
    from riskloom.sources.csv_files import write_csv
    from riskloom.sources.tables import raw_loans

    raw = stage(raw_loans(spark, TABLES), "raw")
    before = scratch_files(spark)
    write_csv(raw.drop("y").orderBy("loan_id").drop("loan_id"), str(tmp_path / "x"))
    write_csv(raw.orderBy("loan_id").select("y"), str(tmp_path / "y"))
    prepare_job(spark, str(tmp_path / "x"), str(tmp_path / "y"), str(tmp_path / "cleaned"))
    cleaned = load_cleaned(spark, str(tmp_path / "cleaned"))
    assert cleaned.count() == clean(spark, TABLES).count()
    names = profile_job(spark, str(tmp_path / "cleaned"), str(tmp_path / "profile"))
    assert len(names) == 11
    for name in names:
        assert spark.read.csv(str(tmp_path / "profile" / name), header=True).count() > 0
    run_job(
        spark, str(tmp_path / "cleaned"), str(tmp_path / "out"),
        search=False, pd_models=[M.TREE], lgd_models=[M.OLS], params=FEW, fill=FILL, exact=True,
        thresholds=[0.2, 0.4],
    )
    written = {p.name for p in (tmp_path / "out").iterdir()}
    assert written == {
        "pd_base_board", "lgd_base_board", "pd_board", "lgd_board", "pd_report", "pd_confusion", "thresholds",
        "flagged", "roc", "summary", "composition", "histogram", "riskiest", "scored", "metadata", "pd_model", "lgd_model",
    }
    assert spark.read.csv(str(tmp_path / "out" / "thresholds"), header=True).count() == 2
    assert scratch_files(spark) <= before
    document = "".join(p.read_text() for p in (tmp_path / "out" / "metadata").glob("part-*"))
    assert json.loads(document)["lgd_model"] == M.OLS and json.loads(document)["pd_cv_auc"] is None
    assert spark.read.parquet(str(tmp_path / "out" / "scored")).count() > 0


def test_cleaned_table_without_key_and_with_truth_values(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,PD,emp_length_x\n1.5,0,True\n2.5,1,False\n")
    df = load_cleaned(spark, str(tmp_path / "c.csv"))
    assert [tuple(r) for r in df.orderBy("loan_id").collect()] == [(0, 1.5, 0, 1), (1, 2.5, 1, 0)]

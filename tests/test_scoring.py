"""New raw loans scored with what a run has saved."""

import pytest
from compare import TABLES
from pyspark.sql import functions as F

from riskloom.operators import training as M
from riskloom.plans.jobs import prepare_job, run_job, score_job
from riskloom.plans.preparation import fit_preparation
from riskloom.plans.prepare import clean_loans, encoded_loans
from riskloom.session import stage
from riskloom.sources.csv_files import quoted, write_csv
from riskloom.sources.tables import raw_loans

FEW = {M.GBT: {"n_estimators": 4}, M.TREE: {"max_depth": 4}}


@pytest.fixture(scope="module")
def raw(spark):
    odd = F.when(F.col("purpose") == "BUILDING", "it's a \\ `b`").otherwise(F.col("purpose"))
    return stage(raw_loans(spark, TABLES).withColumn("purpose", odd), "raw")


@pytest.mark.parametrize("options", [{}, {"cap_outliers": True, "null_category": True}, {"exclude_target_inputs": True}])
def test_preparation_equals_encoding(spark, raw, options, tmp_path):
    clean = stage(clean_loans(raw), "clean")
    preparation = fit_preparation(clean, **options)
    M.save_model(preparation, str(tmp_path / "p"))
    found = M.load_model(str(tmp_path / "p")).transform(raw.drop("y", "princ_rec"))
    want = encoded_loans(clean, **options).drop("PD", "LGD")
    assert set(found.columns) == set(want.columns)
    found = found.join(want.select("loan_id"), "loan_id", "left_semi")
    columns = ["loan_id", *sorted(set(want.columns) - {"loan_id"})]
    same = [quoted(c).cast("double").alias(c) for c in columns]
    assert found.select(*same).exceptAll(want.select(*same)).count() == 0 and found.count() == want.count()


def test_fresh_session_scores_raw_loans_as_the_run_did(spark, raw, tmp_path):
    x, y, cleaned, saved, out = (str(tmp_path / n) for n in ("x", "y", "cleaned", "saved", "out"))
    # A missing rate is filled by what goes with the models, an unseen purpose has no column.
    write_csv(raw.drop("y"), x)
    write_csv(raw.select("loan_id", "y"), y)
    prepare_job(spark, x, y, cleaned, key="loan_id", preparation=saved, cap_outliers=True)
    run_job(spark, cleaned, out, search=False, params=FEW, pd_models=[M.GBT, M.TREE], lgd_models=[M.OLS, M.GBT], fill={"interest_rate": 1.5})
    fresh = spark.newSession()
    score_job(fresh, x, saved, out, str(tmp_path / "new"), key="loan_id")
    new = fresh.read.parquet(str(tmp_path / "new" / "scored"))
    assert new.count() == raw.count() and new.where("p is null or lgd_hat is null or el is null").count() == 0
    old = fresh.read.parquet(f"{out}/scored")
    both = new.alias("n").join(old.alias("o"), "loan_id")
    assert both.count() == old.count() > 0
    assert both.where("n.p <> o.p or n.lgd_hat <> o.lgd_hat or n.EAD <> o.EAD or n.el <> o.el").count() == 0
    total = fresh.read.csv(str(tmp_path / "new" / "summary"), header=True, inferSchema=True).first()
    assert total["expected_loss"] == pytest.approx(new.agg(F.sum("el")).first()[0], abs=0.01)


def test_loans_without_key_and_with_unseen_values(spark, raw, tmp_path):
    clean = stage(clean_loans(raw), "clean")
    preparation = fit_preparation(clean)
    odd = raw.limit(3).withColumn("purpose", F.lit("never seen")).withColumn("num_inq", F.lit(None).cast("bigint"))
    rows = preparation.transform(odd.drop("y")).collect()
    dummies = [c for c in rows[0].asDict() if c.startswith("purpose_")]
    assert len(rows) == 3 and all(r[c] == 0 for r in rows for c in dummies) and all(r["num_inq"] == 0 for r in rows)

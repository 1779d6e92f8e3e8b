"""The registered model queries fit all training loans."""

import re
from types import SimpleNamespace

import pytest

from riskloom.operators import training as M
from riskloom.plans import catalog
from riskloom.plans.oracle import ORACLE


@pytest.mark.parametrize("make", [catalog.whole_run, catalog.quick_run])
def test_no_run_is_bounded(spark, monkeypatch, make):
    given = []
    monkeypatch.setattr(catalog, "encoded", lambda *_: None)
    monkeypatch.setattr(catalog, "_fitted", {})
    monkeypatch.setattr(catalog, "credit_run", lambda *_, **options: given.append(options) or SimpleNamespace())
    make(spark, "folder")
    assert len(given) == 1 and given[0].get("max_fit_rows") is None


def test_the_document_names_no_bound():
    assert re.search(r"cast\(null as bigint\) as max_fit_rows", ORACLE["run_metadata"])


def test_all_rows_are_fitted_without_a_bound(spark):
    """More rows than the registered queries used to take."""
    train = spark.range(2_500).selectExpr("id as loan_id", "cast(id % 3 = 0 as int) as PD", "array(double(id)) as features")
    rows = M._rows_for(train, "pd", 2, "loan_id", 42, None, None)
    assert rows.count == rows.whole.count() == 2_500
    assert sum(p.count() for p in rows.parts) == 2_500

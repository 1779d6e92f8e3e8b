"""Every registered query with an SQL twin, on the smallest tables."""

import pytest
from compare import TABLES, connect, differences

from riskloom.plans.catalog import QUERIES
from riskloom.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def tables():
    return connect(TABLES)


@pytest.fixture(scope="module", autouse=True)
def fewer_trees():
    """The queries of the models as registered, but for the numbers of trees: these alone take minutes."""
    from riskloom.operators.training import FOREST, GBT
    from riskloom.plans import catalog

    patch = pytest.MonkeyPatch()
    fewer = {GBT: [3, 6], FOREST: [5, 10]}
    grids = {k: {n: {**g, "n_estimators": fewer[n]} if n in fewer else g for n, g in v.items()} for k, v in catalog.SEARCH_GRIDS.items()}
    patch.setattr(catalog, "SEARCH_GRIDS", grids)
    patch.setattr(catalog, "PARAMS", {GBT: {"n_estimators": 6}, FOREST: {"n_estimators": 10}})
    patch.setattr(catalog, "_fitted", {})
    yield
    patch.undo()


def test_twins_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, tables, name):
    df = QUERIES[name](spark, TABLES)
    assert differences(df, tables, ORACLE[name]) == []
    plan = plan_of(df)
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["confusion"](spark, TABLES))
    assert "struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "struct<l_orderkey:bigint,l_extendedprice:double,l_returnflag:string>" in plan
    assert "c_custkey:bigint,c_" not in plan


def test_line_table_is_shuffled_once(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # Lines by order and orders by order; customers only where their columns are asked for.
        for name in ("confusion", "rename_target", "threshold_sweep", "expected_loss_summary"):
            plan = plan_of(QUERIES[name](spark, TABLES))
            assert plan.count("Exchange hashpartitioning") == 2, name
            assert "customer" not in plan
        assert plan_of(QUERIES["drop_leakage"](spark, TABLES)).count("Exchange hashpartitioning") == 4
        assert "lineitem" not in plan_of(QUERIES["join_ead_lookup"](spark, TABLES))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)

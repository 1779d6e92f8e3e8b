import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions import order_statistics as O

SHARES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


def column(kind, rng):
    n = 3000
    if kind == "normal":
        return [rng.gauss(0, 1) for _ in range(n)]
    if kind == "third of one value":
        return [0.0 if i % 3 == 0 else rng.uniform(-5, 5) for i in range(n)]
    if kind == "few values":
        return [float(rng.randrange(4)) for _ in range(n)]
    if kind == "one value":
        return [7.0] * n
    if kind == "heavy tail":
        return [rng.paretovariate(0.5) for _ in range(n)]
    return [None if rng.random() < 0.3 else float("nan") if rng.random() < 0.1 else rng.random() for _ in range(n)]


KINDS = ["normal", "third of one value", "few values", "one value", "heavy tail", "missing cells"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(1)
    columns = [column(k, rng) for k in KINDS]
    rows = list(zip(range(3000), *columns))
    schema = "id int, " + ", ".join(f"c{i} double" for i in range(len(KINDS)))
    return spark.createDataFrame(rows, schema).repartition(5).cache()


@pytest.mark.parametrize("gather_rows", [5000, 40, 3])
def test_quantiles_equal_numpy(data, gather_rows, monkeypatch):
    # Small sketches and grids, so that the search has to go through several scans.
    monkeypatch.setattr(O, "GRID", 40)
    got = O.quantiles(data, {k: F.col(f"c{i}") for i, k in enumerate(KINDS)}, SHARES, gather_rows)
    for i, k in enumerate(KINDS):
        values = np.array([r[0] for r in data.select(f"c{i}").collect()], dtype=float)
        assert got[k] == pytest.approx(list(np.quantile(values[~np.isnan(values)], SHARES)), abs=1e-12)


def test_a_useless_sketch_costs_scans_not_correctness(data, monkeypatch):
    monkeypatch.setattr(O, "GRID", 12)
    got = O.quantiles(data, {"x": F.col("c0")}, (0.5,), gather_rows=10)
    values = [r[0] for r in data.select("c0").collect()]
    assert got["x"][0] == pytest.approx(float(np.median(values)), abs=1e-12)


def test_parts_of_the_data_and_empty_series(data):
    series = {
        "low": F.when(F.col("id") < 100, F.col("c0")),
        "none": F.when(F.col("id") < 0, F.col("c0")),
    }
    got = O.quantiles(data, series, (0.5,))
    values = [r[0] for r in data.filter("id < 100").select("c0").collect()]
    assert got["low"][0] == pytest.approx(float(np.median(values)))
    assert got["none"] == [None]


def test_gathering_is_bounded_per_scan(data, monkeypatch):
    monkeypatch.setattr(O, "GATHER_ROWS_PER_SCAN", 4000)
    sizes = [O._Interval(i, None, None, 0, 1500, [1]) for i in range(5)]
    assert [len(b) for b in O._batches(sizes)] == [2, 2, 1]
    got = O.quantiles(data, {i: F.col(f"c{i}") for i in range(4)}, (0.5,))
    assert got[3] == [7.0]


def test_value_splits_balance(data):
    cuts = O.value_splits(data, F.col("c0"), 300)
    assert cuts == sorted(set(cuts)) and len(cuts) == 9
    assert O.value_splits(data, F.col("c0"), 10_000) == []
    assert O.value_splits(data, F.col("c3"), 300) == [7.0]


def test_value_splits_refine_parts(data):
    cuts = O.value_splits(data, F.col("c0"), 20, coarse=5)
    assert len(cuts) > 20
    counts = data.select(F.col("c0").alias("x")).filter("x is not null").collect()
    import bisect
    import collections

    sizes = collections.Counter(bisect.bisect_right(cuts, r["x"]) for r in counts)
    assert max(sizes.values()) <= 6 * 20

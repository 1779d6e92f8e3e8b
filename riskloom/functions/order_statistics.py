"""Exact order statistics of many columns without sorting or shuffling the data.

A mergeable sketch proposes values around every wanted rank, a counting scan
establishes how many rows lie below, at and between them, and the search goes on
only inside the interval that is then known to hold the rank. Once a counted
interval is small, its values are gathered and the answer is read off. The
sketch decides how fast the search narrows, never what it returns. Each scan
moves one small row per task, whatever the data size: two scans for up to
``GATHER_ROWS`` values per column, three for 10^5, five or six for 10^12.
"""

from __future__ import annotations

import math
from collections.abc import Hashable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

GATHER_ROWS = 1_000
GATHER_ROWS_PER_SCAN = 100_000
SKETCH_K = 4000
GRID = 2000
MERGE_GROUPS = 256


@dataclass
class _Interval:
    """Values strictly between ``low`` and ``high`` that hold the open ``ranks``."""

    series: Hashable
    low: float | None
    high: float | None
    below: int
    size: int
    ranks: list[int]
    grid: list[float] = field(default_factory=list)

    def inside(self, x: Column) -> Column:
        return _between(x, self.low, self.high)

    def proposals(self) -> list[tuple[float, float]]:
        """For each rank, a lower and an upper value likely to enclose it."""
        slack = 4
        pairs = []
        for r in self.ranks:
            place = (r - self.below + 0.5) / self.size * (len(self.grid) - 1)
            a = max(0, math.floor(place) - slack)
            b = min(len(self.grid) - 1, math.ceil(place) + slack)
            pairs.append((self.grid[a], self.grid[b]))
        return pairs


def _between(x: Column, low: float | None, high: float | None) -> Column:
    cond = x.isNotNull()
    if low is not None:
        cond = cond & (x > F.lit(low))
    if high is not None:
        cond = cond & (x < F.lit(high))
    return cond


def _no_nan(x: Column) -> Column:
    d = x.cast("double")
    return F.when(~F.isnan(d), d)


def _counted(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def _scan(df: DataFrame, sums: Mapping[str, Column], sketched: Mapping[str, Column], k: int):
    """Sums, and sketched values at even steps of rank, of the whole input as one row.

    Tasks are first merged in ``MERGE_GROUPS`` groups, so that no single task
    has to take in the sketches of every scan task.
    """
    if not sketched:
        return df.agg(*[F.sum(e).alias(n) for n, e in sums.items()]).first()
    first = [F.sum(e).alias(n) for n, e in sums.items()]
    first += [F.kll_sketch_agg_double(e, F.lit(k)).alias(n) for n, e in sketched.items()]
    merged = [F.sum(n).alias(n) for n in sums]
    merged += [F.kll_merge_agg_double(n).alias(n) for n in sketched]
    grouped = df.groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("_merge_group"))
    # The function takes constants only; one text is quicker to build than many literals.
    points = F.split(F.lit(",".join(str(i / GRID) for i in range(GRID + 1))), ",").cast("array<double>")
    read = [
        F.when(F.kll_sketch_get_n_double(n) > 0, F.kll_sketch_get_quantile_double(n, points)).alias(n)
        for n in sketched
    ]
    return grouped.agg(*first).agg(*merged).select(*sums, *read).first()


@dataclass(frozen=True)
class Survey:
    """Non-missing values per series, and values at even steps of rank (roughly)."""

    counts: dict
    grids: dict


def survey(df: DataFrame, series: Mapping[Hashable, Column], k: int = SKETCH_K) -> Survey:
    """Counts and sketched quantiles of all series in one scan."""
    names = list(series)
    x = {n: _no_nan(series[n]) for n in names}
    row = _scan(
        df,
        {f"n{i}": _counted(x[n].isNotNull()) for i, n in enumerate(names)},
        {f"s{i}": x[n] for i, n in enumerate(names)},
        k,
    )
    return Survey(
        {n: row[f"n{i}"] or 0 for i, n in enumerate(names)},
        {n: list(row[f"s{i}"] or ()) for i, n in enumerate(names)},
    )


def _narrow(df: DataFrame, series: Mapping, large: list[_Interval], found: dict, gather_rows: int, k: int):
    """Count at the proposed values; return the parts that hold the open ranks.

    The parts that are likely to stay large are sketched in the same scan.
    """
    sums, sketched, plans = {}, {}, []
    for i, iv in enumerate(large):
        x, inside = series[iv.series], iv.inside(series[iv.series])
        pairs = iv.proposals() if iv.grid else []
        pivots = sorted({p for pair in pairs for p in pair})
        for j, p in enumerate(pivots):
            sums[f"u{i}_{j}"] = _counted(inside & (x < F.lit(p)))
            sums[f"a{i}_{j}"] = _counted(inside & (x == F.lit(p)))
        targets = {}
        if not iv.grid:
            targets[(iv.low, iv.high)] = f"s{i}_0"
        elif iv.size * 10 / GRID > gather_rows:
            inner = [(a, b) for a, b in zip(pivots, pivots[1:]) if any(lo <= a and b <= hi for lo, hi in pairs)]
            targets = {pair: f"s{i}_{j}" for j, pair in enumerate(inner)}
        for (a, b), name in targets.items():
            sketched[name] = F.when(_between(x, a, b), x)
        plans.append((iv, pivots, targets))
    row = _scan(df, sums, sketched, k)
    parts = []
    for i, (iv, pivots, targets) in enumerate(plans):
        counts = [(p, row[f"u{i}_{j}"], row[f"a{i}_{j}"]) for j, p in enumerate(pivots)]
        for part in _split(iv, counts, found):
            name = targets.get((part.low, part.high))
            part.grid = list(row[name] or ()) if name else []
            parts.append(part)
    return parts


def _split(iv: _Interval, counts: Sequence[tuple[float, int, int]], found: dict) -> list[_Interval]:
    """Divide an interval at its counted values; keep the parts that hold ranks."""
    parts: list[_Interval] = []
    left = list(iv.ranks)
    low, below = iv.low, iv.below
    for value, under, at in counts:
        start, stop = iv.below + under, iv.below + under + at
        inner = [r for r in left if r < start]
        if inner:
            parts.append(_Interval(iv.series, low, value, below, start - below, inner))
        found.update({(iv.series, r): value for r in left if start <= r < stop})
        left = [r for r in left if r >= stop]
        low, below = value, stop
    if left:
        parts.append(_Interval(iv.series, low, iv.high, below, iv.below + iv.size - below, left))
    return parts


def _batches(intervals: list[_Interval]) -> list[list[_Interval]]:
    """Intervals grouped so that one scan gathers a bounded number of values."""
    batches: list[list[_Interval]] = []
    room = 0
    for iv in intervals:
        if not batches or iv.size > room:
            batches.append([])
            room = GATHER_ROWS_PER_SCAN
        batches[-1].append(iv)
        room -= iv.size
    return batches


def _gather(df: DataFrame, series: Mapping, small: list[_Interval], found: dict) -> None:
    """Read the ranks off intervals that are counted to be small."""
    aggs = []
    for i, iv in enumerate(small):
        x = series[iv.series]
        values = F.array_sort(F.collect_list(F.when(iv.inside(x), x)))
        aggs.append(values.alias(f"v{i}"))
    picked = [
        F.array(*[F.element_at(f"v{i}", r - iv.below + 1) for r in iv.ranks]).alias(f"g{i}")
        for i, iv in enumerate(small)
    ]
    row = df.agg(*aggs).select(*picked).first()
    for i, iv in enumerate(small):
        found.update({(iv.series, r): v for r, v in zip(iv.ranks, row[f"g{i}"])})


def order_statistics(
    df: DataFrame,
    series: Mapping[Hashable, Column],
    ranks: Mapping[Hashable, Iterable[int]],
    seen: Survey | None = None,
    gather_rows: int = GATHER_ROWS,
    k: int = SKETCH_K,
) -> dict[tuple[Hashable, int], float]:
    """``{(series, rank): value}`` for 0-based ranks among the non-missing values.

    ``series`` are numeric expressions over ``df``; a part of the data, such as
    one class, is an expression that is NULL elsewhere.
    """
    seen = seen or survey(df, series, k)
    series = {n: _no_nan(e) for n, e in series.items()}
    found: dict[tuple[Hashable, int], float] = {}
    open_ = [
        _Interval(n, None, None, 0, seen.counts[n], sorted(set(ranks[n])), seen.grids[n])
        for n in series
        if seen.counts[n] and ranks[n]
    ]
    while open_:
        for batch in _batches([iv for iv in open_ if iv.size <= gather_rows]):
            _gather(df, series, batch, found)
        large = [iv for iv in open_ if iv.size > gather_rows]
        open_ = _narrow(df, series, large, found, gather_rows, k) if large else []
    return found


def quantiles(
    df: DataFrame,
    series: Mapping[Hashable, Column],
    shares: Sequence[float] = (0.25, 0.5, 0.75),
    gather_rows: int = GATHER_ROWS,
) -> dict[Hashable, list[float | None]]:
    """Exact quantiles with linear interpolation between neighbours.

    Missing values are left out; a series without values gives ``None``.
    """
    seen = survey(df, series)
    places = {n: [s * (seen.counts[n] - 1) for s in shares] for n in series if seen.counts[n]}
    ranks = {
        n: sorted({r for p in places.get(n, ()) for r in (math.floor(p), math.ceil(p))}) for n in series
    }
    found = order_statistics(df, series, ranks, seen, gather_rows)

    def between(n: Hashable, place: float) -> float:
        a, b = found[(n, math.floor(place))], found[(n, math.ceil(place))]
        return a + (b - a) * (place - math.floor(place))

    return {n: [between(n, p) for p in places[n]] if n in places else [None] * len(shares) for n in series}


def value_splits(df: DataFrame, value: Column, rows_per_part: int, coarse: int = 1000) -> list[float]:
    """Cut points that divide the values in about equal parts; [] when one part is enough.

    Up to ``coarse`` parts are read off one sketch. When more are needed, each
    of these is sketched by itself and cut again. The cuts only balance work.
    They are read once and used as constants, so every task and every retry
    sees the same parts.
    """
    rows = df.select(_no_nan(value).alias("x"))
    seen = survey(rows, {"x": F.col("x")}, k=8000)
    parts = math.ceil(seen.counts["x"] / rows_per_part)
    if parts <= 1:
        return []
    grid = seen.grids["x"]
    first = min(parts, coarse)
    cuts = sorted({grid[round(i * GRID / first)] for i in range(1, first)})
    if parts <= coarse or not cuts:
        return cuts
    each = math.ceil(parts / coarse)
    steps = F.array(*[F.lit(i / each) for i in range(1, each)])
    placed = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="x", outputCol="part").transform(
        rows.filter(F.col("x").isNotNull())
    )
    sketched = placed.groupBy("part").agg(F.kll_sketch_agg_double("x", F.lit(4000)).alias("s"))
    finer = sketched.select(F.explode(F.kll_sketch_get_quantile_double("s", steps)).alias("x")).distinct()
    return sorted({*cuts, *(r["x"] for r in finer.collect())})

"""Tables of models and their measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.operators.evaluate import binary_metrics, regression_metrics, roc_auc


def long_scores(df: DataFrame, models: Mapping[str, Mapping[str, str]], keep: Sequence[str]) -> DataFrame:
    """One row per loan and model from one row per loan.

    ``models`` maps a model name to its columns, ``{result name: column}``.
    """
    structs = [
        F.struct(F.lit(m).alias("model"), *[F.col(c).alias(n) for n, c in fields.items()])
        for m, fields in models.items()
    ]
    return df.select(*keep, F.explode(F.array(*structs)).alias("r")).select(*keep, "r.*")


def pd_leaderboard(scores: DataFrame, label: str = "PD", score: str = "p", predicted: str = "flag") -> DataFrame:
    """Five measures per model, best area under the curve first."""
    rates = binary_metrics(scores, label, predicted, by=["model"])
    areas = roc_auc(scores, score, label, by=["model"])
    return rates.join(areas, "model").orderBy(F.desc("roc_auc"), "model")


def lgd_leaderboard(scores: DataFrame, actual: str = "LGD", predicted: str = "lgd_hat") -> DataFrame:
    """Three measures per model, smallest mean absolute error first."""
    return regression_metrics(scores, actual, predicted, by=["model"]).orderBy("mae", "model")


def best_model(board: DataFrame, measure: str, largest: bool = True, order: Sequence[str] = ()) -> DataFrame:
    """The row with the best measure; among equals the first in ``order``, then by name."""
    best = F.desc(measure) if largest else F.asc(measure)
    place = [F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))] if order else []
    return board.orderBy(best, *place, "model").limit(1)


def below(board: DataFrame, measure: str, bound: float) -> DataFrame:
    return board.filter(F.col(measure) < bound)


def best_per_measure(
    board: DataFrame, largest: Sequence[str] = (), smallest: Sequence[str] = (), name: str = "model"
) -> DataFrame:
    """For each measure, the best row's name and value."""
    aggs, rows = [], []
    for i, m in enumerate([*largest, *smallest]):
        value = F.col(m).cast("double")
        # The name breaks ties: among equal values the first name wins.
        place = F.struct(-value if m in largest else value, F.col(name))
        aggs += [F.min_by(name, place).alias(f"w{i}"), F.min_by(value, place).alias(f"v{i}")]
        rows.append(F.struct(F.lit(m).alias("measure"), F.col(f"w{i}").alias("best"), F.col(f"v{i}").alias("value")))
    return board.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")

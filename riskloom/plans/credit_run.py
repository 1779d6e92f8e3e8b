"""Train both models, score the test loans and report the expected loss."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, functions as F

from riskloom.functions.numeric import count_where, half_even
from riskloom.operators.clean import defaulted, feature_columns
from riskloom.operators.evaluate import (
    OPERATING_THRESHOLD,
    binary_metrics,
    classification_report,
    confusion,
    flagged,
    flagged_against_actual,
    threshold_sweep,
)
from riskloom.operators.leaderboard import best_model, lgd_leaderboard, pd_leaderboard
from riskloom.operators.loss import expected_loss, loss_summary
from riskloom.operators.scale import fit_scale
from riskloom.operators.split import exact_train_test_split, train_test_split
from riskloom.operators.training import (
    LGD_GRIDS,
    LGD_MODELS,
    OLS,
    PD_GRIDS,
    PD_MODELS,
    Fitted,
    Search,
    assemble,
    fit_default,
    fit_models,
    lgd_scores,
    pd_scores,
    score_portfolio,
)
from riskloom.session import drop_finished, stage
from riskloom.sources.csv_files import quoted


@dataclass(frozen=True)
class Prepared:
    """Encoded loans split by key, and as feature vectors for both kinds of model."""

    train: DataFrame
    test: DataFrame
    pd_features: PipelineModel
    lgd_features: PipelineModel
    pd_train: DataFrame
    pd_test: DataFrame
    lgd_train: DataFrame
    lgd_test: DataFrame


@dataclass(frozen=True)
class Run:
    """The chosen models, the scored test loans and the documents about them.

    The base boards are those of the default parameters; with a search the
    boards are those of the tuned models, without one they are the base boards.
    ``pd_fits`` and ``lgd_fits`` hold the models of the default parameters and the
    searches, ``pd_models`` and ``lgd_models`` those that the choice is among.
    ``pd_report`` and ``pd_confusion`` have a part per model; ``flagged`` sets
    the loans flagged at the operating point against the defaulted ones.
    """

    pd_model: PipelineModel
    lgd_model: PipelineModel
    pd_base_board: DataFrame
    lgd_base_board: DataFrame
    pd_board: DataFrame
    lgd_board: DataFrame
    pd_report: DataFrame
    pd_confusion: DataFrame
    scored: DataFrame
    sweep: DataFrame
    flagged: DataFrame
    summary: DataFrame
    metadata: DataFrame
    data: Prepared
    pd_fits: Fitted
    lgd_fits: Fitted
    pd_models: dict[str, Model]
    lgd_models: dict[str, Model]


def prepare_training(
    encoded: DataFrame,
    key: str = "loan_id",
    seed: int = 42,
    fill: Mapping[str, float] | None = None,
    exact: bool = False,
    stratify: str | None = None,
) -> Prepared:
    """Split once by key, for both models, and write the feature vectors.

    The vectors are read by every fit, so they are staged. ``fill`` gives values
    for missing cells of named features; a feature that still has some is an
    error, since no model can take them. ``exact`` takes exactly a fifth of the
    loans as test loans, of each class of ``stratify`` if it is given; without
    it every loan is drawn by itself, which needs no pass over the data.
    """
    columns = feature_columns(encoded, (key, "PD", "LGD", "EAD"))
    loans = stage(encoded.fillna(dict(fill)) if fill else encoded, "encoded")
    missing = loans.agg(*[count_where(quoted(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    open_ = [f"{c} ({missing[i]})" for i, c in enumerate(columns) if missing[i]]
    if open_:
        raise ValueError(f"missing cells in {', '.join(open_)}; give a fill value or drop the rows")
    if exact or stratify:
        train, test = exact_train_test_split(loans, key, seed, stratify=stratify)
    else:
        train, test = train_test_split(loans, key, seed)
    # The fill goes with the models: new loans may have missing cells too.
    pd_features = assemble(columns, fit_scale(train, columns), fill)
    lgd_features = assemble(columns, fill=fill)

    def vectors(features: PipelineModel, df: DataFrame, label: str) -> DataFrame:
        return features.transform(df).select(key, label, "features")

    return Prepared(
        train,
        test,
        pd_features,
        lgd_features,
        stage(vectors(pd_features, train, "PD"), "pd-train"),
        stage(vectors(pd_features, test, "PD"), "pd-test"),
        stage(vectors(lgd_features, defaulted(train), "LGD"), "lgd-train"),
        vectors(lgd_features, defaulted(test), "LGD"),
    )


def _scored_apart(scores: Callable[..., DataFrame], models: Mapping[str, Model], data: DataFrame, keep: Sequence[str], label: str) -> DataFrame:
    """The rows of ``scores`` of every model, from a pass each: what a pass sends to its tasks is held by the driver,
    and is let go before the next."""
    parts = []
    for name, model in models.items():
        parts.append(stage(scores({name: model}, data, keep), label))
        drop_finished(data.sparkSession)
    return reduce(DataFrame.unionByName, parts)


def _choose(board: DataFrame, measure: str, largest: bool, order: Sequence[str], searches, select_by: str) -> str:
    if select_by == "cv" and searches:
        pick = max if largest else min
        return pick(searches, key=lambda n: searches[n].score)
    return best_model(board, measure, largest, order).first()["model"]


def credit_run(
    encoded: DataFrame,
    key: str = "loan_id",
    seed: int = 42,
    pd_grids: Mapping | None = None,
    lgd_grids: Mapping | None = None,
    pd_models: Sequence[str] | None = None,
    lgd_models: Sequence[str] | None = None,
    params: Mapping[str, Mapping] | None = None,
    search: bool = True,
    select_by: str = "test",
    thresholds: Sequence[float] | None = None,
    threshold: float = OPERATING_THRESHOLD,
    dataset: str = "loans",
    fill: Mapping[str, float] | None = None,
    exact: bool = False,
    stratify: str | None = None,
    max_fit_rows: int | Mapping | None = None,
    partitions: int | None = None,
) -> Run:
    """The whole run. ``search=False`` takes default parameters instead of the grids.

    ``max_fit_rows`` may differ by kind (``pd``, ``lgd``), and by family inside.
    Boosted models of both kinds are fitted at the same time, the others one by one beside them.
    """
    data = prepare_training(encoded, key, seed, fill, exact, stratify)
    most = max_fit_rows if isinstance(max_fit_rows, Mapping) else {"pd": max_fit_rows, "lgd": max_fit_rows}
    fitting = {"seed": seed, "key": key, "partitions": partitions}
    kinds = {
        "pd": (data.pd_train, pd_models, (PD_GRIDS if pd_grids is None else pd_grids) if search else {}),
        "lgd": (data.lgd_train, lgd_models, (LGD_GRIDS if lgd_grids is None else lgd_grids) if search else {}),
    }

    def fitted(kind: str) -> Fitted:
        train, models, grids = kinds[kind]
        return fit_models(train, kind, models, params, grids, max_fit_rows=most.get(kind), beside=beside, **fitting)

    with ThreadPoolExecutor(2) as pool, ThreadPoolExecutor(1) as beside:
        pd_fits, lgd_fits = pool.map(inheritable_thread_target(encoded.sparkSession)(fitted), kinds)
    pd_searches, lgd_searches = pd_fits.searches, lgd_fits.searches
    pd_fitted, lgd_fitted = pd_base, lgd_base = pd_fits.base, lgd_fits.base
    pd_test = _scored_apart(pd_scores, pd_base, data.pd_test, [key, "PD"], "pd-scores")
    lgd_test = _scored_apart(lgd_scores, lgd_base, data.lgd_test, [key, "LGD"], "lgd-scores")
    pd_base_board, lgd_base_board = pd_leaderboard(pd_test), lgd_leaderboard(lgd_test)
    pd_board, lgd_board = pd_base_board, lgd_base_board
    if search:
        pd_fitted = {n: s.model for n, s in pd_searches.items()}
        lgd_fitted = {n: m for n, m in lgd_base.items() if n == OLS} or fit_default(
            data.lgd_train, "lgd", [OLS], max_fit_rows=most.get("lgd"), **fitting
        )
        lgd_fitted |= {n: s.model for n, s in lgd_searches.items()}
        pd_test = _scored_apart(pd_scores, pd_fitted, data.pd_test, [key, "PD"], "pd-scores")
        lgd_test = _scored_apart(lgd_scores, lgd_fitted, data.lgd_test, [key, "LGD"], "lgd-scores")
        pd_board, lgd_board = pd_leaderboard(pd_test), lgd_leaderboard(lgd_test)
    pd_name = _choose(pd_board, "roc_auc", True, PD_MODELS, pd_searches, select_by)
    lgd_name = _choose(lgd_board, "mae", False, LGD_MODELS, lgd_searches, select_by)

    pd_model = PipelineModel([*data.pd_features.stages, pd_fitted[pd_name]])
    lgd_model = PipelineModel([*data.lgd_features.stages, lgd_fitted[lgd_name]])
    keep = [key, "PD", "LGD", "EAD"]
    scored = stage(expected_loss(score_portfolio(data.test, pd_model, lgd_model, keep)), "scored")
    summary = loss_summary(scored)

    pd_search, lgd_search = pd_searches.get(pd_name), lgd_searches.get(lgd_name)
    point = binary_metrics(flagged(scored, "p", threshold), "PD", "flag")
    metadata = run_metadata(
        pd_name,
        lgd_name,
        pd_search.score if pd_search else None,
        pd_search.params if pd_search else {},
        lgd_search.params if lgd_search else {},
        threshold,
        point,
        lgd_board.filter(F.col("model") == lgd_name),
        summary,
        dataset,
        most.get("pd") if not isinstance(most.get("pd"), Mapping) else None,
    )
    return Run(
        pd_model,
        lgd_model,
        pd_base_board,
        lgd_base_board,
        pd_board,
        lgd_board,
        classification_report(pd_test, by=["model"]),
        confusion(pd_test, by=["model"]),
        scored,
        threshold_sweep(scored, thresholds),
        flagged_against_actual(flagged(scored, "p", threshold)),
        summary,
        metadata,
        data,
        pd_fits,
        lgd_fits,
        pd_fitted,
        lgd_fitted,
    )


def run_metadata(
    pd_name: str,
    lgd_name: str,
    cv_auc: float | None,
    pd_params: Mapping,
    lgd_params: Mapping,
    threshold: float,
    point: DataFrame,
    lgd_row: DataFrame,
    summary: DataFrame,
    dataset: str,
    max_fit_rows: int | None = None,
) -> DataFrame:
    """The one-row document of a run, with its figures rounded half to even."""
    # The names of the document's fields, max_fit_rows and spark_version apart.
    spark = point.sparkSession

    def params(p: Mapping):
        pairs = [F.lit(x) for k, v in p.items() for x in (k, json.dumps(v))]
        return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")

    names, row = [], []
    for df, columns in (
        (point, ("precision", "recall", "f1")),
        (lgd_row, ("mae", "rmse")),
        (summary, ("portfolio_value", "expected_loss", "expected_loss_pct")),
    ):
        names += columns
        row += [None if v is None else float(v) for v in df.select(*columns).first()]
    figures = spark.createDataFrame([tuple(row)], ", ".join(f"{n} double" for n in names))
    return figures.select(
        F.lit(pd_name).alias("pd_model"),
        F.lit(lgd_name).alias("lgd_model"),
        F.date_format(F.current_date(), "yyyy-MM").alias("trained_on"),
        F.lit(dataset).alias("dataset"),
        half_even(F.lit(cv_auc).cast("double"), 4).alias("pd_cv_auc"),
        params(pd_params).alias("pd_best_params"),
        params(lgd_params if lgd_name != OLS else {}).alias("lgd_best_params"),
        F.lit(float(threshold)).alias("pd_threshold"),
        half_even(F.col("precision"), 3).alias("pd_test_precision"),
        half_even(F.col("recall"), 3).alias("pd_test_recall"),
        half_even(F.col("f1"), 3).alias("pd_test_f1"),
        half_even(F.col("mae"), 4).alias("lgd_mae"),
        half_even(F.col("rmse"), 4).alias("lgd_rmse"),
        half_even(F.col("portfolio_value"), 2).alias("portfolio_value"),
        half_even(F.col("expected_loss"), 2).alias("expected_loss"),
        half_even(F.col("expected_loss_pct"), 4).alias("expected_loss_pct"),
        F.lit(1).alias("positive_class"),
        F.lit("default").alias("positive_label"),
        F.lit(max_fit_rows).cast("bigint").alias("max_fit_rows"),
        F.lit(spark.version).alias("spark_version"),
    )

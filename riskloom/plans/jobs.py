"""The jobs of the command line: prepare a table, profile it, train and report, score new loans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskloom.operators import evaluate as E
from riskloom.operators import loss as X
from riskloom.operators import profile as P
from riskloom.operators import spread as S
from riskloom.operators.clean import join_by_key
from riskloom.operators.correlate import correlation
from riskloom.operators.training import load_model, save_model, score_portfolio
from riskloom.plans.credit_run import credit_run
from riskloom.plans.preparation import fit_preparation
from riskloom.plans.prepare import clean_loans, encoded_loans
from riskloom.session import stage, staging
from riskloom.sources.csv_files import (
    join_by_position,
    quoted,
    read_csv,
    with_row_position,
    write_csv,
)
from riskloom.sources.documents import write_document

KEY = "loan_id"


def load_raw(spark: SparkSession, features: str, target: str, key: str | None = None) -> DataFrame:
    """The two raw files as one table with the key ``loan_id``.

    Without a key column the rows belong together by position, and the position
    becomes the key.
    """
    hint = "Give the raw feature and target files."
    x = read_csv(spark, features, hint=hint, positions=not key)
    y = read_csv(spark, target, hint=hint, positions=not key)
    if key:
        return join_by_key(x, y, key).withColumnRenamed(key, KEY)
    return join_by_position(x, y).withColumnRenamed("row_position", KEY)


def prepare_job(
    spark: SparkSession,
    features: str,
    target: str,
    out: str,
    key: str | None = None,
    preparation: str | None = None,
    **encoding,
) -> None:
    """Clean and encode the raw files and write the table to ``out``; options as of :func:`encoded_loans`.

    What was learned on the way is saved to ``preparation``, for :func:`score_job`.
    """
    with staging(spark):
        raw = load_raw(spark, features, target, key)
        drop = [c for c in ("emp_title",) if c in raw.columns]
        clean = stage(clean_loans(raw, drop=drop), "clean")
        write_csv(encoded_loans(clean, KEY, **encoding), out)
        if preparation:
            save_model(fit_preparation(clean, KEY, **encoding), preparation)


def load_features(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """A raw file of loans without outcome, with the key ``loan_id``: the position if there is no key column."""
    df = read_csv(spark, path, hint="Give the raw feature file.", positions=not key)
    return df.withColumnRenamed(key, KEY) if key else with_row_position(df, KEY)


def score_job(spark: SparkSession, features: str, preparation: str, run: str, out: str, key: str | None = None) -> None:
    """Score raw loans with a saved preparation and the models of a run; writes ``scored`` and ``summary``.

    Every loan of the file is scored: PD ``p``, severity ``lgd_hat``, expected loss ``el``.
    """
    with staging(spark):
        loans = load_model(preparation).transform(load_features(spark, features, key))
        models = load_model(f"{run}/pd_model"), load_model(f"{run}/lgd_model")
        scored = stage(X.expected_loss(score_portfolio(loans, *models, [KEY, "EAD"])), "scored")
        scored.select(KEY, "EAD", "p", "lgd_hat", "el").write.mode("overwrite").parquet(f"{out}/scored")
        write_csv(X.loss_summary(scored), f"{out}/summary")


def load_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """A cleaned table; truth values become 0/1, and a table without a key gets one."""
    df = read_csv(spark, path, hint="Run the prepare job first.", positions=True)
    if KEY in df.columns:
        df = df.drop("_file", "_block", "_local")
    else:
        df = with_row_position(df, KEY)
    truths = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: quoted(c).cast("int") for c in truths})


def profile_job(spark: SparkSession, path: str, out: str) -> list[str]:
    """The descriptive tables of a cleaned table, each written to its own folder; returns their names."""
    with staging(spark):
        loans = stage(load_cleaned(spark, path), "profile")
        numbers = [c for c in P.numeric_columns(loans, P.TARGETS) if c != KEY]
        others = [c for c in loans.columns if c != KEY]
        tables = {
            "profile": P.numeric_profile(loans, numbers),
            "nulls": P.null_counts(loans),
            "null_rates": P.null_rates(loans),
            "info": P.table_info(loans),
            "classes": P.class_table(loans, "PD"),
            "class_counts": P.value_counts(loans, "PD"),
            "distinct": P.distinct_counts(loans, others),
            "imbalance": P.imbalance_by_column(loans, "PD", others),
            "correlation": correlation(loans, numbers),
            "boxes": S.box_summary(loans, numbers, "PD"),
            "outliers": S.outlier_counts(loans, S.fit_fences(loans, numbers)),
        }
        for name, df in tables.items():
            write_csv(df, f"{out}/{name}")
        return list(tables)


def run_job(spark: SparkSession, path: str, out: str, **options) -> None:
    """Train on a cleaned table; write boards, reports, sweep, scores, models and the run document."""
    with staging(spark):
        run = credit_run(load_cleaned(spark, path), KEY, **options)
        tables = {
            "pd_base_board": run.pd_base_board,
            "lgd_base_board": run.lgd_base_board,
            "pd_board": run.pd_board,
            "lgd_board": run.lgd_board,
            "pd_report": run.pd_report,
            "pd_confusion": run.pd_confusion,
            "thresholds": run.sweep,
            "flagged": run.flagged,
            "roc": E.roc_on_grid(run.scored),
            "summary": run.summary,
            "composition": X.composition(run.scored),
            "histogram": S.histogram(run.scored, "el"),
            "riskiest": X.riskiest(run.scored),
        }
        for name, df in tables.items():
            write_csv(df, f"{out}/{name}")
        scored = run.scored.select(F.col(KEY), "PD", "LGD", "EAD", "p", "lgd_hat", "el")
        scored.write.mode("overwrite").parquet(f"{out}/scored")
        write_document(run.metadata, f"{out}/metadata")
        save_model(run.pd_model, f"{out}/pd_model")
        save_model(run.lgd_model, f"{out}/lgd_model")

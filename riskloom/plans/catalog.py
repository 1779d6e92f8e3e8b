"""The registered queries, each over the whole tables of a folder."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskloom.functions.keys import hash_number
from riskloom.functions.numeric import half_even, ratio, ratio_or_zero
from riskloom.operators import clean as C
from riskloom.operators import evaluate as E
from riskloom.operators import exact_trees as D
from riskloom.operators import leaderboard as B
from riskloom.operators import loss as X
from riskloom.operators import profile as P
from riskloom.operators import spread as S
from riskloom.operators.correlate import correlation
from riskloom.operators.encode import fit_vocabulary, one_hot, one_hot_vector, rank_vocabulary
from riskloom.operators.linear import fit_line, product_sums
from riskloom.operators.scale import fit_scale, scaled
from riskloom.operators.split import exact_train_test_split, is_test, train_test_split, with_folds
from riskloom.operators.training import (
    GBT,
    LGD_GRIDS,
    LGD_MODELS,
    OLS,
    PD_GRIDS,
    PD_MODELS,
    Search,
    lgd_scores,
    load_model,
    pd_scores,
    save_model,
    search_table,
)
from riskloom.plans.credit_run import Run, credit_run
from riskloom.plans.prepare import clean_loans, encoded_loans
from riskloom.session import scratch_path, stage
from riskloom.sources.csv_files import join_by_position, quoted, read_csv, write_csv
from riskloom.sources.documents import json_text
from riskloom.sources.tables import RAW_COLUMNS, SPLIT_SEED, raw_loans, table, with_stand_in_score

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

NUMBERS = ["funded_amnt", "max_bal_owed", "num_inq", "interest_rate", "bal_to_cred_lim"]
BOX_COLUMNS = [*NUMBERS, "LGD"]

# Stand-in models: the weight of the outcome in the score, and the hash seed.
STAND_INS = {"model_a": (300, 42), "model_b": (200, 43), "model_c": (100, 44), "model_d": (0, 45)}

# Stand-in severity models: the width of their error, in quarters of a percent.
SEVERITY_STAND_INS = {"model_a": 21, "model_b": 41, "model_c": 101}

# An order without lines has no rate; it enters the models as 0.
FILL = {"interest_rate": 0.0}

# The whole grids, and the default parameters.
SEARCH_GRIDS = {"pd": PD_GRIDS, "lgd": LGD_GRIDS}
PARAMS: dict[str, dict] = {}


def query(f: Query) -> Query:
    """Register a query; a trailing underscore keeps its name apart from an operator's."""
    QUERIES[f.__name__.rstrip("_")] = f
    return f


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as the last digits of a sum depend on the order of its rows."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in doubles})


def clean(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The cleaned loans: all columns, or the key, the targets and the named ones."""
    if columns is None:
        return clean_loans(raw_loans(spark, folder))
    needed = {"loan_id", "funded_amnt", "max_bal_owed", "y", *columns}
    raw = raw_loans(spark, folder, [c for c in RAW_COLUMNS if c in needed])
    return clean_loans(raw, drop=[]).select("loan_id", *columns, "PD", "LGD", "EAD")


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return with_stand_in_score(clean(spark, folder, []))


def with_loss(spark: SparkSession, folder: str) -> DataFrame:
    return X.expected_loss(scored(spark, folder), severity="LGD")


def model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Four stand-in models' scores, one row per loan and model."""
    df = clean(spark, folder, []).select("loan_id", "PD")
    for m, (signal, seed) in STAND_INS.items():
        df = with_stand_in_score(df, f"p_{m}", signal, seed)
    return E.flagged(
        B.long_scores(df, {m: {"p": f"p_{m}"} for m in STAND_INS}, ["loan_id", "PD"]), threshold=0.5
    )


def with_severity(loans: DataFrame, width: int, name: str = "lgd_hat") -> DataFrame:
    h = hash_number(F.col("loan_id"), SPLIT_SEED)
    return loans.withColumn(name, F.col("LGD") + (h % width - width // 2) / 4)


def severity_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Three stand-in models' severities, one row per loan and model."""
    df = clean(spark, folder, []).select("loan_id", "LGD")
    for m, width in SEVERITY_STAND_INS.items():
        df = with_severity(df, width, f"l_{m}")
    return B.long_scores(df, {m: {"lgd_hat": f"l_{m}"} for m in SEVERITY_STAND_INS}, ["loan_id", "LGD"])


def encoded(spark: SparkSession, folder: str) -> DataFrame:
    return encoded_loans(stage(clean(spark, folder), "clean"))


# Sources and joins


@query
def csv_clean_nulls(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_loans(spark, folder, ["loan_id", "purpose", "emp_length", "interest_rate", "num_inq"])
    path = scratch_path(spark, "csv")
    write_csv(
        raw.select(
            "loan_id",
            F.when(F.col("purpose") == "BUILDING", "n/a").otherwise(F.col("emp_length")).alias("emp_length"),
            F.coalesce(F.col("interest_rate").cast("string"), F.lit("NaN")).alias("interest_rate"),
            F.coalesce(F.col("num_inq").cast("string"), F.lit("NULL")).alias("num_inq"),
        ),
        path,
    )
    return read_csv(spark, path)


@query
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(encoded(spark, folder), path)
    return rounded(read_csv(spark, path))


@query
def csv_quoted_text(spark: SparkSession, folder: str) -> DataFrame:
    """Quotes, commas and outer blanks in cells, numbers at the ends of a bigint and beyond."""
    raw = raw_loans(spark, folder, ["loan_id", "emp_length", "purpose"])
    path = scratch_path(spark, "csv")
    write_csv(
        raw.select(
            "loan_id",
            F.concat(F.lit('  say "'), "emp_length", F.lit('", now ')).alias("note"),
            F.concat(F.lit('"'), "purpose", F.lit('"')).alias("quoted"),
            (F.lit(9223372036854775807) - F.col("loan_id")).alias("wide"),
            F.concat(F.lit("9223372036854775808"), F.col("loan_id").cast("string")).alias("wider"),
        ),
        path,
    )
    return read_csv(spark, path)


@query
def join_by_row_position(spark: SparkSession, folder: str) -> DataFrame:
    raw = stage(raw_loans(spark, folder, ["loan_id", "funded_amnt", "y"]), "raw")
    x_path, y_path = scratch_path(spark, "x"), scratch_path(spark, "y")
    # Both files are written from the same staged partitions, each in the same order.
    write_csv(raw.sortWithinPartitions("loan_id").select("loan_id", "funded_amnt"), x_path)
    write_csv(raw.sortWithinPartitions("loan_id").select("y"), y_path)
    x_type = T.StructType().add("loan_id", T.LongType()).add("funded_amnt", T.DoubleType())
    x = read_csv(spark, x_path, x_type, positions=True)
    y = read_csv(spark, y_path, T.StructType().add("y", T.IntegerType()), positions=True)
    return join_by_position(x, y).drop("row_position")


@query
def join_features_target(spark: SparkSession, folder: str) -> DataFrame:
    features = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("loan_id"), F.col("o_totalprice").alias("funded_amnt")
    )
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("loan_id"))
    returned = F.count(F.when(F.col("l_returnflag") == "R", 1))
    target = lines.agg(F.when(10 * returned >= 6 * F.count(F.lit(1)), 1).otherwise(0).alias("y"))
    return C.join_by_key(features, target, "loan_id")


@query
def join_ead_lookup(spark: SparkSession, folder: str) -> DataFrame:
    loans = stage(clean(spark, folder, []).select("loan_id", "PD", "EAD"), "loans")
    _, test = train_test_split(loans.select("loan_id", "PD"))
    return C.lookup(test, loans, "EAD")


@query
def metadata_json(spark: SparkSession, folder: str) -> DataFrame:
    loans = E.flagged(with_loss(spark, folder))
    counted = loans.agg(*E._cells("PD", "flag"), F.sum("EAD").alias("v"), F.sum("el").alias("l"))
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    document = counted.select(
        F.lit("stand-in").alias("pd_model"),
        F.lit("loans").alias("dataset"),
        F.lit(None).cast("double").alias("pd_cv_auc"),
        F.struct(F.lit("8").alias("max_depth"), F.lit("0.1").alias("learning_rate")).alias("pd_best_params"),
        F.lit(0.1).alias("pd_threshold"),
        half_even(ratio_or_zero(tp, tp + fp), 3).alias("pd_test_precision"),
        half_even(ratio_or_zero(tp, tp + fn), 3).alias("pd_test_recall"),
        half_even(ratio(F.col("l"), F.col("v")), 4).alias("expected_loss_pct"),
        F.lit(1).alias("positive_class"),
        F.lit("default").alias("positive_label"),
    )
    return json_text(document, indent=False)


# Projections and filters


@query
def drop_leakage(spark: SparkSession, folder: str) -> DataFrame:
    return C.drop_columns(raw_loans(spark, folder), ["princ_rec"])


@query
def drop_high_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    texts = raw_loans(spark, folder, ["emp_length", "purpose", "emp_title"])
    return raw_loans(spark, folder).drop(*C.wide_text_columns(texts, 100))


@query
def rename_target(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_loans(spark, folder, ["loan_id", "y"])
    return C.rename(C.rename(raw, "y", "moroso"), "moroso", "PD")


@query
def fill_zero(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["max_bal_owed", "num_inq", "bal_to_cred_lim"]
    return C.fill_zero(raw_loans(spark, folder, ["loan_id", "interest_rate", *columns]), columns)


@query
def derive_lgd(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(C.derive_lgd(raw_loans(spark, folder, ["loan_id", "max_bal_owed", "funded_amnt"])))


@query
def derive_ead(spark: SparkSession, folder: str) -> DataFrame:
    return C.derive_ead(raw_loans(spark, folder, ["loan_id", "funded_amnt"]))


@query
def filter_lgd(spark: SparkSession, folder: str) -> DataFrame:
    raw = C.fill_zero(raw_loans(spark, folder, ["loan_id", "max_bal_owed", "funded_amnt"]), ["max_bal_owed"])
    return rounded(C.keep_bounded_lgd(C.derive_lgd(raw)).select("loan_id", "LGD"))


@query
def cleaned_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clean(spark, folder))


@query
def columns_by_kind(spark: SparkSession, folder: str) -> DataFrame:
    return P.columns_by_kind(clean(spark, folder))


@query
def feature_label_select(spark: SparkSession, folder: str) -> DataFrame:
    loans = clean(spark, folder)
    return loans.select("loan_id", F.col("PD").alias("label"), *C.feature_columns(loans))


@query
def defaulted_only(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(C.defaulted(clean(spark, folder)))


@query
def class_subset_counts(spark: SparkSession, folder: str) -> DataFrame:
    return P.class_table(raw_loans(spark, folder, ["y"]), "y")


@query
def flag_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return E.flagged(scored(spark, folder)).select("loan_id", "p", "flag")


@query
def preview(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(P.preview(clean(spark, folder), "loan_id"))


# Profiling


@query
def numeric_profile(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_loans(spark, folder)
    numbers = P.numeric_columns(raw)
    return rounded(P.numeric_profile(stage(raw.select(*numbers), "raw"), numbers), 4)


@query
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return P.value_counts(raw_loans(spark, folder, ["emp_length"]), "emp_length")


@query
def class_value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return P.value_counts(clean(spark, folder, []), "PD")


@query
def imbalance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(P.class_balance(raw_loans(spark, folder, ["y"]), "y"))


@query
def imbalance_by_column(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_loans(spark, folder)
    return rounded(P.imbalance_by_column(raw, "y", raw.columns))


@query
def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return P.null_counts(raw_loans(spark, folder))


@query
def null_rates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(P.null_rates(raw_loans(spark, folder), top=5))


@query
def distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    texts = ["emp_length", "purpose", "emp_title"]
    return P.distinct_counts(raw_loans(spark, folder, texts), texts)


@query
def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    loans = stage(clean(spark, folder, NUMBERS).select(*NUMBERS), "clean")
    return rounded(correlation(loans, NUMBERS))


@query
def box_summary_by_class(spark: SparkSession, folder: str) -> DataFrame:
    loans = stage(clean(spark, folder, NUMBERS).select("PD", *BOX_COLUMNS), "clean")
    return rounded(S.box_summary(loans, BOX_COLUMNS, "PD"))


@query
def five_number_by_class(spark: SparkSession, folder: str) -> DataFrame:
    loans = stage(clean(spark, folder, ["interest_rate"]).select("PD", "interest_rate"), "clean")
    return rounded(S.five_numbers(loans, "interest_rate", "PD"))


@query
def quartiles(spark: SparkSession, folder: str) -> DataFrame:
    loans = stage(clean(spark, folder, NUMBERS).select(*BOX_COLUMNS), "clean")
    fences = S.fit_fences(loans, BOX_COLUMNS)
    rows = [(c, f.q1, f.q3) for c, f in fences.items()]
    return rounded(spark.createDataFrame(rows, "column string, q1 double, q3 double"))


@query
def table_info(spark: SparkSession, folder: str) -> DataFrame:
    return P.table_info(clean(spark, folder))


@query
def shape(spark: SparkSession, folder: str) -> DataFrame:
    return P.shape(clean(spark, folder))


@query
def outlier_counts(spark: SparkSession, folder: str) -> DataFrame:
    loans = stage(clean(spark, folder, NUMBERS).select(*BOX_COLUMNS), "clean")
    return rounded(S.outlier_counts(loans, S.fit_fences(loans, BOX_COLUMNS)))


@query
def headline(spark: SparkSession, folder: str) -> DataFrame:
    loans = clean(spark, folder)
    return rounded(P.headline(loans, "PD", C.feature_columns(loans)))


# Transforms


@query
def iqr_treatment(spark: SparkSession, folder: str) -> DataFrame:
    loans = stage(clean(spark, folder, NUMBERS).select("loan_id", *NUMBERS), "clean")
    return rounded(S.treat_outliers(loans, S.fit_fences(loans, NUMBERS)))


@query
def one_hot_(spark: SparkSession, folder: str) -> DataFrame:
    texts = ["emp_length", "purpose"]
    vocabulary = fit_vocabulary(stage(clean(spark, folder, texts).select(*texts), "texts"), texts)
    return rounded(one_hot(clean(spark, folder), vocabulary))


@query
def one_hot_sparse(spark: SparkSession, folder: str) -> DataFrame:
    """All text columns of the loans, the one with a value per customer too, as one sparse vector, in its text form."""
    texts = ["emp_title", "purpose", "emp_length"]
    loans = stage(raw_loans(spark, folder, ["loan_id", *texts]), "texts")
    vectors = one_hot_vector(loans, stage(rank_vocabulary(loans, texts), "vocabulary"), texts)
    return vectors.select("loan_id", F.col("dummies").cast("string").alias("dummies"))


@query
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    loans = stage(encoded(spark, folder), "encoded")
    columns = C.feature_columns(loans)
    train, test = train_test_split(loans.select("loan_id", *columns))
    return rounded(scaled(test, fit_scale(train, columns)))


@query
def train_test_split_(spark: SparkSession, folder: str) -> DataFrame:
    return clean(spark, folder, []).select("loan_id", is_test("loan_id").cast("int").alias("test"))


@query
def exact_split(spark: SparkSession, folder: str) -> DataFrame:
    loans = stage(clean(spark, folder, []).select("loan_id", "PD"), "clean")
    return exact_train_test_split(loans)[1]


@query
def exact_stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    loans = stage(clean(spark, folder, []).select("loan_id", "PD"), "clean")
    return exact_train_test_split(loans, stratify="PD")[1]


@query
def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    loans = stage(clean(spark, folder, []).select("loan_id", "PD"), "clean")
    return with_folds(loans, 2, stratify="PD")


@query
def plain_folds(spark: SparkSession, folder: str) -> DataFrame:
    loans = stage(C.defaulted(clean(spark, folder, [])).select("loan_id"), "clean")
    return with_folds(loans, 2)


# Metrics


@query
def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return E.confusion(E.flagged(scored(spark, folder)))


@query
def binary_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(E.binary_metrics(E.flagged(scored(spark, folder))))


@query
def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(E.classification_report(E.flagged(scored(spark, folder))))


@query
def flagged_vs_actual(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(E.flagged_against_actual(E.flagged(scored(spark, folder))))


@query
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(E.roc_auc(stage(scored(spark, folder).select("PD", "p"), "scored")), 9)


@query
def roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(E.roc_curve(stage(scored(spark, folder).select("PD", "p"), "scored")))


@query
def roc_on_grid(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(E.roc_on_grid(stage(scored(spark, folder).select("PD", "p"), "scored")))


@query
def threshold_counts(spark: SparkSession, folder: str) -> DataFrame:
    return E.threshold_counts(scored(spark, folder))


@query
def threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return E.threshold_sweep(scored(spark, folder))


@query
def operating_point(spark: SparkSession, folder: str) -> DataFrame:
    return E.operating_point(E.threshold_sweep(scored(spark, folder)))


@query
def choose_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return E.choose_threshold(E.threshold_counts(scored(spark, folder)), 0.95)


@query
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    loans = clean(spark, folder, []).select("loan_id", "LGD")
    return rounded(E.regression_metrics(with_severity(loans, SEVERITY_STAND_INS["model_b"])))


@query
def ols_single_feature(spark: SparkSession, folder: str) -> DataFrame:
    loans = clean(spark, folder, ["max_bal_owed"]).select("LGD", (F.col("max_bal_owed") / 1000).alias("x"))
    loans = stage(loans, "clean")
    vectors = VectorAssembler(inputCols=["x"], outputCol="features").transform(loans)
    model = fit_line(vectors, "LGD")
    return rounded(
        spark.createDataFrame(
            [(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double"
        ),
        5,
    )


# Leaderboards


@query
def leaderboard_sort(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(B.pd_leaderboard(stage(model_scores(spark, folder), "scores")))


@query
def lgd_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(B.lgd_leaderboard(severity_scores(spark, folder)))


@query
def best_row(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(B.best_model(B.lgd_leaderboard(severity_scores(spark, folder)), "mae", largest=False))


@query
def filter_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(B.below(B.lgd_leaderboard(severity_scores(spark, folder)), "mae", 5))


@query
def arg_best_model(spark: SparkSession, folder: str) -> DataFrame:
    areas = E.roc_auc(stage(model_scores(spark, folder), "scores"), by=["model"])
    return rounded(B.best_model(areas, "roc_auc", order=list(STAND_INS)))


@query
def best_per_metric(spark: SparkSession, folder: str) -> DataFrame:
    board = B.lgd_leaderboard(severity_scores(spark, folder))
    return rounded(B.best_per_measure(board, largest=["r2"], smallest=["mae", "rmse"]))


@query
def best_threshold_per_metric(spark: SparkSession, folder: str) -> DataFrame:
    sweep = E.threshold_sweep(scored(spark, folder))
    return B.best_per_measure(sweep, largest=["precision", "recall", "f1"], name="threshold")


# Expected loss


@query
def expected_loss_per_loan(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(with_loss(spark, folder).select("loan_id", "EAD", "p", "el"))


@query
def expected_loss_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = X.loss_summary(with_loss(spark, folder))
    return summary.select(
        F.round("portfolio_value", 2).alias("portfolio_value"),
        F.round("expected_loss", 2).alias("expected_loss"),
        F.round("expected_loss_pct", 6).alias("expected_loss_pct"),
        "unscored",
    )


@query
def expected_loss_formatted(spark: SparkSession, folder: str) -> DataFrame:
    return X.summary_texts(X.loss_summary(with_loss(spark, folder)))


@query
def portfolio_composition(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(X.composition(with_loss(spark, folder)), 2)


@query
def el_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(S.histogram(stage(with_loss(spark, folder).select("el"), "el"), "el", 40), 4)


@query
def top_risk_loans(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(X.riskiest(with_loss(spark, folder)))


# Models. SQL cannot fit them, so these queries return what it can decide about the
# fitted models' results: whose they are, how many, in which range and order.

_fitted: dict[tuple, object] = {}


def shared(spark: SparkSession, folder: str, name: str, make: Callable[[], object]):
    """What several queries need of the same fits, made once per session and folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _fitted:
        _fitted[key] = make()
    return _fitted[key]


def quick_run(spark: SparkSession, folder: str) -> Run:
    """A run of all families without a search, of 20 boosted trees."""
    return credit_run(encoded(spark, folder), search=False, params={GBT: {"n_estimators": 20}}, fill=FILL)


def whole_run(spark: SparkSession, folder: str) -> Run:
    """All families with their default parameters and the whole search of both kinds, fitted on all training loans.

    It is made once per session and folder: every query of a model shows a part of it.
    """

    def make() -> Run:
        grids = {"pd_grids": SEARCH_GRIDS["pd"], "lgd_grids": SEARCH_GRIDS["lgd"]}
        return credit_run(encoded(spark, folder), **grids, params=PARAMS, fill=FILL)

    return shared(spark, folder, "run", make)


def _sorted_by(board: DataFrame, measure: str, largest: bool) -> bool:
    """Whether the few rows of a leaderboard stand in order."""
    values = [r[measure] for r in board.collect()]
    return values == sorted(values, reverse=largest)


def _pd_checked(scores: DataFrame) -> DataFrame:
    ordered = _sorted_by(B.pd_leaderboard(scores), "roc_auc", True)
    return scores.groupBy("model").agg(
        F.count(F.lit(1)).alias("loans"),
        F.sum("PD").cast("bigint").alias("defaults"),
        F.bool_and(F.col("p").between(0, 1)).alias("in_range"),
        F.bool_and(F.col("flag").isin(0, 1)).alias("classes"),
        F.lit(ordered).alias("board_in_order"),
    )


def _lgd_checked(scores: DataFrame) -> DataFrame:
    board = B.lgd_leaderboard(scores)
    ordered = _sorted_by(board, "mae", False)
    loans = scores.groupBy("model").agg(F.count("lgd_hat").alias("loans"))
    checked = board.select("model", (F.col("mae") <= F.col("rmse")).alias("errors_consistent"))
    return loans.join(checked, "model").withColumn("board_in_order", F.lit(ordered))


def _search_checked(train: DataFrame, found: dict[str, Search]) -> DataFrame:
    return search_table(train, found).select(
        "model",
        "candidates",
        F.size(F.map_keys("best_params")).alias("dimensions"),
        (F.col("cv_score") >= 0).alias("has_score"),
    )


@query
def product_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """What a line is solved from: sums of products of the numbers, the severity and ones over all
    defaulted loans, as shares of the columns' own."""
    loans = C.defaulted(clean(spark, folder, NUMBERS)).fillna(FILL)
    names = F.array(*[F.lit(c) for c in ("ones", *NUMBERS, "LGD")])
    sums = stage(product_sums(loans, [F.col(c) for c in (*NUMBERS, "LGD")]), "products")
    own = sums.where("i = j").select("i", F.col("value").alias("own"))
    both = sums.join(own, "i").join(own.select(F.col("i").alias("j"), F.col("own").alias("other")), "j")
    share = ratio(F.col("value"), F.sqrt(F.col("own") * F.col("other")))
    return both.select(names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), F.round(share, 9).alias("share"))


def first_splits(loans: DataFrame, label: str) -> DataFrame:
    """The split of the root of a tree over all rows, and those of its two children."""
    kept = F.lit(0).alias("node"), F.lit(1).alias("least")
    table = stage(D.with_cells(loans, F.col(label), [F.col(c) for c in NUMBERS], *kept), "cells")
    root = stage(D.best_splits(table), "root")
    children = D.moved(table, root.select("node", "feature", "threshold", F.lit(1).alias("left"), F.lit(2).alias("right")))
    both = root.unionByName(D.best_splits(children))
    name = F.array(*[F.lit(c) for c in NUMBERS])[F.col("feature")]
    place = F.array(*[F.lit(p) for p in ("root", "left", "right")])[F.col("node")]
    return both.withColumns({"place": place, "feature": name})


@query
def tree_splits(spark: SparkSession, folder: str) -> DataFrame:
    """First two levels of the default tree, over all loans."""
    found = first_splits(clean(spark, folder, NUMBERS).fillna(FILL), "PD")
    counts = [F.col(c).cast("bigint").alias(d) for c, d in (("s", "defaults"), ("s_left", "defaults_left"))]
    return rounded(found.select("place", "feature", "threshold", "n", "n_left", *counts, "gain"))


@query
def severity_splits(spark: SparkSession, folder: str) -> DataFrame:
    """First two levels of the severity tree, over all defaulted loans."""
    found = first_splits(C.defaulted(clean(spark, folder, NUMBERS)).fillna(FILL), "LGD")
    means = [F.round(F.col(s) / F.col(n), 4).alias(m) for s, n, m in (("s", "n", "mean"), ("s_left", "n_left", "mean_left"))]
    return found.select("place", "feature", F.round("threshold", 6).alias("threshold"), "n", "n_left", *means)


@query
def pd_baseline(spark: SparkSession, folder: str) -> DataFrame:
    run = whole_run(spark, folder)
    return _pd_checked(stage(pd_scores(run.pd_fits.base, run.data.pd_test, ["loan_id", "PD"]), "scores"))


@query
def pd_grid_search(spark: SparkSession, folder: str) -> DataFrame:
    run = whole_run(spark, folder)
    return _search_checked(run.data.train, run.pd_fits.searches)


@query
def pd_final(spark: SparkSession, folder: str) -> DataFrame:
    run = whole_run(spark, folder)
    scores = stage(pd_scores(run.pd_models, run.data.pd_test, ["loan_id", "PD"]), "scores")
    report = E.classification_report(scores, by=["model"])
    cells = E.confusion(scores, by=["model"]).select("model", (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("loans"))
    areas = E.roc_auc(scores, by=["model"]).select("model", F.col("roc_auc").between(0, 1).alias("area_in_range"))
    return report.select("model", "row", "support").join(cells, "model").join(areas, "model")


@query
def lgd_baseline(spark: SparkSession, folder: str) -> DataFrame:
    run = whole_run(spark, folder)
    return _lgd_checked(stage(lgd_scores(run.lgd_fits.base, run.data.lgd_test, ["loan_id", "LGD"]), "scores"))


@query
def lgd_grid_search(spark: SparkSession, folder: str) -> DataFrame:
    run = whole_run(spark, folder)
    return _search_checked(run.data.train, run.lgd_fits.searches)


@query
def lgd_final(spark: SparkSession, folder: str) -> DataFrame:
    run = whole_run(spark, folder)
    return _lgd_checked(stage(lgd_scores(run.lgd_models, run.data.lgd_test, ["loan_id", "LGD"]), "scores"))


@query
def score_portfolio_(spark: SparkSession, folder: str) -> DataFrame:
    scored_loans = whole_run(spark, folder).scored
    return rounded(
        scored_loans.select(
            "loan_id",
            "PD",
            "LGD",
            "EAD",
            F.col("p").between(0, 1).alias("p_in_range"),
            F.col("lgd_hat").isNotNull().alias("has_severity"),
            (F.col("el") <= F.col("EAD") * F.col("p") + 1e-9).alias("el_bounded"),
        )
    )


@query
def expected_loss_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    run = whole_run(spark, folder)
    total = run.scored.agg(F.sum("el")).first()[0]
    return run.summary.select(
        F.round("portfolio_value", 2).alias("portfolio_value"),
        "unscored",
        (F.abs(F.col("expected_loss") - total) < 0.01).alias("loss_is_the_sum"),
        F.col("expected_loss_pct").between(0, 1).alias("share_in_range"),
    )


@query
def run_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """All fields of the run's document: as they are where SQL knows them, else against the run's tables.

    The figures must equal those of the boards, searches and scores they come
    from, and the parameters must be a point of the chosen family's grid.
    """
    run = whole_run(spark, folder)
    meta = run.metadata.first()
    pd_search, lgd_search = run.pd_fits.searches[meta["pd_model"]], run.lgd_fits.searches.get(meta["lgd_model"])
    point = E.binary_metrics(E.flagged(run.scored, "p", meta["pd_threshold"]), "PD", "flag").first()
    lgd = run.lgd_board.filter(F.col("model") == meta["lgd_model"]).first()
    total = run.scored.agg(F.sum("el").alias("el"), F.sum("EAD").alias("ead")).first()
    own = lambda search: {k: json.dumps(v) for k, v in search.params.items()} if search else {}
    near = lambda field, value, digits: meta[field] is not None and abs(meta[field] - value) <= 0.5001 * 10**-digits
    grid = SEARCH_GRIDS["pd"][meta["pd_model"]]
    checked = {
        "pd_cv_auc": near("pd_cv_auc", pd_search.score, 4),
        "pd_best_params": meta["pd_best_params"] == own(pd_search) and all(json.loads(v) in grid[k] for k, v in meta["pd_best_params"].items()),
        "lgd_best_params": meta["lgd_best_params"] == own(lgd_search),
        "pd_test_precision": near("pd_test_precision", point["precision"], 3),
        "pd_test_recall": near("pd_test_recall", point["recall"], 3),
        "pd_test_f1": near("pd_test_f1", point["f1"], 3),
        "lgd_mae": near("lgd_mae", lgd["mae"], 4),
        "lgd_rmse": near("lgd_rmse", lgd["rmse"], 4),
        "expected_loss": near("expected_loss", total["el"], 2),
        "expected_loss_pct": near("expected_loss_pct", total["el"] / total["ead"], 4),
        "spark_version": meta["spark_version"] == spark.version,
    }
    return run.metadata.select(
        (F.col("pd_model") == B.best_model(run.pd_board, "roc_auc", True, PD_MODELS).first()["model"]).alias("pd_model"),
        (F.col("lgd_model") == B.best_model(run.lgd_board, "mae", False, LGD_MODELS).first()["model"]).alias("lgd_model"),
        "trained_on",
        "dataset",
        "pd_threshold",
        "portfolio_value",
        "positive_class",
        "positive_label",
        "max_fit_rows",
        *[F.lit(bool(v)).alias(c) for c, v in checked.items()],
    )


@query
def model_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Per test loan, the families whose saved and re-loaded model scores as the fitted one."""
    run = whole_run(spark, folder)
    out, same = run.data.test, []
    for i, fitted in enumerate(run.pd_models.values()):
        model = PipelineModel([*run.data.pd_features.stages, fitted])
        path = scratch_path(spark, "model")
        save_model(model, path)
        own = [quoted(c) for c in out.columns]
        for name, m in ((f"_fit{i}", model), (f"_load{i}", load_model(path))):
            out = m.transform(out).select(*own, vector_to_array("probability")[1].alias(name))
            own = [quoted(c) for c in out.columns]
        same.append((F.col(f"_fit{i}") == F.col(f"_load{i}")).cast("int"))
    return out.select("loan_id", sum(same).alias("equal_families"))

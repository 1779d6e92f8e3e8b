"""Scores against outcomes: confusion, rates, ROC, threshold sweep, regression errors.

Every operator takes ``by``, the columns of independent groups such as the
model name, and then gives its result per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.numeric import count_where, even_grid, f1_score, half_even, ratio, ratio_or_zero
from riskloom.functions.order_statistics import value_splits

# The thresholds of a sweep for which none are given.
DEFAULT_THRESHOLDS = [0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50]

# Fixed value: the threshold at which loans are flagged.
OPERATING_THRESHOLD = 0.10

ROWS_PER_PART = 50_000


def flagged(df: DataFrame, score: str = "p", threshold: float = OPERATING_THRESHOLD, name: str = "flag") -> DataFrame:
    """1 where the score reaches the threshold, else 0."""
    return df.withColumn(name, (F.col(score) >= threshold).cast("int"))


def _cells(label: str, predicted: str) -> list[Column]:
    y, f = F.col(label), F.col(predicted)
    return [
        count_where((y == 0) & (f == 0)).alias("tn"),
        count_where((y == 0) & (f == 1)).alias("fp"),
        count_where((y == 1) & (f == 0)).alias("fn"),
        count_where((y == 1) & (f == 1)).alias("tp"),
    ]


def confusion(df: DataFrame, label: str = "PD", predicted: str = "flag", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*_cells(label, predicted))


def _rates(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    precision = ratio_or_zero(tp.cast("double"), tp + fp)
    recall = ratio_or_zero(tp.cast("double"), tp + fn)
    return {
        "accuracy": ratio_or_zero((tp + tn).cast("double"), tp + tn + fp + fn),
        "precision": precision,
        "recall": recall,
        "f1": f1_score(precision, recall),
    }


def binary_metrics(df: DataFrame, label: str = "PD", predicted: str = "flag", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, and precision, recall and F1 of the positive class; 0 on an empty denominator."""
    cells = [F.col(c) for c in ("tn", "fp", "fn", "tp")]
    rates = [e.alias(n) for n, e in _rates(*cells).items()]
    return confusion(df, label, predicted, by).select(*by, *rates)


def classification_report(
    df: DataFrame,
    label: str = "PD",
    predicted: str = "flag",
    names: Sequence[str] = ("No Default", "Defaulter"),
    by: Sequence[str] = (),
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and both averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    negative, positive = _rates(tp, fn, fp, tn), _rates(tn, fp, fn, tp)
    n0, n1 = tn + fp, fn + tp
    total = n0 + n1
    measures = ("precision", "recall", "f1")

    def row(name: str, values: dict[str, Column], support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("row"), *[values[m].alias(m) for m in measures], support.alias("support")
        )

    macro = {m: (negative[m] + positive[m]) / 2 for m in measures}
    weighted = {m: ratio_or_zero(negative[m] * n0 + positive[m] * n1, total) for m in measures}
    nothing = F.lit(None).cast("double")
    accuracy = {"precision": nothing, "recall": nothing, "f1": positive["accuracy"]}
    rows = F.array(
        row(names[0], negative, n0),
        row(names[1], positive, n1),
        row("accuracy", accuracy, total),
        row("macro avg", macro, total),
        row("weighted avg", weighted, total),
    )
    return confusion(df, label, predicted, by).select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def flagged_against_actual(df: DataFrame, label: str = "PD", predicted: str = "flag") -> DataFrame:
    """Flagged loans, defaulted loans, and flagged per defaulted (this may exceed 1)."""
    return df.agg(count_where(F.col(predicted) == 1).alias("flagged"), count_where(F.col(label) == 1).alias("actual")).select(
        "flagged", "actual", ratio(F.col("flagged").cast("double"), F.col("actual")).alias("flagged_to_actual_ratio")
    )


def _before(x: str, window) -> Column:
    return F.coalesce(F.sum(x).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _ranked(df: DataFrame, score: str, label: str, by: Sequence[str]) -> DataFrame:
    """Per distinct score: positives and negatives at it, above it and in all.

    Rows without a score (missing or NaN) or label are left out. Equal scores are
    merged before they are shuffled. The score range is cut in parts at quantiles
    of the scores, each sorted by one task, and running totals come in two steps,
    over the few parts and inside each part. The totals of the parts are taken
    from the rows: a scan with a tiny shuffle, whereas taking them from the
    merged scores would merge and shuffle these a second time.
    """
    value = F.col(score).cast("double")
    rows = df.filter(value.isNotNull() & ~F.isnan(value) & F.col(label).isNotNull())
    rows = rows.select(*by, value.alias("score"), F.col(label).alias("_y"))
    pos, neg = count_where(F.col("_y") == 1), count_where(F.col("_y") == 0)
    whole = Window.partitionBy(*by)
    # A cut at 0 alone does no harm and lets one part take the same way as many.
    edges = [float("-inf"), *(value_splits(rows, F.col("score"), ROWS_PER_PART) or [0.0]), float("inf")]
    rows = Bucketizer(splits=edges, inputCol="score", outputCol="part").transform(rows)
    totals = rows.groupBy(*by, "part", "score").agg(pos.alias("pos"), neg.alias("neg"))
    per_part = rows.groupBy(*by, "part").agg(pos.alias("_pp"), neg.alias("_pn"))
    parts_down = whole.orderBy(F.desc("part"))
    starts = per_part.select(
        *by,
        "part",
        _before("_pp", parts_down).alias("_pos_before"),
        _before("_pn", parts_down).alias("_neg_before"),
        F.sum("_pp").over(whole).alias("all_pos"),
        F.sum("_pn").over(whole).alias("all_neg"),
    )
    down = Window.partitionBy(*by, "part").orderBy(F.desc("score"))
    return totals.join(starts, [*by, "part"]).select(
        *by,
        "score",
        "pos",
        "neg",
        (F.col("_pos_before") + _before("pos", down)).alias("pos_above"),
        (F.col("_neg_before") + _before("neg", down)).alias("neg_above"),
        "all_pos",
        "all_neg",
    )


def roc_auc(df: DataFrame, score: str = "p", label: str = "PD", by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL when one class is absent."""
    ranked = _ranked(df, score, label, by)
    pos, neg, above = (F.col(c).cast("double") for c in ("pos", "neg", "pos_above"))
    # A negative counts once for every positive above it and half for those tied.
    won = F.sum(neg * (above + pos / 2))
    totals = ranked.groupBy(*by).agg(won.alias("_won"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return totals.select(
        *by, ratio(F.col("_won"), F.col("_p").cast("double") * F.col("_n").cast("double")).alias("roc_auc")
    )


def roc_curve(df: DataFrame, score: str = "p", label: str = "PD") -> DataFrame:
    """One point per distinct score, and the origin, whose threshold is NULL.

    ``fpr`` and ``tpr`` are the shares of negatives and positives that reach
    the threshold.
    """
    ranked = _ranked(df, score, label, ())
    points = ranked.select(
        F.col("score").alias("threshold"),
        ratio((F.col("neg_above") + F.col("neg")).cast("double"), F.col("all_neg")).alias("fpr"),
        ratio((F.col("pos_above") + F.col("pos")).cast("double"), F.col("all_pos")).alias("tpr"),
    )
    origin = ranked.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def roc_on_grid(df: DataFrame, score: str = "p", label: str = "PD", points: int = 50) -> DataFrame:
    """The curve at evenly spaced ``fpr``: the highest ``tpr`` reached at or below each.

    A drawing needs a bounded number of points, however many scores there are.
    """
    curve = roc_curve(df, score, label)
    slot = F.ceil(F.round(F.col("fpr") * (points - 1), 9)).cast("int")
    best = curve.groupBy(slot.alias("i")).agg(F.max("tpr").alias("tpr"))
    grid = df.sparkSession.range(1).select(F.posexplode(even_grid(0.0, 1.0, points)).alias("i", "fpr"))
    so_far = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(best, "i", "left").select(
        "fpr", F.max("tpr").over(so_far).alias("tpr"), F.col("fpr").alias("random")
    )


def threshold_counts(
    df: DataFrame, thresholds: Sequence[float] | None = None, score: str = "p", label: str = "PD"
) -> DataFrame:
    """True and false positives, misses at each threshold, from one scan of the scores."""
    chosen = list(thresholds or DEFAULT_THRESHOLDS)
    y, p = F.col(label), F.col(score)
    aggs = [count_where(y == 1).alias("pos")]
    rows = []
    for i, t in enumerate(chosen):
        hit = p >= F.lit(float(t))
        aggs += [count_where(hit & (y == 1)).alias(f"tp{i}"), count_where(hit & (y == 0)).alias(f"fp{i}")]
        rows.append(
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.col(f"tp{i}").alias("tp"),
                F.col(f"fp{i}").alias("fp"),
                (F.col("pos") - F.col(f"tp{i}")).alias("fn"),
            )
        )
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def sweep_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 of threshold counts, to three digits."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision = ratio_or_zero(tp.cast("double"), tp + fp)
    recall = ratio_or_zero(tp.cast("double"), tp + fn)
    return counts.select(
        "threshold",
        half_even(precision, 3).alias("precision"),
        half_even(recall, 3).alias("recall"),
        half_even(f1_score(precision, recall), 3).alias("f1"),
    )


def threshold_sweep(
    df: DataFrame, thresholds: Sequence[float] | None = None, score: str = "p", label: str = "PD"
) -> DataFrame:
    """The rates at each threshold; no or an empty list means the default."""
    return sweep_rates(threshold_counts(df, thresholds, score, label))


def operating_point(sweep: DataFrame, threshold: float = OPERATING_THRESHOLD) -> DataFrame:
    return sweep.filter(F.abs(F.col("threshold") - threshold) < 1e-9)


def choose_threshold(counts: DataFrame, min_recall: float = 0.95) -> DataFrame:
    """The rates at the largest threshold whose recall, before rounding, still reaches ``min_recall``.

    ``counts`` is the result of :func:`threshold_counts`.
    """
    recall = ratio_or_zero(F.col("tp").cast("double"), F.col("tp") + F.col("fn"))
    return sweep_rates(counts.filter(recall >= min_recall).orderBy(F.desc("threshold")).limit(1))


def regression_metrics(
    df: DataFrame, actual: str = "LGD", predicted: str = "lgd_hat", by: Sequence[str] = ()
) -> DataFrame:
    """Mean absolute error, root mean squared error and R², in one pass."""
    a = F.col(actual).cast("double")
    e = a - F.col(predicted)
    sums = df.filter(e.isNotNull()).groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("_mse"),
        F.var_pop(a).alias("_var"),
        (F.min(a) == F.max(a)).alias("_constant"),
        F.count(F.lit(1)).alias("_n"),
    )
    unexplained = 1 - F.try_divide(F.col("_mse"), F.col("_var"))
    r2 = F.when(F.col("_n") < 2, F.lit(None)).otherwise(
        F.when(~F.col("_constant"), unexplained).otherwise(F.when(F.col("_mse") == 0, 1.0).otherwise(0.0))
    )
    return sums.select(*by, "mae", F.sqrt("_mse").alias("rmse"), r2.alias("r2"))

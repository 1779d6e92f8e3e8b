"""Expected loss per loan and of the portfolio."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.numeric import clip, count_where, half_even, loan_label, money_text, percent_text, ratio


def expected_loss(
    df: DataFrame, probability: str = "p", severity: str = "lgd_hat", exposure: str = "EAD", name: str = "el"
) -> DataFrame:
    """Probability times severity, held within 0 and 100 percent, times exposure."""
    share = clip(F.col(severity), 0, 100) / 100
    return df.withColumn(name, F.col(probability) * share * F.col(exposure))


def loss_summary(df: DataFrame, exposure: str = "EAD", loss: str = "el") -> DataFrame:
    """Portfolio value, expected loss, its share, and the loans without a loss, in one row.

    A loan that lacks its exposure or its prediction has no loss. The totals
    it would belong to are then unknown, so NULL, rather than too small.
    """
    sums = df.agg(
        F.sum(exposure).alias("_value"),
        F.sum(loss).alias("_loss"),
        count_where(F.col(exposure).isNull()).alias("_open"),
        count_where(F.col(loss).isNull()).alias("unscored"),
    )
    known = sums.select(
        F.when(F.col("_open") == 0, F.col("_value")).alias("portfolio_value"),
        F.when(F.col("unscored") == 0, F.col("_loss")).alias("expected_loss"),
        "unscored",
    )
    return known.select(
        "portfolio_value",
        "expected_loss",
        ratio(F.col("expected_loss"), F.col("portfolio_value")).alias("expected_loss_pct"),
        "unscored",
    )


def summary_texts(summary: DataFrame) -> DataFrame:
    """The summary as printed: money to the cent, the share in percent."""
    return summary.select(
        money_text(F.col("portfolio_value")).alias("portfolio_value"),
        money_text(F.col("expected_loss")).alias("expected_loss"),
        percent_text(F.col("expected_loss_pct")).alias("expected_loss_pct"),
    )


def composition(df: DataFrame, exposure: str = "EAD", loss: str = "el") -> DataFrame:
    """Expected loss and safe capital, each with its share in percent."""
    total, el = F.col("portfolio_value"), F.col("expected_loss")
    parts = [("Expected Loss", el), ("Safe Capital", total - el)]
    rows = [
        F.struct(F.lit(n).alias("part"), v.alias("amount"), (100 * ratio(v, total)).alias("share_pct"))
        for n, v in parts
    ]
    return loss_summary(df, exposure, loss).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def riskiest(
    df: DataFrame, rows: int = 10, key: str = "loan_id", exposure: str = "EAD", loss: str = "el"
) -> DataFrame:
    """The loans with the largest expected loss."""
    share = half_even(ratio(F.col(loss), F.col(exposure)) * 100, 1)
    return (
        df.orderBy(F.desc(loss), key)
        .limit(rows)
        .select(
            loan_label(F.col(key)).alias("loan"),
            F.col(exposure).alias("ead"),
            F.col(loss).alias("expected_loss"),
            share.alias("el_pct"),
        )
    )

"""The loan tables: order, line and customer tables seen as a loan book."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions.keys import hash_number

SPLIT_SEED = 42


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


LINE_COLUMNS = ["max_bal_owed", "num_inq", "interest_rate", "princ_rec", "y"]
CUSTOMER_COLUMNS = ["bal_to_cred_lim", "purpose", "emp_title"]
RAW_COLUMNS = [
    "loan_id", "funded_amnt", "max_bal_owed", "num_inq", "interest_rate", "bal_to_cred_lim",
    "emp_length", "purpose", "emp_title", "princ_rec", "y",
]


def raw_loans(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per order, with the columns of a raw loan extract (all, or those named).

    The line table is aggregated on the order key, and the join that follows
    uses the same partitioning, so the larger table is shuffled once. Lines and
    customers are joined only for columns that come from them; both are outer
    joins, so the rows are those of the orders whatever is asked for.
    """
    wanted = list(columns or RAW_COLUMNS)
    lines = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("loan_id"))
        .agg(
            F.max("l_extendedprice").alias("max_bal_owed"),
            F.count(F.lit(1)).alias("num_inq"),
            # Rounded, since the sum behind an average depends on row order.
            F.round(100 * F.avg("l_discount"), 6).alias("interest_rate"),
            F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("n_returned"),
        )
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_totalprice").alias("funded_amnt"),
        F.col("o_orderpriority").alias("emp_length"),
    )
    customers = table(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_acctbal").alias("bal_to_cred_lim"),
        F.col("c_mktsegment").alias("purpose"),
        F.col("c_name").alias("emp_title"),
    )
    y = F.when(10 * F.col("n_returned") >= 6 * F.col("num_inq"), 1).otherwise(0)
    loans = orders
    if set(wanted) & set(LINE_COLUMNS):
        loans = loans.join(lines, "loan_id", "left").withColumns({"princ_rec": F.col("n_returned"), "y": y})
    if set(wanted) & set(CUSTOMER_COLUMNS):
        loans = loans.join(customers, "c_custkey", "left")
    return loans.select(*wanted)


def with_stand_in_score(loans: DataFrame, name: str = "p", signal: int = 300, seed: int = SPLIT_SEED) -> DataFrame:
    """A score that needs no model: a hash of the key, raised for defaulted loans."""
    k = hash_number(F.col("loan_id"), seed) % (1000 - signal) + signal * F.col("PD")
    return loans.withColumn(name, k.cast("double") / 1000)

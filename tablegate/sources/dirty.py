"""Dirty customer / transaction sources derived from the driver tables.

The driver's TPC-H-style tables are clean, so the contract gate would have
nothing to reject. These sources inject dirt deterministically with column
expressions over the whole tables: every row is kept, some values are
replaced, and the rule is the same in Spark and in the DuckDB oracle
(``tablegate.plans.oracle``). The work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: dirt injection rules (modulus, residue) per column ---------
NAME_NULL = (17, 3)
NAME_BLANK = (19, 4)
BLANK_NAME = "  "
EMAIL_NULL = (13, 5)
EMAIL_BAD = (29, 7)
BAD_EMAIL = "not-an-email"
EMAIL_DUP = (23, 8)  # reuses the previous customer's address
COUNTRY_NULL = (31, 9)
CUSTOMER_ORPHAN = (37, 1)
ORPHAN_OFFSET = 10_000_000
AMOUNT_NULL = (41, 2)
AMOUNT_NEGATIVE = (43, 3)
DATE_WRONG_FORMAT = (47, 4)
AMOUNT_THREE_DECIMALS = (53, 5)
AMOUNT_WHOLE = (59, 6)
AMOUNT_HUGE = (61, 7)
HUGE_AMOUNT = 1e17
AMOUNT_NAN = (67, 8)
AMOUNT_INFINITE = (71, 9)
EMAIL_USER_PREFIX = "user"
EMAIL_DOMAIN = "@mail.com"
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hit(k: Column, rule: tuple[int, int]) -> Column:
    modulus, residue = rule
    return (k % modulus) == residue


def _user_email(n: Column) -> Column:
    return F.concat(F.lit(EMAIL_USER_PREFIX), n.cast("string"), F.lit(EMAIL_DOMAIN))


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(customer_id, name, email, country)`` from customer JOIN nation.

    nation is a fixed 25-row dimension: Catalyst broadcasts it because its
    measured size is under the broadcast threshold, so customer never shuffles.
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "inner").select(
        k.alias("customer_id"),
        F.when(_hit(k, NAME_NULL), F.lit(None))
        .when(_hit(k, NAME_BLANK), F.lit(BLANK_NAME))
        .otherwise(F.col("c_name"))
        .alias("name"),
        F.when(_hit(k, EMAIL_NULL), F.lit(None))
        .when(_hit(k, EMAIL_BAD), F.lit(BAD_EMAIL))
        .when(_hit(k, EMAIL_DUP), _user_email(k - 1))
        .otherwise(_user_email(k))
        .alias("email"),
        F.when(_hit(k, COUNTRY_NULL), F.lit(None)).otherwise(F.col("n_name")).alias("country"),
    )


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(transaction_id, customer_id, amount, date)`` from orders (narrow, no shuffle)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("transaction_id"),
        F.when(_hit(k, CUSTOMER_ORPHAN), k + ORPHAN_OFFSET).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.when(_hit(k, AMOUNT_NULL), F.lit(None).cast("double"))
        .when(_hit(k, AMOUNT_NEGATIVE), -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice"))
        .alias("amount"),
        F.when(_hit(k, DATE_WRONG_FORMAT), F.date_format("o_orderdate", "dd-MM-yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("date"),
    )


def inexact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dirty_transactions`` with amounts that are no decimals of two places: three places, 1e17, NaN, infinity.

    Those amounts are found in valid rows of customers 0 to 4 modulo 10 only,
    and some whole amounts (which are exact) are among the others.
    """
    t = dirty_transactions(spark, sf_dir)
    k, amount = F.col("transaction_id"), F.col("amount")
    odd = (
        F.when(_hit(k, AMOUNT_THREE_DECIMALS), F.floor(amount) + F.lit(0.125))
        .when(_hit(k, AMOUNT_HUGE), F.lit(HUGE_AMOUNT))
        .when(_hit(k, AMOUNT_NAN), F.lit(float("nan")))
        .when(_hit(k, AMOUNT_INFINITE), F.lit(float("inf")))
    )
    changed = F.when(F.col("customer_id") % 10 < 5, F.coalesce(odd, amount)).otherwise(amount)
    whole = F.when(_hit(k, AMOUNT_WHOLE), F.floor(amount).cast("double")).otherwise(changed)
    return t.withColumn("amount", F.when(amount.isNull(), amount).otherwise(whole))


def clean_customers_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The undirtied customer source (for the passing reconciliation variant)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "inner").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        _user_email(F.col("c_custkey")).alias("email"),
        F.col("n_name").alias("country"),
    )


def clean_transactions_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The undirtied transaction source."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
    )

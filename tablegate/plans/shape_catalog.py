"""Queries over the shaped sources: rules, coercion of strings, and masking of typed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions import rules
from tablegate.operators import contract
from tablegate.operators.contract import Contract, Field
from tablegate.plans.contracts import TRANSACTION_CONTRACT
from tablegate.session import run_folder
from tablegate.sources import shapes
from tablegate.sources.sinks import outcome_columns
from tablegate.sources.text import read_text


def rule_email_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = shapes.shaped_customers(spark, sf_dir)
    return c.select("customer_id", "email", rules.email()(F.col("email")).alias("email_valid"))


def rule_not_blank_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = shapes.shaped_customers(spark, sf_dir)
    return c.select("customer_id", rules.not_blank()(F.col("name")).alias("name_not_blank"))


def rule_iso_date_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = shapes.shaped_dates(spark, sf_dir)
    return t.select("transaction_id", rules.iso_date()(F.col("date")).alias("date_valid"))


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.gate(shapes.string_transactions(spark, sf_dir), TRANSACTION_CONTRACT)


def gate_strings_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed values; NaN and infinity, which are clean, by name."""
    amount = F.col("amount")
    special = F.when(F.isnan(amount), F.lit("nan")).when(amount == float("inf"), F.lit("inf"))
    return contract.clean(_gated(spark, sf_dir)).select(
        "transaction_id",
        "customer_id",
        F.when(special.isNull(), amount).alias("amount"),
        special.alias("special_amount"),
        "date",
    )


def gate_strings_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.rejected(_gated(spark, sf_dir))


def masked_rejects_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows as the quarantine holds them, a field that was to be a number masked with the rest."""
    gated = _gated(spark, sf_dir)
    written = gated.select(*outcome_columns(gated, ["transaction_id", "date"]))
    return contract.rejected(written).select(
        F.col("transaction_id").alias("transaction_id_sha256"), "customer_id", F.col("date").alias("date_sha256"), "rejection_reason"
    )


LONG_CONTRACT = Contract(
    "long",
    (
        Field("email", T.StringType(), (rules.email(),)),
        Field("name", T.StringType(), (rules.not_blank(),)),
        Field("day", T.StringType(), (rules.iso_date(),)),
        Field("id", T.LongType()),
        Field("amount", T.DoubleType(), (rules.positive_amount(),)),
        Field("price", T.DecimalType(18, 2)),
    ),
)


def gate_long_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule and coercion of strings on values of thousands to two million characters."""
    source = shapes.long_values(spark, sf_dir)
    value = F.col("value")
    fields = source.select("customer_id", F.length(value).cast("long").alias("n_chars"), *[value.alias(f) for f in LONG_CONTRACT.field_names])
    return contract.gate(fields, LONG_CONTRACT).select(
        "customer_id",
        "n_chars",
        "id",
        F.col("price").cast("string").alias("price"),
        F.array_join(F.col("_violations")["field"], ",").alias("bad_fields"),
    )


def _text_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions written as CSV lines to the shared folder, read back as text and gated."""
    path = f"{run_folder(spark, 'lines')}/transactions"
    shapes.transaction_lines(spark, sf_dir).write.text(path)
    return contract.gate(read_text(spark, path, TRANSACTION_CONTRACT, columns=TRANSACTION_CONTRACT.field_names), TRANSACTION_CONTRACT)


def gate_text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.clean(_text_gated(spark, sf_dir))


def gate_text_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines: the fields of those that could be read, the whole line of those that could not."""
    rows = contract.rejected(_text_gated(spark, sf_dir))
    line = F.col(contract.CORRUPT)
    fields = [F.when(line.isNull(), F.col(f)).alias(f) for f in TRANSACTION_CONTRACT.field_names]
    return rows.select(*fields, line.alias("line"), "rejection_reason")


QUERIES = {
    "gate_text_clean": gate_text_clean,
    "gate_text_rejected": gate_text_rejected,
    "gate_long_values": gate_long_values,
    "rule_email_shapes": rule_email_shapes,
    "rule_not_blank_shapes": rule_not_blank_shapes,
    "rule_iso_date_shapes": rule_iso_date_shapes,
    "gate_strings_clean": gate_strings_clean,
    "gate_strings_rejected": gate_strings_rejected,
    "masked_rejects_typed": masked_rejects_typed,
}

"""Audit report and alert outbox.

The report is ONE row built by a global aggregate over the check summaries
(a handful of rows) and the gate counts (one row per entity): no join, no
driver round trip. ``details`` travel as JSON strings and are turned into
VARIANT values in the report, so the JSON sink nests them as objects.

Alerts are not sent from here (the reference's senders are stubs): a failing
report yields one outbox row per channel, which a delivery process drains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.operators.contract import union_all
from tablegate.operators.summary import SUMMARY_COLUMNS, AuditCheck

# --- Fixed values: the reference's placeholder channel targets and subject ---
DEFAULT_WEBHOOK_URL = "https://mock.webhook.example/alert"
DEFAULT_EMAIL_TO = "data-team@example.com"
DEFAULT_SUBJECT = "ETL Audit Failed"
# -----------------------------------------------------------------------------

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def summaries(checks: list[AuditCheck]) -> DataFrame:
    """Union of the one-row summaries, each tagged with its input position."""
    return union_all(
        [c.summary.select(F.lit(i).alias("ordinal"), *SUMMARY_COLUMNS) for i, c in enumerate(checks)]
    )


def status_label(passed: str = "passed"):
    """``PASS`` / ``FAIL``."""
    return F.when(F.col(passed), F.lit("PASS")).otherwise(F.lit("FAIL"))


def build_report(summary_rows: DataFrame, gate_counts: DataFrame | None = None) -> DataFrame:
    """One row ``(timestamp, overall_pass, audit_checks, rejected_at_gate)``.

    ``summary_rows`` is ``summaries(...)`` output; ``gate_counts`` is
    ``(entity, clean_rows, rejected_rows)``. ``overall_pass`` is the AND of
    every check and TRUE for no checks (``all([])``). ``timestamp`` is the
    naive UTC ISO time of the run.
    """
    check = F.struct("ordinal", "check_name", "passed", "violation_count", "details")
    checks = summary_rows.select(
        check.alias("c"),
        F.lit(None).cast("string").alias("entity"),
        F.lit(None).cast("bigint").alias("rejected"),
    )
    rows = checks
    if gate_counts is not None:
        check_type = checks.schema["c"].dataType
        rows = checks.unionByName(
            gate_counts.select(
                F.lit(None).cast(check_type).alias("c"),
                F.col("entity"),
                F.col("rejected_rows").cast("bigint").alias("rejected"),
            )
        )
    agg = rows.agg(
        F.coalesce(F.bool_and("c.passed"), F.lit(True)).alias("overall_pass"),
        F.sort_array(F.collect_list("c")).alias("_checks"),
        F.sort_array(
            F.collect_list(F.when(F.col("entity").isNotNull(), F.struct("entity", "rejected")))
        ).alias("_gate"),
    )
    audit_checks = F.transform(
        "_checks",
        lambda c: F.struct(
            c["check_name"].alias("check_name"),
            c["passed"].alias("passed"),
            c["violation_count"].alias("violation_count"),
            F.parse_json(c["details"]).alias("details"),
        ),
    )
    ts = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), TIMESTAMP_FORMAT)
    return agg.select(
        ts.alias("timestamp"),
        F.col("overall_pass"),
        audit_checks.alias("audit_checks"),
        F.map_from_entries("_gate").alias("rejected_at_gate"),
    )


def alert_outbox(
    report: DataFrame,
    webhook_url: str = DEFAULT_WEBHOOK_URL,
    email_to: str = DEFAULT_EMAIL_TO,
    subject: str = DEFAULT_SUBJECT,
) -> DataFrame:
    """L1-L3: one ``(channel, target, subject, body)`` row per channel when the run failed.

    ``body`` is the report as JSON. A passing report yields no rows. The two
    channel rows come from ``explode`` of a two-element array, not a join.
    """
    body = F.to_json(F.struct(*[F.col(c) for c in report.columns]))
    channels = F.array(
        F.struct(F.lit("webhook").alias("channel"), F.lit(webhook_url).alias("target")),
        F.struct(F.lit("email").alias("channel"), F.lit(email_to).alias("target")),
    )
    return (
        report.filter(~F.col("overall_pass"))
        .select(F.explode(channels).alias("o"), body.alias("body"))
        .select(F.col("o.channel"), F.col("o.target"), F.lit(subject).alias("subject"), "body")
    )

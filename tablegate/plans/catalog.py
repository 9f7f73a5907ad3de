"""Named queries over the driver tables, one per operator (``__spark_entry__``).

Every query reads the whole ``customer`` / ``nation`` / ``orders`` tables
through the dirty sources and returns a DataFrame; nothing here collects.
The audit's own queries (``audit_*``, ``alert_*``) first write the gated
sources to the shared folder. Column names match ``tablegate.plans.oracle`` exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.functions import masking, rules
from tablegate.operators import audit, contract, enrich, reconcile, report
from tablegate.plans import job
from tablegate.plans.contracts import COMPLETENESS_COLUMNS, CUSTOMER_CONTRACT, TRANSACTION_CONTRACT
from tablegate.plans.shape_catalog import QUERIES as SHAPE_QUERIES
from tablegate.session import materialize, run_folder
from tablegate.sources import dirty
from tablegate.sources.sinks import write_split

Query = Callable[[SparkSession, str], DataFrame]


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty.dirty_customers(spark, sf_dir)


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty.dirty_transactions(spark, sf_dir)


def _annotated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        contract.gate(_customers(spark, sf_dir), CUSTOMER_CONTRACT),
        contract.gate(_transactions(spark, sf_dir), TRANSACTION_CONTRACT),
    )


def _clean(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c, t = _annotated(spark, sf_dir)
    return contract.clean(c), contract.clean(t)


# --- gate (C7-C10) -------------------------------------------------------------


def gate_customers_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.clean(_annotated(spark, sf_dir)[0])


def gate_customers_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.rejected(_annotated(spark, sf_dir)[0])


def gate_transactions_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.clean(_annotated(spark, sf_dir)[1])


def gate_transactions_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.rejected(_annotated(spark, sf_dir)[1])


def rejections_by_field_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t = _annotated(spark, sf_dir)
    return contract.violation_counts(c, "customers").unionByName(contract.violation_counts(t, "transactions"))


def gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t = _annotated(spark, sf_dir)
    return contract.gate_counts(c, "customers").unionByName(contract.gate_counts(t, "transactions"))


# --- single rules (C2-C6): predicate per row, NULL where the value is NULL ---------


def rule_not_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customers(spark, sf_dir)
    nb = rules.not_blank()
    return c.select("customer_id", nb(F.col("name")).alias("name_not_blank"), nb(F.col("country")).alias("country_not_blank"))


def rule_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customers(spark, sf_dir)
    return c.select("customer_id", "email", rules.email()(F.col("email")).alias("email_valid"))


def rule_positive_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _transactions(spark, sf_dir)
    return t.select("transaction_id", "customer_id", rules.positive()(F.col("customer_id")).alias("customer_id_positive"))


def rule_positive_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _transactions(spark, sf_dir)
    return t.select("transaction_id", "amount", rules.positive_amount()(F.col("amount")).alias("amount_positive"))


def rule_iso_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _transactions(spark, sf_dir)
    return t.select("transaction_id", "date", rules.iso_date()(F.col("date")).alias("date_valid"))


# --- enrich (J1, G1, O1) -----------------------------------------------------------


def enriched_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t = _clean(spark, sf_dir)
    return enrich.enrich(t, c, "customer_id")


def spend_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t = _clean(spark, sf_dir)
    return enrich.order_desc(enrich.group_totals(t, c), "total_amount", "country")


# --- audits (A1-A3) ----------------------------------------------------------------


def _completeness(c: DataFrame, t: DataFrame) -> audit.AuditCheck:
    return audit.completeness(
        [
            ("customers", c, COMPLETENESS_COLUMNS["customers"]),
            ("transactions", t, COMPLETENESS_COLUMNS["transactions"]),
        ]
    )


def completeness_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _completeness(_customers(spark, sf_dir), _transactions(spark, sf_dir)).violations


def completeness_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _completeness(*_clean(spark, sf_dir)).violations


def uniqueness_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.uniqueness(_customers(spark, sf_dir), "email").violations


def uniqueness_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, _ = _clean(spark, sf_dir)
    return audit.uniqueness(c, "email").violations


def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t = _clean(spark, sf_dir)
    return audit.orphan_keys(t, c, "customer_id")


def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t = _clean(spark, sf_dir)
    return audit.orphan_rows(t, c, "customer_id")


# --- reconciliation (A4-A6) ----------------------------------------------------------


def raw_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, c = _transactions(spark, sf_dir), _customers(spark, sf_dir)
    return enrich.order_desc(reconcile.raw_totals(t, c, as_double=True), "raw_total", "country")


def _comparison(t_raw: DataFrame, c_raw: DataFrame, t_clean: DataFrame, c_clean: DataFrame) -> DataFrame:
    raw = reconcile.raw_totals(t_raw, c_raw)
    clean = enrich.group_totals(t_clean, c_clean, as_double=False)
    return reconcile.compare_totals(raw, clean)


def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean and raw totals in one pass over each gated source."""
    c, t = _annotated(spark, sf_dir)
    return reconcile.fused_totals(t, c)


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 via ``fused_totals``: each source is scanned once for both sides."""
    cmp = reconcile.fused_comparison(_fused(spark, sf_dir))
    diff = reconcile.mismatches(cmp).select("country", "raw_total", "clean_total")
    return reconcile.to_double(diff, ["raw_total", "clean_total"])


def reconciliation_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 via the explicit formulation: raw totals FULL OUTER JOIN clean totals."""
    c, t = _clean(spark, sf_dir)
    cmp = _comparison(_transactions(spark, sf_dir), _customers(spark, sf_dir), t, c)
    out = reconcile.to_double(reconcile.deltas(cmp), ["raw_total", "clean_total", "delta"])
    return enrich.order_desc(out, "delta", "country")


def reconciliation_passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passing variant: the clean tables are the raw side too; every delta is 0."""
    c, t = _annotated(spark, sf_dir)
    ok = contract.is_clean()
    fused = reconcile.fused_totals(t.filter(ok), c.filter(ok))
    cmp = reconcile.fused_comparison(fused).select("country", "raw_total", "clean_total")
    out = reconcile.to_double(reconcile.deltas(cmp), ["raw_total", "clean_total", "delta"])
    return enrich.order_desc(out, "delta", "country")


# --- the orders as a column (O1, O2) -------------------------------------------------


def spend_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t = _clean(spark, sf_dir)
    return enrich.ranked_desc(enrich.group_totals(t, c), "total_amount", "country")


def raw_totals_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = reconcile.raw_totals(_transactions(spark, sf_dir), _customers(spark, sf_dir), as_double=True)
    return enrich.ranked_desc(totals, "raw_total", "country")


def delta_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 from one pass over each source, with its order as a column."""
    cmp = reconcile.fused_comparison(_fused(spark, sf_dir)).select("country", "raw_total", "clean_total")
    out = reconcile.to_double(reconcile.deltas(cmp), ["raw_total", "clean_total", "delta"])
    return enrich.ranked_desc(out.select("country", "delta"), "delta", "country")


# --- amounts that are no exact decimals ------------------------------------------------


def _inexact_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = contract.gate(_customers(spark, sf_dir), CUSTOMER_CONTRACT)
    t = contract.gate(dirty.inexact_transactions(spark, sf_dir), TRANSACTION_CONTRACT)
    return reconcile.fused_totals(t, c)


def totals_inexact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per country: exact totals of both sides and the joined rows that are not in them."""
    fused = _inexact_fused(spark, sf_dir)
    out = fused.select("country", "raw_total", "clean_total", "raw_pairs", "clean_pairs", "raw_inexact", "clean_inexact", "raw_nan")
    return reconcile.to_double(out, ["raw_total", "clean_total"])


def totals_as_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 where some amounts are no exact decimals: each country's total as a double, by name where it is no number.

    ``finite`` totals leave the amounts that are NaN or infinite aside; ``all`` totals hold them.
    """
    c, t = _customers(spark, sf_dir), dirty.inexact_transactions(spark, sf_dir)
    parts = []
    for kind, facts in (("finite", t.filter(rules.finite()(F.col("amount")))), ("all", t)):
        total = F.col("total_amount")
        special = F.when(F.isnan(total), F.lit("nan")).when(total == float("inf"), F.lit("inf")).when(total == float("-inf"), F.lit("-inf"))
        sums = enrich.group_totals(facts, c.filter(F.col("country").isNotNull()))
        parts.append(sums.select(F.lit(kind).alias("kind"), "country", F.when(special.isNull(), total).alias("total"), special.alias("special")))
    return contract.union_all(parts)


def reconciliation_inexact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 where some amounts are no exact decimals: their groups are mismatches."""
    cmp = reconcile.fused_comparison(_inexact_fused(spark, sf_dir))
    out = reconcile.mismatches(cmp).select("country", "raw_total", "clean_total", "raw_inexact", "clean_inexact")
    return reconcile.to_double(out, ["raw_total", "clean_total"])


# --- masking, summary, report, alerts (A7, A8, R1, L1-L3) -----------------------------


def masked_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rej = gate_customers_rejected(spark, sf_dir)
    return masking.mask(rej, ["name", "email"], suffix="_sha256").select(
        "customer_id", "name_sha256", "email_sha256", "country", "rejection_reason"
    )


def _gated_once(spark: SparkSession, sf_dir: str) -> tuple[list[audit.AuditCheck], DataFrame]:
    """The four checks and the gate counts, from splits written once, as ``run_audit`` does: one read of each source."""
    cfg, root = job.AuditConfig(), run_folder(spark, "checks")
    c, t = _annotated(spark, sf_dir)
    dims = write_split(c, f"{root}/{cfg.dims_name}", cfg.dims_name, cfg.completeness[cfg.dims_name])
    facts = write_split(t, f"{root}/{cfg.facts_name}", cfg.facts_name, cfg.completeness[cfg.facts_name])
    fused = materialize(job.split_totals(dims, facts, cfg), f"{root}/totals")
    return job.split_checks(spark, dims, facts, fused, cfg), job.split_counts(spark, dims, facts, cfg)


def audit_checks(spark: SparkSession, sf_dir: str) -> list[audit.AuditCheck]:
    """The four reference checks over the gated dirty sources."""
    return _gated_once(spark, sf_dir)[0]


def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = report.summaries(audit_checks(spark, sf_dir))
    return rows.select("check_name", "passed", report.status_label().alias("status"), "violation_count")


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks, counts = _gated_once(spark, sf_dir)
    return report.build_report(report.summaries(checks), counts)


def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _report(spark, sf_dir)
    return r.select(
        "overall_pass",
        F.size("audit_checks").cast("bigint").alias("n_checks"),
        F.size(F.filter("audit_checks", lambda c: ~c["passed"])).cast("bigint").alias("n_failed"),
        F.col("rejected_at_gate")["customers"].alias("rejected_customers"),
        F.col("rejected_at_gate")["transactions"].alias("rejected_transactions"),
    )


def alert_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.alert_outbox(_report(spark, sf_dir)).select("channel", "target", "subject")


def audit_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every violation of the keyed checks -> ``(check_name, key, n)``; nothing is sampled."""
    keys = {"uniqueness": ("email", F.col("n")), "referential_integrity": ("customer_id", F.col("n_rows")), "reconciliation": ("country", F.lit(1))}
    checks = [c for c in audit_checks(spark, sf_dir) if c.name in keys]
    return contract.union_all(
        [
            c.violations.select(
                F.lit(c.name).alias("check_name"),
                F.col(keys[c.name][0]).cast("string").alias("key"),
                keys[c.name][1].cast("bigint").alias("n"),
            )
            for c in checks
        ]
    )


DETAILS_TYPE = (
    "null_counts map<string,bigint>, violation_count bigint, duplicate_rows bigint, orphan_rows bigint, "
    "duplicate_emails array<string>, orphan_customer_ids array<bigint>, "
    "country_mismatches array<struct<country string, raw_total double, clean_total double>>"
)


def audit_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the report says of each check, one row per item -> ``(check_name, item, value)``."""
    rows = _report(spark, sf_dir).select(F.explode("audit_checks").alias("c"))
    parsed = rows.select("c.check_name", F.from_json(F.to_json("c.details"), DETAILS_TYPE).alias("d"))

    def entry(item, value):
        return F.struct(item.alias("item"), value.cast("string").alias("value"))

    def listed(name, value=lambda x: x):
        return F.transform(F.col(f"d.{name}"), lambda x: entry(F.lit(name), value(x)))

    def money(c):
        return c.cast("decimal(18,2)").cast("string")

    parts = [
        F.transform(F.map_entries("d.null_counts"), lambda e: entry(F.concat(F.lit("null_counts."), e["key"]), e["value"])),
        *[F.array(entry(F.lit(n), F.col(f"d.{n}"))) for n in ("violation_count", "duplicate_rows", "orphan_rows")],
        listed("duplicate_emails"),
        listed("orphan_customer_ids"),
        listed("country_mismatches", lambda m: F.concat_ws("|", m["country"], money(m["raw_total"]), money(m["clean_total"]))),
    ]
    nothing = F.array().cast("array<struct<item:string,value:string>>")
    items = F.concat(*[F.coalesce(p, nothing) for p in parts])
    return parsed.select("check_name", F.explode(items).alias("i")).where("i.value IS NOT NULL").select("check_name", "i.item", "i.value")


def alert_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of the alerts' JSON bodies, one row per channel and check."""
    body = (
        "timestamp string, overall_pass boolean, rejected_at_gate map<string,bigint>, "
        "audit_checks array<struct<check_name string, passed boolean, violation_count bigint>>"
    )
    parsed = report.alert_outbox(_report(spark, sf_dir)).select("channel", F.from_json("body", body).alias("b"))
    return parsed.select("channel", "b", F.explode("b.audit_checks").alias("c")).select(
        "channel",
        F.col("b.overall_pass").alias("overall_pass"),
        F.col("b.timestamp").isNotNull().alias("has_timestamp"),
        F.col("b.rejected_at_gate")["customers"].alias("rejected_customers"),
        F.col("b.rejected_at_gate")["transactions"].alias("rejected_transactions"),
        "c.check_name",
        "c.passed",
        "c.violation_count",
    )


QUERIES: dict[str, Query] = {
    "gate_customers_clean": gate_customers_clean,
    "gate_customers_rejected": gate_customers_rejected,
    "gate_transactions_clean": gate_transactions_clean,
    "gate_transactions_rejected": gate_transactions_rejected,
    "rule_not_blank": rule_not_blank,
    "rule_email": rule_email,
    "rule_positive_id": rule_positive_id,
    "rule_positive_amount": rule_positive_amount,
    "rule_iso_date": rule_iso_date,
    "rejections_by_field_rule": rejections_by_field_rule,
    "gate_counts": gate_counts,
    "enriched_transactions": enriched_transactions,
    "spend_by_country": spend_by_country,
    "completeness_raw": completeness_raw,
    "completeness_clean": completeness_clean,
    "uniqueness_raw": uniqueness_raw,
    "uniqueness_clean": uniqueness_clean,
    "orphan_keys": orphan_keys,
    "orphan_rows": orphan_rows,
    "raw_totals": raw_totals,
    "reconciliation": reconciliation,
    "reconciliation_delta": reconciliation_delta,
    "reconciliation_passing": reconciliation_passing,
    "spend_ranking": spend_ranking,
    "raw_totals_ranking": raw_totals_ranking,
    "delta_ranking": delta_ranking,
    "totals_inexact": totals_inexact,
    "reconciliation_inexact": reconciliation_inexact,
    "totals_as_doubles": totals_as_doubles,
    "masked_rejects": masked_rejects,
    "audit_summary": audit_summary,
    "audit_report": audit_report,
    "alert_outbox": alert_outbox,
    "audit_violations": audit_violations,
    "audit_details": audit_details,
    "alert_bodies": alert_bodies,
    **SHAPE_QUERIES,
}

"""tablegate: data contracts, audits and reconciliation as Spark DataFrame jobs.

Importing creates no SparkSession; every function takes DataFrames (and the
session where it needs one) from the caller.
"""

from tablegate.functions import rules
from tablegate.functions.masking import mask
from tablegate.operators.audit import completeness, orphan_rows, referential_integrity, uniqueness
from tablegate.operators.contract import Contract, Field, clean, gate, gate_counts, rejected, violation_counts
from tablegate.operators.enrich import enrich, group_totals, order_desc
from tablegate.operators.reconcile import compare_totals, deltas, fused_totals, raw_totals, reconciliation
from tablegate.operators.report import alert_outbox, build_report, summaries
from tablegate.plans.job import AuditConfig, AuditRun, run_audit
from tablegate.sources.sinks import save_report, write_split

__version__ = "0.1.0"

__all__ = [
    "AuditConfig", "AuditRun", "Contract", "Field", "alert_outbox", "build_report", "clean",
    "compare_totals", "completeness", "deltas", "enrich", "fused_totals", "gate", "gate_counts",
    "group_totals", "mask", "order_desc", "orphan_rows", "raw_totals", "reconciliation",
    "referential_integrity", "rejected", "rules", "run_audit", "save_report", "save_report_file",
    "summaries", "uniqueness", "violation_counts", "write_split",
]

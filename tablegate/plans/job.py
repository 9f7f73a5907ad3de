"""End-to-end audit job (E1): gate -> enrich -> totals -> 4 audits -> report -> outbox.

Actions per run, whatever the data size (with AQE each shuffle stage of an
action is submitted as its own Spark job, so ``AuditRun.jobs`` is larger but
still a constant of the plan):

1. customers gate, written once partitioned by outcome; gate counts and the
   completeness NULL counts are observed on that same write;
2. transactions gate, likewise, submitted together with 1 (independent jobs);
3. clean AND raw group totals in one pass over the two written splits
   (``fused_totals``), written (one row per group) -- the raw sources are
   never scanned again;
4. uniqueness, referential integrity, reconciliation and the report,
   written as ONE row (one plan over the written splits and totals);
5. the JSON report, 6. the outbox (empty when the run passed), 7. a one-row
   read of the verdict.

Everything between steps goes through files under the shared checkpoint
folder, so a lost executor costs a task retry on the last written table,
never a replay from the sources. Only the one-row report and the two
observed counts reach the driver.
"""

from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from tablegate.functions.masking import mask
from tablegate.operators import audit, enrich, reconcile, report
from tablegate.operators.contract import Contract, gate
from tablegate.operators.summary import DEFAULT_SAMPLE, AuditCheck
from tablegate.plans.contracts import COMPLETENESS_COLUMNS, CUSTOMER_CONTRACT, TRANSACTION_CONTRACT
from tablegate.session import literal_rows, materialize, run_folder
from tablegate.sources.sinks import Split, clean_flag, save_report, write_outbox, write_split

logger = logging.getLogger(__name__)


@dataclass
class AuditConfig:
    """Everything entity-specific is a parameter; defaults are the reference's."""

    dims_contract: Contract = CUSTOMER_CONTRACT
    facts_contract: Contract = TRANSACTION_CONTRACT
    dims_name: str = "customers"
    facts_name: str = "transactions"
    key: str = "customer_id"
    group: str = "country"
    amount: str = "amount"
    unique_keys: tuple[str, ...] = ("email",)
    completeness: dict[str, list[str]] = field(default_factory=lambda: dict(COMPLETENESS_COLUMNS))
    precision: int = enrich.DEFAULT_PRECISION
    scale: int = enrich.DEFAULT_SCALE
    tolerance: float = 0.0
    sample_size: int = DEFAULT_SAMPLE
    mask_columns: tuple[str, ...] = ()
    write_enriched: bool = False
    rejected_files: int | None = None  # also write a compact quarantine table in this many files
    write_violations: bool = True  # write every check's full violations under <run>/violations/<check>
    webhook_url: str = report.DEFAULT_WEBHOOK_URL
    email_to: str = report.DEFAULT_EMAIL_TO
    subject: str = report.DEFAULT_SUBJECT


@dataclass
class AuditRun:
    path: str
    dims: Split
    facts: Split
    enriched: DataFrame
    totals: DataFrame
    checks: list[AuditCheck]
    report: DataFrame
    outbox: DataFrame
    overall_pass: bool
    inexact_amounts: int
    jobs: int


def _jobs_in_group(spark: SparkSession, group_id: str) -> int:
    try:
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group_id))
    except Exception:  # Spark Connect: no status tracker
        return -1


def _check_columns(df: DataFrame, contract: Contract, needed: list[str], entity: str) -> None:
    """Fail before any job when a configured column is neither in the input nor the contract."""
    known = set(df.columns) | set(contract.field_names)
    missing = [c for c in needed if c not in known]
    if missing:
        raise ValueError(f"{entity}: columns {missing} are configured but not in the input or its contract")


def _check_masking(raw_dims: DataFrame, raw_facts: DataFrame, cfg: AuditConfig) -> None:
    """Fail before any job when a masked column is unknown or one that totals and joins need."""
    fixed = [c for c in cfg.mask_columns if c in (cfg.key, cfg.group, cfg.amount)]
    known = {*raw_dims.columns, *raw_facts.columns, *cfg.dims_contract.field_names, *cfg.facts_contract.field_names}
    unknown = [c for c in cfg.mask_columns if c not in known]
    if fixed or unknown:
        raise ValueError(f"cannot mask {fixed} (key, group or amount) nor {unknown} (in no input)")


def _masked(df: DataFrame, contract: Contract, columns: tuple[str, ...]) -> list[str]:
    """Those of ``columns`` that the gated table has."""
    return [c for c in columns if c in df.columns or c in contract.field_names]


def split_totals(dims: Split, facts: Split, cfg: AuditConfig) -> DataFrame:
    """Clean and raw totals in one pass over the written splits; one row per group."""
    return reconcile.fused_totals(
        facts.annotated, dims.annotated, cfg.key, cfg.group, cfg.amount, cfg.precision, cfg.scale,
        clean_flag=clean_flag(),
    )


def split_checks(spark: SparkSession, dims: Split, facts: Split, fused: DataFrame, cfg: AuditConfig) -> list[AuditCheck]:
    """The four checks over the written splits and their totals; no source is read."""
    clean_for_checks = dims.clean
    if cfg.mask_columns:
        clean_for_checks = mask(dims.clean, [c for c in cfg.mask_columns if c in cfg.unique_keys])
    observed = [
        (name, col, split.clean_null_counts[col])
        for name, split in ((cfg.dims_name, dims), (cfg.facts_name, facts))
        for col in cfg.completeness.get(name, [])
    ]
    return [
        audit.completeness_from_counts(spark, observed),
        audit.uniqueness(clean_for_checks, list(cfg.unique_keys), cfg.sample_size),
        audit.referential_integrity(facts.clean, dims.clean, cfg.key, cfg.sample_size),
        reconcile.reconciliation_from(
            reconcile.fused_comparison(fused, cfg.group, cfg.scale), cfg.group, cfg.tolerance, cfg.sample_size
        ),
    ]


def split_counts(spark: SparkSession, dims: Split, facts: Split, cfg: AuditConfig) -> DataFrame:
    """One row ``(entity, clean_rows, rejected_rows)`` per split, as observed on its write."""
    return literal_rows(
        spark,
        T.StructType(
            [
                T.StructField("entity", T.StringType(), False),
                T.StructField("clean_rows", T.LongType(), False),
                T.StructField("rejected_rows", T.LongType(), False),
            ]
        ),
        [
            (cfg.dims_name, dims.clean_rows, dims.rejected_rows),
            (cfg.facts_name, facts.clean_rows, facts.rejected_rows),
        ],
    )


def run_audit(
    spark: SparkSession,
    raw_dims: DataFrame,
    raw_facts: DataFrame,
    config: AuditConfig | None = None,
    output_dir: str | None = None,
) -> AuditRun:
    """Run the whole audit; outputs land under ``output_dir`` (default: a
    fresh folder under ``spark.checkpoint.dir``)."""
    cfg = config or AuditConfig()
    _check_columns(raw_dims, cfg.dims_contract, [cfg.key, cfg.group, *cfg.unique_keys], cfg.dims_name)
    _check_columns(raw_facts, cfg.facts_contract, [cfg.key, cfg.amount], cfg.facts_name)
    _check_masking(raw_dims, raw_facts, cfg)
    root = output_dir or run_folder(spark, "audit")
    group_id = f"tablegate-audit-{uuid.uuid4().hex[:8]}"
    sc = None
    try:
        sc = spark.sparkContext
        sc.setJobGroup(group_id, "tablegate audit run")
    except Exception:
        sc = None
    in_thread = inheritable_thread_target(spark)  # job group / tags follow the worker threads
    try:
        # Amounts that are no exact decimals are counted on the same write; the
        # reconciliation fails the groups that hold them unless nothing was removed.
        inexact = F.count_if(enrich.inexact(cfg.amount, cfg.precision, cfg.scale))
        # The two gate writes are independent jobs: submit them together so the
        # smaller one runs on executors the larger one leaves idle.
        with ThreadPoolExecutor(max_workers=2) as pool:
            dims_job = pool.submit(in_thread(write_split),
                gate(raw_dims, cfg.dims_contract), f"{root}/{cfg.dims_name}", cfg.dims_name,
                cfg.completeness.get(cfg.dims_name, []), _masked(raw_dims, cfg.dims_contract, cfg.mask_columns),
            )
            facts_job = pool.submit(in_thread(write_split),
                gate(raw_facts, cfg.facts_contract), f"{root}/{cfg.facts_name}", cfg.facts_name,
                cfg.completeness.get(cfg.facts_name, []), _masked(raw_facts, cfg.facts_contract, cfg.mask_columns), [inexact.alias("inexact_amounts")],
            )
            dims, facts = dims_job.result(), facts_job.result()
        if cfg.rejected_files:
            # The single-pass split leaves one rejected file per input task; a
            # compact quarantine table (rows + reasons) merges them without a
            # shuffle. Consumers read this; the split stays internal.
            for name, split in ((cfg.dims_name, dims), (cfg.facts_name, facts)):
                split.rejected = materialize(split.rejected.coalesce(cfg.rejected_files), f"{root}/{name}_rejected")
        inexact_amounts = facts.metrics["inexact_amounts"]
        if inexact_amounts:
            logger.warning(
                "%d %s rows have an amount that is no decimal(%d,%d) (NaN, infinite, too large or with more "
                "decimals); their groups cannot be reconciled exactly",
                inexact_amounts, cfg.facts_name, cfg.precision, cfg.scale,
            )

        enriched = enrich.enrich(facts.clean, dims.clean, cfg.key)
        # Clean and raw totals in one pass over each written split (no second
        # scan of the sources); one row per group. The optional enriched table
        # (as large as the clean facts) is written alongside, as its own job.
        totals_plan = split_totals(dims, facts, cfg)
        with ThreadPoolExecutor(max_workers=2) as pool:
            fused_job = pool.submit(in_thread(materialize), totals_plan, f"{root}/totals")
            if cfg.write_enriched:
                enriched = pool.submit(in_thread(materialize), enriched, f"{root}/enriched").result()
            fused = fused_job.result()
        totals = reconcile.clean_side(fused, cfg.group, "total_amount")
        checks = split_checks(spark, dims, facts, fused, cfg)
        gate_rows = split_counts(spark, dims, facts, cfg)
        built = report.build_report(report.summaries(checks), gate_rows)
        with ThreadPoolExecutor(max_workers=4) as pool:
            report_job = pool.submit(in_thread(materialize), built, f"{root}/report")
            if cfg.write_violations:  # the full lists behind the report's bounded samples
                written = {
                    c.name: pool.submit(in_thread(materialize), c.violations, f"{root}/violations/{c.name}")
                    for c in checks
                }
                for c in checks:
                    c.violations = written[c.name].result()
            report_df = report_job.result()
        save_report(report_df, f"{root}/audit_report.json")
        outbox = report.alert_outbox(report_df, cfg.webhook_url, cfg.email_to, cfg.subject)
        overall_pass = bool(report_df.select("overall_pass").first()[0])
        # Written on every run (empty when the run passed), so a re-run into the
        # same folder never leaves a previous run's alerts behind.
        write_outbox(outbox, f"{root}/outbox")
        for row in report_df.select(F.explode("audit_checks").alias("c")).where(~F.col("c.passed")).select("c.check_name", "c.violation_count").collect():
            logger.warning("check %s failed with %d violations", row["check_name"], row["violation_count"])  # one row per check
        logger.info("run %s ended, overall_pass=%s", root, overall_pass)
    finally:
        if sc is not None:
            sc.setLocalProperty("spark.jobGroup.id", None)
    return AuditRun(
        path=root,
        dims=dims,
        facts=facts,
        enriched=enriched,
        totals=enrich.order_desc(reconcile.to_double(totals, ["total_amount"]), "total_amount", cfg.group),
        checks=checks,
        report=report_df,
        outbox=outbox,
        overall_pass=overall_pass,
        inexact_amounts=inexact_amounts,
        jobs=_jobs_in_group(spark, group_id),
    )


def audit_details(run: AuditRun) -> DataFrame:
    """The per-check rows of a run's report, flattened (one row per check)."""
    return run.report.select(F.explode("audit_checks").alias("c")).select("c.*")


def main(argv: list[str] | None = None) -> int:
    """``spark-submit`` entry: audit two tables, print the verdict as one JSON line.

    Inputs are paths read with ``--format`` (default parquet), or ``--sf-dir``
    to derive the dirty customer / transaction sources from the driver tables.
    Exit code 0 when every check passed, 2 when one failed.
    """
    import argparse
    import json

    from tablegate.session import build_session
    from tablegate.sources import dirty
    from tablegate.sources.text import FORMATS, read_text

    ap = argparse.ArgumentParser(prog="tablegate-audit")
    ap.add_argument("--customers")
    ap.add_argument("--transactions")
    ap.add_argument("--format", default="parquet", help="parquet, orc, ...; csv and json are read as text and typed by the gate")
    ap.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="reader option, e.g. sep=; (may be repeated)")
    ap.add_argument("--sf-dir", help="derive dirty sources from <dir>/{customer,nation,orders}.parquet")
    ap.add_argument("--output", help="output folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--mask", default="", help="comma-separated PII columns to hash in outputs")
    ap.add_argument("--write-enriched", action="store_true")
    ap.add_argument("--rejected-files", type=int, help="also write a compact quarantine table in N files")
    ap.add_argument("--no-violations", action="store_true", help="do not write every check's full violations")
    ap.add_argument("--customers-contract", help="JSON contract spec (Contract.from_spec) for the first table")
    ap.add_argument("--transactions-contract", help="JSON contract spec for the second table")
    ap.add_argument("--key", default="customer_id")
    ap.add_argument("--group", default="country")
    ap.add_argument("--amount", default="amount")
    ap.add_argument("--unique", default="email", help="comma-separated uniqueness key columns")
    args = ap.parse_args(argv)

    spark = build_session()
    def load(path, default):
        if not path:
            return default
        with open(path, encoding="utf-8") as fh:
            return Contract.from_spec(json.load(fh))

    contracts = load(args.customers_contract, CUSTOMER_CONTRACT), load(args.transactions_contract, TRANSACTION_CONTRACT)
    options = dict(o.split("=", 1) for o in args.option)

    def source(path, contract):
        if args.format in FORMATS:
            return read_text(spark, path, contract, args.format, **options)
        return spark.read.format(args.format).options(**options).load(path)

    if args.sf_dir:
        dims, facts = dirty.dirty_customers(spark, args.sf_dir), dirty.dirty_transactions(spark, args.sf_dir)
    elif args.customers and args.transactions:
        dims, facts = source(args.customers, contracts[0]), source(args.transactions, contracts[1])
    else:
        ap.error("give --sf-dir or both --customers and --transactions")

    cfg = AuditConfig(
        dims_contract=contracts[0],
        facts_contract=contracts[1],
        key=args.key,
        group=args.group,
        amount=args.amount,
        unique_keys=tuple(c for c in args.unique.split(",") if c),
        mask_columns=tuple(c for c in args.mask.split(",") if c),
        write_enriched=args.write_enriched,
        rejected_files=args.rejected_files,
        write_violations=not args.no_violations,
    )
    # With a contract from a file, completeness covers that contract's fields
    # (except the join key) instead of the reference's column names.
    for name, path, contract in (
        (cfg.dims_name, args.customers_contract, cfg.dims_contract),
        (cfg.facts_name, args.transactions_contract, cfg.facts_contract),
    ):
        if path:
            cfg.completeness[name] = [f for f in contract.field_names if f != cfg.key]
    run = run_audit(spark, dims, facts, cfg, args.output)
    print(
        json.dumps(
            {
                "path": run.path,
                "overall_pass": run.overall_pass,
                "rejected": {cfg.dims_name: run.dims.rejected_rows, cfg.facts_name: run.facts.rejected_rows},
                "clean": {cfg.dims_name: run.dims.clean_rows, cfg.facts_name: run.facts.clean_rows},
            }
        )
    )
    return 0 if run.overall_pass else 2


if __name__ == "__main__":
    raise SystemExit(main())

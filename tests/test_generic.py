"""The engine is generic: audit lineitem against supplier (other names, other columns).

Contracts come from specs, the key / group / amount / uniqueness columns are
configuration, and the results are compared with plain DataFrame code.
"""

import json

import pytest
from pyspark.sql import functions as F

from tablegate.operators.contract import Contract
from tablegate.plans.job import AuditConfig, audit_details, run_audit
from tablegate.sources.dirty import table

from .conftest import SF_SMALL

pytestmark = pytest.mark.integration

SUPPLIERS = Contract.from_spec({"name": "suppliers", "fields": [
    {"name": "supplier_id", "type": "bigint"},
    {"name": "supplier_name", "type": "string", "rules": ["not_blank"]},
    {"name": "nation", "type": "string", "rules": ["not_blank"]}]})
LINES = Contract.from_spec({"name": "lines", "fields": [
    {"name": "line_id", "type": "string"},
    {"name": "supplier_id", "type": "bigint", "rules": ["positive"]},
    {"name": "price", "type": "double", "rules": ["positive_amount", "finite"]},
    {"name": "ship_date", "type": "string", "rules": ["iso_date"]}]})


def test_lineitem_against_supplier(spark):
    s = table(spark, SF_SMALL, "supplier").join(table(spark, SF_SMALL, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    suppliers = s.select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"),
                         F.col("n_name").alias("nation"))
    lines = table(spark, SF_SMALL, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_extendedprice").alias("price"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
    )
    cfg = AuditConfig(
        dims_contract=SUPPLIERS, facts_contract=LINES, dims_name="suppliers", facts_name="lines",
        key="supplier_id", group="nation", amount="price", unique_keys=("supplier_name",),
        completeness={"suppliers": ["supplier_name", "nation"], "lines": ["price"]},
    )
    run = run_audit(spark, suppliers, lines, cfg)
    assert run.dims.clean_rows + run.dims.rejected_rows == suppliers.count()
    assert run.facts.clean_rows + run.facts.rejected_rows == lines.count()

    def sums(facts, dims):
        return {
            r.nation: r.s
            for r in facts.join(dims, "supplier_id").filter(F.col("nation").isNotNull() & F.col("price").isNotNull())
            .groupBy("nation").agg(F.sum(F.col("price").cast("decimal(18,2)")).alias("s")).collect()
        }

    clean = sums(run.facts.clean, run.dims.clean)
    raw = sums(lines, suppliers)
    assert {r.nation: r.total_amount for r in run.totals.collect()} == {k: float(v) for k, v in clean.items()}
    mism = {r.nation: (r.raw_total, r.clean_total) for r in run.checks[3].violations.collect()}
    expected = {k: (raw.get(k, 0), clean.get(k, 0)) for k in set(raw) | set(clean) if raw.get(k, 0) != clean.get(k, 0)}
    assert mism == expected

    orphans = lines.select("supplier_id").distinct().join(suppliers.select("supplier_id"), "supplier_id", "left_anti").count()
    checks = {r.check_name: r for r in audit_details(run).collect()}
    assert checks["referential_integrity"].violation_count == orphans
    assert json.loads(checks["completeness"].details.toJson())["null_counts"] == {"supplier_name": 0, "nation": 0, "price": 0}
    assert checks["reconciliation"].passed is (run.dims.rejected_rows == 0 and run.facts.rejected_rows == 0)

"""Model-based test: the Spark gate against a small Python model of the contracts.

The model follows the validator semantics row by row in plain Python
(``str.strip()``, ``value <= 0``, ``strptime('%Y-%m-%d')``, the e-mail
pattern via the ``regex`` module); random records from each hypothesis
example are gated in ONE Spark job and compared field by field.
"""

from datetime import datetime

import pytest
import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablegate.functions import rules
from tablegate.operators.contract import gate
from tablegate.plans.contracts import CUSTOMER_CONTRACT, TRANSACTION_CONTRACT
from tablegate.sources.mock import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA

pytestmark = pytest.mark.unit

SETTINGS = settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
EMAIL_RE = regex.compile(rules.EMAIL_PATTERN.replace(r"\z", r"\Z"))


def _blank(v: str) -> bool:
    return not v.strip()


def _date_ok(v: str) -> bool:
    try:
        datetime.strptime(v, "%Y-%m-%d")
        return True
    except ValueError:
        return False


def model_customer(cid, name, email, country):
    out = []
    if cid is None:
        out.append(("customer_id", "required"))
    for f, v in (("name", name), ("email", email), ("country", country)):
        if v is None:
            out.append((f, "required"))
        elif f == "email":
            if len(v) > rules.EMAIL_MAX_LENGTH or not EMAIL_RE.search(v):
                out.append((f, "email"))
        elif _blank(v):
            out.append((f, "not_blank"))
    return out


def model_transaction(tid, cid, amount, date):
    out = []
    if tid is None:
        out.append(("transaction_id", "required"))
    if cid is None:
        out.append(("customer_id", "required"))
    elif cid <= 0:
        out.append(("customer_id", "positive"))
    if amount is None:
        out.append(("amount", "required"))
    elif amount <= 0:
        out.append(("amount", "positive"))
    if date is None:
        out.append(("date", "required"))
    elif not _date_ok(date):
        out.append(("date", "iso_date"))
    return out


WS = st.sampled_from([" ", "\t", " ", "　", "\n", "\x1c"])
WORD = st.text(alphabet="abcXYZé0-", min_size=1, max_size=5)
NAMES = st.one_of(st.none(), WORD, st.lists(WS, max_size=3).map("".join), st.builds(lambda a, b: a + b, WS, WORD))
LABEL = st.text(alphabet="abz09-é", min_size=1, max_size=4)
EMAILS = st.one_of(
    st.none(),
    st.builds(lambda u, d, t: f"{u}@{d}.{t}", WORD, LABEL, LABEL),
    st.builds(lambda u, d: f"{u}@{d}", WORD, LABEL),
    st.text(alphabet="a.@-+_ ", max_size=8),
)
IDS = st.one_of(st.none(), st.integers(-3, 10**6))
AMOUNTS = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True), st.sampled_from([0.0, -0.0, 0.01, -1.0]))
DIGITS = st.text(alphabet="0123456789", max_size=5)
DATES = st.one_of(
    st.none(),
    st.builds(lambda y, m, d: f"{y}-{m}-{d}", DIGITS, DIGITS, DIGITS),
    st.dates().map(lambda d: d.strftime("%Y-%m-%d")),
    st.dates().map(lambda d: d.strftime("%d-%m-%Y")),
)


def _gate(spark, rows, schema, contract):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "_i int, " + schema)
    got = gate(df, contract).select("_i", "_violations").collect()
    return [[(v["field"], v["rule"]) for v in r["_violations"]] for r in sorted(got, key=lambda r: r["_i"])]


@SETTINGS
@given(st.lists(st.tuples(IDS, NAMES, EMAILS, NAMES), min_size=1, max_size=300))
def test_customer_gate_matches_model(spark, rows):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CUSTOMER_SCHEMA.fields)
    assert _gate(spark, rows, schema, CUSTOMER_CONTRACT) == [model_customer(*r) for r in rows]


@SETTINGS
@given(st.lists(st.tuples(IDS, IDS, AMOUNTS, DATES), min_size=1, max_size=300))
def test_transaction_gate_matches_model(spark, rows):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRANSACTION_SCHEMA.fields)
    assert _gate(spark, rows, schema, TRANSACTION_CONTRACT) == [model_transaction(*r) for r in rows]

"""DuckDB twins of the catalog queries (correctness oracle).

Hand-written SQL over the pre-registered views ``customer``, ``nation`` and
``orders``. Only the fixed values are shared with the Spark side (dirt
rules, regular expressions, messages); the logic is written again in plain
SQL, so a mistake in a Spark operator shows up as a mismatch.
"""

from __future__ import annotations

from tablegate.functions import rules
from tablegate.operators.report import DEFAULT_EMAIL_TO, DEFAULT_SUBJECT, DEFAULT_WEBHOOK_URL
from tablegate.plans.shape_oracle import ORACLE as SHAPE_ORACLE
from tablegate.sources import shapes as s
from tablegate.sources import dirty as d


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _m(col: str, rule: tuple[int, int]) -> str:
    return f"{col} % {rule[0]} = {rule[1]}"


def _user(expr: str) -> str:
    return f"{_lit(d.EMAIL_USER_PREFIX)} || CAST({expr} AS VARCHAR) || {_lit(d.EMAIL_DOMAIN)}"


NB = _lit(rules.not_blank_pattern())
EMAIL = _lit(rules.EMAIL_PATTERN)
DATE = _lit(rules.DATE_PATTERN)


def _nb(c: str) -> str:
    return f"regexp_matches({c}, {NB})"


def _email(c: str) -> str:
    return f"(length({c}) <= {rules.EMAIL_MAX_LENGTH} AND regexp_matches({c}, {EMAIL}))"


def _date(c: str) -> str:
    return (
        f"(regexp_matches({c}, {DATE}) AND NOT starts_with({c}, {_lit(rules.ZERO_YEAR_PREFIX)}) "
        f"AND TRY_CAST({c} AS DATE) IS NOT NULL)"
    )


DC = f"""dc AS (
  SELECT c_custkey AS customer_id,
    CASE WHEN {_m('c_custkey', d.NAME_NULL)} THEN NULL
         WHEN {_m('c_custkey', d.NAME_BLANK)} THEN {_lit(d.BLANK_NAME)} ELSE c_name END AS name,
    CASE WHEN {_m('c_custkey', d.EMAIL_NULL)} THEN NULL
         WHEN {_m('c_custkey', d.EMAIL_BAD)} THEN {_lit(d.BAD_EMAIL)}
         WHEN {_m('c_custkey', d.EMAIL_DUP)} THEN {_user('c_custkey - 1')}
         ELSE {_user('c_custkey')} END AS email,
    CASE WHEN {_m('c_custkey', d.COUNTRY_NULL)} THEN NULL ELSE n_name END AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

DT = f"""dt AS (
  SELECT o_orderkey AS transaction_id,
    CASE WHEN {_m('o_orderkey', d.CUSTOMER_ORPHAN)} THEN {d.ORPHAN_OFFSET} + o_orderkey ELSE o_custkey END AS customer_id,
    CASE WHEN {_m('o_orderkey', d.AMOUNT_NULL)} THEN NULL
         WHEN {_m('o_orderkey', d.AMOUNT_NEGATIVE)} THEN -o_totalprice ELSE o_totalprice END AS amount,
    CASE WHEN {_m('o_orderkey', d.DATE_WRONG_FORMAT)} THEN strftime(o_orderdate, '%d-%m-%Y')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date
  FROM orders)"""

# Per field: the rule that failed (NULL when fine) and its message.
CV = f"""cv AS (
  SELECT *,
    CASE WHEN customer_id IS NULL THEN 'required' END AS r_customer_id,
    CASE WHEN name IS NULL THEN 'required' WHEN NOT {_nb('name')} THEN 'not_blank' END AS r_name,
    CASE WHEN email IS NULL THEN 'required' WHEN NOT {_email('email')} THEN 'email' END AS r_email,
    CASE WHEN country IS NULL THEN 'required' WHEN NOT {_nb('country')} THEN 'not_blank' END AS r_country
  FROM dc)"""

TV = f"""tv AS (
  SELECT *,
    CASE WHEN transaction_id IS NULL THEN 'required' END AS r_transaction_id,
    CASE WHEN customer_id IS NULL THEN 'required' WHEN NOT (customer_id > 0) THEN 'positive' END AS r_customer_id,
    CASE WHEN amount IS NULL THEN 'required' WHEN amount <= 0 THEN 'positive' END AS r_amount,
    CASE WHEN date IS NULL THEN 'required' WHEN NOT {_date('date')} THEN 'iso_date' END AS r_date
  FROM dt)"""

MESSAGES = {
    "required": "is required",
    "not_blank": "must be a non-empty string",
    "email": "must be a valid e-mail address",
    "positive": "must be > 0",
    "iso_date": "must be a date in YYYY-MM-DD format",
}


def _reason(fields: list[str]) -> str:
    parts = []
    for f in fields:
        whens = " ".join(f"WHEN r_{f} = {_lit(r)} THEN {_lit(f + ': ' + m)}" for r, m in MESSAGES.items())
        parts.append(f"CASE {whens} END")
    return "concat_ws('; ', " + ", ".join(parts) + ")"


C_FIELDS = ["customer_id", "name", "email", "country"]
T_FIELDS = ["transaction_id", "customer_id", "amount", "date"]


def _ok(fields: list[str]) -> str:
    return "(" + " AND ".join(f"r_{f} IS NULL" for f in fields) + ")"


CG = f"""cg AS (SELECT *, {_ok(C_FIELDS)} AS ok, {_reason(C_FIELDS)} AS rejection_reason FROM cv)"""
TG = f"""tg AS (SELECT *, {_ok(T_FIELDS)} AS ok, {_reason(T_FIELDS)} AS rejection_reason FROM tv)"""
CC = "cc AS (SELECT customer_id, name, email, country FROM cg WHERE ok)"
TC = "tc AS (SELECT transaction_id, customer_id, amount, date FROM tg WHERE ok)"

BASE = ",\n".join([DC, DT, CV, TV, CG, TG, CC, TC])


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([BASE, *ctes]) + "\n"


def _dec(c: str) -> str:
    return f"CAST({c} AS DECIMAL(18,2))"


RAW = f"""raw AS (
  SELECT c.country, SUM({_dec('t.amount')}) AS raw_total
  FROM dt t LEFT JOIN dc c ON t.customer_id = c.customer_id
  WHERE t.amount IS NOT NULL AND c.country IS NOT NULL
  GROUP BY c.country)"""
CLEAN = f"""cl AS (
  SELECT c.country, SUM({_dec('t.amount')}) AS clean_total
  FROM tc t JOIN cc c ON t.customer_id = c.customer_id
  GROUP BY c.country)"""
CMP = """cmp AS (
  SELECT coalesce(r.country, l.country) AS country,
         coalesce(r.raw_total, 0) AS raw_total, coalesce(l.clean_total, 0) AS clean_total
  FROM raw r FULL OUTER JOIN cl l ON r.country = l.country)"""
RAW_PASS = f"""rawp AS (
  SELECT c.country, SUM({_dec('t.amount')}) AS raw_total
  FROM tc t LEFT JOIN cc c ON t.customer_id = c.customer_id
  WHERE t.amount IS NOT NULL AND c.country IS NOT NULL
  GROUP BY c.country)"""
CMP_PASS = """cmpp AS (
  SELECT coalesce(r.country, l.country) AS country,
         coalesce(r.raw_total, 0) AS raw_total, coalesce(l.clean_total, 0) AS clean_total
  FROM rawp r FULL OUTER JOIN cl l ON r.country = l.country)"""

GATE_COUNTS = """gc AS (
  SELECT 'customers' AS entity, count(*) FILTER (WHERE ok) AS clean_rows, count(*) FILTER (WHERE NOT ok) AS rejected_rows FROM cg
  UNION ALL
  SELECT 'transactions', count(*) FILTER (WHERE ok), count(*) FILTER (WHERE NOT ok) FROM tg)"""

CHECKS = """dup AS (SELECT email FROM cc GROUP BY email HAVING count(*) > 1),
orph AS (SELECT DISTINCT customer_id FROM tc t
         WHERE NOT EXISTS (SELECT 1 FROM cc c WHERE c.customer_id = t.customer_id)),
nulls AS (SELECT count(*) FILTER (WHERE name IS NULL) + count(*) FILTER (WHERE email IS NULL)
               + count(*) FILTER (WHERE country IS NULL) AS n FROM cc),
tnulls AS (SELECT count(*) FILTER (WHERE amount IS NULL) AS n FROM tc),
checks AS (
  SELECT 0 AS ordinal, 'completeness' AS check_name,
         (SELECT n FROM nulls) + (SELECT n FROM tnulls) AS violation_count
  UNION ALL SELECT 1, 'uniqueness', (SELECT count(*) FROM dup)
  UNION ALL SELECT 2, 'referential_integrity', (SELECT count(*) FROM orph)
  UNION ALL SELECT 3, 'reconciliation', (SELECT count(*) FROM cmp WHERE raw_total <> clean_total))"""


# What the report says of the checks; lists hold the first 20 in order.
DETAILS = """dupn AS (SELECT email, count(*) AS n FROM cc GROUP BY email HAVING count(*) > 1),
details AS (
  SELECT 'completeness' AS check_name, 'null_counts.name' AS item, CAST(count(*) FILTER (WHERE name IS NULL) AS VARCHAR) AS value FROM cc
  UNION ALL SELECT 'completeness', 'null_counts.email', CAST(count(*) FILTER (WHERE email IS NULL) AS VARCHAR) FROM cc
  UNION ALL SELECT 'completeness', 'null_counts.country', CAST(count(*) FILTER (WHERE country IS NULL) AS VARCHAR) FROM cc
  UNION ALL SELECT 'completeness', 'null_counts.amount', CAST(count(*) FILTER (WHERE amount IS NULL) AS VARCHAR) FROM tc
  UNION ALL SELECT check_name, 'violation_count', CAST(CAST(violation_count AS BIGINT) AS VARCHAR) FROM checks WHERE check_name <> 'completeness'
  UNION ALL SELECT 'uniqueness', 'duplicate_rows', CAST(CAST(coalesce(sum(n), 0) AS BIGINT) AS VARCHAR) FROM dupn
  UNION ALL SELECT 'uniqueness', 'duplicate_emails', email FROM (SELECT email FROM dupn ORDER BY email LIMIT 20)
  UNION ALL SELECT 'referential_integrity', 'orphan_rows', CAST(count(*) AS VARCHAR) FROM tc WHERE customer_id IN (SELECT customer_id FROM orph)
  UNION ALL SELECT 'referential_integrity', 'orphan_customer_ids', CAST(customer_id AS VARCHAR)
    FROM (SELECT customer_id FROM orph ORDER BY customer_id LIMIT 20)
  UNION ALL SELECT 'reconciliation', 'country_mismatches',
      country || '|' || CAST(CAST(raw_total AS DECIMAL(18,2)) AS VARCHAR) || '|' || CAST(CAST(clean_total AS DECIMAL(18,2)) AS VARCHAR)
    FROM (SELECT country, raw_total, clean_total FROM cmp WHERE raw_total <> clean_total ORDER BY country LIMIT 20))"""


def _completeness(src_c: str, src_t: str) -> str:
    return f"""SELECT 'customers' AS entity, 'name' AS column_name, count(*) FILTER (WHERE name IS NULL) AS null_count FROM {src_c}
UNION ALL SELECT 'customers', 'email', count(*) FILTER (WHERE email IS NULL) FROM {src_c}
UNION ALL SELECT 'customers', 'country', count(*) FILTER (WHERE country IS NULL) FROM {src_c}
UNION ALL SELECT 'transactions', 'amount', count(*) FILTER (WHERE amount IS NULL) FROM {src_t}"""


def _by_rule(entity: str, src: str, fields: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{entity}' AS entity, '{f}' AS field, r_{f} AS rule, count(*) AS n FROM {src} "
        f"WHERE r_{f} IS NOT NULL GROUP BY r_{f}"
        for f in fields
    )


def _place(total: str) -> str:
    return f"row_number() OVER (ORDER BY CAST({total} AS DOUBLE) DESC NULLS LAST, country ASC NULLS LAST) AS position"


# Amounts that are no decimals of two places, in valid rows of customers 0 to 4 modulo 10.
DX = f"""dx AS (
  SELECT transaction_id, customer_id, date,
    CASE WHEN amount IS NULL THEN NULL
         WHEN {_m('transaction_id', d.AMOUNT_WHOLE)} THEN floor(amount)
         WHEN customer_id % 10 >= 5 THEN amount
         WHEN {_m('transaction_id', d.AMOUNT_THREE_DECIMALS)} THEN floor(amount) + 0.125::DOUBLE
         WHEN {_m('transaction_id', d.AMOUNT_HUGE)} THEN {d.HUGE_AMOUNT}::DOUBLE
         WHEN {_m('transaction_id', d.AMOUNT_NAN)} THEN 'nan'::DOUBLE
         WHEN {_m('transaction_id', d.AMOUNT_INFINITE)} THEN 'inf'::DOUBLE
         ELSE amount END AS amount
  FROM dt),
tx AS (
  SELECT *, isnan(amount) AS nan,
    CASE WHEN isnan(amount) OR isinf(amount) THEN true WHEN abs(amount) >= 1e16 THEN true
         ELSE round(amount * 1000) % 10 <> 0 END AS odd,
    transaction_id IS NOT NULL AND customer_id > 0 AND amount IS NOT NULL AND (isnan(amount) OR amount > 0)
      AND date IS NOT NULL AND {_date('date')} AS ok
  FROM dx),
px AS (
  SELECT c.country,
    sum(CASE WHEN NOT t.odd THEN {_dec('CASE WHEN t.odd THEN 0 ELSE t.amount END')} END) AS raw_total,
    sum(CASE WHEN NOT t.odd AND t.ok AND c.ok THEN {_dec('CASE WHEN t.odd THEN 0 ELSE t.amount END')} END) AS clean_total,
    count(*) AS raw_pairs, count(*) FILTER (WHERE t.ok AND c.ok) AS clean_pairs,
    count(*) FILTER (WHERE t.odd) AS raw_inexact, count(*) FILTER (WHERE t.odd AND t.ok AND c.ok) AS clean_inexact,
    count(*) FILTER (WHERE t.nan) AS raw_nan
  FROM tx t JOIN cg c ON t.customer_id = c.customer_id
  WHERE t.amount IS NOT NULL AND c.country IS NOT NULL
  GROUP BY c.country)"""

# Sums of the amounts that are no decimals: whole eighths, added as integers and rounded once at the end.
_EIGHTHS = "sum(CASE WHEN t.odd AND NOT isnan(t.amount) AND NOT isinf(t.amount) THEN CAST(t.amount * 8 AS HUGEINT) END)"
_ROUNDED = "CAST(e // 4294967296 AS DOUBLE) * 4294967296.0::DOUBLE / 8 + CAST(e % 4294967296 AS DOUBLE) / 8"
DOUBLES = f"""dd AS (
  SELECT country, CASE WHEN e IS NULL THEN x WHEN x IS NULL THEN r ELSE x + r END AS total, nan, inf
  FROM (SELECT *, CASE WHEN e IS NOT NULL THEN {_ROUNDED.replace('e //', 'abs(e) //').replace('e %', 'abs(e) %')} END * sign(e) AS r FROM (
    SELECT c.country, CAST(sum(CASE WHEN NOT t.odd THEN {_dec('CASE WHEN t.odd THEN 0 ELSE t.amount END')} END) AS DOUBLE) AS x,
      {_EIGHTHS} AS e, count(*) FILTER (WHERE isnan(t.amount)) AS nan, count(*) FILTER (WHERE isinf(t.amount)) AS inf
    FROM tx t JOIN dc c ON t.customer_id = c.customer_id WHERE c.country IS NOT NULL GROUP BY c.country)))"""

# CSV lines: which of them are broken, and what they are.
LINES = f"""li AS (
  SELECT *, CASE
      WHEN {_m('transaction_id', s.LINE_CUT)} THEN head
      WHEN {_m('transaction_id', s.LINE_LONG)} THEN head || ',' || tail || ',more'
      WHEN {_m('transaction_id', s.LINE_QUOTE)} THEN head || ',"' || tail END AS line
  FROM (SELECT *, transaction_id || ',' || customer_id AS head, coalesce(CAST({_dec('amount')} AS VARCHAR), '') || ',' || date AS tail FROM tg))"""

ORACLE: dict[str, str] = {
    "totals_as_doubles": _with(DX, DOUBLES)
    + "SELECT 'finite' AS kind, country, total, NULL AS special FROM dd UNION ALL "
    "SELECT 'all', country, CASE WHEN nan = 0 AND inf = 0 THEN total END, CASE WHEN nan > 0 THEN 'nan' WHEN inf > 0 THEN 'inf' END FROM dd",
    "gate_text_clean": _with(LINES) + "SELECT transaction_id, customer_id, amount, date FROM li WHERE line IS NULL AND ok",
    "gate_text_rejected": _with(LINES)
    + "".join(
        f"{'SELECT' if f == T_FIELDS[0] else ','} CASE WHEN line IS NULL THEN CAST({_dec(f) if f == 'amount' else f} AS VARCHAR) END AS {f}" for f in T_FIELDS
    )
    + ", line, CASE WHEN line IS NULL THEN rejection_reason ELSE '_corrupt_record: line cannot be read' END AS rejection_reason "
    "FROM li WHERE line IS NOT NULL OR NOT ok",
    "totals_inexact": _with(DX)
    + "SELECT country, CAST(raw_total AS DOUBLE) AS raw_total, CAST(clean_total AS DOUBLE) AS clean_total, "
    "raw_pairs, clean_pairs, raw_inexact, clean_inexact, raw_nan FROM px",
    "reconciliation_inexact": _with(DX)
    + "SELECT country, CAST(raw_total AS DOUBLE) AS raw_total, CAST(coalesce(clean_total, 0) AS DOUBLE) AS clean_total, "
    "raw_inexact, clean_inexact FROM px WHERE raw_total <> coalesce(clean_total, 0) "
    "OR (raw_inexact > 0 AND NOT (raw_pairs = clean_pairs AND raw_nan = 0))",
    "gate_customers_clean": _with() + "SELECT * FROM cc",
    "gate_customers_rejected": _with()
    + "SELECT customer_id, name, email, country, rejection_reason FROM cg WHERE NOT ok",
    "gate_transactions_clean": _with() + "SELECT * FROM tc",
    "gate_transactions_rejected": _with()
    + "SELECT transaction_id, customer_id, amount, date, rejection_reason FROM tg WHERE NOT ok",
    "rule_not_blank": f"WITH {DC}\nSELECT customer_id, {_nb('name')} AS name_not_blank, "
    f"{_nb('country')} AS country_not_blank FROM dc",
    "rule_email": f"WITH {DC}\nSELECT customer_id, email, {_email('email')} AS email_valid FROM dc",
    "rule_positive_id": f"WITH {DT}\nSELECT transaction_id, customer_id, customer_id > 0 AS customer_id_positive FROM dt",
    "rule_positive_amount": f"WITH {DT}\nSELECT transaction_id, amount, NOT (amount <= 0) AS amount_positive FROM dt",
    "rule_iso_date": f"WITH {DT}\nSELECT transaction_id, date, {_date('date')} AS date_valid FROM dt",
    "rejections_by_field_rule": _with()
    + _by_rule("customers", "cv", C_FIELDS)
    + "\nUNION ALL\n"
    + _by_rule("transactions", "tv", T_FIELDS),
    "gate_counts": _with(GATE_COUNTS) + "SELECT * FROM gc",
    "enriched_transactions": _with()
    + "SELECT t.customer_id, t.transaction_id, t.amount, t.date, c.name, c.email, c.country "
    "FROM tc t JOIN cc c ON t.customer_id = c.customer_id",
    "spend_by_country": _with(CLEAN)
    + "SELECT country, CAST(clean_total AS DOUBLE) AS total_amount FROM cl ORDER BY total_amount DESC, country",
    "completeness_raw": f"WITH {DC},\n{DT}\n" + _completeness("dc", "dt"),
    "completeness_clean": _with() + _completeness("cc", "tc"),
    "uniqueness_raw": f"WITH {DC}\nSELECT email, count(*) AS n FROM dc GROUP BY email HAVING count(*) > 1",
    "uniqueness_clean": _with() + "SELECT email, count(*) AS n FROM cc GROUP BY email HAVING count(*) > 1",
    "orphan_keys": _with()
    + "SELECT DISTINCT customer_id FROM tc t WHERE NOT EXISTS (SELECT 1 FROM cc c WHERE c.customer_id = t.customer_id)",
    "orphan_rows": _with()
    + "SELECT customer_id, transaction_id, amount, date FROM tc t "
    "WHERE NOT EXISTS (SELECT 1 FROM cc c WHERE c.customer_id = t.customer_id)",
    "raw_totals": _with(RAW) + "SELECT country, CAST(raw_total AS DOUBLE) AS raw_total FROM raw",
    "reconciliation": _with(RAW, CLEAN, CMP)
    + "SELECT country, CAST(raw_total AS DOUBLE) AS raw_total, CAST(clean_total AS DOUBLE) AS clean_total "
    "FROM cmp WHERE raw_total <> clean_total",
    "reconciliation_delta": _with(RAW, CLEAN, CMP)
    + "SELECT country, CAST(raw_total AS DOUBLE) AS raw_total, CAST(clean_total AS DOUBLE) AS clean_total, "
    "CAST(raw_total - clean_total AS DOUBLE) AS delta FROM cmp",
    "reconciliation_passing": _with(CLEAN, RAW_PASS, CMP_PASS)
    + "SELECT country, CAST(raw_total AS DOUBLE) AS raw_total, CAST(clean_total AS DOUBLE) AS clean_total, "
    "CAST(raw_total - clean_total AS DOUBLE) AS delta FROM cmpp",
    "spend_ranking": _with(CLEAN) + f"SELECT country, CAST(clean_total AS DOUBLE) AS total_amount, {_place('clean_total')} FROM cl",
    "raw_totals_ranking": _with(RAW) + f"SELECT country, CAST(raw_total AS DOUBLE) AS raw_total, {_place('raw_total')} FROM raw",
    "delta_ranking": _with(RAW, CLEAN, CMP)
    + f"SELECT country, CAST(raw_total - clean_total AS DOUBLE) AS delta, {_place('raw_total - clean_total')} FROM cmp",
    "masked_rejects": _with()
    + "SELECT customer_id, sha256(name) AS name_sha256, sha256(email) AS email_sha256, country, rejection_reason "
    "FROM cg WHERE NOT ok",
    "audit_summary": _with(RAW, CLEAN, CMP, CHECKS)
    + "SELECT check_name, violation_count = 0 AS passed, CASE WHEN violation_count = 0 THEN 'PASS' ELSE 'FAIL' END "
    "AS status, CAST(violation_count AS BIGINT) AS violation_count FROM checks",
    "audit_report": _with(RAW, CLEAN, CMP, CHECKS, GATE_COUNTS)
    + "SELECT coalesce(bool_and(violation_count = 0), true) AS overall_pass, count(*) AS n_checks, "
    "count(*) FILTER (WHERE violation_count > 0) AS n_failed, "
    "(SELECT rejected_rows FROM gc WHERE entity = 'customers') AS rejected_customers, "
    "(SELECT rejected_rows FROM gc WHERE entity = 'transactions') AS rejected_transactions FROM checks",
    "alert_outbox": _with(RAW, CLEAN, CMP, CHECKS)
    + f"SELECT ch.channel, ch.target, {_lit(DEFAULT_SUBJECT)} AS subject "
    f"FROM (VALUES ('webhook', {_lit(DEFAULT_WEBHOOK_URL)}), ('email', {_lit(DEFAULT_EMAIL_TO)})) AS ch(channel, target) "
    "WHERE EXISTS (SELECT 1 FROM checks WHERE violation_count > 0)",
    "audit_violations": _with(RAW, CLEAN, CMP)
    + "SELECT 'uniqueness' AS check_name, email AS key, count(*) AS n FROM cc GROUP BY email HAVING count(*) > 1\n"
    "UNION ALL SELECT 'referential_integrity', CAST(customer_id AS VARCHAR), count(*) FROM tc t "
    "WHERE NOT EXISTS (SELECT 1 FROM cc c WHERE c.customer_id = t.customer_id) GROUP BY customer_id\n"
    "UNION ALL SELECT 'reconciliation', country, 1 FROM cmp WHERE raw_total <> clean_total",
    "audit_details": _with(RAW, CLEAN, CMP, CHECKS, DETAILS) + "SELECT check_name, item, value FROM details",
    "alert_bodies": _with(RAW, CLEAN, CMP, CHECKS, GATE_COUNTS)
    + "SELECT ch.channel, false AS overall_pass, true AS has_timestamp, "
    "(SELECT rejected_rows FROM gc WHERE entity = 'customers') AS rejected_customers, "
    "(SELECT rejected_rows FROM gc WHERE entity = 'transactions') AS rejected_transactions, "
    "k.check_name, k.violation_count = 0 AS passed, CAST(k.violation_count AS BIGINT) AS violation_count "
    "FROM checks k, (VALUES ('webhook'), ('email')) AS ch(channel) "
    "WHERE EXISTS (SELECT 1 FROM checks WHERE violation_count > 0)",
    **SHAPE_ORACLE,
}

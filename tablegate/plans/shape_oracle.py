"""DuckDB twins of the shape queries.

Nothing here evaluates a rule: for each shape it is written down whether the
value is good, and what it is read as. The templates of what arrives are the
only thing shared with the Spark side.
"""

from __future__ import annotations

from tablegate.sources import shapes as s

# Numbers of the good shapes.
GOOD_EMAILS = (0, 1, 2, 3, 12, 15, 17)
GOOD_NAMES = (0, 7, 9, 10, 12)
GOOD_DATES = (0, 2, 4, 14, 18)
# Residues whose text is no number of the field's type.
BAD_IDS = (3, 5, 6, 7, 8, 9)
BAD_AMOUNTS = (7, 8, 9, 10, 14, 15)
NOT_POSITIVE = (5, 6, 13, 16)


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _filled(template: str, value: str, mark: str) -> str:
    before, found, after = template.partition(mark)
    return f"{_lit(before)} || {value} || {_lit(after)}" if found else _lit(template)


def _chosen(number: str, texts: dict[int, str], other: str = "NULL") -> str:
    return f"CASE {number} " + " ".join(f"WHEN {n} THEN {t}" for n, t in texts.items()) + f" ELSE {other} END"


def _good(key: str, templates: tuple[str, ...], good: tuple[int, ...]) -> str:
    return f"({key} % {len(templates)}) IN {good}"


_K = "CAST(o_orderkey AS VARCHAR)"
_A = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
_EMAIL_TEXT = _chosen(
    f"c_custkey % {len(s.EMAILS)}",
    {i: _filled(t, "CAST(c_custkey AS VARCHAR)", "{k}") for i, t in enumerate(s.EMAILS)},
)

# What arrives, and what it is read as; NULL where the text is no number.
STRINGS = f"""WITH st AS (
  SELECT o_orderkey % {s.ID_MODULUS} AS ri, o_orderkey % {s.AMOUNT_MODULUS} AS ra, o_orderkey AS k, o_custkey AS c,
    o_orderkey % {s.KEY_LETTER[0]} = {s.KEY_LETTER[1]} AS letter,
    {_chosen(f'o_orderkey % {s.ID_MODULUS}', {r: _filled(t, _K, '{k}') for r, t in s.ID_TEXTS.items()}, _K)} AS id_text,
    {_chosen(f'o_orderkey % {s.AMOUNT_MODULUS}', {r: _filled(t, _A, '{a}') for r, t in s.AMOUNT_TEXTS.items()}, _A)} AS amount_text,
    CAST({_A} AS DOUBLE) AS a,
    CASE WHEN o_orderkey % {s.DATE_MISSING[0]} <> {s.DATE_MISSING[1]} THEN strftime(o_orderdate, '%Y-%m-%d') END AS date
  FROM orders),
sv AS (
  SELECT *,
    CASE WHEN ri = 4 THEN CAST('1' || CAST(k AS VARCHAR) AS BIGINT) ELSE k END AS id_value,
    CASE ra WHEN 2 THEN 1000.0::DOUBLE WHEN 4 THEN 10.5::DOUBLE WHEN 11 THEN 0.5::DOUBLE WHEN 12 THEN 5.0::DOUBLE
      WHEN 3 THEN NULL WHEN 17 THEN NULL ELSE a END AS amount_value,
    CASE ra WHEN 3 THEN 'nan' WHEN 17 THEN 'inf' END AS special_amount,
    CASE WHEN letter THEN 'c' || CAST(c AS VARCHAR) ELSE CAST(c AS VARCHAR) END AS key_text,
    concat_ws('; ',
      CASE WHEN ri IN {BAD_IDS} THEN 'transaction_id: must be of type bigint' END,
      CASE WHEN letter THEN 'customer_id: must be of type bigint' WHEN c <= 0 THEN 'customer_id: must be > 0' END,
      CASE WHEN ra IN {BAD_AMOUNTS} THEN 'amount: must be of type double' WHEN ra IN {NOT_POSITIVE} THEN 'amount: must be > 0' END,
      CASE WHEN date IS NULL THEN 'date: is required' END) AS rejection_reason
  FROM st)
"""

# The long values: the fields they are no good for, their integer and their decimal.
_TEXT = "email,day,id,amount,price"
_LONG_BAD = {i: _TEXT for i in range(len(s.LONG))} | {
    1: "email,day,id,price",
    2: "email,day",
    3: "email,day",
    4: "email,name,day,id,amount,price",
    10: "day,id,amount,price",
    13: "email,day,id",
}
_LONG_ID = {2: "7", 3: "7"}
_LONG_PRICE = {2: "'7.00'", 3: "'7.00'", 13: "'0.50'"}
_LONG_KIND = f"c_custkey % {len(s.LONG)}"
_LONG_TIMES = f"CASE WHEN c_custkey % {s.LONGEST[0]} = {s.LONGEST[1]} THEN {s.LONGEST_REPEATS} ELSE {s.LONG_REPEATS} END"
_LONG_CHARS = _chosen(_LONG_KIND, {i: f"{len(unit)} * ({_LONG_TIMES}) + {len(tail)}" for i, (unit, tail) in enumerate(s.LONG)})

ORACLE: dict[str, str] = {
    "gate_long_values": f"SELECT c_custkey AS customer_id, ({_LONG_CHARS})::BIGINT AS n_chars, ({_chosen(_LONG_KIND, _LONG_ID)})::BIGINT AS id, "
    f"{_chosen(_LONG_KIND, _LONG_PRICE)} AS price, {_chosen(_LONG_KIND, {i: _lit(b) for i, b in _LONG_BAD.items()})} AS bad_fields FROM customer",
    "rule_email_shapes": f"SELECT c_custkey AS customer_id, {_EMAIL_TEXT} AS email, "
    f"{_good('c_custkey', s.EMAILS, GOOD_EMAILS)} AS email_valid FROM customer",
    "rule_not_blank_shapes": f"SELECT c_custkey AS customer_id, {_good('c_custkey', s.NAMES, GOOD_NAMES)} AS name_not_blank FROM customer",
    "rule_iso_date_shapes": f"SELECT o_orderkey AS transaction_id, {_good('o_orderkey', s.DATES, GOOD_DATES)} AS date_valid FROM orders",
    "gate_strings_clean": STRINGS
    + "SELECT id_value AS transaction_id, c AS customer_id, amount_value AS amount, special_amount, date "
    "FROM sv WHERE rejection_reason = ''",
    "gate_strings_rejected": STRINGS
    + "SELECT id_text AS transaction_id, key_text AS customer_id, amount_text AS amount, date, rejection_reason "
    "FROM sv WHERE rejection_reason <> ''",
    "masked_rejects_typed": STRINGS
    + "SELECT sha256(id_text) AS transaction_id_sha256, key_text AS customer_id, sha256(date) AS date_sha256, rejection_reason "
    "FROM sv WHERE rejection_reason <> ''",
}

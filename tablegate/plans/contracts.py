"""The customer and transaction contracts (C1-C6 applied; C9 instances).

Any other entity is just another ``Contract``; nothing downstream is
specific to these two.
"""

from __future__ import annotations

from pyspark.sql import types as T

from tablegate.functions import rules
from tablegate.operators.contract import Contract, Field

CUSTOMER_CONTRACT = Contract(
    "customers",
    (
        Field("customer_id", T.LongType()),
        Field("name", T.StringType(), (rules.not_blank(),)),
        Field("email", T.StringType(), (rules.email(),)),
        Field("country", T.StringType(), (rules.not_blank(),)),
    ),
)

TRANSACTION_CONTRACT = Contract(
    "transactions",
    (
        Field("transaction_id", T.LongType()),
        Field("customer_id", T.LongType(), (rules.positive(),)),
        Field("amount", T.DoubleType(), (rules.positive_amount(),)),
        Field("date", T.StringType(), (rules.iso_date(),)),
    ),
)

# Columns the completeness audit counts NULLs in (as in the reference).
COMPLETENESS_COLUMNS = {
    "customers": ["name", "email", "country"],
    "transactions": ["amount"],
}

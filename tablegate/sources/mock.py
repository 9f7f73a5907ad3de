"""The small embedded dirty dataset, for tests and demos only.

Built with ``createDataFrame`` and an explicit schema, so an all-NULL column
or an all-rejected input still has the right types. Not used on the data
path: real inputs come from ``spark.read``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("email", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
    ]
)

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType(), True),
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("date", T.StringType(), True),
    ]
)

# --- Fixed values: the reference's embedded dirty records --------------------
CUSTOMERS_RAW = [
    (1, "Ana Torres", "ana@email.com", "Colombia"),
    (2, "Juan Pérez", None, "Mexico"),
    (3, "Laura Gómez", "laura_gomez@email.com", None),
    (4, "Juan Pérez", "juanperez@email.com", "Mexico"),
    (5, None, "andres@email.com", "Chile"),
]

TRANSACTIONS_RAW = [
    (100, 1, 200.0, "2025-01-01"),
    (101, 2, 150.0, "2025-01-02"),
    (102, 2, 150.0, "2025-01-02"),
    (103, 3, None, "2025-01-03"),
    (104, 6, 300.0, "2025-01-04"),
]
# -----------------------------------------------------------------------------


def mock_customers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CUSTOMERS_RAW, CUSTOMER_SCHEMA)


def mock_transactions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TRANSACTIONS_RAW, TRANSACTION_SCHEMA)

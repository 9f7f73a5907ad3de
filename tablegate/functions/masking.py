"""PII masking for samples and quarantine output.

SHA-256 hex digests (``sha2(x, 256)``, equal to DuckDB's ``sha256``) replace
the clear values, so rejected rows can be shared and still joined on the
masked value. NULL stays NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sha256(column: str):
    return F.sha2(F.col(column).cast("string"), 256)


def mask(df: DataFrame, columns: list[str], suffix: str = "") -> DataFrame:
    """Replace each column in ``columns`` by its SHA-256 digest.

    With a ``suffix`` the digest is written to ``column + suffix`` and the
    clear column is dropped. A column that does not exist is an error.
    """
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"columns to mask that are not there: {unknown}")
    out = df
    for c in columns:
        if suffix:
            out = out.withColumn(c + suffix, sha256(c)).drop(c)
        else:
            out = out.withColumn(c, sha256(c))
    return out

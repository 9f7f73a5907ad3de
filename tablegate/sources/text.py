"""Text sources for the gate (S2): CSV and JSON lines read as strings, broken lines kept.

Every contract field is read as text, so that typing is the gate's work and a
value that is no number is a violation with its reason, not a NULL from the
reader. A line that does not fit (too few or too many fields, an open quote, no
JSON object) stays a row: ``_corrupt_record`` holds the line, and the gate
reports it as the row's one violation. Lines of white space hold no record.

The readers are Spark's own, in PERMISSIVE mode: files are split and read by
tasks, and a read of some columns only does not change what counts as broken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablegate.operators.contract import CORRUPT, Contract

FORMATS = ("csv", "json")


def _schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def read_text(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract,
    format: str = "csv",
    columns: list[str] | None = None,
    **options: str,
) -> DataFrame:
    """The records under ``path`` as strings, with ``_corrupt_record``.

    CSV: ``columns`` names the fields in order for files without a header;
    otherwise every file starts with a header line. Names come from one file,
    and a file whose header differs is an error, not a silent shift. A quote
    inside a quoted value is doubled. Columns that the contract does not name
    are read as text too; a field the files do not have is missing (the gate
    reports it as required).

    JSON: one object a line. Scalars arrive as their text, objects and arrays
    as JSON text; keys that the contract does not name are left out, unless
    ``columns`` names them.

    ``options`` are further reader options (``sep``, ``encoding``,
    ``multiLine``, ``nullValue``, ...).
    """
    if format not in FORMATS:
        raise ValueError(f"text format {format!r}; known: {list(FORMATS)}")
    reader = spark.read.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    if format == "json":
        names = [*contract.field_names, *[c for c in columns or [] if c not in contract.field_names]]
        return reader.options(**options).schema(_schema(names)).json(path)
    # With column pruning a line is taken apart only as far as needed, and one with a field too many would pass.
    options = {"quote": '"', "escape": '"', "header": str(columns is None).lower(), **options, "columnPruning": "false"}
    reader = reader.options(**options)
    # A header is checked file by file; without one, fields are by position.
    names = columns or reader.csv(path).columns
    alike = sorted({n for n in names if [x.lower() for x in names].count(n.lower()) > 1})
    if alike:
        raise ValueError(f"columns {alike} are there more than once")
    if CORRUPT in names:
        raise ValueError(f"a column is named {CORRUPT}, which holds broken lines")
    return reader.option("enforceSchema", str(columns is not None).lower()).schema(_schema(names)).csv(path)

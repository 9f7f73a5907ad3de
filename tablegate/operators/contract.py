"""Contract gate: annotate, split clean from rejected, count.

``gate(df, contract)`` is narrow: every field is coerced to
its target type and checked, and the row gets ``_violations``, an array of
``struct<field, rule, message, reason>`` with one entry per failing field. Nothing
shuffles and nothing leaves the executors; ``clean`` and ``rejected`` are two
filters over the same annotated frame. Callers that need both should
materialise the annotated frame once (``tablegate.sources.sinks.write_split``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.coercion import coerce
from tablegate.functions.rules import Rule

VIOLATIONS = "_violations"
REASON = "rejection_reason"
RAW_PREFIX = "_raw_"
CORRUPT = "_corrupt_record"  # a line that its reader could not take apart
RESERVED = (VIOLATIONS, "_gate")  # columns the gate and the split write add

VIOLATION_TYPE = T.StructType(
    [
        T.StructField("field", T.StringType(), False),
        T.StructField("rule", T.StringType(), False),
        T.StructField("message", T.StringType(), False),
        T.StructField("reason", T.StringType(), False),  # "field: message", folded to a literal
    ]
)


@dataclass(frozen=True)
class Field:
    """One contract field: target type, whether it is required, value rules.

    Rules run in order after the type check; the first failing rule is the
    field's one violation (a validator chain stops at its first error).
    """

    name: str
    dtype: T.DataType
    rules: tuple[Rule, ...] = ()
    required: bool = True


@dataclass(frozen=True)
class Contract:
    """An ordered list of fields for one entity."""

    name: str
    fields: tuple[Field, ...] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        names = [f.name for f in self.fields]
        dup = sorted({n for n in names if names.count(n) > 1})
        if dup:
            raise ValueError(f"contract {self.name!r} repeats fields {dup}")

    @classmethod
    def from_spec(cls, spec: dict) -> "Contract":
        """Build a contract from plain data, e.g. a parsed JSON / YAML file::

            {"name": "customers",
             "fields": [{"name": "customer_id", "type": "bigint"},
                        {"name": "email", "type": "string", "rules": ["email"]},
                        {"name": "nickname", "type": "string", "required": false}]}

        ``type`` is a Spark DDL type string; ``rules`` name constructors in
        ``tablegate.functions.rules.RULES``.
        """
        from tablegate.functions.rules import RULES

        fields = []
        for f in spec["fields"]:
            unknown = [r for r in f.get("rules", []) if r not in RULES]
            if unknown:
                raise ValueError(f"unknown rules {unknown} for field {f['name']!r}; known: {sorted(RULES)}")
            fields.append(
                Field(
                    f["name"],
                    _simple_type(f["type"]),
                    tuple(RULES[r]() for r in f.get("rules", [])),
                    bool(f.get("required", True)),
                )
            )
        return cls(spec["name"], tuple(fields))

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dtype, True) for f in self.fields])


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


_SIMPLE_TYPES = {
    "tinyint": T.ByteType, "byte": T.ByteType, "smallint": T.ShortType, "short": T.ShortType,
    "int": T.IntegerType, "integer": T.IntegerType, "bigint": T.LongType, "long": T.LongType,
    "float": T.FloatType, "double": T.DoubleType, "string": T.StringType, "boolean": T.BooleanType,
    "date": T.DateType, "timestamp": T.TimestampType,
}


def _simple_type(name: str) -> T.DataType:
    """A field type from its Spark SQL name (``bigint``, ``decimal(18,2)``, ...)."""
    key = name.strip().lower().replace(" ", "")
    if key in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[key]()
    if key.startswith("decimal(") and key.endswith(")"):
        precision, scale = (int(x) for x in key[len("decimal("):-1].split(","))
        return T.DecimalType(precision, scale)
    raise ValueError(f"unsupported field type {name!r}")


def _violation(field_name: str, rule: str, message: str) -> Column:
    """A one-element violation array literal (one expression, one driver call)."""
    reason = f"{field_name}: {message}"
    return F.expr(
        f"array(named_struct('field', {_sql_str(field_name)}, 'rule', {_sql_str(rule)}, "
        f"'message', {_sql_str(message)}, 'reason', {_sql_str(reason)}))"
    )


def _no_violation() -> Column:
    return F.array().cast(T.ArrayType(VIOLATION_TYPE))


def _field_check(raw: Column, typed: Column, f: Field, same_type: bool) -> Column:
    """One CASE per field: required -> type -> rules; an empty array when fine.

    Arrays of zero or one element joined with ``concat`` keep the whole gate
    in whole-stage codegen (a ``filter(array, lambda)`` would not be).
    """
    chain = F
    if f.required:
        chain = chain.when(raw.isNull(), _violation(f.name, "required", "is required"))
    if not same_type:  # a value that cannot be coerced is NULL where the raw one is not
        chain = chain.when(raw.isNotNull() & typed.isNull(), _violation(f.name, "type", f"must be of type {f.dtype.simpleString()}"))
    for rule in f.rules:
        bad = typed.isNotNull() & ~F.coalesce(rule(typed), F.lit(False))
        chain = chain.when(bad, _violation(f.name, rule.name, rule.message))
    return _no_violation() if chain is F else chain.otherwise(_no_violation())


def quoted(name: str) -> str:
    """A column name that Spark reads as one name, dots included."""
    return "`" + name.replace("`", "``") + "`"


def gate(df: DataFrame, contract: Contract) -> DataFrame:
    """Annotate every row with its contract violations.

    Output columns: each contract field as its typed value (same name), a
    ``_raw_<field>`` copy only where the source type differs from the target
    type (so rejected rows can show what arrived), every other input column
    unchanged, and ``_violations``.

    A row whose ``_corrupt_record`` (see ``tablegate.sources.text``) is not NULL
    has that as its one violation.

    The gate has up to two stages, each an array of one element that a generator
    unpacks: the coerced values, then the violations. Catalyst neither merges
    expressions into a generator nor copies what it makes into a filter above
    it, so each coercion and each rule is evaluated once per row, whatever is
    done with the result; filters on other columns still pass through to the
    scan. (As plain projections, every rule, ``_violations`` and every filter on
    it would each hold their own copy of every coercion.)
    """
    clash = [c for c in df.columns if c in RESERVED or c.startswith(RAW_PREFIX)]
    if clash:
        raise ValueError(f"input columns {clash} use names reserved by the gate; rename them first")
    lower = [c.lower() for c in [*contract.field_names, *(c for c in df.columns if c not in contract.field_names)]]
    alike = sorted({c for c in lower if lower.count(c) > 1})
    if alike:
        raise ValueError(f"columns {alike} differ in upper and lower case only; rename them first")
    types = {f.name: f.dataType for f in df.schema.fields}
    extras = [F.col(quoted(c)) for c in df.columns if c not in contract.field_names]
    same = [f for f in contract.fields if types.get(f.name) == f.dtype]
    other = [f for f in contract.fields if f.name in types and f not in same]
    missing = [f for f in contract.fields if f.name not in types]
    # A missing column is a NULL column: it violates ``required``.
    kept = [F.col(quoted(f.name)) for f in same] + [F.lit(None).cast(f.dtype).alias(f.name) for f in missing]
    raws = [F.col(quoted(f.name)).alias(RAW_PREFIX + f.name) for f in other]
    typed = [coerce(F.col(quoted(f.name)), types[f.name], f.dtype)[0].cast(f.dtype).alias(f.name) for f in other]
    coerced = df.select(*extras, *kept, *raws, *([F.inline(F.array(F.struct(*typed)))] if typed else []))
    checks = [
        _field_check(F.col(quoted(RAW_PREFIX + f.name if f in other else f.name)), F.col(quoted(f.name)), f, f not in other)
        for f in contract.fields
    ]
    violations = F.concat(*checks) if checks else _no_violation()
    if CORRUPT in df.columns and CORRUPT not in contract.field_names:
        # What was read of a broken line means nothing, so that is its one violation.
        broken = _violation(CORRUPT, "corrupt", "line cannot be read")
        violations = F.when(F.col(CORRUPT).isNotNull(), broken).otherwise(violations)
    fields = [F.col(quoted(f.name)) for f in contract.fields]
    raw_cols = [F.col(quoted(RAW_PREFIX + f.name)) for f in other]
    return coerced.select(*fields, *extras, *raw_cols, F.explode(F.array(violations)).alias(VIOLATIONS))


def is_clean() -> Column:
    """True for rows without violations (never NULL: ``_violations`` is never NULL)."""
    return F.size(F.col(VIOLATIONS)) == 0


def _raw_fields(annotated: DataFrame) -> list[str]:
    return [c for c in annotated.columns if c.startswith(RAW_PREFIX)]


def clean(annotated: DataFrame) -> DataFrame:
    """Rows with no violation, contract fields carrying their typed values."""
    drop = [VIOLATIONS, CORRUPT, *_raw_fields(annotated)]
    return annotated.filter(is_clean()).drop(*drop)


def rejection_reason(violations: Column | None = None) -> Column:
    """``field: message`` per violation, joined with ``'; '``.

    Each violation carries its reason text, so this is a struct-field
    extraction plus ``array_join`` (codegen), not a per-element lambda.
    """
    violations = F.col(VIOLATIONS) if violations is None else violations
    return F.array_join(violations["reason"], "; ")


def rejected(annotated: DataFrame, keep_violations: bool = False) -> DataFrame:
    """Rows with at least one violation, as they arrived, plus the reason.

    Fields whose source type differed from the contract type are restored
    from their ``_raw_`` copy. An input column named ``rejection_reason`` is
    overwritten, as in the reference gate.
    """
    raws = {c[len(RAW_PREFIX):]: c for c in _raw_fields(annotated)}
    cols = [
        F.col(quoted(raws[c])).alias(c) if c in raws else F.col(quoted(c))
        for c in annotated.columns
        if c not in (VIOLATIONS, REASON) and not c.startswith(RAW_PREFIX)
    ]
    out = annotated.filter(~is_clean()).select(
        *cols, rejection_reason().alias(REASON), F.col(VIOLATIONS)
    )
    return out if keep_violations else out.drop(VIOLATIONS)


def violation_counts(annotated: DataFrame, entity: str | None = None) -> DataFrame:
    """Rejections per (field, rule); partial aggregation keeps the shuffle tiny."""
    counts = (
        annotated.select(F.explode(VIOLATIONS).alias("v"))
        .groupBy(F.col("v.field").alias("field"), F.col("v.rule").alias("rule"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if entity is not None:
        counts = counts.select(F.lit(entity).alias("entity"), "field", "rule", "n")
    return counts


def gate_count_columns() -> list[Column]:
    """Aggregate expressions for clean / rejected row counts."""
    return [
        F.count_if(is_clean()).alias("clean_rows"),
        F.count_if(~is_clean()).alias("rejected_rows"),
    ]


def gate_counts(annotated: DataFrame, entity: str | None = None) -> DataFrame:
    """One row ``(entity, clean_rows, rejected_rows)``."""
    counts = annotated.agg(*gate_count_columns())
    if entity is not None:
        counts = counts.select(F.lit(entity).alias("entity"), "clean_rows", "rejected_rows")
    return counts


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)

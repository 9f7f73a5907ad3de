"""Lax type coercion for contract fields.

Mirrors the lax mode of the contract library the reference uses: integers
accept integral numbers, booleans, whole floats and integer strings; floats
accept numbers, booleans and float strings (NaN / infinity included);
strings accept strings only. Numeric strings follow that library's grammar,
checked here with regular expressions before a ``try_cast`` (ANSI mode, on
by default in Spark 4, makes a plain ``cast`` throw on bad input):

- surrounding Unicode ``White_Space`` is ignored;
- integers: ``[+-]digits``, single underscores between digits, optionally a
  fraction of zeros (``"1.00"``); no exponent;
- decimals: as floats, but read digit by digit; a value that the type would
  round, NaN and infinity are type violations, and so is one of more than
  ``DECIMAL_MAX_LENGTH`` characters after its leading zeros;
- floats: ``nan`` / ``inf`` / ``infinity`` in any case with an optional
  sign, or a decimal float with optional exponent; single underscores are
  allowed except at the start or the end; no hex floats or type suffixes.

Integers are 64-bit here: a value beyond ``bigint`` is a type violation.
Each grammar is matched in linear time and without recursion, whatever the
length of the value.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.rules import members, whitespace_chars

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)

# --- Fixed values: numeric string grammar of the lax contract mode ------------
# ``_`` may stand between any two characters of a decimal float, once.
# Repeats are possessive: Java recurses on other repeated groups, and a value
# that is nearly a number would be tried in quadratic time.
_INT_STRING = r"[+-]?+[0-9]++(?:_[0-9]++)*+(?:\.0++)?+"
_FLOAT_STRING = (
    r"(?:[+-]_?+)?+(?:[0-9](?:_?+[0-9])*+(?:_?+\.(?:_?+[0-9])*+)?+|\.(?:_?+[0-9])++)"
    r"(?:_?+[eE](?:_?+[+-])?+(?:_?+[0-9])++)?+"
)
_NAN_STRING = r"(?i:[+-]?+nan)"
_INFINITY_STRING = r"(?i:[+-]?+inf(?:inity)?+)"
# Characters of a decimal string, leading zeros aside, beyond which it is no decimal of any type here.
DECIMAL_MAX_LENGTH = 1000
# -----------------------------------------------------------------------------


@lru_cache(maxsize=1)
def white_space() -> str:
    """The characters with the Unicode property White_Space: what ``str.isspace`` finds but for four separators."""
    return "".join(c for c in whitespace_chars() if c not in "\x1c\x1d\x1e\x1f")


def _strip(raw: Column) -> Column:
    """Drop leading / trailing Unicode White_Space (``trim`` strips spaces only)."""
    return F.btrim(raw, F.lit(white_space()))


def _is(raw: Column, grammar: str) -> Column:
    """Whether a value is of a grammar, white space around it aside."""
    space = "[" + members(white_space()) + "]*+"
    return raw.rlike(rf"\A{space}{grammar}{space}\z")


def int_from_string(raw: Column, target: T.DataType) -> Column:
    digits = F.substring_index(F.replace(_strip(raw), F.lit("_"), F.lit("")), ".", 1)
    return F.when(_is(raw, _INT_STRING), digits.try_cast(target))


def float_from_string(raw: Column, target: T.DataType) -> Column:
    plain = F.replace(_strip(raw), F.lit("_"), F.lit(""))
    if isinstance(target, T.DecimalType):
        # Straight to the decimal, never through a double; a value that would be rounded is refused.
        short = F.regexp_replace(plain, r"\A([+-]?+)(?:0(?=[0-9]))++", "$1")
        exact = short.try_cast(target)
        wide = short.try_cast(T.DecimalType(38, max(target.scale, 18)))
        digits = short.rlike(r"\A[+-]?+[0-9]*+(?:\.[0-9]{0,%d}+0*+)?+\z" % target.scale)
        kept = F.when(digits | F.coalesce(wide == exact, F.lit(False)), exact)
        return F.when(_is(raw, _FLOAT_STRING), F.when(F.length(short) <= DECIMAL_MAX_LENGTH, kept))
    value = (
        F.when(_is(raw, _FLOAT_STRING), plain.try_cast("double"))
        .when(_is(raw, _NAN_STRING), F.lit(float("nan")))
        .when(_is(raw, _INFINITY_STRING), F.when(raw.contains("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    )
    return value if isinstance(target, T.DoubleType) else value.try_cast(target)


def coerce(raw: Column, source: T.DataType, target: T.DataType) -> tuple[Column, Column]:
    """Return ``(typed_value, type_ok)`` for one field.

    ``type_ok`` is only meaningful where ``raw`` is not NULL; a NULL raw
    value is reported by the ``required`` check instead.
    """
    if source == target:
        return raw, F.lit(True)
    if isinstance(target, _INTEGRAL):
        if isinstance(source, _INTEGRAL) or isinstance(source, T.BooleanType):
            value = raw.try_cast(target)
            return value, value.isNotNull()
        if isinstance(source, _FRACTIONAL):
            if isinstance(source, T.DecimalType):
                whole = F.floor(raw) == raw  # in decimal: a double would lose digits
            else:
                as_double = raw.cast("double")
                whole = ~F.isnan(as_double) & (F.floor(as_double) == as_double)
            value = F.when(whole, raw.try_cast(target))
            return value, value.isNotNull()
        if isinstance(source, T.StringType):
            value = int_from_string(raw, target)
            return value, value.isNotNull()
    if isinstance(target, _FRACTIONAL) and isinstance(source, T.StringType):
        value = float_from_string(raw, target)
        return value, value.isNotNull()
    if isinstance(target, T.DecimalType) and isinstance(source, (*_INTEGRAL, *_FRACTIONAL)):
        value = raw.try_cast(target)
        same = value == raw  # a value that the decimal would round is refused
        return F.when(same, value), F.coalesce(same, F.lit(False))
    if isinstance(target, (T.FloatType, T.DoubleType)) and isinstance(source, (*_INTEGRAL, *_FRACTIONAL)):
        value = raw.try_cast(target)
        return value, value.isNotNull()
    if isinstance(target, _FRACTIONAL) and isinstance(source, T.BooleanType):
        value = raw.cast("int").try_cast(target)
        return value, value.isNotNull()
    if isinstance(target, (T.DateType, T.TimestampType, T.BooleanType)) and isinstance(source, T.StringType):
        value = raw.try_cast(target)
        return value, value.isNotNull()
    if isinstance(target, T.TimestampType) and isinstance(source, T.DateType):
        return raw.cast(target), F.lit(True)
    # No other pair of types is converted: a string field takes strings only, a number no dates or arrays.
    return F.lit(None).cast(target), F.lit(False)

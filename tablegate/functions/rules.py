"""Contract rules as Spark Column predicates.

A rule is a name, a message and a function ``Column -> Column`` that
returns a boolean predicate over the *typed* value of one field. Rules are
pure Catalyst expressions (``rlike``, comparisons, ``try_cast``), so they
stay inside whole-stage codegen and never leave the JVM. Patterns neither
backtrack nor recurse without bound: a value of any length gets its verdict in
time that grows with its length, on a stack that does not.

The same fixed patterns are exported so the DuckDB oracle in
``tablegate.plans.oracle`` evaluates the identical regular expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must stay as written for results to agree) --------------
# E-mail syntax: dot-atom local part of letters, digits and the RFC 5322
# atext symbols; a domain of dot-separated labels (letters/digits, inner
# hyphens) whose last label starts with a letter. No lookarounds so Java and
# RE2 (DuckDB) accept it alike; ``\z`` because Java's ``$`` also matches
# before a trailing newline.
EMAIL_PATTERN = (
    r"^[\p{L}\p{N}!#$%&'*+/=?^_`{|}~-]+(\.[\p{L}\p{N}!#$%&'*+/=?^_`{|}~-]+)*"
    r"@([\p{L}\p{N}]([\p{L}\p{N}-]*[\p{L}\p{N}])?\.)+"
    r"\p{L}([\p{L}\p{N}-]*[\p{L}\p{N}])?\z"
)
EMAIL_MAX_LENGTH = 254
LOCAL_PART_MAX_LENGTH = 64
LABEL_MAX_LENGTH = 63
# Domains that name no mail host: reserved top-level names.
SPECIAL_USE_DOMAINS = ("arpa", "invalid", "local", "localhost", "onion", "test")
# The longest e-mail value, display name included, that is looked at at all.
EMAIL_VALUE_MAX_LENGTH = 2048
# strptime('%Y-%m-%d'): four-digit year, one- or two-digit month and day.
DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
ZERO_YEAR_PREFIX = "0000"
# -----------------------------------------------------------------------------


@lru_cache(maxsize=1)
def whitespace_chars() -> str:
    """Every code point Python's ``str.strip()`` removes (``str.isspace``).

    Derived from the interpreter rather than typed out, so a blank test in
    Spark agrees with ``value.strip()`` character for character.
    """
    return "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def members(chars: str) -> str:
    """The characters as the inside of a regex class, neighbours as one range: a character is held against each part in turn."""
    points = sorted(map(ord, chars))
    firsts = [p for p in points if p - 1 not in points]
    lasts = [p for p in points if p + 1 not in points]
    return "".join("\\x{%x}" % a if a == b else "\\x{%x}-\\x{%x}" % (a, b) for a, b in zip(firsts, lasts, strict=True))


@lru_cache(maxsize=1)
def not_blank_pattern() -> str:
    """Regex that finds one character outside the whitespace set."""
    return "[^" + members(whitespace_chars()) + "]"


@dataclass(frozen=True)
class Rule:
    """A named boolean check over a typed, non-NULL field value."""

    name: str
    message: str
    predicate: Callable[[Column], Column]

    def __call__(self, value: Column) -> Column:
        return self.predicate(value)


def not_blank() -> Rule:
    """At least one non-whitespace character; the value is not trimmed."""
    pattern = not_blank_pattern()
    return Rule("not_blank", "must be a non-empty string", lambda c: c.rlike(pattern))


@lru_cache(maxsize=1)
def email_value_pattern() -> str:
    """One pattern for a whole e-mail value: outer white space, display name, address, limits.

    Java matches a repeated group by recursion unless the repeat is possessive,
    so every repeat here is (``++``, ``*+``): nothing is tried twice and the
    stack does not grow with the value.
    """
    space = "[" + not_blank_pattern()[2:] + "*+"
    letter, atom = r"[\p{L}\p{N}]", r"[\p{L}\p{N}!#$%&'*+/=?^_`{|}~-]"
    label = rf"(?![\p{{L}}\p{{N}}-]{{{LABEL_MAX_LENGTH + 1}}})"
    reserved = rf"(?!(?i:{'|'.join(SPECIAL_USE_DOMAINS)})(?![\p{{L}}\p{{N}}-]))"
    address = (
        rf"(?=[^@]{{1,{LOCAL_PART_MAX_LENGTH}}}+@)(?![\p{{L}}\p{{N}}!#$%&'*+/=?^_`{{|}}~.@-]{{{EMAIL_MAX_LENGTH + 1}}})"
        rf"{atom}++(?:\.{atom}++)*+@"
        rf"(?:{label}{letter}++(?:-++{letter}++)*+\.)++"
        rf"{label}{reserved}\p{{L}}{letter}*+(?:-++{letter}++)*+"
    )
    # ``Display name <address>``, the name bare words or quoted.
    name = rf"(?:{atom}++(?:\s++{atom}++)*+|\"[^\"]++\")?+\s*+"
    return rf"\A{space}(?:{address}|{name}<{space}{address}{space}>){space}\z"


def _valid_address(value: Column) -> Column:
    # A CASE, unlike AND, fixes the order: the pattern never sees a value without a length limit.
    return F.when(F.length(value) <= EMAIL_VALUE_MAX_LENGTH, value.rlike(email_value_pattern())).otherwise(
        F.when(value.isNotNull(), F.lit(False))
    )


def email() -> Rule:
    """An address, bare or with a display name (limits and reserved domains: the fixed values above)."""
    return Rule("email", "must be a valid e-mail address", _valid_address)


def positive() -> Rule:
    """C4: strictly greater than zero (integer ids)."""
    return Rule("positive", "must be > 0", lambda c: c > 0)


def positive_amount() -> Rule:
    """Rejects ``value <= 0``; NaN and infinity pass, as in Python."""
    return Rule("positive", "must be > 0", lambda c: ~(c <= 0))


def finite() -> Rule:
    """Opt-in: rejects NaN and +/-infinity (they cannot be summed exactly)."""
    return Rule(
        "finite",
        "must be a finite number",
        lambda c: ~F.isnan(c) & (c != float("inf")) & (c != float("-inf")),
    )


def iso_date() -> Rule:
    """``YYYY-M-D`` that names a real calendar day, year 0001-9999."""
    return Rule(
        "iso_date",
        "must be a date in YYYY-MM-DD format",
        lambda c: c.rlike(DATE_PATTERN)
        & ~c.startswith(ZERO_YEAR_PREFIX)
        & c.try_cast("date").isNotNull(),
    )


# Rule constructors by name, for contracts loaded from configuration.
RULES: dict[str, Callable[[], Rule]] = {
    "not_blank": not_blank,
    "email": email,
    "positive": positive,
    "positive_amount": positive_amount,
    "finite": finite,
    "iso_date": iso_date,
}

"""Enrichment and exact group totals.

Totals are summed as ``decimal(precision, scale)``: decimal addition is
associative, so the same rows give the same total under any partitioning,
and the reconciliation check compares like with like. Doubles are produced
only at the edge (``as_double=True``).

``group_totals`` never materialises the fact-to-dimension join. It sums the
fact side per join key first (map-side partial aggregation collapses a hot
key inside each task, so a key holding a third of all rows costs one row per
task in the shuffle), counts dimension copies per (key, group), joins the two
compact frames and sums ``key_total * copies`` per group. That is exactly
``sum(amount)`` over the inner join, fan-out of duplicate keys included.
Amounts that are no such decimal (NaN, infinite, out of range, more digits)
are counted and summed apart, exactly too: they are never dropped, and their
total is the same double under any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions import exact_sum
from tablegate.session import materialize, run_folder

DEFAULT_PRECISION = 18
DEFAULT_SCALE = 2


def exact(amount: Column | str, precision: int = DEFAULT_PRECISION, scale: int = DEFAULT_SCALE) -> Column:
    """Amount as a decimal: rounded to ``scale``, NULL for NaN, infinity and overflow (see ``inexact``)."""
    c = F.col(amount) if isinstance(amount, str) else amount
    return c.try_cast(T.DecimalType(precision, scale))


def inexact(amount: Column | str, precision: int = DEFAULT_PRECISION, scale: int = DEFAULT_SCALE) -> Column:
    """Whether an amount is present but not kept whole by ``exact``: NaN, infinite, out of range or rounded."""
    c = F.col(amount) if isinstance(amount, str) else amount
    e = exact(c, precision, scale)
    return c.isNotNull() & (e.isNull() | (e != c))


def times_copies(total: str, copies: str, precision: int) -> Column:
    """A key's exact total times its copies, at the total's own scale.

    A product of decimals keeps its scale while its precisions add up to less
    than 38 digits, so the copies get the digits that a sum leaves free; a key
    with more copies than those hold stops the job instead of losing digits.
    """
    digits = 38 - min(38, precision + 10) - 1
    if digits < 1:
        raise ValueError(f"precision {precision} leaves no digits for the copies of a key; use 26 at most")
    n = F.col(copies)
    fits = F.when(n < 10**digits, n).otherwise(F.raise_error(F.lit(f"a join key has 10^{digits} copies or more")).cast("bigint"))
    return F.col(total) * fits.cast(T.DecimalType(digits, 0))


def enrich(facts: DataFrame, dims: DataFrame, key: str = "customer_id") -> DataFrame:
    """Inner equi-join on ``key`` with one merged key column.

    Duplicate dimension keys fan out (kept, as in the reference). The
    physical join is left to Catalyst + AQE: broadcast only when the
    dimension's measured size is under the broadcast threshold, otherwise
    sort-merge, with AQE splitting a skewed key partition.
    """
    return facts.join(dims, on=key, how="inner")


def key_sums(
    facts: DataFrame,
    key: str,
    amount: str,
    precision: int = DEFAULT_PRECISION,
    scale: int = DEFAULT_SCALE,
) -> DataFrame:
    """Per-key sums -> ``(key, _bin, _key_total, _key_units, _key_inexact)``.

    ``_key_total`` adds the amounts that are exact decimals, in the row whose
    ``_bin`` is NULL; the others are counted and added as whole units of their
    bin (``tablegate.functions.exact_sum``), so none is lost or rounded.
    """
    odd = inexact(amount, precision, scale)
    value = F.when(odd, F.col(amount).try_cast("double"))
    return facts.groupBy(key, exact_sum.bin_of(value).alias("_bin")).agg(
        F.sum(F.when(~odd, exact(amount, precision, scale))).alias("_key_total"),
        F.sum(exact_sum.units(value)).alias("_key_units"),
        F.count_if(odd).alias("_key_inexact"),
    )


def key_groups(dims: DataFrame, key: str, group: str) -> DataFrame:
    """Copies of each (key, group) in the dimension -> ``(key, group, _copies)``."""
    return dims.groupBy(key, group).agg(F.count(F.lit(1)).alias("_copies"))


def group_totals(
    facts: DataFrame,
    dims: DataFrame,
    key: str = "customer_id",
    group: str = "country",
    amount: str = "amount",
    alias: str = "total_amount",
    precision: int = DEFAULT_PRECISION,
    scale: int = DEFAULT_SCALE,
    as_double: bool = True,
    count_inexact: bool = False,
) -> DataFrame:
    """G1: ``sum(amount)`` per ``group`` over ``facts JOIN dims USING (key)``.

    Returns ``(group, alias)``; ``alias`` is a double when ``as_double`` (then
    with the amounts that are no exact decimals added to the exact total) else
    the exact decimal total of the others. ``count_inexact`` adds
    ``<alias>_inexact``, the joined rows whose amount is not in that decimal.
    Unordered: apply ``order_desc`` for the report view.
    """
    sums = key_sums(facts, key, amount, precision, scale)
    copies = key_groups(dims, key, group)
    # Bins of a group are added up first: one row per group and bin, however many keys.
    binned = sums.join(copies, on=key, how="inner").groupBy(group, "_bin").agg(
        F.sum(times_copies("_key_total", "_copies", precision)).alias("_exact"),
        F.sum(times_copies("_key_units", "_copies", exact_sum.UNITS_PRECISION)).alias("_units"),
        F.sum(F.col("_key_inexact") * F.col("_copies")).alias("_inexact"),
    )
    units = F.when(F.col("_bin").isNotNull(), F.struct(F.col("_bin").alias("bin"), F.col("_units").alias("units")))
    totals = binned.groupBy(group).agg(
        F.sum("_exact").alias("_exact"),
        F.sum("_inexact").alias(f"{alias}_inexact"),
        exact_sum.total(F.collect_list(units)).alias("_rest"),
    )
    whole = F.col("_exact").cast(T.DecimalType(38, scale))
    out = plus_rest(whole, F.col("_rest")) if as_double else whole
    return totals.select(group, out.alias(alias), *([f"{alias}_inexact"] if count_inexact else []))


def plus_rest(exact_total: Column, rest: Column) -> Column:
    """A double total: the exact decimal part plus the double part, either of which may be NULL."""
    part = exact_total.cast("double")
    return F.when(rest.isNull(), part).otherwise(F.coalesce(part, F.lit(0.0)) + rest)


def order_desc(df: DataFrame, by: str, tiebreak: str | None = None) -> DataFrame:
    """O1/O2: largest first, NULLs last, ``tiebreak`` ascending for a total order."""
    keys = [F.col(by).desc_nulls_last()]
    if tiebreak is not None:
        keys.append(F.col(tiebreak).asc_nulls_last())
    return df.orderBy(*keys)


def ranked_desc(totals: DataFrame, by: str, tiebreak: str, alias: str = "position") -> DataFrame:
    """``order_desc``'s order as a column, 1 for the first row, at any number of rows.

    Rows are sorted in ranges, as ``order_desc`` does, and written with their
    place: the range and the row within it. A row's position is its place plus
    the sizes of the ranges before, which are one number per range.
    """
    path = run_folder(totals.sparkSession, "ranking")
    place = "_place"
    rows = materialize(order_desc(totals, by, tiebreak).withColumn(place, F.monotonically_increasing_id()), path)
    part, within = F.shiftright(place, 33), F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = rows.withColumn("_part", part).join(starts, "_part")
    return numbered.select(*totals.columns, (F.col("_start") + within + 1).cast("bigint").alias(alias))

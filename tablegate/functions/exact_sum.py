"""Order-independent sums of doubles.

Adding doubles rounds at every step, so the result depends on how rows are
dealt out. Here a double is taken apart into an integer times a power of two,
powers being shared by the doubles of similar size (a bin). Integers of a bin
are added as decimals, which is exact in any order; at the end the few bins of
a group, in order of size, are added up in two doubles that keep what rounding
drops. Equal rows give equal bits under any partitioning.

Built-in functions only::

    sums = df.groupBy("g", bin_of(x).alias("bin")).agg(F.sum(units(x)).alias("units"))
    sums.groupBy("g").agg(total(F.collect_list(F.struct("bin", "units"))))
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Precision of ``units``: a long's digits.
UNITS_PRECISION = 19
UNITS = T.DecimalType(UNITS_PRECISION, 0)
# A bin spans WIDTH powers of two. Its unit lies BELOW powers under the size of its doubles: the 53 bits of a
# double and one more, as log2 may be off by one next to a power of two. So units stay below 2**59.
WIDTH = 4
BELOW = 54
# Bins of what is no number, above those of all numbers.
POSITIVE_INFINITY, NEGATIVE_INFINITY, NAN = 5_000, 5_001, 5_002
_PART = 1 << 40


def bin_of(x: Column) -> Column:
    """The exponent of a double's unit, or one of the three codes above; NULL for NULL."""
    power = F.floor(F.log2(F.abs(x)))
    return (
        F.when(x.isNull(), F.lit(None))
        .when(F.isnan(x), F.lit(NAN))
        .when(x == float("inf"), F.lit(POSITIVE_INFINITY))
        .when(x == float("-inf"), F.lit(NEGATIVE_INFINITY))
        .when(x == 0, F.lit(0))
        .otherwise(F.floor((power - BELOW) / WIDTH) * WIDTH)
        .cast("int")
    )


def _scaled(x: Column, power: Column) -> Column:
    """x times 2**power, in two steps, as 2**power alone may be no double."""
    half = F.floor(power / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def units(x: Column) -> Column:
    """A double as an integer number of its bin's units; of what is no number, 1."""
    odd = F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(odd, F.lit(1).cast(UNITS)).otherwise(_scaled(x, -bin_of(x)).cast("long").cast(UNITS))


def _halves(n: Column) -> tuple[Column, Column]:
    """n as a * 2**40 + b, |b| <= 2**40; whatever the division rounds to, the rest is exact."""
    high = (n / F.lit(_PART).cast("decimal(13,0)")).cast("decimal(28,0)")
    return high, (n - high * F.lit(_PART).cast("decimal(13,0)")).cast("decimal(28,0)")


def _parts(item: Column) -> Column:
    """The doubles that a bin's units add up to, each exact, largest first."""
    high, low = _halves(item["units"].cast("decimal(38,0)"))
    top, middle = _halves(high)
    return F.array(*[_scaled(p.cast("double"), item["bin"] + k) for p, k in ((top, 80), (middle, 40), (low, 0))])


def _added(so_far: Column, x: Column) -> Column:
    """A sum and what its roundings have dropped, with x added (two-sum)."""
    high = so_far["high"] + x
    back = high - so_far["high"]
    dropped = (so_far["high"] - (high - back)) + (x - back)
    return F.struct(high.alias("high"), (so_far["low"] + dropped).alias("low"))


def total(items: Column) -> Column:
    """The double sum of ``items``, an array of ``struct<bin, units>`` with each bin once; NULL if there are none."""
    def has(code: int) -> Column:
        return F.exists(items, lambda i: i["bin"] == code)

    numbers = F.reverse(F.array_sort(F.filter(items, lambda i: i["bin"] < POSITIVE_INFINITY)))
    zero = F.struct(F.lit(0.0).alias("high"), F.lit(0.0).alias("low"))
    whole = F.aggregate(F.flatten(F.transform(numbers, _parts)), zero, _added, lambda s: s["high"] + s["low"])
    return (
        F.when(F.size(items) == 0, F.lit(None).cast("double"))
        .when(has(NAN) | (has(POSITIVE_INFINITY) & has(NEGATIVE_INFINITY)), F.lit(float("nan")))
        .when(has(POSITIVE_INFINITY), F.lit(float("inf")))
        .when(has(NEGATIVE_INFINITY), F.lit(float("-inf")))
        .otherwise(whole)
    )

"""Exact quantile without gathering the values."""

from __future__ import annotations

import math
import sys
from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf.functions.names import named

BINS, HELD = 10_000, 10_000
#: Passes after which something is wrong: with the fewest bins allowed 2^64 values need about 40, and decimals of 38 digits 65 more.
MOST_PASSES = 200
#: Decimal digits of the arithmetic on brackets; Spark's decimals have 38.
DIGITS = 80


def exact_quantile(df: DataFrame, column: str, q: float, bins: int = BINS, held: int = HELD):
    """The element at nearest rank ``ceil(q * n)``, in the column's type; NULL and NaN do not count.

    An exact quantile as one aggregate keeps every distinct value in one task.
    This brackets the rank instead: a mergeable sketch of the values in the
    bracket gives two of them close to the rank on either side, and counting
    below and at each tells which is the element, or which lie between. A sketch
    of ``bins`` errs by a share of 1 / ``bins``, so each pass leaves a few
    ``bins``-ths of the values, whatever they are: ten billion need three passes.
    Up to ``held`` values are sorted on the driver at the end. Like
    ``DataFrame.approxQuantile`` it runs at once. RuntimeError if the values change
    between passes, or if 200 passes do not end.
    """
    with localcontext(prec=DIGITS):
        return _narrowed(df, column, q, bins, held)


def _narrowed(df: DataFrame, column: str, q: float, bins: int, held: int):
    if bins < 10 or held < 1:
        raise ValueError("bins must be 10 or more, held 1 or more")
    if not 0 <= q <= 1:
        raise ValueError("q must lie between 0 and 1")
    kind = df.schema[column].dataType
    x = F.col("x")
    values = df.select(named(column).alias("x")).filter("x IS NOT NULL")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        values = values.select(x.cast("double").alias("x")).filter("NOT isnan(x)")
    total, low, high = values.agg(F.count("x"), F.min("x"), F.max("x")).first()
    rank = max(math.ceil(q * total), 1)
    inside, left, skipped, passes = values, total, 0, 0
    while left > held and low < high:
        passes += 1
        if passes > MOST_PASSES:
            raise RuntimeError(f"{MOST_PASSES} passes over {column} did not bracket the quantile")
        wanted = (rank - skipped) / left
        shares = [max(0.0, wanted - 2 / bins), min(1.0, wanted + 2 / bins)]
        found = inside.agg(_sketch(x, low, high, shares, bins)).first()[0]
        probes = [min(max(_value(f, low, kind), low), high) for f in found]
        if _is_wide(low, high):
            # Doubles cannot tell all values of such a bracket apart: its middle halves it at least.
            probes = sorted([probes[0] if wanted < 0.5 else probes[1], _middle(low, high, kind)])
        first, second = probes
        lo, hi = F.lit(first), F.lit(second)
        at = values.agg(*[F.count_if(t) for t in (x < lo, x <= lo, x < hi, x <= hi)]).first()
        if rank <= at[0]:
            high, left = _next(first, kind, -1), at[0] - skipped
        elif rank <= at[1]:
            return first
        elif rank <= at[2]:
            low, high, left, skipped = _next(first, kind, 1), _next(second, kind, -1), at[2] - at[1], at[1]
        elif rank <= at[3]:
            return second
        else:
            low, left, skipped = _next(second, kind, 1), left + skipped - at[3], at[3]
        inside = values.filter(x.between(F.lit(low), F.lit(high)))
    if left and low == high:
        return low
    rest = sorted(row[0] for row in inside.collect())
    if len(rest) != left:
        raise RuntimeError(f"values of {column} changed between passes")
    return rest[rank - skipped - 1] if rest else None


def _is_wide(low, high) -> bool:
    """Whether whole numbers or decimals lie further apart than doubles count."""
    return not isinstance(low, float) and high - low >= 2**62


def _middle(low, high, kind: T.DataType):
    if isinstance(kind, T.DecimalType):
        return low + ((high - low) / 2).quantize(Decimal(1).scaleb(-kind.scale))
    return low + (high - low) // 2


def _sketch(x: Column, low, high, shares: list[float], bins: int) -> Column:
    """Values near the shares, of doubles.

    Whole numbers and decimals count from the bracket's lower end: their distance
    becomes exact as the bracket shrinks. Infinities count as the largest doubles.
    """
    if isinstance(low, float):
        number = F.greatest(F.least(x, F.lit(sys.float_info.max)), F.lit(-sys.float_info.max))
    else:
        number = x.cast("double") - float(low) if _is_wide(low, high) else (x - F.lit(low)).cast("double")
    return F.percentile_approx(number, shares, bins)


def _value(found: float, low, kind: T.DataType):
    """The value at a sketched distance: of decimals a whole number of the type's last digits."""
    if isinstance(low, float):
        return found
    if isinstance(kind, T.DecimalType):
        return low + Decimal(found).quantize(Decimal(1).scaleb(-kind.scale))
    return low + round(found)


def _next(value, kind: T.DataType, step: int):
    """The next value of the type, up or down."""
    if isinstance(value, float):
        return math.nextafter(value, step * math.inf)
    if isinstance(kind, T.DecimalType):
        return value + step * Decimal(1).scaleb(-kind.scale)
    return value + step

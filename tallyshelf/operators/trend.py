"""Measures over time: every period present, change against earlier ones, and tests for a trend."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyshelf.functions.names import named

# Periods, with their step and how many make a year.
PERIODS = {"day": ("1 day", 365), "week": ("7 days", 52), "month": ("1 month", 12), "quarter": ("3 months", 4), "year": ("1 year", 1)}


def period_series(
    df: DataFrame,
    day: str,
    measures: Mapping[str, Column],
    *,
    by: Sequence[str] = (),
    period: str = "month",
    first: date | None = None,
    last: date | None = None,
    zero: Sequence[str] = (),
) -> DataFrame:
    """``(by, period, <measures>, is_filled)``: one row per group and period, gaps included.

    ``measures`` are aggregates. The calendar runs from ``first`` to ``last``, or from the
    first to the last period that any row has, the same for all groups; a group is
    one that has a row, NULL included. In periods without rows the measures named
    in ``zero`` are 0 and the others NULL, and ``is_filled`` is true. Rows without
    a date, and rows outside the calendar, do not count. Rows are combined per
    group and period before the shuffle; the calendar is as long as its periods.
    """
    step, _ = PERIODS[period]

    def begin(column: Column) -> Column:
        return column if period == "day" else F.trunc(column, period)

    start = begin(named(day).cast("date"))
    within = start.isNotNull()
    for bound, keeps in ((first, lambda b: start >= b), (last, lambda b: start <= b)):
        if bound is not None:
            within = within & keeps(begin(F.lit(bound)))
    rows = df.filter(within)
    keys = [named(b).alias(b) for b in by]
    measured = rows.groupBy(*keys, start.alias("period")).agg(*[e.alias(n) for n, e in measures.items()])
    bounds = measured.agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    low = bounds.select("lo").scalar() if first is None else begin(F.lit(first))
    high = bounds.select("hi").scalar() if last is None else begin(F.lit(last))
    groups = measured.select(*map(named, by)).distinct() if by else df.sparkSession.range(1).select()
    ends = groups.withColumn("_lo", low).withColumn("_hi", high).filter("_lo <= _hi")
    spine = ends.select(*map(named, by), F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step}"))).alias("period"))
    there = measured.select(F.struct(*measured.columns).alias("m"))
    same = F.col("period") == F.col("m.period")
    for b in by:
        same = same & named(b).eqNullSafe(F.col("m")[b])
    values = [F.coalesce(F.col("m")[n], F.lit(0)).alias(n) if n in zero else F.col("m")[n].alias(n) for n in measures]
    filled = F.col("m").isNull().alias("is_filled")
    return spine.join(there, same, "left").select(*map(named, by), "period", *values, filled)


def with_change(
    series: DataFrame, value: str, *, by: Sequence[str] = (), period: str = "month", width: int = 3
) -> DataFrame:
    """``series`` with ``previous``, ``growth``, ``year_before``, ``moving_mean`` and ``running_total`` of ``value``.

    ``growth`` is the change against the period before as a share of it, NULL
    after 0 or NULL; ``year_before`` the value as many periods earlier as make a
    year; ``moving_mean`` that of this period and the ``width - 1`` before it, NULL
    values left out, and NULL before there are so many periods. Expects a row per
    period, as ``period_series`` gives. Groups are bounded by the calendar.
    """
    _, year = PERIODS[period]
    own = Window.partitionBy(*map(named, by)).orderBy("period")
    last = own.rowsBetween(-(width - 1), 0)
    x, previous = named(value), F.lag(named(value)).over(own)
    return series.withColumns(
        {
            "previous": previous,
            "growth": F.when(previous != 0, (x - previous).cast("double") / previous),
            "year_before": F.lag(x, year).over(own),
            "moving_mean": F.when(F.count(F.lit(1)).over(last) == width, F.avg(x).over(last)),
            "running_total": F.sum(x).over(own.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )


def trend_test(series: DataFrame, value: str, *, by: Sequence[str] = (), critical: float = 1.96) -> DataFrame:
    """``(by, n, s, tau, z, slope, intercept, trend)``: Mann-Kendall and Theil-Sen of each group's periods.

    ``s`` counts the pairs of periods of which the later is higher, less those of
    which it is lower; ``tau`` is its share of all pairs; ``z`` the standard score
    with the correction for equal values, 0 where all are equal; ``slope`` the median
    change per period over all pairs, ``intercept`` the median of what is left at period 0; ``trend`` is rising or falling
    if ``z`` is beyond ``critical``, else none. NULL values take no part; their periods still count as time. Fewer
    than two values: NULL measures.

    Works on the bounded aggregate, a row per period: a group's values are one
    array, and its pairs are made inside the row, of at most the square of the
    calendar. Nothing grows with the rows behind the aggregate.
    """
    own = Window.partitionBy(*map(named, by)).orderBy("period")
    numbered = series.select(
        *map(named, by), (F.row_number().over(own) - 1).cast("double").alias("t"), named(value).cast("double").alias("y")
    )
    points = F.array_sort(F.collect_list(F.when(F.col("y").isNotNull(), F.struct("t", "y"))))
    grouped = numbered.groupBy(*map(named, by)).agg(points.alias("points"))
    pairs = F.flatten(
        F.transform(
            "points",
            lambda a, i: F.transform(
                F.slice("points", i + 2, F.greatest(F.size("points") - i - 1, F.lit(0))),
                lambda b: F.struct((b["y"] - a["y"]).alias("rise"), (b["t"] - a["t"]).alias("run")),
            ),
        )
    )
    values = F.transform("points", lambda p: p["y"])
    ties = F.transform(
        F.array_distinct(values), lambda v: F.size(F.filter(values, lambda w: w == v)).cast("bigint")
    )

    def total(array: Column, of) -> Column:
        return F.aggregate(array, F.lit(0).cast("bigint"), lambda acc, x: acc + of(x))

    n = F.size("points").cast("bigint")
    measured = grouped.select(*map(named, by), "points", n.alias("n"), pairs.alias("pairs"), ties.alias("ties"))
    s = total(F.col("pairs"), lambda p: F.signum(p["rise"]).cast("bigint"))
    spread = F.col("n") * (F.col("n") - 1) * (2 * F.col("n") + 5) - total(
        F.col("ties"), lambda t: t * (t - 1) * (2 * t + 5)
    )
    slope = _median(F.transform("pairs", lambda p: p["rise"] / p["run"]))
    scored = measured.withColumns({"s": s, "spread": spread, "slope": slope})
    z = F.when(F.col("spread") > 0, (F.col("s") - F.signum("s")) / F.sqrt(F.col("spread") / F.lit(18.0))).otherwise(0.0)
    tau = F.col("s").cast("double") / (F.col("n") * (F.col("n") - 1) / 2)
    enough = F.col("n") >= 2
    rest = _median(F.transform("points", lambda p: p["y"] - F.col("slope") * p["t"]))
    trend = F.when(F.col("z") > critical, "rising").when(F.col("z") < -critical, "falling").otherwise("none")
    return (
        scored.select(
            *map(named, by), "n", *[F.when(enough, e).alias(m) for m, e in (("s", F.col("s")), ("tau", tau), ("z", z))],
            F.when(enough, F.col("slope")).alias("slope"), F.when(enough, rest).alias("intercept"),
        )
        .withColumn("trend", F.when(F.col("z").isNotNull(), trend))
    )


def _median(array: Column) -> Column:
    """The middle of an array, or the mean of the two in the middle; NULL if it is empty."""
    ordered, n = F.array_sort(array), F.size(array)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2)

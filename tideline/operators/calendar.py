"""Daily calendars: reference price with fill and lags, holidays, school breaks.

A calendar has one row per day between two dates the caller names, and that number is checked. It is the only table
here that a window orders without partitioning, and the only one that is always broadcast.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.functions.scalars import flag_or_false

MAX_CALENDAR_DAYS = 40_000  # about 110 years

REF_LAGS = (1, 3, 7)
BREAK_ZONES = ("break_zone_a", "break_zone_b", "break_zone_c")


def _as_date(day: date | str) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def day_range(start: Column, stop: Column) -> Column:
    """Days from ``start`` to the day before ``stop``; no rows (NULL array) when the range is empty."""
    return F.when(start < stop, F.sequence(start, F.date_sub(stop, 1)))


def calendar_range(spark: SparkSession, start: date | str, stop: date | str) -> DataFrame:
    """Calendar table ``day``, end-exclusive, of checked length."""
    first, last = _as_date(start), _as_date(stop)
    if (last - first).days > MAX_CALENDAR_DAYS:
        raise ValueError(f"calendar of {(last - first).days} days exceeds {MAX_CALENDAR_DAYS}")
    days = spark.range(1).select(
        F.explode(day_range(F.lit(first.isoformat()).cast("date"), F.lit(last.isoformat()).cast("date"))).alias("day")
    )
    return days


def with_facts(
    calendar: DataFrame,
    *,
    ref: DataFrame | None = None,
    holidays: DataFrame | None = None,
    breaks: DataFrame | None = None,
) -> DataFrame:
    """Add what is known about each day: ``ref``, ``is_holiday``, the three school-break flags (those that are given).

    Unlisted days have no ``ref`` and FALSE flags. A day given several times counts once: highest quote, any flag. The
    sources are stacked and reduced to one row per day in a single aggregation, then joined once.
    """
    parts = []
    if ref is not None:
        parts.append(ref.selectExpr("cast(day as date) as day", "ref"))
    if holidays is not None:
        parts.append(holidays.selectExpr("cast(day as date) as day", "true as is_holiday"))
    if breaks is not None:
        parts.append(
            breaks.selectExpr("cast(day as date) as day", *[f"cast({z} as boolean) as {z}" for z in BREAK_ZONES])
        )
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    facts = [c for c in stacked.columns if c != "day"]
    per_day = stacked.groupBy("day").agg(*[F.max(c).alias(c) for c in facts])
    known = calendar.join(per_day, "day", "left")
    return known.withColumns({c: flag_or_false(F.col(c)) for c in facts if c != "ref"})


def ref_fill(calendar: DataFrame, *, backfill: bool = False) -> DataFrame:
    """``ref_lag0``: the last known quote on or before each day.

    ``backfill=True`` also gives the days before the first quote that quote; by default they stay NULL.
    """
    ordered = Window.orderBy("day")
    known = F.last("ref", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    if backfill:
        everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        known = F.coalesce(known, F.first("ref", ignorenulls=True).over(everything))
    return calendar.withColumn("ref_lag0", known).drop("ref")


def ref_lags(filled: DataFrame, lags: tuple[int, ...] = REF_LAGS, delay: int = 0) -> DataFrame:
    """The reference price 1, 3 and 7 days earlier; ``delay`` shifts the whole series for a quote published late."""
    ordered = Window.orderBy("day")
    lagged = {f"ref_lag{n}": F.lag("ref_lag0", n + delay).over(ordered) for n in lags}
    if delay:
        lagged["ref_lag0"] = F.lag("ref_lag0", delay).over(ordered)
    return filled.withColumns(lagged)


def ref_diffs(lagged: DataFrame) -> DataFrame:
    """One-day and seven-day change of the reference price, FLOAT."""
    return lagged.withColumns(
        {
            "ref_diff_1d": (F.col("ref_lag0") - F.col("ref_lag1")).cast("float"),
            "ref_diff_7d": (F.col("ref_lag0") - F.col("ref_lag7")).cast("float"),
        }
    )


def holiday_neighbours(calendar: DataFrame) -> DataFrame:
    """``before_holiday`` (tomorrow is one) and ``after_holiday`` (yesterday was one).

    The first and last calendar day have no neighbour on one side and get NULL there.
    """
    ordered = Window.orderBy("day")
    return calendar.withColumns(
        {
            "before_holiday": F.lead("is_holiday").over(ordered),
            "after_holiday": F.lag("is_holiday").over(ordered),
        }
    )


def daily_calendar(
    spark: SparkSession,
    start: date | str,
    end: date | str,
    *,
    ref: DataFrame,
    holidays: DataFrame,
    breaks: DataFrame,
    warmup_days: int = 366,
    backfill: bool = False,
    ref_delay: int = 0,
) -> DataFrame:
    """All calendar columns for the days ``start .. end`` (inclusive).

    Fill, lags and neighbours are computed on a range that begins ``warmup_days`` earlier and ends a day later, so the
    kept days have their full past and their tomorrow. The last quote on or before the first of these days is carried
    into it, however old it is.
    """
    first = _as_date(start) - timedelta(days=warmup_days)
    day = F.col("day").cast("date")
    known = ref.where(F.col("ref").isNotNull() & (day <= F.lit(first)))
    carried = known.agg(F.max(F.struct(day.alias("day"), "ref")).alias("last")).select(
        F.lit(first).alias("day"), F.col("last.ref").alias("ref")
    )
    ref = ref.where(day > F.lit(first)).select(day.alias("day"), "ref").unionByName(carried)
    days = calendar_range(spark, first, _as_date(end) + timedelta(days=2))
    table = with_facts(days, ref=ref, holidays=holidays, breaks=breaks)
    table = holiday_neighbours(ref_diffs(ref_lags(ref_fill(table, backfill=backfill), delay=ref_delay)))
    return table.where(F.col("day").between(str(_as_date(start)), str(_as_date(end))))

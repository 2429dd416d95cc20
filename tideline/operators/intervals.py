"""Validity intervals: the daily panel without a grid, a join or a fill window.

After :func:`last_per_day` a reading stays valid from its day until the day before the key's next reading. Everything
the panel needs about the past (first day, previous price, start of the current run, the prices of the last week) is
known per *reading*, in one window over the key, before the days are generated. Expanding an interval into days is
then a pure row generator: the filled price is already on the row and no shuffle or sort follows.

Rows per key are bounded by the number of days, because the input holds one row per key and day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.schema import KEY


def _day_literal(day: date | str) -> Column:
    return F.lit(str(day)).cast("date")


def validity_intervals(daily: DataFrame, *, key: Sequence[str] = KEY, day: str = "day") -> DataFrame:
    """Add ``next_day`` (day of the key's next reading, NULL for the last one)."""
    return daily.withColumn("next_day", F.lead(day).over(Window.partitionBy(*key).orderBy(day)))


def expand_days(
    intervals: DataFrame,
    *,
    start: date | str | Column | None = None,
    end: date | str | None = None,
    day: str = "day",
    into: str = "day",
) -> DataFrame:
    """One row per day of each interval.

    ``end=None`` stops a key at its last reading; a date extends it to that day. ``start`` clips intervals instead of
    dropping them, so the reading before the window carries into its first day. Empty ranges are removed first:
    ``sequence`` would count them downwards.
    """
    low = F.col(day)
    if start is not None:
        low = F.greatest(low, start if isinstance(start, Column) else _day_literal(start))
    high = F.date_sub("next_day", 1)
    if end is None:
        high = F.coalesce(high, F.col(day))
    else:
        high = F.least(high, _day_literal(end))  # least skips the NULL of an open interval
    bounded = intervals.withColumn("_low", low).withColumn("_high", high).where("_low <= _high")
    kept = [c for c in intervals.columns if c not in (into, "next_day")]
    return bounded.select(*kept, F.explode(F.sequence("_low", "_high")).alias(into))


def asof_daily(
    daily: DataFrame,
    *,
    key: Sequence[str] = KEY,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """The latest reading as of each day."""
    return expand_days(validity_intervals(daily, key=key), start=start, end=end).select(*daily.columns)


def panel_grid(spans: DataFrame, *, key: Sequence[str] = KEY) -> DataFrame:
    """Every key on every day of its own span."""
    return spans.select(*key, F.explode(F.sequence("first_day", "last_day")).alias("day"))


def price_history(
    daily: DataFrame, *, key: Sequence[str] = KEY, window: int = 7, scale: int = 1000, carry: Sequence[str] = ()
) -> DataFrame:
    """Validity intervals plus what the features need about the past, all from one window over the key.

    Adds ``next_day``, ``first_day``, ``last_price`` (the price before this reading), ``run_day`` (last day the price
    changed, NULL before any change) and, for j = 0 .. ``window``, ``_start{j}`` / ``_units{j}``: first day and price
    of the j-th interval back. A trailing week touches at most ``window`` earlier intervals.

    ``carry`` names further columns of the reading to keep. Without them only ``day`` and ``price`` enter the window,
    so that every use of the history reads the same shuffle.
    """
    ordered = f"over (partition by {', '.join(key)} order by day)"
    to_here = f"over (partition by {', '.join(key)} order by day rows between unbounded preceding and current row)"
    back = range(1, window + 1)
    history = daily.selectExpr(
        *key,
        *carry,
        "day",
        "price",
        f"lead(day) {ordered} as next_day",
        f"first(day) {to_here} as first_day",
        f"lag(price) {ordered} as last_price",
        *[f"lag(day, {j}) {ordered} as _start{j}" for j in back],
        *[f"lag(price, {j}) {ordered} as _price{j}" for j in back],
    )
    in_units = "cast(rint({} * {}D) as bigint) as _units{}"
    return history.selectExpr(
        *key, *carry, "day", "price", "next_day", "first_day", "last_price",
        f"last_value(if(price != last_price, day, null)) ignore nulls {to_here} as run_day",
        "day as _start0",
        in_units.format("price", float(scale), 0),
        *[f"_start{j}" for j in back],
        *[in_units.format(f"_price{j}", float(scale), j) for j in back],
    )


def trailing_units(day: str = "day", window: int = 7) -> Column:
    """Sum of the previous-day prices of the ``window`` rows ending on ``day``, from the lagged intervals.

    These are the prices of the days ``day - window .. day - 1``. Interval j ends where the next one starts, so it
    covers ``min(its length, what is left of the window)`` of those days, never less than zero.
    """
    starts = [f"_start{j}" for j in range(window + 1)]
    ends = [day, *starts]
    terms = [
        f"coalesce(_units{j} * greatest(0, least(datediff({end}, {start}), {window} - datediff({day}, {end}))), 0L)"
        for j, (start, end) in enumerate(zip(starts, ends))
    ]
    return F.expr(" + ".join(terms))

"""The feature panel: one function for training and for scoring."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import ref_spread, weekday_index
from tideline.operators.intervals import expand_days, price_history, trailing_units
from tideline.operators.readings import entity_span, last_per_day, with_area
from tideline.operators.series import gap_to_mean, interval_peer_totals, join_peers
from tideline.schema import ATTRIBUTES, KEY, PANEL_COLUMNS


def count_peer_groups(entities: DataFrame) -> int:
    """Number of (product, area) groups: one number, from a pre-aggregated scan of two columns."""
    return entities.select("product", "area").distinct().count()


def feature_panel(
    daily: DataFrame,
    entities: DataFrame | None,
    calendar: DataFrame,
    *,
    start: date | str,
    end: date | str,
    extend: bool = False,
    window: int = 7,
    scale: int = 1000,
    ref_factor: float = 0.01,
    peer_groups: int | None = None,
) -> DataFrame:
    """The 29-column panel for the days ``start .. end``.

    ``daily`` has one reading per key and day, ``entities`` one row per key (attributes and ``area``), ``calendar`` one
    row per day, from :func:`tideline.operators.calendar.daily_calendar`. Without ``entities`` the attributes and the area
    are columns of ``daily``, and a day shows those of the reading it is filled from. A series stops at its last reading; with
    ``extend`` it goes on to ``end``. Its first day has no previous price and is left out. ``scale`` is the number of
    price units kept in sums (1000 for three decimals).

    Features are taken from the whole history in ``daily``; ``start`` only selects the rows that are written.

    ``peer_groups`` (see :func:`count_peer_groups`) bounds the table of peer means by groups x days; a bounded table is
    broadcast and the expanded rows reach the output without a shuffle.

    Shuffles: ``daily`` by key, ``entities`` by key, the peer totals. Both uses of the history read the same exchange.
    """
    carry = () if entities is not None else (*ATTRIBUTES, "area")
    history = price_history(daily, window=window, scale=scale, carry=carry)
    if entities is not None:
        history = history.join(entities.drop("first_day", "last_day"), list(KEY))
    rows = price_panel(history, start=start, end=end, extend=extend, window=window, scale=scale)

    days = (date.fromisoformat(str(end)) - date.fromisoformat(str(start))).days + 1
    peer_rows = None if peer_groups is None else peer_groups * days
    peers = interval_peer_totals(history, start=start, end=end, extend=extend)
    panel = join_peers(rows, peers, peer_rows=peer_rows, scale=scale)
    return (
        panel.join(F.broadcast(calendar), "day", "left")
        .withColumns(
            {
                "weekday": weekday_index(F.col("day")),
                "ref_spread": ref_spread(F.col("prev_price"), F.col("ref_lag0"), ref_factor),
            }
        )
        .select(*PANEL_COLUMNS)
    )


def price_panel(
    history: DataFrame,
    *,
    start: date | str,
    end: date | str,
    extend: bool = False,
    window: int = 7,
    scale: int = 1000,
) -> DataFrame:
    """The rows of the panel with what follows from a key's own prices, from :func:`price_history` of the same window.

    ``price``, ``prev_price``, ``days_unchanged`` and ``rolling_gap``, next to the history's columns: one shuffle by key
    before the expansion, none after it.
    """
    rows = _expand(history, start, end, extend)
    prev_price = F.when(F.col("day") == F.col("_reading_day"), F.col("last_price")).otherwise(F.col("price"))
    run_start = F.greatest(F.col("run_day"), F.date_add("first_day", 1))
    known_days = F.least(F.datediff("day", "first_day"), F.lit(window))
    return rows.withColumn("prev_price", prev_price).withColumns(
        {
            "days_unchanged": F.datediff("day", run_start).cast("smallint"),
            "rolling_gap": gap_to_mean(F.col("prev_price"), trailing_units("day", window), known_days, scale),
        }
    )


def _expand(history: DataFrame, start: date | str, end: date | str, extend: bool) -> DataFrame:
    """Days of each interval, from the day after the key's first one."""
    first_kept = F.greatest(F.date_add("first_day", 1), F.lit(str(start)).cast("date"))
    intervals = history.withColumnRenamed("day", "_reading_day")
    if not extend:  # an open interval lasts one day
        intervals = intervals.withColumn("next_day", F.coalesce("next_day", F.date_add("_reading_day", 1)))
    return expand_days(intervals, start=first_kept, end=end, day="_reading_day")


def training_panel(
    readings: DataFrame,
    calendar: DataFrame,
    *,
    start: date | str,
    end: date | str,
    tie_break: Sequence[str] = (),
    unique_tie: bool = False,
    scale: int = 1000,
    peer_groups: int | None = None,
    **options,
) -> DataFrame:
    """Readings to panel: last reading per day, entity attributes, features."""
    daily = last_per_day(readings, tie_break=tie_break, unique_tie=unique_tie)
    entities = with_area(entity_span(readings))
    return feature_panel(
        daily, entities, calendar, start=start, end=end, scale=scale, peer_groups=peer_groups, **options
    )


def enrich(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """A dense panel with the calendar columns of its day."""
    return panel.join(F.broadcast(calendar), "day", "left")


def with_split(
    panel: DataFrame, *, train: tuple[date | str, date | str], valid_from: date | str, day: str = "day"
) -> DataFrame:
    """Add ``part`` (``train`` / ``valid``) by date and drop other days.

    One pass: written with ``partitionBy("part")`` it yields both sets without computing the panel twice.
    """
    first, last = (F.lit(str(d)).cast("date") for d in train)
    part = F.when(F.col(day).between(first, last), "train").when(
        F.col(day) >= F.lit(str(valid_from)).cast("date"), "valid"
    )
    return panel.withColumn("part", part).where("part is not null")


def latest_day(table: DataFrame, day: str = "day") -> DataFrame:
    """Rows of the table's last day (uncorrelated scalar subquery)."""
    return table.where(F.col(day) == table.agg(F.max(day).alias(day)).scalar())

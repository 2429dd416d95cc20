"""Feature operators on a dense daily panel (one row per key and day, no gaps).

Each adds one column. They can be used on any dense panel; the feature panel in :mod:`tideline.plans.panel` derives
the same values from validity intervals without sorting the expanded rows.

Windows by key see at most one row per day. The peer mean is grouped by day, area and product, a group that can hold a
large share of all rows, and is therefore pre-aggregated and joined instead of windowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.scalars import units
from tideline.operators.intervals import expand_days
from tideline.operators.skew import heavy_groups, null_safe_join, sliced_join
from tideline.schema import KEY

PEER_GROUP = ("product", "area", "day")

# A broadcast row of the peer table takes about 100 bytes in memory: at most some 200 MB per executor.
MAX_BROADCAST_ROWS = 2_000_000


def with_prev_price(panel: DataFrame, *, key: Sequence[str] = KEY) -> DataFrame:
    """``prev_price``: yesterday's price of the key."""
    return panel.withColumn("prev_price", F.lag("price").over(Window.partitionBy(*key).orderBy("day")))


def with_change_flag(panel: DataFrame) -> DataFrame:
    """``changed``: 1 when the price differs from yesterday's, 0 otherwise and on the first day."""
    differs = F.col("price") != F.col("prev_price")
    return panel.withColumn("changed", F.when(differs, 1).otherwise(0))


def with_run_id(panel: DataFrame, *, key: Sequence[str] = KEY) -> DataFrame:
    """``run_id``: number of changes so far."""
    so_far = Window.partitionBy(*key).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return panel.withColumn("run_id", F.sum("changed").over(so_far))


def with_days_unchanged(panel: DataFrame, *, key: Sequence[str] = KEY) -> DataFrame:
    """``days_unchanged``: position of the row in its run, from 0."""
    run = Window.partitionBy(*key, "run_id").orderBy("day")
    return panel.withColumn("days_unchanged", (F.row_number().over(run) - 1).cast("smallint"))


def with_rolling_gap(
    panel: DataFrame, *, key: Sequence[str] = KEY, window: int = 7, scale: int = 1000
) -> DataFrame:
    """``rolling_gap``: previous price minus its mean over the last ``window`` rows, this one included."""
    trailing = Window.partitionBy(*key).orderBy("day").rowsBetween(1 - window, 0)
    total = F.sum(units(F.col("prev_price"), scale)).over(trailing)
    count = F.count("prev_price").over(trailing)
    return panel.withColumn("rolling_gap", gap_to_mean(F.col("prev_price"), total, count, scale))


def gap_to_mean(value: Column, total_units: Column, count: Column, scale: int) -> Column:
    """``value - total / count`` as FLOAT, from an exact unit sum."""
    return (value - total_units / (count * F.lit(float(scale)))).cast("float")


def peer_totals(panel: DataFrame, *, scale: int = 1000) -> DataFrame:
    """Unit sum and count of the previous prices per day, area and product."""
    return panel.groupBy(*PEER_GROUP).agg(
        F.sum(units(F.col("prev_price"), scale)).alias("peer_units"), F.count("prev_price").alias("peer_count")
    )


def interval_peer_totals(
    history: DataFrame, *, start: date | str, end: date | str, extend: bool = False
) -> DataFrame:
    """The totals of :func:`peer_totals` for ``start .. end``, from intervals that were not expanded into days.

    ``history`` is :func:`tideline.operators.intervals.price_history` with ``product`` and ``area``. A price is the previous
    price from the day after its reading to the next reading's day: it is added to its group on the first of these days and
    taken off after the last. These changes are summed by group and day, then along the days of a group, so the work
    follows readings, and the window sees at most one row per day and group.
    """
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    known = history.withColumns(
        {
            "_from": F.greatest(F.date_add("day", 1), first),
            "_to": F.least(F.coalesce("next_day", last if extend else F.col("day")), last),
            "_known": F.col("price").isNotNull().cast("bigint"),
        }
    ).where("_from <= _to")
    changes = F.array(
        *[
            F.struct(
                at.alias("day"), (F.coalesce("_units0", F.lit(0)) * sign).alias("units"),
                (F.col("_known") * sign).alias("known"), F.lit(sign).alias("rows"),
            )
            for at, sign in ((F.col("_from"), 1), (F.date_add("_to", 1), -1))
        ]
    )
    by_day = known.select("product", "area", F.inline(changes)).groupBy(*PEER_GROUP).agg(
        F.sum("units").alias("units"), F.sum("known").alias("known"), F.sum("rows").alias("rows")
    )
    days = Window.partitionBy("product", "area").orderBy("day")
    so_far = days.rowsBetween(Window.unboundedPreceding, 0)
    running = by_day.select(
        *PEER_GROUP,
        F.sum("units").over(so_far).alias("_sum"),
        F.sum("known").over(so_far).alias("peer_count"),
        F.sum("rows").over(so_far).alias("_rows"),
        F.lead("day").over(days).alias("next_day"),
    ).where("_rows > 0")
    totals = running.withColumn("peer_units", F.expr("if(peer_count > 0, _sum, null)")).drop("_sum", "_rows")
    return expand_days(totals).select(*PEER_GROUP, "peer_units", "peer_count")


def join_peers(
    panel: DataFrame, peers: DataFrame, *, peer_rows: int | None, scale: int = 1000, key: Sequence[str] = KEY
) -> DataFrame:
    """``peer_gap`` from totals of the row's own group (the row itself included; an unknown area is a group too).

    ``peer_rows`` is an upper bound of the totals' row count. Within ``MAX_BROADCAST_ROWS`` the totals are broadcast
    and the wide panel is not shuffled. Without a bound, or beyond it, both sides are shuffled by group, and groups
    that hold a large share of the rows (their size is in the totals) are cut into slices by key.
    """
    if peer_rows is not None and peer_rows <= MAX_BROADCAST_ROWS:
        joined = null_safe_join(panel, F.broadcast(peers), PEER_GROUP)
    else:
        heavy = heavy_groups(peers, PEER_GROUP, "peer_count")
        joined = sliced_join(panel, peers, PEER_GROUP, heavy_left=heavy, spread_left=key)
    gap = gap_to_mean(F.col("prev_price"), F.col("peer_units"), F.col("peer_count"), scale)
    return joined.withColumn("peer_gap", gap).drop("peer_units", "peer_count")


def with_peer_gap(panel: DataFrame, *, scale: int = 1000, peer_rows: int | None = None) -> DataFrame:
    """``peer_gap``: previous price minus the mean of all entities of the same day, area and product."""
    return join_peers(panel, peer_totals(panel, scale=scale), peer_rows=peer_rows, scale=scale)

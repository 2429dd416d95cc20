"""Rolling state between daily runs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.readings import last_per_day
from tideline.schema import ATTRIBUTES, KEY, STATE_COLUMNS

STATE_DAYS = 14


def feed_to_state(
    feed: DataFrame, *, tie_break: Sequence[str] = (), attributes: Sequence[str] = ATTRIBUTES
) -> DataFrame:
    """The day's readings in the layout of the state: the last one per key and day."""
    return last_per_day(feed, keep=("price", *attributes), tie_break=tie_break)


def union_state(state: DataFrame, feed: DataFrame, *, key: Sequence[str] = KEY) -> DataFrame:
    """State and feed (both in state layout) as one row per key and day; the feed wins.

    A feed repeats the latest price under its original date until it changes, so most of its rows are already in the
    state. Both sides hold one row per key and day and few days, so they are shuffled by key alone: the choice here and
    every later step by key (roll, attributes, history) run on that one shuffle.
    """
    values = [c for c in STATE_COLUMNS if c not in (*key, "day")]
    both = state.select(*STATE_COLUMNS, F.lit(0).alias("_source")).unionByName(
        feed.select(*STATE_COLUMNS, F.lit(1).alias("_source"))
    )
    winner = F.max(F.struct("_source", *values)).alias("_row")
    return both.repartition(*key).groupBy(*key, "day").agg(winner).select(*key, "day", *[F.col("_row")[c].alias(c) for c in values])


def roll_state(
    merged: DataFrame, as_of: date | str, *, keep_days: int = STATE_DAYS, key: Sequence[str] = KEY
) -> DataFrame:
    """The rows the next run needs: the last ``keep_days`` days plus each key's last older row.

    Without that row a price that last changed before the window would be lost, and its key with it. A row is needed if
    its key's next reading falls into the window or does not exist. Rolling again changes nothing.
    """
    cutoff = F.date_sub(F.lit(str(as_of)).cast("date"), keep_days)
    following = F.lead("day").over(Window.partitionBy(*key).orderBy("day"))
    return (
        merged.withColumn("_next", following)
        .where((F.col("day") >= cutoff) | F.col("_next").isNull() | (F.col("_next") >= cutoff))
        .drop("_next")
    )


def late_readings(state: DataFrame, feed: DataFrame, *, key: Sequence[str] = KEY) -> DataFrame:
    """Readings of the feed (with ``observed_at``) from days before all that the state still holds of their key.

    They came too late for any later step: rolling drops them again. A key the state does not know has none.
    """
    oldest = state.groupBy(*key).agg(F.min("day").alias("_oldest"))
    return feed.join(oldest, list(key)).where(F.to_date("observed_at") < F.col("_oldest")).select(*feed.columns)

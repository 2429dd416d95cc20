"""The daily forecast: state + feed to predictions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.decisions import dead_band, predicted_price, published_delta, trend_label
from tideline.operators.readings import HIGH, LOW, plausible, with_area
from tideline.operators.state import feed_to_state, roll_state, union_state
from tideline.plans.panel import count_peer_groups, feature_panel
from tideline.schema import PREDICTION_COLUMNS
from tideline.session import scratch, settle
from tideline.sources.commits import publish_run
from tideline.sources.state_store import StateVersion, by_day, write_store
from tideline.sources.writers import publish_snapshot, write_state

Scorer = Callable[[DataFrame], DataFrame]
Publisher = Callable[[DataFrame, str, date | str], None]


def column_scorer(expression: Column) -> Scorer:
    """Score with a column expression instead of a fitted model."""
    return lambda panel: panel.withColumn("raw_delta", expression)


def decide(scored: DataFrame, *, anchor: str = "price") -> DataFrame:
    """Predicted price, published change and trend from ``raw_delta``.

    ``anchor`` is the price the change is added to: the day's own price when forecasting the next one (default), the
    previous price (``prev_price``) when evaluating. The price uses the unrounded kept change.
    """
    kept = scored.withColumn("delta", dead_band(F.col("raw_delta")))
    return kept.withColumns(
        {
            "predicted_price": predicted_price(F.col(anchor), F.col("delta")),
            "predicted_delta": published_delta(F.col("delta")),
            "trend": trend_label(F.col("delta")),
        }
    )


def merged_state(
    state: DataFrame,
    feed: DataFrame,
    *,
    low: float = LOW,
    high: float = HIGH,
    not_after: date | str | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """State and the feed's plausible readings: a time, a price strictly between the bounds, no day after ``not_after``."""
    kept = plausible(feed, low, high)
    if not_after is not None:
        kept = kept.where(F.to_date("observed_at") <= F.lit(str(not_after)).cast("date"))
    return union_state(state, feed_to_state(kept, tie_break=tie_break))


def daily_forecast(
    merged: DataFrame,
    calendar: DataFrame,
    scorer: Scorer,
    *,
    as_of: date | str,
    scale: int = 1000,
    peer_groups: int | None = None,
) -> DataFrame:
    """Predictions for every key of the merged state, as of one day.

    The same feature function as in training, asked for a single day: each key yields one row from the interval that
    contains ``as_of``, and no day before it is generated. That interval is the key's latest reading, so its attributes
    are the current ones and need no table of entities.
    """
    known = merged.where(F.col("day") <= F.lit(str(as_of)).cast("date"))
    panel = feature_panel(
        with_area(known), None, calendar, start=as_of, end=as_of, extend=True, scale=scale, peer_groups=peer_groups
    )
    return decide(scorer(panel)).select(*PREDICTION_COLUMNS)


def run_day(
    state: DataFrame,
    feed: DataFrame,
    calendar: DataFrame,
    scorer: Scorer,
    *,
    root: str,
    as_of: date | str,
    version: str | None = None,
    tie_break: Sequence[str] = (),
    scale: int = 1000,
    low: float = LOW,
    high: float = HIGH,
    publish: Publisher = publish_snapshot,
) -> None:
    """One daily run: merge, forecast, publish, roll.

    Readings without a time, outside the price bounds or after ``as_of`` take no part. A run for a day before that of
    the snapshot adds to the archive only. ``publish`` takes (predictions, root, as_of).

    The merged state feeds several steps and is written once. The new state is written last and under its own version:
    a run that broke off can be repeated as a whole and leaves the same files.
    """
    with scratch(feed.sparkSession):
        merged = settle(
            merged_state(state, feed, low=low, high=high, not_after=as_of, tie_break=tie_break), "merged"
        )
        groups = count_peer_groups(with_area(merged))
        forecast = daily_forecast(merged, calendar, scorer, as_of=as_of, scale=scale, peer_groups=groups)
        publish(forecast, root, as_of)
        write_state(roll_state(merged, as_of), root, version or str(as_of))


def run_day_on_store(
    base: StateVersion,
    feed: DataFrame,
    calendar: DataFrame,
    scorer: Scorer,
    *,
    root: str,
    as_of: date | str,
    version: str | None = None,
    tie_break: Sequence[str] = (),
    scale: int = 1000,
    low: float = LOW,
    high: float = HIGH,
) -> StateVersion:
    """:func:`run_day` on a bucketed state, published by commit; gives the version it wrote.

    The feed is shuffled to the state's buckets and the state stays where it is; of the new version only the buckets that
    changed are written. Readers meet the former predictions until the new ones are whole.
    """
    kept = plausible(feed, low, high).where(F.to_date("observed_at") <= F.lit(str(as_of)).cast("date"))
    with scratch(feed.sparkSession):
        merged = settle(base.merged(feed_to_state(kept, tie_break=tie_break), as_of), "merged")
        rows = by_day(merged, "merged")
        groups = count_peer_groups(with_area(rows))
        publish_run(daily_forecast(rows, calendar, scorer, as_of=as_of, scale=scale, peer_groups=groups), root, as_of)
        return write_store(base, merged, root, version or str(as_of))

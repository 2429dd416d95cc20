"""From raw readings to one reading per key and day, and one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import area_code
from tideline.schema import ATTRIBUTES, KEY


LOW, HIGH = 0.5, 3.5  # bounds of a plausible price, the same in training and scoring


def plausible(readings: DataFrame, low: float = LOW, high: float = HIGH, value: str = "price") -> DataFrame:
    """Readings with a time and a value strictly between ``low`` and ``high`` (drops NULLs too)."""
    return readings.where(
        F.col("observed_at").isNotNull() & (F.col(value) > F.lit(low)) & (F.col(value) < F.lit(high))
    )


INTEGERS = ("tinyint", "smallint", "int", "bigint")
FIXED_WIDTH = (*INTEGERS, "float", "double", "date", "timestamp", "timestamp_ntz", "boolean")
TIE_VALUES = 1 << 65  # room for any long and for NULL below them


def packed_order(time: str, tie: Column) -> Column:
    """Time of day, then a long, as one number: within a day it orders like both together, NULL last of all.

    A day has fewer than 2^37 microseconds and the tie takes 2^65 values, so the number has at most 32 digits. A decimal is
    the widest type that aggregation by hashing can hold.
    """
    seconds = F.hour(time) * 3600 + F.minute(time) * 60 + F.date_part(F.lit("SECOND"), time)
    micros = (seconds.cast("decimal(11,6)") * 1_000_000).cast("decimal(12,0)")
    place = F.coalesce(tie.cast("decimal(20,0)") + F.lit(str((1 << 63) + 1)).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.coalesce(micros, F.lit(-1).cast("decimal(12,0)")) * F.lit(str(TIE_VALUES)).cast("decimal(20,0)") + place


def last_per_day(
    readings: DataFrame,
    *,
    key: Sequence[str] = KEY,
    keep: Sequence[str] = ("price",),
    tie_break: Sequence[str] = (),
    unique_tie: bool = False,
) -> DataFrame:
    """The last reading of each key and day: ``key, day, *keep``.

    The order is total on what is returned: latest ``observed_at``, then ``tie_break``, then ``keep``. As an
    aggregation it is combined on the map side, so a key that holds most of the rows sends one row per day and task.
    Downstream the number of rows per key is bounded by the number of days.

    With ``unique_tie`` the caller states that one integer tells apart all readings of a key and time. One value of fixed
    width is then aggregated by hashing, and raw readings are never sorted. Other orders take a sort per task.
    """
    day = F.to_date("observed_at").alias("day")
    types = dict(readings.dtypes)
    if unique_tie and len(keep) == 1 and types[keep[0]] in FIXED_WIDTH and len(tie_break) == 1 and types[tie_break[0]] in INTEGERS:
        order = packed_order("observed_at", F.col(tie_break[0]))
        return (
            readings.groupBy(*key, day).agg(F.max_by(keep[0], order).alias(keep[0])).select(*key, "day", *keep)
        )
    ordered = dict.fromkeys(("observed_at", *tie_break, *keep))
    return (
        readings.groupBy(*key, day)
        .agg(F.max(F.struct(*ordered)).alias("_latest"))
        .select(*key, "day", *[F.col("_latest")[c].alias(c) for c in keep])
    )


def entity_span(
    readings: DataFrame,
    *,
    key: Sequence[str] = KEY,
    attributes: Sequence[str] = ATTRIBUTES,
    time: str = "observed_at",
) -> DataFrame:
    """One row per key: ``first_day``, ``last_day`` and the attributes of its latest reading.

    First groups by key *and* attributes, with fixed-width buffers: a hash aggregation that leaves one row per
    attribute variant on the map side, however many readings a key has. Only the variants are then compared.
    Variants seen at the same instant are ordered by their values.
    """
    names = ", ".join(attributes)
    return (
        readings.groupBy(*key, *attributes)
        .agg(F.expr(f"struct(min(to_date({time})), max(to_date({time})), max({time})) as _span"))
        .groupBy(*key)
        .agg(
            F.expr("min(_span.col1) as first_day"),
            F.expr("max(_span.col2) as last_day"),
            F.expr(f"max(struct(_span.col3 as _seen, {names})) as _latest"),
        )
        .selectExpr(*key, "first_day", "last_day", *[f"_latest.{a} as {a}" for a in attributes])
    )


def with_area(entities: DataFrame, code: str = "postal_code") -> DataFrame:
    return entities.withColumn("area", area_code(F.col(code)))

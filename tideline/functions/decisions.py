"""Training target, asymmetric dead band and labels, as column expressions.

All comparisons are strict and done in the type named in each docstring: a move that lies exactly on a bound is
decided by its binary value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.functions.scalars import half_even

# Fixed values (price units): decision bounds and training weight.
DOWN_BOUND = 0.0020
UP_BOUND = 0.0008
MOVE_BOUND = 0.002
RISE_WEIGHT = 1.4


def price_change(price: Column, prev_price: Column) -> Column:
    """Training target: today's change, FLOAT."""
    return (price - prev_price).cast("float")


def target_weight(target: Column, bound: float = MOVE_BOUND, weight: float = RISE_WEIGHT) -> Column:
    """Heavier weight for rises above ``bound``; compared in FLOAT, the target's own type."""
    return F.when(target > F.lit(bound).cast("float"), F.lit(weight)).otherwise(F.lit(1.0))


def dead_band(delta: Column, down: float = DOWN_BOUND, up: float = UP_BOUND) -> Column:
    """Keep a predicted change outside ``[-down, up]``, else 0; NULL stays NULL."""
    return F.when((delta < F.lit(-down)) | (delta > F.lit(up)), delta).when(delta.isNotNull(), F.lit(0.0))


def trend_label(delta: Column, down: float = DOWN_BOUND, up: float = UP_BOUND) -> Column:
    """``up`` / ``down`` / ``stable`` from a change and its two bounds; NULL stays NULL."""
    return (
        F.when(delta > F.lit(up), F.lit("up"))
        .when(delta < F.lit(-down), F.lit("down"))
        .when(delta.isNotNull(), F.lit("stable"))
    )


def actual_label(delta: Column, bound: float = MOVE_BOUND) -> Column:
    """Label of an observed change with a symmetric bound, DOUBLE comparison."""
    return trend_label(delta, down=bound, up=bound)


def predicted_price(price: Column, kept_delta: Column, digits: int = 3) -> Column:
    """Price plus the unrounded kept change, rounded afterwards."""
    return half_even(price + kept_delta, digits)


def published_delta(kept_delta: Column, digits: int = 4) -> Column:
    return half_even(kept_delta, digits)

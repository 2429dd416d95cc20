"""Equi-joins in which one group may hold a large share of the rows.

The groups that need care are found from counts, so their number is bounded: at most ``1 / share`` groups can hold more
than ``share`` of all rows. The share follows the number of shuffle partitions, so a slice is a fixed part of what a task
gets on average, and the list has a few rows per partition: it is safe to broadcast whatever the data. Each heavy group is cut into slices by
another column, and the other side's row of that group is repeated once per slice; light groups stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICES_PER_PARTITION = 4  # a slice holds at most this part of a task's average rows
MIN_SLICE_ROWS = 50_000


def heavy_groups(
    counts: DataFrame, keys: Sequence[str], n: str, *, share: float | None = None, min_rows: int = MIN_SLICE_ROWS
) -> DataFrame:
    """Groups larger than ``share`` of all rows (and than ``min_rows``) with ``_slices``, the parts to cut them into.

    By default the share is one in ``SLICES_PER_PARTITION`` times the shuffle partitions.
    """
    if share is None:
        share = 1 / (SLICES_PER_PARTITION * int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    total = counts.agg(F.sum(n).alias("_total")).scalar()
    limit = F.greatest(total * F.lit(share), F.lit(float(min_rows)))
    return counts.select(*keys, F.ceil(F.col(n) / limit).cast("int").alias("_slices")).where("_slices > 1")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on equally named columns that treats NULL as a value; the right side's copies are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same: Column = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def _with_slices(table: DataFrame, keys: Sequence[str], heavy: DataFrame, slice_of, into: str) -> DataFrame:
    """Add the slice column ``into``; ``slice_of`` maps the group's number of slices (1 if light) to it."""
    listed = heavy.withColumnsRenamed({k: f"_heavy_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_heavy_{k}")) for k in keys])
    found = table.join(F.broadcast(listed), same, "left")
    return found.withColumn(into, slice_of(F.coalesce("_slices", F.lit(1)))).drop(
        "_slices", *[f"_heavy_{k}" for k in keys]
    )


def _cut(table: DataFrame, keys: Sequence[str], heavy: DataFrame, spread_by: Sequence[str], into: str) -> DataFrame:
    """Each row in one slice of its group."""
    return _with_slices(table, keys, heavy, lambda n: F.pmod(F.xxhash64(*spread_by), n).cast("int"), into)


def _repeat(table: DataFrame, keys: Sequence[str], heavy: DataFrame, into: str) -> DataFrame:
    """Each row once per slice of its group."""
    return _with_slices(table, keys, heavy, lambda n: F.explode(F.sequence(F.lit(0), n - 1)), into)


def sliced_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    heavy_left: DataFrame,
    spread_left: Sequence[str],
    heavy_right: DataFrame | None = None,
    spread_right: Sequence[str] = (),
    tasks: int | None = None,
) -> DataFrame:
    """Inner equi-join whose heavy groups are cut into slices.

    A group that is heavy on the left is cut by ``spread_left`` and met by a copy of the right rows per slice; likewise
    the other way round if ``heavy_right`` is given. Every pair of rows still meets in exactly one slice.

    With ``tasks`` both sides are laid into that many partitions, which adaptive execution does not merge by their bytes:
    for joins whose pairs far outnumber their rows. NULL keys meet nothing then.
    """
    by = [*keys, "_left_slice"]
    left = _cut(left, keys, heavy_left, spread_left, "_left_slice")
    right = _repeat(right, keys, heavy_left, "_left_slice")
    if heavy_right is not None:
        by.append("_right_slice")
        left = _repeat(left, keys, heavy_right, "_right_slice")
        right = _cut(right, keys, heavy_right, spread_right, "_right_slice")
    if tasks is not None:
        return left.repartition(tasks, *by).join(right.repartition(tasks, *by), by).drop("_left_slice", "_right_slice")
    return null_safe_join(left, right, by).drop("_left_slice", "_right_slice")

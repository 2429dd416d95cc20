"""What the operators share: row numbers, integer names, whole-text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NAME_BUCKETS = 65_536


def number_rows(table: DataFrame, into: str = "_row") -> DataFrame:
    """Each row with a number of its own, so that repeated rows (equal ids, equal texts) stay apart.

    The numbers hold within one evaluation only: a scan is cut by the parallelism of the moment, which changes when an
    executor goes or comes, so a later evaluation may number the rows differently. ``settle`` the numbered rows, or what
    is made of them in the same pass, and use only the stored numbers from there on.
    """
    return table.withColumn(into, F.monotonically_increasing_id())


def whole_text(column: str | Column) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")


def integer_names(table: DataFrame, by: list[str], n: str) -> DataFrame:
    """Add ``name``, one integer per distinct value of the columns ``by``, and ``total``, the sum of ``n`` over its rows.

    Values are sorted within hash buckets and named (bucket, rank), so a name depends on the set of values only: a
    lost and repeated task names them alike. Equal values get equal names, unequal ones never do: no hash decides.
    Rows should be combined per value beforehand; here each value's rows meet in one place.
    """
    bucketed = table.withColumn("_bucket", F.pmod(F.xxhash64(*by), F.lit(NAME_BUCKETS)))
    rank = F.dense_rank().over(Window.partitionBy("_bucket").orderBy(*by)).cast("long")
    total = F.sum(n).over(Window.partitionBy("_bucket", *by))  # the rows lie in this order already
    return (
        bucketed.withColumn("name", F.col("_bucket") * F.lit(1 << 40) + rank)
        .withColumn("total", total)
        .drop("_bucket")
    )

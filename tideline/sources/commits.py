"""A log of commits: what readers may see, as one appended row each.

Data is written to folders of its own that are never touched again; a row of the log then points to them. A row is one
small file that appears as a whole, so a reader meets either the state before a commit or the state after it, and a run
that fails earlier leaves nothing but an unnamed folder. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = "seq long, kind string, version string, day date, paths array<string>, note string"


def log_entries(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The commits of a kind, one row each; none before the first commit."""
    try:
        stored = spark.read.schema(LOG_SCHEMA).json(f"{root}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], LOG_SCHEMA)
    return stored.where(F.col("kind") == F.lit(kind))


def commit(
    spark: SparkSession, root: str, kind: str, *, version: str | None = None, day: date | str | None = None,
    paths: list[str] = (), note: str | None = None,
) -> None:
    """Append one commit. Later commits have larger numbers; nothing is changed or removed."""
    last = log_entries(spark, root, kind).agg(F.max("seq")).first()[0]
    at = None if day is None else date.fromisoformat(str(day))
    row = [(0 if last is None else last + 1, kind, version, at, list(paths), note)]
    spark.createDataFrame(row, LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/log")


def newest(entries: DataFrame, *order: str) -> Row | None:
    """The entry that comes last by ``order``, then by number."""
    found = entries.orderBy(*[F.col(c).desc() for c in (*order, "seq")]).limit(1).collect()
    return found[0] if found else None


def fresh_folder(root: str, label: str) -> str:
    return f"{root}/{label}/{uuid.uuid4().hex}"


# --- published predictions -------------------------------------------------------------------------------------------


def publish_run(predictions: DataFrame, root: str, as_of: date | str) -> None:
    """Publish the day's predictions: archive entry and, unless a later day was published, snapshot, in one commit.

    A repeated run, also one without rows, takes the place of the day's former run.
    """
    path = fresh_folder(root, f"runs/day={as_of}")
    predictions.write.option("compression", "zstd").parquet(path)
    commit(predictions.sparkSession, root, "publish", day=as_of, paths=[path])


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """The predictions of the latest published day; no rows before the first commit."""
    last = newest(log_entries(spark, root, "publish"), "day")
    return spark.createDataFrame([], schema) if last is None else spark.read.schema(schema).parquet(*last.paths)


def read_archive(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """The predictions of every published day, each from its newest run."""
    runs = log_entries(spark, root, "publish").groupBy("day").agg(F.max(F.struct("seq", "paths")).alias("last"))
    paths = [p for r in runs.orderBy("day").collect() for p in r.last.paths]  # one a day
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

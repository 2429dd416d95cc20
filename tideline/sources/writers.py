"""Tables to files: repeatable writes that never touch their own input."""

from __future__ import annotations

import re
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.schema import STATE_COLUMNS, STATE_SCHEMA

VERSIONED_STATE = T.StructType([*STATE_SCHEMA.fields, T.StructField("version", T.StringType())])


def write_table(
    table: DataFrame, path: str, *, mode: str = "errorifexists", partition_by: tuple[str, ...] = (), codec: str = "zstd"
) -> None:
    """Parquet; ZSTD unless another codec is asked for."""
    writer = table.write.mode(mode).option("compression", codec)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def publish_snapshot(predictions: DataFrame, root: str, as_of: date | str) -> None:
    """Add the day's predictions to the archive, then make them the snapshot.

    ``archive/day=YYYY-MM-DD`` is replaced as a whole partition, also by a run without rows, so a repeated run leaves the same
    files; ``predictions`` are those of ``as_of`` alone. The snapshot is copied from the archived files: the plan runs
    once, and both hold the same rows. A day before the snapshot's goes to the archive alone: the snapshot never turns
    back. Both are replaced in place; :func:`tideline.sources.commits.publish_run` leaves readers a whole table at all times.
    """
    spark = predictions.sparkSession
    write_table(predictions.drop("day"), f"{root}/archive/day={date.fromisoformat(str(as_of))}", mode="overwrite")
    shown = snapshot_day(spark, root)
    if shown is not None and shown > date.fromisoformat(str(as_of)):
        return
    archived = spark.read.schema(predictions.schema).parquet(f"{root}/archive")
    today = archived.where(F.col("day") == F.lit(str(as_of)).cast("date")).select(*predictions.columns)
    write_table(today, f"{root}/latest", mode="overwrite")


def snapshot_day(spark: SparkSession, root: str) -> date | None:
    """The day of the current snapshot; None if there is none yet or it is empty."""
    try:
        shown = spark.read.schema("day date").parquet(f"{root}/latest")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return shown.agg(F.max("day").alias("day")).first().day


def write_state(state: DataFrame, root: str, version: str) -> None:
    """Write the state as a version of its own; a repeated run replaces only that version."""
    write_table(state.select(*STATE_COLUMNS), f"{root}/state/version={version}", mode="overwrite")


def read_state(spark: SparkSession, root: str, *, before: str) -> DataFrame:
    """The newest version that sorts before ``before``: a repeated run starts from the same state as the first."""
    stored = spark.read.schema(VERSIONED_STATE).parquet(f"{root}/state")
    versions = {m[1] for m in (re.search(r"/version=([^/]+)/", f) for f in stored.inputFiles()) if m}  # empty ones too
    earlier = [v for v in versions if v < before]
    if not earlier:
        raise ValueError(f"no state version before {before} in {root}")
    return stored.where(F.col("version") == F.lit(max(earlier))).drop("version")

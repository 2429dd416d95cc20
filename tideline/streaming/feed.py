"""The daily run as a stream over landed feed files.

The engine's work is a daily batch; the stream only decides when it runs. Every micro-batch is cut into one run per feed
day, in order, and every run is :func:`tideline.plans.forecast.run_day` with the state version before it. What a batch depends
on besides its files (the last day that is believed) is written down when it is first run, so a batch that is replayed
after a failure, also on another day, reads the same and leaves the same files.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.readings import HIGH, LOW, plausible
from tideline.operators.state import late_readings
from tideline.plans.forecast import Publisher, Scorer, run_day
from tideline.schema import READING_SCHEMA
from tideline.sources.commits import commit, log_entries, newest
from tideline.sources.writers import publish_snapshot, read_state, write_state, write_table


def version_of(batch_id: int, run: int | None = None) -> str:
    """Batch and run numbers as text that sorts like numbers; the initial state sorts before them."""
    return f"b{batch_id:012d}" + ("" if run is None else f"-{run:06d}")


def start_state(spark: SparkSession, root: str, state: DataFrame) -> None:
    """Write the state the first batch starts from."""
    write_state(state, root, "a")


def last_believed_day(spark: SparkSession, root: str, version: str, today: Callable[[], date]) -> date:
    """The last day of which a batch believes readings: ``today`` when the batch was first run."""
    told = newest(log_entries(spark, root, "batch").where(F.col("version") == F.lit(version)))
    if told is not None:
        return told.day
    believed = today()
    commit(spark, root, "batch", version=version, day=believed)
    return believed


def feed_days(batch: DataFrame, file: str, *, low: float, high: float, not_after: date) -> list[tuple[date, list[str]]]:
    """(day, files) of a batch, ascending: the day of a file is the latest one among its plausible readings."""
    day = F.to_date("observed_at")
    known = plausible(batch, low, high).where(day <= F.lit(not_after))
    per_file = known.groupBy(file).agg(F.max(day).alias("day")).collect()  # one row a landed file
    days: dict[date, list[str]] = {}
    for row in per_file:
        days.setdefault(row.day, []).append(row[file])
    return sorted(days.items())


def stream_feed(
    spark: SparkSession,
    landing: str,
    root: str,
    *,
    calendar: Callable[[date], DataFrame],
    scorer: Scorer,
    files_per_run: int = 1,
    scale: int = 1000,
    low: float = LOW,
    high: float = HIGH,
    not_after: date | None = None,
    today: Callable[[], date] = date.today,
    publish: Publisher = publish_snapshot,
) -> StreamingQuery:
    """Process every feed file in ``landing`` that was not processed yet, oldest first, then stop.

    ``calendar`` gives the calendar of a day. The day of a file is the latest one among its plausible readings; files of one
    day make one run, and the runs of a batch go in order of their days, each with a state version of its own, so the
    archive does not depend on ``files_per_run``. Days after ``not_after`` are not believed; unless given, it is ``today()``
    when the batch is first run. A late file changes the state, not the snapshot. Readings older than all that the state
    holds of their key change nothing; they are kept in ``late/run=..`` for whoever wants to look.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        believed = not_after or last_believed_day(spark, root, version_of(batch_id), today)
        for number, (as_of, files) in enumerate(feed_days(batch, "_file", low=low, high=high, not_after=believed)):
            version = version_of(batch_id, number)
            feed = batch.where(F.col("_file").isin(files)).drop("_file")
            state = read_state(spark, root, before=version)
            known = plausible(feed, low, high).where(F.to_date("observed_at") <= F.lit(as_of))
            write_table(late_readings(state, known), f"{root}/late/run={version}", mode="overwrite")
            run_day(
                state, feed, calendar(as_of), scorer, root=root, as_of=as_of, version=version, scale=scale, low=low, high=high,
                publish=publish,
            )

    return (
        spark.readStream.schema(READING_SCHEMA)
        .option("maxFilesPerTrigger", files_per_run)
        .parquet(landing)
        .select("*", F.col("_metadata.file_path").alias("_file"))
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )

"""Daily runs one after the other, as batches and as a stream."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from helpers import d, empty_days, plain_calendar, reading, readings
from tideline.operators.calendar import daily_calendar
from tideline.operators.state import feed_to_state
from tideline.plans.forecast import run_day
from tideline.schema import READING_SCHEMA, STATE_SCHEMA
from tideline.sources.commits import publish_run, read_archive, read_snapshot
from tideline.sources.writers import read_state, write_state
from tideline.streaming.feed import last_believed_day, start_state, stream_feed, version_of

FEEDS = {
    "2024-03-01": [reading("s", "2024-03-01 06:00:00", 1.5), reading("t", "2024-02-20 06:00:00", 1.9)],
    "2024-03-02": [reading("s", "2024-03-02 06:00:00", 1.6), reading("t", "2024-02-20 06:00:00", 1.9)],
    "2024-03-03": [reading("s", "2024-03-02 06:00:00", 1.6), reading("t", "2024-03-03 06:00:00", 1.8)],
}
def scorer(panel):
    return panel.withColumn("raw_delta", F.lit(0.003))



def calendar(spark, day):
    return plain_calendar(spark, str(day), str(day), ref=[("2024-02-25", 80.0)])


def snapshot(spark, root):
    rows = spark.read.parquet(f"{root}/latest").collect()
    return {r.entity: (str(r.day), r.price, r.predicted_price) for r in rows}


EXPECTED = {"s": ("2024-03-03", 1.6, 1.603), "t": ("2024-03-03", 1.8, 1.803)}


def test_three_days_with_a_repeat(spark, tmp_path):
    root = str(tmp_path)
    write_state(spark.createDataFrame([], STATE_SCHEMA), root, "2024-02-29")
    for day in ("2024-03-01", "2024-03-02", "2024-03-02", "2024-03-03"):
        state = read_state(spark, root, before=day)
        run_day(state, readings(spark, FEEDS[day]), calendar(spark, day), scorer, root=root, as_of=day)
    assert snapshot(spark, root) == EXPECTED
    state = read_state(spark, root, before="2024-03-04")
    assert sorted((r.entity, str(r.day)) for r in state.collect()) == [
        ("s", "2024-03-01"), ("s", "2024-03-02"), ("t", "2024-02-20"), ("t", "2024-03-03"),
    ]
    days = {str(r.day) for r in spark.read.parquet(f"{root}/archive").select("day").distinct().collect()}
    assert days == {"2024-03-01", "2024-03-02", "2024-03-03"}


def landed(spark, landing, feeds):
    """Each feed as one file, oldest first."""
    for i, rows in enumerate(feeds):
        readings(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        for name in os.listdir(landing):
            if name.endswith(".parquet") and not os.path.exists(f"{landing}/.{name}.seen"):
                os.utime(f"{landing}/{name}", (time.time() - 1000 + 100 * i,) * 2)
                open(f"{landing}/.{name}.seen", "w").close()


@pytest.mark.parametrize("files", [1, 2, 3])
def test_archive_does_not_depend_on_files_per_run(spark, tmp_path, files):
    root, landing = str(tmp_path / "root"), str(tmp_path / "landing")
    start_state(spark, root, spark.createDataFrame([], STATE_SCHEMA))
    late = reading("s", "2024-02-01 06:00:00", 1.2)
    landed(spark, landing, [*list(FEEDS.values())[:2], [*FEEDS["2024-03-03"], late]])
    query = stream_feed(spark, landing, root, calendar=lambda day: calendar(spark, day), scorer=scorer, files_per_run=files)
    query.awaitTermination(300)
    assert query.exception() is None
    archive = spark.read.parquet(f"{root}/archive").select("entity", "day", "price", "predicted_price")
    assert sorted((r.entity, str(r.day), r.price, r.predicted_price) for r in archive.collect()) == [
        ("s", "2024-03-02", 1.6, 1.603), ("s", "2024-03-03", 1.6, 1.603),  # the first day of a series has no previous price
        ("t", "2024-03-01", 1.9, 1.903), ("t", "2024-03-02", 1.9, 1.903), ("t", "2024-03-03", 1.8, 1.803),
    ]
    assert snapshot(spark, root) == EXPECTED
    found = spark.read.schema(READING_SCHEMA).parquet(f"{root}/late").collect()
    assert [(r.entity, r.price) for r in found] == [("s", 1.2)]


def test_a_replay_on_another_day_believes_the_same(spark, tmp_path):
    root = str(tmp_path)
    first = last_believed_day(spark, root, version_of(7), lambda: d("2024-03-01"))
    again = last_believed_day(spark, root, version_of(7), lambda: d("2024-03-02"))
    later = last_believed_day(spark, root, version_of(8), lambda: d("2024-03-02"))
    assert (str(first), str(again), str(later)) == ("2024-03-01", "2024-03-01", "2024-03-02")


def test_stream_published_by_commit(spark, tmp_path):
    root, landing = str(tmp_path / "root"), str(tmp_path / "landing")
    start_state(spark, root, spark.createDataFrame([], STATE_SCHEMA))
    landed(spark, landing, FEEDS.values())
    stream_feed(
        spark, landing, root, calendar=lambda day: calendar(spark, day), scorer=scorer, files_per_run=2, publish=publish_run
    ).awaitTermination(300)
    shown = read_snapshot(spark, root, "entity string, day date, price double, predicted_price double").collect()
    assert {r.entity: (str(r.day), r.price, r.predicted_price) for r in shown} == EXPECTED
    assert read_archive(spark, root, "day date").distinct().count() == 3


def test_stream_gives_the_same(spark, tmp_path):
    root, landing = str(tmp_path / "root"), str(tmp_path / "landing")
    start_state(spark, root, spark.createDataFrame([], STATE_SCHEMA))
    for i, rows in enumerate(FEEDS.values()):
        readings(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        for name in os.listdir(landing):  # oldest first
            if name.endswith(".parquet") and not os.path.exists(f"{landing}/.{name}.seen"):
                os.utime(f"{landing}/{name}", (time.time() - 1000 + 100 * i,) * 2)
                open(f"{landing}/.{name}.seen", "w").close()
    query = stream_feed(spark, landing, root, calendar=lambda day: calendar(spark, day), scorer=scorer)
    query.awaitTermination(300)
    assert query.exception() is None and not query.isActive
    assert snapshot(spark, root) == EXPECTED
    assert read_state(spark, root, before="c").count() == 4


def test_implausible_readings_are_never_published(spark, tmp_path):
    root = str(tmp_path)
    write_state(spark.createDataFrame([], STATE_SCHEMA), root, "2024-02-29")
    feed = [
        reading("s", "2024-02-29 06:00:00", 1.5), reading("s", "2024-03-01 06:00:00", 99.0), reading("s", None, 1.7),
        reading("s", "2099-01-01 06:00:00", 1.8), reading("t", None, 1.9),
    ]
    state = read_state(spark, root, before="2024-03-01")
    run_day(state, readings(spark, feed), calendar(spark, "2024-03-01"), scorer, root=root, as_of="2024-03-01")
    assert snapshot(spark, root) == {"s": ("2024-03-01", 1.5, 1.503)}
    left = read_state(spark, root, before="2024-03-02").collect()
    assert [(r.entity, str(r.day)) for r in left] == [("s", "2024-02-29")]


def test_late_file_and_missing_state(spark, tmp_path):
    root = str(tmp_path)
    write_state(spark.createDataFrame([], STATE_SCHEMA), root, "a")
    with pytest.raises(ValueError, match="no state version"):
        read_state(spark, root, before="a")
    for version, day in (("b1", "2024-03-02"), ("b2", "2024-03-01")):
        state = read_state(spark, root, before=version)
        run_day(state, readings(spark, FEEDS[day]), calendar(spark, day), scorer, root=root, as_of=day, version=version)
        assert {r[0] for r in snapshot(spark, root).values()} == {"2024-03-02"}


def test_stream_does_not_believe_the_future(spark, tmp_path):
    root, landing = str(tmp_path / "root"), str(tmp_path / "landing")
    start_state(spark, root, spark.createDataFrame([], STATE_SCHEMA))
    rows = [*FEEDS["2024-03-01"], reading("s", "2099-01-01 06:00:00", 1.8), reading("s", "2024-03-05 06:00:00", 99.0)]
    readings(spark, rows).coalesce(1).write.parquet(landing)
    stream_feed(spark, landing, root, calendar=lambda day: calendar(spark, day), scorer=scorer).awaitTermination(300)
    assert {r[0] for r in snapshot(spark, root).values()} == {"2024-03-01"}


def test_old_quote_is_carried_whatever_the_warm_up(spark):
    quotes = [("2023-01-05", 70.0), ("2023-02-01", 80.0)]
    found = {
        n: daily_calendar(
            spark, "2024-03-01", "2024-03-02", warmup_days=n,
            ref=spark.createDataFrame([(d(x), v) for x, v in quotes], "day date, ref double"),
            holidays=empty_days(spark), breaks=empty_days(spark, ", break_zone_a int, break_zone_b int, break_zone_c int"),
        ).select("day", "ref_lag0", "ref_lag7").collect()
        for n in (10, 366, 500)
    }
    assert found[10] == found[366] == found[500] and found[10][0].ref_lag0 == 80.0

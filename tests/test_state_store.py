"""The bucketed state and the log of commits."""

from __future__ import annotations

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import d, plain_calendar, reading, readings
from tideline.operators.state import feed_to_state, late_readings, roll_state, union_state
from tideline.plans.forecast import run_day_on_store
from tideline.schema import PREDICTION_COLUMNS, STATE_SCHEMA
from tideline.sources import commits, state_store as store


def some_rows(seed, n, first="2024-01-01", days=40, entities=30):
    rng = random.Random(seed)
    start = date.fromisoformat(first)
    return [
        reading(f"s{rng.randrange(entities)}", f"{start + timedelta(rng.randrange(days))} {rng.randrange(24):02d}:00:00",
                round(rng.uniform(1, 2), 3), product=rng.choice(("E10", "E85")))
        for _ in range(n)
    ]


def in_layout(spark, rows):
    return feed_to_state(readings(spark, rows))


def listed(frame):
    return sorted(tuple(r) for r in frame.select(*STATE_SCHEMA.names).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_merging_and_rolling_equal_the_plain_state(spark, tmp_path, seed):
    """Several days one after the other: the rows of union_state and roll_state."""
    root = str(tmp_path)
    plain = in_layout(spark, some_rows(seed, 300))
    version = store.start_store(spark, root, "a", plain, 8)
    assert listed(version.rows()) == listed(plain)
    for number, day in enumerate(("2024-02-08", "2024-02-09", "2024-02-20")):
        feed = in_layout(spark, some_rows(10 * seed + number, 25, first="2024-01-30", days=11, entities=12))
        known = feed.where(F.col("day") <= day)
        merged = version.merged(known, day)
        plain = spark.createDataFrame(listed(union_state(plain, known)), STATE_SCHEMA)
        assert listed(store.by_day(merged, "merged")) == listed(plain)
        plain = spark.createDataFrame(listed(roll_state(plain, day)), STATE_SCHEMA)
        version = store.write_store(version, merged, root, f"b{number}")
        assert listed(store.read_store(spark, root).rows()) == listed(plain)
        assert listed(store.read_store(spark, root, before=f"b{number}z").rows()) == listed(plain)
    with pytest.raises(ValueError, match="no state version"):
        store.read_store(spark, root, before="a")


def test_only_changed_buckets_are_written(spark, tmp_path):
    root = str(tmp_path)
    first = store.start_store(spark, root, "a", in_layout(spark, some_rows(3, 400, days=3)), 16)
    key = first.rows().select("entity", "product").first()
    (bucket,) = first.rows().where((F.col("entity") == key.entity) & (F.col("product") == key.product)).select(
        store.bucket_of(16).alias("b")).distinct().collect()
    feed = in_layout(spark, [reading(key.entity, "2024-01-05 08:00:00", 1.111, product=key.product)])
    second = store.write_store(first, first.merged(feed, "2024-01-05"), root, "b")
    assert [i for i in range(16) if first.folders[i] != second.folders[i]] == [bucket.b]
    assert second.rows().count() == first.rows().count() + 1
    again = store.write_store(second, second.merged(feed, "2024-01-05"), root, "c")
    assert again.folders == second.folders  # nothing new: nothing written
    written = spark.read.parquet(second.folders[bucket.b]).select(store.bucket_of(16).alias("b")).distinct().collect()
    assert [r.b for r in written] == [bucket.b]


def test_a_version_lies_in_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "MOST_FOLDERS", 2)
    root = str(tmp_path)
    version = store.start_store(spark, root, "a", in_layout(spark, some_rows(4, 200, days=3)), 8)
    want = version.rows()
    for number in range(5):
        row = [reading(f"new{number}", "2024-01-03 08:00:00", 1.5)]
        feed = in_layout(spark, row)
        want = want.unionByName(feed)
        version = store.write_store(version, version.merged(feed, "2024-01-03"), root, f"b{number}")
        assert len(set(version.folders)) <= 2
    assert listed(version.rows()) == listed(want)


def test_the_state_is_not_shuffled(spark, tmp_path):
    """Also when its buckets lie in two folders: only the feed moves, and nothing of the state is sorted."""
    root = str(tmp_path)
    version = store.start_store(spark, root, "a", in_layout(spark, some_rows(5, 300)), 8)
    feed = in_layout(spark, some_rows(6, 3, days=40))
    version = store.write_store(version, version.merged(feed, "2024-01-20"), root, "b")
    in_layout(spark, some_rows(8, 200)).write.parquet(f"{root}/feed")
    merged = version.merged(spark.read.parquet(f"{root}/feed"), "2024-01-21")
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Bucketed: true") == len(set(version.folders)) == 2 and "Window" not in plan
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
    for at, line in enumerate(lines):
        if "Exchange" in line or "Sort [" in line:
            below = next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))
            assert not any("Bucketed" in x for x in lines[at:below])


def test_keys_with_nulls_and_empty_sides(spark, tmp_path):
    root = str(tmp_path)
    none = spark.createDataFrame([], STATE_SCHEMA)
    version = store.start_store(spark, root, "a", none, 4)
    assert version.rows().count() == 0
    feed = in_layout(spark, [reading(None, "2024-01-05 08:00:00", 1.1), reading("s", "2024-01-05 08:00:00", 1.2)])
    version = store.write_store(version, version.merged(feed, "2024-01-05"), root, "b")
    assert [r.entity for r in version.rows().collect()] == ["s"]
    version = store.write_store(version, version.merged(none, "2024-06-05"), root, "c")
    assert [r.entity for r in version.rows().collect()] == ["s"]  # a key's last reading is never dropped


def predictions(spark, day, prices):
    return spark.createDataFrame([(f"s{i}", d(day), p) for i, p in enumerate(prices)], "entity string, day date, price double")


SHOWN = "entity string, day date, price double"


def seen(frame):
    return sorted((r.entity, str(r.day), r.price) for r in frame.collect())


def test_publishing_by_commit(spark, tmp_path):
    root = str(tmp_path)
    assert commits.read_snapshot(spark, root, SHOWN).count() == 0 == commits.read_archive(spark, root, SHOWN).count()
    for day, prices in (("2025-01-02", [1.5, 1.6]), ("2025-01-03", [1.7]), ("2025-01-03", [1.8])):
        commits.publish_run(predictions(spark, day, prices), root, day)
    assert seen(commits.read_snapshot(spark, root, SHOWN)) == [("s0", "2025-01-03", 1.8)]
    commits.publish_run(predictions(spark, "2025-01-01", [1.1]), root, "2025-01-01")  # late: archive alone
    commits.publish_run(predictions(spark, "2025-01-02", []), root, "2025-01-02")  # a day without rows replaces the day
    assert seen(commits.read_snapshot(spark, root, SHOWN)) == [("s0", "2025-01-03", 1.8)]
    assert seen(commits.read_archive(spark, root, SHOWN)) == [("s0", "2025-01-01", 1.1), ("s0", "2025-01-03", 1.8)]
    commits.publish_run(predictions(spark, "2025-01-04", []), root, "2025-01-04")
    assert seen(commits.read_snapshot(spark, root, SHOWN)) == []


def test_a_failed_run_leaves_the_old_snapshot(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    commits.publish_run(predictions(spark, "2025-01-02", [1.5]), root, "2025-01-02")
    reader = commits.read_snapshot(spark, root, SHOWN)
    broken = predictions(spark, "2025-01-03", [1.7]).withColumn("price", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        commits.publish_run(broken, root, "2025-01-03")

    def fails(*args, **how):
        raise OSError("no commit")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "commit", fails)
        with pytest.raises(OSError, match="no commit"):
            commits.publish_run(predictions(spark, "2025-01-03", [1.7]), root, "2025-01-03")
    assert seen(commits.read_snapshot(spark, root, SHOWN)) == [("s0", "2025-01-02", 1.5)]
    commits.publish_run(predictions(spark, "2025-01-03", [1.9]), root, "2025-01-03")
    assert seen(reader) == [("s0", "2025-01-02", 1.5)]  # who has begun to read goes on with the same files
    assert seen(commits.read_snapshot(spark, root, SHOWN)) == [("s0", "2025-01-03", 1.9)]


def test_days_on_the_store(spark, tmp_path):
    root = str(tmp_path)
    version = store.start_store(spark, root, "2024-02-29", spark.createDataFrame([], STATE_SCHEMA), 4)
    days = {
        "2024-03-01": [reading("s", "2024-03-01 06:00:00", 1.5), reading("t", "2024-02-20 06:00:00", 1.9)],
        "2024-03-02": [reading("s", "2024-03-02 06:00:00", 1.6), reading("u", "2024-03-02 06:00:00", 99.0)],
        "2024-03-03": [reading("t", "2024-03-03 06:00:00", 1.8), reading("t", "2024-03-09 06:00:00", 1.1)],
    }
    for day in ("2024-03-01", "2024-03-02", "2024-03-02", "2024-03-03"):
        base = store.read_store(spark, root, before=day)
        version = run_day_on_store(
            base, readings(spark, days[day]), plain_calendar(spark, day, day, ref=[("2024-02-25", 80.0)]),
            lambda panel: panel.withColumn("raw_delta", F.lit(0.003)), root=root, as_of=day,
        )
    schema = ", ".join(f"{c} {'date' if c == 'day' else 'double' if 'price' in c else 'string'}" for c in PREDICTION_COLUMNS if c in (
        "entity", "day", "price", "predicted_price"))
    shown = commits.read_snapshot(spark, root, schema).collect()
    assert sorted((r.entity, str(r.day), r.price, r.predicted_price) for r in shown) == [
        ("s", "2024-03-03", 1.6, 1.603), ("t", "2024-03-03", 1.8, 1.803)
    ]
    assert sorted((r.entity, str(r.day)) for r in version.rows().collect()) == [
        ("s", "2024-03-01"), ("s", "2024-03-02"), ("t", "2024-02-20"), ("t", "2024-03-03"),
    ]
    archived = commits.read_archive(spark, root, schema)
    assert {str(r.day) for r in archived.select("day").distinct().collect()} == set(days)


def test_late_readings(spark):
    state = in_layout(spark, [reading("s", "2024-01-10 08:00:00", 1.5), reading("s", "2024-01-20 08:00:00", 1.6)])
    feed = [reading("s", "2024-01-09 08:00:00", 1.1), reading("s", "2024-01-10 08:00:00", 1.5), reading("new", "2020-01-01 08:00:00", 1.2)]
    assert [(r.entity, r.price) for r in late_readings(state, readings(spark, feed)).collect()] == [("s", 1.1)]


def test_scratch_is_cleaned(spark, tmp_path):
    from tideline.session import fresh_path, scratch, settle

    shared = os.listdir(spark.conf.get("spark.checkpoint.dir"))
    table = spark.range(5).selectExpr("cast(id as string) as entity")
    with scratch(spark):
        outer = settle(table, "outer")
        with pytest.raises(ZeroDivisionError), scratch(spark):
            settle(table, "inner").write.parquet(fresh_path(spark, "more"))
            raise ZeroDivisionError
        assert outer.count() == 5  # an inner scope removes its own folders only
        fresh_path(spark, "never-made")
    assert os.listdir(spark.conf.get("spark.checkpoint.dir")) == shared
    kept = settle(table, "kept")
    assert kept.count() == 5 and len(os.listdir(spark.conf.get("spark.checkpoint.dir"))) == len(shared) + 1


def test_a_day_leaves_no_scratch(spark, tmp_path):
    shared = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    version = store.start_store(spark, str(tmp_path), "a", spark.createDataFrame([], STATE_SCHEMA), 4)
    run_day_on_store(
        version, readings(spark, [reading("s", "2024-03-01 06:00:00", 1.5)]), plain_calendar(spark, "2024-03-01", "2024-03-01"),
        lambda panel: panel.withColumn("raw_delta", F.lit(0.003)), root=str(tmp_path), as_of="2024-03-01",
    )
    assert set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) == shared

"""Shape of the physical plans."""

from __future__ import annotations

import re

import pytest

from tideline.plans.panel import training_panel
from workload import standins as st
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def final_plan(frame) -> str:
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture
def no_auto_broadcast(spark):
    """Plan as if every table were large; only explicit, size-checked broadcasts remain."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval|BatchEvalPython|InPandas", plan)


def test_panel_shuffles(spark, no_auto_broadcast):
    """Readings are shuffled by key and day, then by key; both are reused by the peer means; rows are not shuffled."""
    panel = training_panel(
        st.readings(spark, SF_DIR), st.calendar(spark, SF_DIR),
        start=st.START, end=st.END, tie_break=st.TIE, scale=st.SCALE, peer_groups=10,
    )
    plan = final_plan(panel)
    top = plan.split("BroadcastExchange")[0]
    assert plan.count("ReusedExchange") == 2
    assert top.count("Exchange hashpartitioning") <= 4  # dedup, key, entity variants, entities
    assert "SinglePartition" not in top
    assert top.count("SortMergeJoin") == 1


def test_panel_reads_only_needed_columns(spark):
    plan = final_plan(st.daily(spark, SF_DIR))
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "props" not in scan
    assert "PushedFilters: [IsNotNull(value)" in plan


def test_daily_reduction_sorts_no_readings(spark):
    """Hash aggregation on both sides of the shuffle."""
    plan = final_plan(st.daily(spark, SF_DIR))
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan and "Sort [" not in plan


def test_packed_order_equals_the_order_of_structs(spark):
    from pyspark.sql import functions as F

    from tideline.operators.readings import last_per_day

    rows = spark.range(4000).selectExpr(
        "cast(id % 7 as string) as entity", "cast(id % 2 as string) as product",
        "if(id % 97 = 0, null, timestampadd(MICROSECOND, pmod(xxhash64(id), 40) * 21600000001, timestamp_ntz'2024-03-30 21:00:00')) as observed_at",
        "if(id % 41 = 0, null, if(id % 2 = 0, 1L, -1L) * (9223372036854775807 - id)) as reading_id", "double(id) as price",
    )
    plain = rows.groupBy("entity", "product", F.to_date("observed_at").alias("day")).agg(
        F.max(F.struct("observed_at", "reading_id")).alias("best")
    )
    found = last_per_day(rows, keep=("price",), tie_break=("reading_id",), unique_tie=True)
    met = found.join(rows.select("price", "observed_at", "reading_id"), "price").select(
        "entity", "product", "day", F.struct("observed_at", "reading_id").alias("best")
    )
    assert met.exceptAll(plain).count() == 0 == plain.exceptAll(met).count()


def test_daily_reduction_is_combined_before_the_shuffle(spark):
    plan = final_plan(st.daily(spark, SF_DIR))
    assert "partial_max" in plan.split("Exchange hashpartitioning")[1]


def test_latest_day_uses_a_scalar_subquery(spark):
    plan = final_plan(QUERIES["latest_day"](spark, SF_DIR))
    assert "Subquery" in plan and "Join" not in plan.split("Subquery")[0]


def test_radius_search_pushes_the_latitude_bound(spark, tmp_path):
    from tideline.operators.geo import within_radius

    spark.range(10).selectExpr("cast(id as string) entity", "'E10' product", "id * 9.0D latitude", "2.0D longitude").write.parquet(
        str(tmp_path / "s")
    )
    plan = final_plan(within_radius(spark.read.parquet(str(tmp_path / "s")), 45.0, 2.0, 1000.0, product="E10"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(latitude", plan)


@pytest.mark.parametrize("name", ["segment_report", "classification_report", "predicted_price"])
def test_reports_read_the_events_once(spark, name):
    plan = final_plan(QUERIES[name](spark, SF_DIR))
    assert plan.count("Location:") == 1 and "Join" not in plan


def test_rows_are_expanded_once(spark):
    """The peer totals come from interval ends: the only generator of days over keys is the one of the rows."""
    plan = final_plan(QUERIES["feature_panel"](spark, SF_DIR))
    generated = re.findall(r"Generate (?:explode|inline)\(([^\n]*)", plan)
    assert sum("entity" in g for g in generated) == 1


def test_slices_follow_the_partitions(spark):
    """Fifty groups of equal size: none holds much, but all exceed a quarter of an average task and are cut."""
    from tideline.operators.skew import SLICES_PER_PARTITION, heavy_groups, sliced_join

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        rows = spark.range(50_000).selectExpr("id % 50 as g", "id as entity")
        counts = rows.groupBy("g").count()
        heavy = heavy_groups(counts, ["g"], "count", min_rows=1)
        assert {r._slices for r in heavy.collect()} == {8}  # 1000 rows, at most 50000 / 400 in a slice
        assert heavy.count() <= 100 * SLICES_PER_PARTITION
        joined = sliced_join(rows, counts, ["g"], heavy_left=heavy, spread_left=["entity"])
        plain = rows.join(counts, "g")
        assert joined.count() == 50_000
        assert joined.exceptAll(plain.select(*joined.columns)).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)

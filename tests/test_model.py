"""Training and scoring."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import plain_calendar
from tideline.functions import dead_band
from tideline.operators import metrics
from tideline.plans import model as md
from tideline.plans.forecast import daily_forecast
from tideline.plans.panel import training_panel
from tideline.schema import CATEGORICAL_FEATURES, FLAG_FEATURES, NUMERIC_FEATURES, PREDICTION_COLUMNS, STATE_COLUMNS


@pytest.fixture(scope="module")
def learnable(spark):
    """Prices that rise every Monday and fall every Thursday, by two cents."""
    rows = spark.range(60 * 120).selectExpr(
        "cast(id % 60 as string) as entity", "'E10' as product",
        "cast(date_add(date'2024-01-01', cast(id div 60 as int)) as timestamp_ntz) + interval 8 hours as observed_at",
        "if(weekday(date_add(date'2024-01-01', cast(id div 60 as int))) < 3, 1.72D, 1.70D) + (id % 60) / 1000.0D as price",
        "46.0D as latitude", "2.0D as longitude", "concat(69 + id % 3, '300') as postal_code",
        "if(id % 10 = 0, 'A', 'R') as road_type", "'Lyon' as city", "'1 rue A' as address",
    )
    calendar = plain_calendar(spark, "2024-01-01", "2024-05-31", ref=[("2024-02-01", 80.0)])
    panel = training_panel(rows, calendar, start="2024-01-01", end="2024-05-31").cache()
    yield panel
    panel.unpersist()


@pytest.fixture(scope="module")
def fitted(learnable):
    return md.fit_price_change(learnable.where("day < '2024-04-01'"), trees=8, rate=0.4, depth=4)


def test_eighteen_features():
    assert len(CATEGORICAL_FEATURES + NUMERIC_FEATURES + FLAG_FEATURES) == 18


def test_beats_naive_on_unseen_days(learnable, fitted):
    scored = md.score(fitted, learnable.where("day >= '2024-04-01'")).withColumn("delta", dead_band(F.col("raw_delta")))
    result = metrics.model_mae(scored).first()
    assert result.model_mae < 0.2 * result.naive_mae
    report = {r.label: r for r in metrics.classification_report(scored).collect()}
    assert report["up"].recall == 1.0 and report["down"].recall == 1.0


def test_saved_model_scores_the_same(spark, learnable, fitted, tmp_path):
    md.save_model(fitted, str(tmp_path / "m"))
    again = md.load_model(str(tmp_path / "m"))
    rows = learnable.where("day >= '2024-04-25'")
    assert md.score(fitted, rows).exceptAll(md.score(again, rows)).count() == 0


def test_unseen_category_and_missing_values(learnable, fitted):
    odd = learnable.limit(3).withColumns(
        {"product": F.lit("new"), "area": F.lit(None).cast("string"), "ref_lag0": F.lit(None).cast("double"),
         "before_holiday": F.lit(None).cast("boolean")}
    )
    assert md.score(fitted, odd).where("raw_delta is null or isnan(raw_delta)").count() == 0


def test_forecast_with_a_fitted_model(spark, learnable, fitted):
    """Sunday prices, model says they rise on Monday... as of the Monday row itself."""
    state = learnable.where("day between '2024-04-08' and '2024-04-15'").select(*STATE_COLUMNS)
    calendar = plain_calendar(spark, "2024-04-15", "2024-04-15", ref=[("2024-04-10", 80.0)])
    found = daily_forecast(state, calendar, md.model_scorer(fitted), as_of="2024-04-15")
    assert tuple(found.columns) == PREDICTION_COLUMNS
    assert found.count() == 60 and found.where("trend = 'up'").count() == 60


def test_settings():
    stage = md.build_pipeline().getStages()[-1]
    assert (stage.getMaxIter(), stage.getStepSize(), stage.getMaxDepth()) == (131, 0.03, 6)
    assert (stage.getMinInstancesPerNode(), stage.getFeatureSubsetStrategy(), stage.getSeed()) == (50, "0.8", 42)


def test_days_held_out_pick_the_number_of_trees(spark, learnable):
    """As many trees as help on days that go on alike, few if those days go the other way."""
    train, valid = learnable.where("day < '2024-04-08'"), learnable.where("day >= '2024-04-08'")
    late = F.col("day") >= "2024-04-01"
    other_way = train.withColumn("price", F.when(late, 2 * F.col("prev_price") - F.col("price")).otherwise(F.col("price")))
    settings = {"validate_from": "2024-04-01", "rate": 0.3, "depth": 4, "trees": 20}
    fitted, reports = md.train_and_evaluate(train, valid, **settings)
    misled, _ = md.train_and_evaluate(other_way, valid, **settings)
    assert 0 < misled.stages[-1].getNumTrees < fitted.stages[-1].getNumTrees <= 20
    error = reports["errors"].first()
    assert error.model_mae < 0.5 * error.naive_mae


def test_held_out_rows_grow_no_trees(spark, learnable):
    train = learnable.where("day < '2024-03-01'").select("entity", "product", "day", "price", *md.FEATURES_OF_PANEL)
    moved = train.withColumn("price", F.when(F.col("day") >= "2024-02-20", F.col("price") + 1).otherwise(F.col("price")))
    models = [md.fit_price_change(t, validate_from="2024-02-20", trees=1, depth=3) for t in (train, moved)]
    first, second = (m.stages[-1].toDebugString.split("\n", 1)[1] for m in models)
    assert first == second

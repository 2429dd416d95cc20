from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_llm import awkward, clashing
from tideline.llm import quality as q

SF = "/root/testdata/sf0.1"


def grades_of(spark):
    return q.criteria_grades(spark.read.parquet(f"{SF}/labels.parquet"))


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return q.fit_on(q.labelled_sample(docs, grades_of(spark).where("doc_id % 4 <> 0")), 3)


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = q.rate(docs, model).join(grades_of(spark).where("doc_id % 4 = 0"), "doc_id").collect()
    good = [r for r in held if r.grade == 2]
    bad = [r for r in held if r.grade < 2]
    assert sum(r.kept for r in good) / len(good) >= 0.98
    assert sum(not r.kept for r in bad) / len(bad) >= 0.65
    assert np.mean([r.expected_grade for r in good]) > np.mean([r.expected_grade for r in bad]) + 0.3


def test_scores_agree_with_features_and_thresholds_ascend(spark, model, tmp_path):
    docs = awkward(spark, tmp_path)
    assert list(model.thresholds) == sorted(model.thresholds)
    found = q.rate(clashing(docs), model).collect()
    expected = []
    for r in docs.collect():
        slots, values = q.features(r.text or "")
        score = float((model.weights[slots].astype(float) * values).sum())
        tails = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        expected.append((r.doc_id, sum(tails), tails[-1]))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for mine, theirs in zip(sorted(map(tuple, found), key=key), sorted(expected, key=key), strict=True):
        assert mine[0] == theirs[0] and mine[1] == pytest.approx(theirs[1], abs=1e-4) and mine[2] == pytest.approx(theirs[2], abs=1e-4)
        assert mine[3] == (mine[2] >= 0.5)
    assert q.rate(docs.where("false"), model).count() == 0


def test_keep_good_keeps_columns(spark, model, tmp_path):
    docs = clashing(awkward(spark, tmp_path))
    kept = q.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == q.rate(docs, model).where("kept").count()


def test_sample_rules(spark, tmp_path):
    docs = awkward(spark, tmp_path)
    ratings = spark.createDataFrame(
        [(5, 2), (5, 1), (1, 0), (None, 1), (2, None), (77, 2), (8, 2)], "doc_id long, grade int"
    )
    rows = q.labelled_sample(docs, ratings).collect()
    assert sorted((r.grade, len(r._text)) for r in rows) == sorted([(1, 1), (0, 0), (2, len(docs.where("doc_id = 8").first().text))])
    assert q.labelled_sample(docs, ratings, sample_rows=2).count() <= 2
    empty = q.fit_on(q.labelled_sample(docs, ratings.where("false")), 3)
    assert q.rate(docs, empty).select("tail_probability").distinct().count() == 1
    one = q.fit_on(q.labelled_sample(docs, ratings.where("grade = 2")), 3)
    assert q.rate(docs, one).count() == docs.count()


def test_gradient_against_differences():
    """One step from zero weights goes down the numerical slope of the ordinal log likelihood."""
    rng = random.Random(1)
    rows = [(rng.randrange(3), np.array([1, 2 + i % 3]), np.array([1.0, 0.5])) for i in range(60)]
    model = q.fit(rows, 3, epochs=30)

    def loss(weights, cuts):
        total = 0.0
        for g, s, v in rows:
            score = (weights[s] * v).sum()
            low = 1 / (1 + math.exp(cuts[g - 1] - score)) if g else 1.0
            high = 1 / (1 + math.exp(cuts[g] - score)) if g < 2 else 0.0
            total -= math.log(max(1e-12, low - high))
        return total

    start = loss(np.zeros(1 << q.FEATURE_BITS), [-0.7, 0.7])
    end = loss(model.weights.astype(float), model.thresholds)
    assert end < start
    for i in (1, 2, 3, 4):
        nudged = model.weights.astype(float).copy()
        nudged[i] += 1e-3
        assert abs(loss(nudged, model.thresholds) - end) < 0.05  # near a stationary point


def test_graded_words_order_documents(spark):
    words = {0: "awful", 1: "fair", 2: "great"}
    rng = random.Random(2)
    rows = []
    for i in range(300):
        g = i % 3
        rows.append((g, *q.features(" ".join([words[g], *(f"w{rng.randrange(500)}" for _ in range(20))]))))
    model = q.fit(rows, 3)
    scores = [q._score(f"{words[g]} w1 w2 w3", model.weights.tolist(), {}) for g in range(3)]
    assert scores[0] < model.thresholds[0] < scores[1] < model.thresholds[1] < scores[2]


def test_null_labels_give_no_grade(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (3, 0, None), (4, 0, 1)], "doc_id long, quality int, toxic int")
    assert [r.grade for r in q.criteria_grades(labels).orderBy("doc_id").collect()] == [2, None, None, 0]
    assert q.criteria_grades(labels).where(F.col("grade").isNull()).count() == 2


def test_fit_is_stable_on_separable_rows():
    """Perfectly separable rows push weights up without end; scores stay finite and ordered."""
    rows = [(g, np.array([g, 5]), np.array([3.0, 1.0])) for g in (0, 1, 2)] * 400
    model = q.fit(rows, 3, epochs=60)
    scores = [3 * model.weights[g] + model.weights[5] for g in range(3)]
    assert np.isfinite(model.weights).all() and scores[0] < model.thresholds[0] < scores[1] < model.thresholds[1] < scores[2]

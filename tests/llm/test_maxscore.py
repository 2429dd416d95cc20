from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests_llm import clashing
from tideline.llm import maxscore as ms

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, queries, k):
    """(row, vector) lists: each query's k best other rows."""
    out = []
    for at, q in queries:
        scored = sorted((-int(q @ v), i, row) for row, (i, v) in enumerate(vectors) if row != at)
        out.append([(i, -s) for s, i, _ in scored[:k]])
    return out


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 90), st.integers(1, 6), st.integers(1, 6), st.sampled_from([1, 3, 300]), st.integers(0, 10**6))
def test_shard_against_all_scores(n, dims, k, size, seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-size, size + 1, (n, dims))
    ids = rng.integers(0, n, n)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ms, "TRAVERSED_AT_ONCE", 16)
        patch.setattr(ms, "PROBED_AT_ONCE", 2)
        shard = ms.Shard(vectors, ids, np.arange(n))
        for at in range(0, n, 7):
            places, scores = shard.best(vectors[at], at, k)
            expected = brute(list(zip(ids.tolist(), vectors, strict=True)), [(at, vectors[at])], k)[0]
            assert [s for _, s in expected] == scores.tolist()
            assert [i for i, _ in expected] == shard.ids[places].tolist()


def test_pruning_leaves_work_undone():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 60, (30, 64))
    vectors = np.floor(centres[rng.integers(0, 30, 4096)] + rng.normal(0, 6, (4096, 64))).astype(np.int64)
    shard, probed = ms.Shard(vectors, np.arange(4096), np.arange(4096)), []
    block = shard._block

    def counted(*given):
        found, scores = block(*given)
        probed.append(len(found))
        return found, scores

    shard._block = counted
    shard.best(vectors[0], 0, 5)
    assert probed[0] == ms.TRAVERSED_AT_ONCE and probed[1] < 200


def stored(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    return spark.read.parquet(f"{folder}/embeddings.parquet")


def result(vectors, **how):
    found = ms.top_k(vectors, is_query=F.col("vec_id") % 50 == 0, k=3, **how)
    return sorted(tuple(r) for r in found.collect())


def test_awkward_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [-inf, 0.0], 1),
        (6, [0.5, -0.25], 1), (6, [0.5, -0.25], 1), (7, [], None), (8, [1.0], 2), (9, [-1.0, 1.0, 5.0], 2), (50, [0.001, 0.0], 3),
        (50, [0.001, 0.0], 3), (100, None, 3), (None, [1.0, 1.0], 3), (150, [], 3),
    ]
    vectors = stored(spark, tmp_path, rows)
    expected = [
        (0, 1, 8, 32768), (0, 2, 6, 20480), (0, 3, 6, 20480),
        (50, 1, 0, 0), (50, 1, 0, 0), (50, 2, 6, 0), (50, 2, 6, 0), (50, 3, 6, 0), (50, 3, 6, 0),
        (150, 1, 0, 0), (150, 2, 6, 0), (150, 3, 6, 0),
    ]
    assert result(vectors) == sorted(expected)
    assert result(vectors, shard_vectors=3, block_queries=1) == sorted(expected)
    assert result(clashing(vectors)) == sorted(expected)
    assert result(vectors.where("false")) == []
    assert result(vectors.where("vec_id = 0")) == []


def test_many_ties_and_shards(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.5]) for _ in range(4)], 0) for i in range(300)]
    vectors = stored(spark, tmp_path, rows)
    quantised = [(i, np.floor(256 * np.array(v)).astype(np.int64)) for i, v, _ in rows]
    queries = [(i, v) for i, v in quantised if i % 50 == 0]
    expected = sorted(
        (q, rank, i, s) for (q, _), found in zip(queries, brute(quantised, queries, 3), strict=True) for rank, (i, s) in enumerate(found, 1)
    )
    assert result(vectors, shard_vectors=40, block_queries=2) == expected


def test_query_blocks_are_never_broadcast(spark, tmp_path):
    """They are as many as queries times shards, which no estimate of the plan sees; the driver would hold them all."""
    rng = np.random.default_rng(3)
    vectors = stored(spark, tmp_path, [(i, rng.normal(0, 1, 8).tolist(), 0) for i in range(400)])
    found = ms.top_k(vectors, is_query=F.col("vec_id") % 50 == 0, k=3, shard_vectors=20, block_queries=2)
    assert found.count() == 24
    plan = found._jdf.queryExecution()
    plan.executedPlan().execute().count()
    final = plan.executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin [s_group" in final and "HashJoin [s_group" not in final


def test_large_components_are_summed_in_integers():
    """Sums beyond 2^53 differ by one; floats would call them equal."""
    vectors = np.array([[1 << 27, 1], [1 << 27, 2], [1 << 27, 3], [5, 5]], np.int64)
    query = np.array([1 << 27, 1], np.int64)
    places, scores = ms.Shard(vectors, np.arange(4), np.arange(4)).best(query, 0, 3)
    assert places.tolist() == [2, 1, 3] and scores.tolist() == [(1 << 54) + 3, (1 << 54) + 2, 5 * (1 << 27) + 5]
    narrow = ms.Shard(np.array([[3, -1], [2, 2]], np.int8), np.arange(2), np.arange(2))
    assert narrow.best(np.array([1, 1], np.int8), -1, 2)[1].tolist() == [4, 2]

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests_llm import SF, awkward, clashing
from tideline.llm import sharding as sd


def test_awkward_rows_sizes_and_slots(spark, tmp_path):
    docs = awkward(spark, tmp_path)
    dealt = sd.shard_rows(clashing(docs), shards=5, partitions=8).collect()
    plain = Counter((r.doc_id, r.text) for r in docs.collect())
    expected = Counter()
    for (doc_id, text), n in plain.items():
        data = (text or "").encode()
        expected[doc_id, len(data) + 16, zlib.crc32(data)] += n
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in dealt) == expected
    slots = defaultdict(list)
    for r in dealt:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, ())) for s in range(5)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(dealt)
    assert sd.shard_rows(docs.where("false"), shards=5, partitions=8).count() == 0


@pytest.mark.parametrize("seed", [0, 5])
def test_whole_table(spark, seed):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dealt = sd.shard_rows(docs, shards=40, seed=seed).collect()
    assert sorted(r.doc_id for r in dealt) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    sizes = Counter(r.shard for r in dealt)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(40)) <= 1
    again = sd.shard_rows(docs, shards=40, seed=seed)
    assert {(r.doc_id, r.shard, r.slot) for r in dealt} == {(r.doc_id, r.shard, r.slot) for r in again.collect()}


def test_matrix_has_exact_margins(spark):
    counts = spark.createDataFrame([(0, 5), (1, 0), (2, 1000), (3, 7), (6, 90)], "part int, n long")
    rows = {r.part: r.ends for r in sd.communication_matrix(counts, shards=7, partitions=8).collect()}
    given = {0: 5, 2: 1000, 3: 7, 6: 90}
    assert {p: e[-1] for p, e in rows.items()} == {p: given.get(p, 0) for p in range(8)}
    cells = [[b - a for a, b in zip([0, *e], e, strict=False)] for e in rows.values()]
    assert all(c >= 0 for row in cells for c in row)
    assert sorted(map(sum, zip(*cells, strict=True))) == sorted(1102 // 7 + (s < 1102 % 7) for s in range(7))


@pytest.mark.parametrize(("total", "marked", "drawn"), [(20, 8, 5), (10, 10, 4), (10, 0, 4), (7, 3, 7), (1, 1, 1), (0, 0, 0), (60, 30, 30)])
def test_hypergeometric_law(spark, total, marked, drawn):
    points = 4000
    u = (F.col("id") + 0.5) / points
    value = sd.hypergeometric(F.lit(total), F.lit(marked), F.lit(drawn), u)
    found = Counter(r.k for r in spark.range(points).select(value.alias("k")).collect())
    for k in range(drawn + 1):
        chance = math.comb(marked, k) * math.comb(total - marked, drawn - k) / math.comb(total, drawn)
        assert abs(found[k] - points * chance) <= 1.01


def test_large_draws_follow_mean_and_spread(spark):
    value = sd.hypergeometric(F.lit(10**6), F.lit(25_000), F.lit(500_000), (F.col("id") + 0.5) / 400)
    drawn = [r.k for r in spark.range(400).select(value.alias("k")).collect()]
    assert drawn == sorted(drawn)
    mean = sum(drawn) / 400
    spread = math.sqrt(sum((x - mean) ** 2 for x in drawn) / 400)
    assert abs(mean - 12_500) < 0.5 and abs(spread - math.sqrt(500_000 * 0.025 * 0.975 * 0.5)) < 0.5


def test_every_split_of_rows_is_possible(spark):
    """Over some seeds every one of 3 rows stands in each of 2 shards."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 3").select("doc_id", "text")
    seen = Counter()
    for seed in range(6):
        for r in sd.shard_rows(docs, shards=2, partitions=2, seed=seed).collect():
            seen[r.doc_id, r.shard] += 1
    assert len(seen) == 6

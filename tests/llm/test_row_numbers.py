"""Results do not depend on how a scan is cut, also if that changes between the jobs of an operator."""

from __future__ import annotations

import random
from itertools import cycle

import public_tokenizers
import pytest

from tests_llm import rows_of
from tideline.llm import exact_dedup, line_dedup, packing, simhash

PARALLELISM = "spark.sql.leafNodeDefaultParallelism"
OPEN_COST = "spark.sql.files.openCostInBytes"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
OPERATORS = {
    "exact_groups": (exact_dedup, lambda d: exact_dedup.exact_groups(d).drop("row_number")),
    "drop_copies": (exact_dedup, exact_dedup.drop_copies),
    "near_groups": (simhash, lambda d: simhash.near_groups(d).drop("row_number")),
    "drop_near_copies": (simhash, simhash.drop_near_copies),
    "pack_documents": (packing, lambda d: packing.pack_documents(d, tokenizer=TOKENIZER).select("doc_id", "start", "length", "ids_crc32")),
    "drop_repeated_lines": (line_dedup, lambda d: line_dedup.drop_repeated_lines(d).drop("row_number")),
}


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """One file of many row groups; every third text stands twice."""
    rng = random.Random(3)
    texts = ["\n".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) for _ in range(4)) for _ in range(1_500)]
    texts += texts[::3]
    path = str(tmp_path_factory.mktemp("cut") / "documents.parquet")
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    made.write.option("parquet.block.size", 32_768).parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def cuts(spark):
    spark.conf.set(OPEN_COST, "1024")
    spark.conf.set(PARALLELISM, "12")
    yield
    spark.conf.unset(OPEN_COST)
    spark.conf.unset(PARALLELISM)


def test_parallelism_cuts_the_scan(spark, docs, cuts):
    found = set()
    for n in ("12", "8"):
        spark.conf.set(PARALLELISM, n)
        found.add(docs.select("*").rdd.getNumPartitions())
    assert len(found) == 2


@pytest.mark.parametrize("name", OPERATORS)
def test_same_result_when_parallelism_changes_between_jobs(spark, docs, cuts, monkeypatch, name):
    module, operator = OPERATORS[name]
    expected = rows_of(operator(docs))
    settle, values = module.settle, cycle(["8", "12"])

    def moving(table, label):
        found = settle(table, label)
        spark.conf.set(PARALLELISM, next(values))
        return found

    monkeypatch.setattr(module, "settle", moving)
    for last in ("8", "12"):
        spark.conf.set(PARALLELISM, "12")
        result = operator(docs)
        spark.conf.set(PARALLELISM, last)
        assert rows_of(result) == expected

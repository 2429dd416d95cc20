from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from compare import connect, difference
from test_simhash import brute_components, brute_print
from tests_llm import awkward, clashing
from tideline.llm.oracles import ORACLES
from tideline.llm.queries import QUERIES, quality_model
from tideline.llm import quality

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_every_operator_has_a_query():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "packing"]


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_model(spark, docs, SF)
    good = {r.doc_id for r in quality.rate(docs, model).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    last = {t: d for d, t in sorted(rows)}
    rows = [(d, t) for d, t in rows if last[t] == d]
    roots = brute_components([brute_print(t) for _, t in rows])
    least = {}
    for (d, _), r in zip(rows, roots, strict=True):
        least[r] = min(least.get(r, d), d)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    left = {d: tokenizer.encode(t, add_special_tokens=False).ids + [2] for d, t in rows if d in least.values()}
    pieces = corpus_pipeline.run(spark, SF).collect()
    whole = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        ids = left[p.doc_id][p.start : p.start + p.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == p.ids_crc32
        assert whole.get(p.doc_id, 0) == p.start
        whole[p.doc_id] = p.start + p.length
    assert whole == {d: len(ids) for d, ids in left.items()}


def test_stages_take_awkward_documents(spark, tmp_path):
    docs = clashing(awkward(spark, tmp_path))
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        assert name == "packing" or found.columns == docs.columns
        ids = docs.select("doc_id").distinct().count()
        assert 0 < found.select("doc_id").distinct().count() <= ids  # packing gives several pieces of a long document
        assert stage(spark, docs.where("false"), SF).count() == 0

from __future__ import annotations

import hashlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

from tests_llm import SF, awkward, clashing, documents, rows_of
from tideline.llm import exact_dedup as ed


def brute(rows):
    groups = defaultdict(list)
    for n, (doc_id, text) in enumerate(rows):
        groups[text or ""].append((doc_id is not None, doc_id or 0, -n))
    out = []
    for n, (doc_id, text) in enumerate(rows):
        best = max(groups[text or ""])
        keep = best[1] if best[0] else None
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc_id, keep, len(groups[text or ""]), best[2] == -n, sha))
    return sorted(out, key=repr)


def result(docs, **how):
    return rows_of(ed.exact_groups(docs, **how).select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def test_awkward_rows_and_small_blocks(spark, tmp_path):
    docs = awkward(spark, tmp_path).coalesce(1)
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    expected = [r[:3] + r[4:] for r in brute(plain)]
    for size in (1 << 20, 1024, 7):
        found = result(docs, block_bytes=size)
        assert sorted((r[:3] + r[4:] for r in found), key=repr) == sorted(expected, key=repr)
        assert sum(r[3] for r in found) == len({t or "" for _, t in plain})


def test_texts_that_differ_in_one_place_only(spark, tmp_path):
    base = "".join(chr(97 + i * i % 26) for i in range(400))
    rows = [(i, base[:p] + "!" + base[p + 1 :]) for i, p in enumerate([0, 10, 399, 10, 200, 0])]
    rows += [(9, base), (10, base[::-1]), (11, base + base), (12, base)]
    docs = documents(spark, rows, tmp_path)
    assert result(docs, block_bytes=8) == brute(rows)


def test_repeated_blocks_within_a_text(spark, tmp_path):
    rows = [(1, "ab" * 8), (2, "ab" * 9), (3, "ab" * 8), (4, "ab" * 10), (5, "ba" * 8)]
    assert result(documents(spark, rows, tmp_path), block_bytes=2) == brute(rows)


def test_extra_columns_and_empty_table(spark, tmp_path):
    docs = awkward(spark, tmp_path)
    assert result(clashing(docs)) == result(docs)
    assert result(docs.where("false")) == []


def test_drop_copies_keeps_columns_and_one_row_per_text(spark, tmp_path):
    docs = clashing(awkward(spark, tmp_path))
    left = ed.drop_copies(docs)
    assert left.columns == docs.columns
    texts = [r.text for r in left.collect()]
    assert len(texts) == len(set(t or "" for t in texts)) == docs.select(F.coalesce("text", F.lit(""))).distinct().count()


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs, block_bytes=64) == brute(plain)


def test_chunks_stay_small():
    rows = pa.record_batch(
        [list(range(24)), list(range(24)), ["-"] * 24, [f"{n:07d}".encode() * 150_000 for n in range(24)]],
        names=["_row", "doc_id", "text_sha256", "_text"],
    )
    found = pa.Table.from_batches(ed._chunk_batches(iter([rows]), 1024)).to_pylist()
    held = defaultdict(int)
    for r in found:
        held[r["chunk"]] += len(r["block"] or b"")
    assert len(held) > 2 and max(held.values()) <= 8 << 20
    assert [r["_row"] for r in found if r["_row"] is not None] == list(range(24))


def test_dropping_sorts_no_texts(spark, tmp_path):
    docs = documents(spark, [(1, "a"), (2, "a"), (3, None), (None, "b")], tmp_path)
    left = ed.drop_copies(docs)
    plan = left._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "LeftAnti" in line)
    assert "ShuffledHashJoin" in join and "SortMergeJoin" not in plan.split("LeftAnti")[0]
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == ["2", "3", "None"]

from __future__ import annotations

import heapq
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests_llm import SF, awkward, clashing
from tideline.llm import token_files as tf
from tideline.session import fresh_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def unlimited_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=2, max_size=60))
def test_code_is_optimal_prefix_free_and_canonical(counts):
    counts = np.array(counts)
    lengths = tf.code_lengths(counts, 16)
    used = np.flatnonzero(counts)
    assert (lengths[counts == 0] == 0).all() and (lengths[used] > 0).all()
    if len(used) > 1:
        assert sum(2.0 ** -int(x) for x in lengths[used]) == 1
        assert int((lengths * counts).sum()) == unlimited_cost(counts)
        codes = tf.canonical_codes(lengths)
        words = sorted(format(codes[i], f"0{lengths[i]}b") for i in used)
        assert all(not b.startswith(a) for a, b in zip(words, words[1:], strict=False))
        order = sorted(used, key=lambda i: (lengths[i], i))
        assert [format(codes[i], f"0{lengths[i]}b") for i in order] == sorted(words)


def test_length_limit_binds():
    counts = np.array([2**k for k in range(30)])
    lengths = tf.code_lengths(counts, 6)
    assert lengths.max() == 6 and sum(2.0 ** -int(x) for x in lengths) <= 1
    best = min(  # by exchange: no single step to another complete code is cheaper
        int((np.sort(lengths)[::-1] * np.sort(counts)).sum()), int((lengths * counts).sum())
    )
    assert best == int((lengths * counts).sum())
    with pytest.raises(ValueError):
        tf.code_lengths(np.ones(65), 6)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=1500), st.integers(1, 3))
def test_round_trip(ids, power):
    ids = np.array(ids, np.int64) ** power % 49_408
    counts = np.bincount(ids, minlength=1)
    lengths = tf.code_lengths(counts)
    bits, checkpoints = tf.encode_ids(ids, lengths, tf.canonical_codes(lengths))
    assert tf.decode_ids(bits, checkpoints, len(ids), tf.decoding_table(lengths)).tolist() == ids.tolist()


def test_a_block_decodes_alone():
    ids = np.arange(3000) * 37 % 500
    lengths = tf.code_lengths(np.bincount(ids))
    bits, checkpoints = tf.encode_ids(ids, lengths, tf.canonical_codes(lengths))
    table = tf.decoding_table(lengths)
    assert tf.decode_ids(bits, checkpoints[5:6], 256, table).tolist() == ids[5 * 256 : 6 * 256].tolist()


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc_id, text in rows:
        data = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, len(data), zlib.crc32(data.tobytes())))
    return out


def stored(spark, docs):
    path = fresh_path(spark, "token-test")
    tf.write_token_files(docs, path, tokenizer=PATH)
    return tf.read_token_files(spark, path).collect()


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark, tmp_path)
    found = sorted(stored(spark, clashing(docs)), key=lambda r: r.start)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in found], key=key) == sorted(expected([(r.doc_id, r.text) for r in docs.collect()]), key=key)
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in found:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    assert stored(spark, docs.where("false")) == []


def test_whole_table_in_small_segments(spark, monkeypatch):
    monkeypatch.setattr(tf, "SEGMENT_IDS", 3000)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    found = sorted(stored(spark, docs), key=lambda r: r.start)
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in found] == expected(rows)
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()


@pytest.mark.parametrize("n", [0, 1, tf.RUN_IDS - 1, tf.RUN_IDS, tf.RUN_IDS + 1, 3 * tf.RUN_IDS + 77])
def test_runs_of_ids_leave_no_seam(n):
    """The bits of a long segment are those of its ids' codes in a row, also where one run of ids ends and the next begins."""
    ids = np.random.default_rng(n).zipf(1.3, n).clip(max=3000).astype("<u4")
    lengths = tf.code_lengths(np.bincount(ids, minlength=2))
    bits, checkpoints = tf.encode_ids(ids, lengths, tf.canonical_codes(lengths))
    codes = tf.canonical_codes(lengths)
    row = "".join(format(codes[i], f"0{lengths[i]}b") for i in ids)
    size = (len(row) + 7) // 8
    assert bits[:size] == int(row.ljust(size * 8, "0") or "0", 2).to_bytes(size, "big")
    before = np.concatenate([[0], np.cumsum(lengths[ids], dtype=np.int64)])[:-1] if n else np.zeros(0)
    assert checkpoints.tolist() == before[:: tf.BLOCK_IDS].tolist()
    assert (tf.decode_ids(bits, checkpoints, n, tf.decoding_table(lengths)) == ids).all()


@pytest.mark.parametrize(("end_id", "width"), [(2, 2), ((1 << 16) - 1, 2), (1 << 16, 4), ((1 << 20) + 3, 4)])
def test_staged_ids_are_as_wide_as_they_must_be(end_id, width):
    texts = ["some words, 12 of them", "", "Größe naïve"]
    rows = pa.record_batch([[3, 5, 9], texts], names=["doc_id", "_text"])
    path = public_tokenizers.path("word_bpe_49k.json")
    made = [r for b in tf._staged_batches(iter([rows]), path, end_id) for r in b.to_pylist()]
    segment, told = made
    counts = np.frombuffer(told["counts"], "<i8")
    encode = Tokenizer.from_file(path).encode
    ids = [i for t in texts for i in [*encode(t, add_special_tokens=False).ids, end_id]]
    assert len(segment["ids"]) == width * len(ids) and counts.tolist() == np.bincount(ids).tolist()
    lengths = tf.code_lengths(counts)
    staged = pa.Table.from_pylist([{k: segment[k] for k in ("segment", "doc_ids", "lengths", "ids")} | {"part": 0}])
    (packed,) = [r for b in tf._segment_batches(iter(staged.to_batches()), lengths) for r in b.to_pylist()]
    back = tf.decode_ids(packed["bits"], packed["checkpoints"], packed["n_ids"], tf.decoding_table(lengths))
    assert back.tolist() == ids

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests_llm import SF, awkward, clashing
from tideline.llm import packing as pk, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def checked(pieces, expected, capacity):
    """Every document's ids exactly once, every sequence gapless and not too long; returns the share of padding."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert p.length == len(ids) > 0 and p.ids_crc32 == zlib.crc32(p.ids)
        docs[p.row_number, p.doc_id].append((p.start, ids, p.doc_tokens))
        sequences[p.sequence_id].append((p.offset, p.length))
    found = []
    for (_, doc_id), parts in docs.items():
        whole = []
        for start, ids, total in sorted(parts):
            assert start == len(whole)
            whole += ids
        assert total == len(whole)
        found.append((doc_id, whole))
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return 1 - sum(p.length for p in pieces) / (capacity * len(sequences)) if pieces else 0.0


@pytest.mark.parametrize(("capacity", "windows"), [(16, 2), (4096, 128)])
def test_awkward_rows(spark, tmp_path, capacity, windows):
    docs = awkward(spark, tmp_path)
    expected = [(r.doc_id, library_ids(r.text)) for r in docs.collect()]
    pieces = pk.pack_documents(clashing(docs), tokenizer=PATH, capacity=capacity, open_windows=windows).collect()
    checked(pieces, expected, capacity)
    assert pk.pack_documents(docs.where("false"), tokenizer=PATH).count() == 0


def test_whole_table_with_little_padding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    docs.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/packing-docs")
    docs = spark.read.parquet(path)
    pieces = pk.pack_documents(docs, tokenizer=PATH, capacity=2048).collect()
    assert checked(pieces, [(r.doc_id, library_ids(r.text)) for r in docs.collect()], 2048) < 0.05


def test_windows_stay_bounded_and_take_the_best_fit():
    windows = pk.OpenWindows(10, 2, 0)
    assert [windows.place(n) for n in (6, 7, 3, 4, 2)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0)]
    assert windows.place(9) == (3, 0) and windows.place(10) == (4, 0)  # the fullest was closed
    assert len(windows.rooms) <= 2


def test_merging_keeps_every_window_and_leaves_few_open():
    rng = random.Random(1)
    left = pd.DataFrame({"sequence": range(200), "length": [rng.randint(1, 99) for _ in range(200)]})
    merged = pk.merge_windows(left, 100, 5)
    assert sorted(merged["sequence"]) == list(range(200)) and merged["open"].sum() <= 5
    used = defaultdict(list)
    for m, length in zip(merged.itertuples(), merged.merge(left, on="sequence")["length"], strict=True):
        used[m.host].append((m.shift, length))
    for parts in used.values():
        at = 0
        for shift, length in sorted(parts):
            assert shift == at
            at += length
        assert at <= 100
    assert len(used) < 120


def test_merge_over_several_rounds(spark):
    rows = [((p << 32) + w, 10 + (p * 7 + w) % 50) for p in range(40) for w in range(3)]
    left = spark.createDataFrame(rows, "sequence long, length long")
    moves = {r.sequence: (r.host, r["shift"]) for r in pk._merged(left, 100, 2).collect()}
    used = defaultdict(list)
    for sequence, length in rows:
        host, shift = moves[sequence]
        used[host].append((shift, length))
    for parts in used.values():
        at = 0
        for shift, length in sorted(parts):
            assert shift == at
            at += length
        assert at <= 100


def test_a_task_leaves_no_units_in_its_worker():
    rows = pa.record_batch([[0, 1], ["some words here", "others there"], [7, 8]], names=["_row", "_text", "doc_id"])
    made = [r for b in pk._piece_batches(iter([rows]), PATH, 2, 4096, 4) for r in b.to_pylist()]
    assert [r["doc_tokens"] for r in made if r["_row"] is not None] == [len(library_ids("some words here")), len(library_ids("others there"))]
    held = tokens.encoder(PATH)
    assert not held.units and not held.units_before and not held.parts

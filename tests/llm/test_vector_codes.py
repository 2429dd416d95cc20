from __future__ import annotations

import random
from hashlib import sha256
from math import floor, isfinite

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests_llm import SF, clashing, rows_of
from tideline.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def distance(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def brute(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error) and the codebooks' digest, by plain loops."""
    good = [r for r in rows if r[1] is not None and all(x is not None and isfinite(x) for x in r[1])]
    vectors = [[floor(256 * float(x)) for x in r[1]] for r in good]
    width = len(vectors[0]) // parts if good else 0
    cut = [[v[p * width : (p + 1) * width] for v in vectors] for p in range(parts)]
    first = sorted((i for i, r in enumerate(good) if r[0] is not None), key=lambda i: (good[i][0], list(good[i][1])))[:entries]
    books = [[cut[p][i] for i in first] for p in range(parts)]

    def assigned(p):
        return [min(range(len(books[p])), key=lambda e: (distance(x, books[p][e]), e)) for x in cut[p]]

    for _ in range(rounds):
        for p in range(parts):
            code = assigned(p)
            for e in set(code):
                own = [x for x, c in zip(cut[p], code, strict=True) if c == e]
                books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    codes = [assigned(p) for p in range(parts)]
    out = []
    for i, r in enumerate(good):
        own = [codes[p][i] for p in range(parts)]
        out.append((r[0], r[2], bytes(own), sum(distance(cut[p][i], books[p][c]) for p, c in enumerate(own))))
    totals = {}
    for _, label, _, e in out:
        totals[label] = totals.get(label, 0) + e
    return sorted(((*x, totals[x[1]]) for x in out), key=repr), sha256(
        ",".join(str(x) for b in books for e in b for x in e).encode()
    ).hexdigest()


def result(table, **how):
    made, books = vc.compress(table, **how)
    return rows_of(made.withColumn("code", F.col("code"))), vc.codebooks_digest(books)


def stored(spark, folder, rows):
    path = f"{folder}/embeddings.parquet"
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def plain(found):
    return sorted(((r[0], r[1], bytes(r[2]), r[3], r[4]) for r in found[0]), key=repr), found[1]


def test_awkward_rows(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0, rng.uniform(-1, 1)]) for _ in range(32)], rng.choice([None, 1, 2])) for i in range(150)]
    rows += rows[:20] + [(None, rows[3][1], None), (500, None, 1), (501, [float("nan")] * 32, 1), (502, [float("inf")] + [0.0] * 31, 2)]
    rows += [(503, [None] + [0.0] * 31, None), (-5, [0.0] * 32, 7), (-5, [0.125] * 32, 7)]
    table = stored(spark, tmp_path, rows)
    mine = plain(result(table))
    assert mine == brute([tuple(r) for r in table.collect()])
    assert plain(result(clashing(table).withColumn("id", F.lit("?")))) == mine


@pytest.mark.parametrize("n", [0, 1, 5, 64, 65])
def test_few_vectors(spark, tmp_path, n):
    rng = random.Random(n)
    table = stored(spark, tmp_path, [(i, [rng.uniform(-1, 1) for _ in range(16)], None) for i in range(n)])
    found = plain(result(table))
    assert found[0] == (brute([tuple(r) for r in table.collect()])[0] if n else [])


def test_equal_vectors(spark, tmp_path):
    table = stored(spark, tmp_path, [(i, [0.5] * 64, 1) for i in range(200)])
    assert plain(result(table)) == brute([tuple(r) for r in table.collect()])


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert plain(result(table)) == brute([(r.vec_id, r.embedding, r.label) for r in table.collect()])


def test_lengths_and_bounds_are_checked(spark, tmp_path):
    for rows, said in (
        ([(1, [0.0] * 16, 1), (2, [0.0] * 32, 1)], "differ in length"),
        ([(1, [0.0] * 10, 1)], "equal parts"),
        ([(1, [3e30] * 16, 1)], "not be exact"),
    ):
        with pytest.raises(Exception, match=said):
            result(stored(spark, tmp_path, rows).coalesce(1))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 64), st.integers(1, 5), st.integers(1, 40), st.randoms(use_true_random=False))
def test_masks_find_the_nearest_entry(entries, width, n, rng):
    spread = rng.choice([2, 30, 3000])
    book = np.array([[rng.randint(-spread, spread) for _ in range(width)] for _ in range(entries)], np.int64)
    points = np.array([[rng.randint(-2 * spread, 2 * spread) for _ in range(width)] for _ in range(n)], np.int64)
    index, least = vc.EntryMasks(book).nearest(points)
    every = ((points[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all() and (least == every.min(axis=1)).all()


def test_few_entries_are_measured():
    rng = np.random.default_rng(1)
    book, points = rng.integers(-300, 300, (64, 4)), rng.integers(-300, 300, (2000, 4))
    masks = vc.EntryMasks(book)
    radius = np.floor(np.sqrt(masks.at_hand(points))).astype(np.int64) + 1
    left = sum(int(m).bit_count() for m in masks.within(points, radius)) / len(points)
    assert left < 32


def test_decompress():
    books = [np.array([[1, 2], [3, 4]]), np.array([[5, 6], [7, 8]])]
    assert vc.decompress([b"\x00\x01", b"\x01\x00"], books).tolist() == [[1, 2, 7, 8], [3, 4, 5, 6]]

from __future__ import annotations

import random

import numpy as np
import pytest

from tests_llm import SF, awkward, clashing, documents
from tideline.llm import line_dedup as ld


def brute(rows, min_words):
    """Every run of lines against every earlier one; (doc_id, text) in row order."""
    docs = []
    for number, (doc_id, text) in enumerate(rows):
        docs.append(((doc_id is None, doc_id or 0, number), (text or "").split("\n")))
    at = [[i for i, line in enumerate(lines) if line and not line.isspace()] for _, lines in docs]
    seen: dict[tuple, list] = {}
    runs = []
    for n, (key, lines) in enumerate(docs):
        own = [lines[i] for i in at[n]]
        for start in range(len(own)):
            words = 0
            for end in range(start + 1, len(own) + 1):
                words += len(own[end - 1].split())
                if words >= min_words:
                    seen.setdefault(tuple(own[start:end]), []).append((key, start))
                    runs.append((n, key, start, end, tuple(own[start:end])))
    gone = [set() for _ in docs]
    for n, key, start, end, run in runs:
        if any(k < key or k == key and s + len(run) <= start for k, s in seen[run]):
            gone[n] |= set(range(start, end))
    out = []
    for n, (_, lines) in enumerate(docs):
        dropped = {at[n][p] for p in gone[n]}
        out.append((rows[n][0], "\n".join(x for i, x in enumerate(lines) if i not in dropped), len(dropped)))
    return sorted(out, key=repr)


def result(docs, **how):
    found = ld.drop_repeated_lines(docs, **how).collect()
    return sorted(((r.doc_id, r.text, r.removed) for r in found), key=repr)


@pytest.mark.parametrize("min_words", [1, 3, 5])
def test_random_lines_against_all_runs(spark, tmp_path, min_words):
    rng = random.Random(min_words)
    lines = ["a", "b c", "d e f", "g", "", "  ", "h i j k l", "m"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(40)]
    docs = documents(spark, rows, tmp_path).coalesce(1)
    assert result(docs, min_words=min_words) == brute([(r.doc_id, r.text) for r in docs.collect()], min_words)


def test_planted_passage_goes_but_for_its_first_copy(spark, tmp_path):
    passage = "\n".join(" ".join(f"p{i}w{j}" for j in range(12)) for i in range(6))
    rows = [(7, f"own start\n{passage}\nown end"), (3, f"{passage}\nthree"), (9, "nothing in common"), (5, f"five\n\n{passage[:200]}")]
    found = {i: (t, n) for i, t, n in result(documents(spark, rows, tmp_path))}
    assert found[7] == ("own start\nown end", 6) and found[3] == (f"{passage}\nthree", 0)
    assert found[9][1] == 0 and found[5][1] == 0  # its copy is cut within a line and too short before that


def test_repeats_within_one_document(spark, tmp_path):
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "\n".join([line] * 5)), (2, "\n".join(["short line"] * 100))]
    found = {i: (t, n) for i, t, n in result(documents(spark, rows, tmp_path))}
    assert found[1] == (line, 4)
    assert found[2] == ("\n".join(["short line"] * 25), 75)  # the first run of 50 words stays


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark, tmp_path)
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], 50)
    strip = lambda rows: sorted((r[0], r[1], r[2]) for r in rows if r[0] is not None)
    assert strip(result(clashing(docs))) == strip(expected)
    assert len(result(docs)) == docs.count()
    assert ld.drop_repeated_lines(docs.where("false")).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert result(docs, min_words=20) == brute([(r.doc_id, r.text) for r in docs.collect()], 20)


def test_windows_are_the_shortest():
    starts, sizes = ld.windows(np.array([0, 1, 2, 3, 7, 8]), np.array([3, 1, 1, 3, 4, 1]), 4)
    assert sorted(zip(starts, sizes, strict=True)) == [(0, 2), (0, 3), (1, 3), (2, 2), (7, 1), (7, 2)]

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests_llm import SF, awkward, clashing, documents, rows_of
from tideline.llm import simhash as sh


def brute_print(text, words=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    shingles = [found] if len(found) < words else [found[i : i + words] for i in range(len(found) - words + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=3):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints)
    least = {}
    for (doc_id, _), r in zip(rows, roots, strict=True):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return sorted(((d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(rows, prints, roots, strict=True)), key=repr)


def result(docs, **how):
    return rows_of(sh.near_groups(docs, **how).select("doc_id", "fingerprint", "component_id"))


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark, tmp_path)
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert result(clashing(docs)) == result(docs)
    assert result(docs.where("false")) == []
    kept = sh.drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len({r[2] for r in result(docs)})


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def flipped(rng, value, bits):
    for b in rng.sample(range(64), bits):
        value ^= 1 << b
    return value


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("run_rows", [2048, 8, 3])
@pytest.mark.parametrize("radius", [0, 2, 3])
def test_links_against_all_pairs(spark, run_rows, radius):
    rng = random.Random(run_rows * 10 + radius)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        prints.add(centre)
        for _ in range(12):
            centre = flipped(rng, centre, rng.randint(1, 5))  # chains of near fingerprints
            prints.add(centre)
    hot = rng.getrandbits(64)
    prints |= {hot ^ (1 << b) for b in range(30)} | {0, 1, 7, (1 << 64) - 1}
    prints = sorted(prints)
    table = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long")
    found = {r.node: r.root for r in sh.components(sh.near_edges(table, radius=radius, run_rows=run_rows)).collect()}
    mine = [found.get(signed(p), signed(p)) for p in prints]
    theirs = brute_components(prints, radius)
    assert len(set(zip(mine, theirs, strict=True))) == len(set(mine)) == len(set(theirs))


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 200), st.integers(1, 20), st.integers(0, 6), st.randoms(use_true_random=False))
def test_bit_sliced_runs(n, runs, radius, rng):
    seeds = [rng.getrandbits(64) for _ in range(4)]
    rows = sorted((rng.randrange(runs), signed(flipped(rng, rng.choice(seeds), rng.randint(0, 4)))) for _ in range(n))
    keys, prints = (np.array(x, np.int64) for x in zip(*rows, strict=True))
    a, b = sh._spanning(keys, prints, radius)
    edges = Counter(zip(a.tolist(), b.tolist(), strict=True))
    assert all(((x ^ y) & (1 << 64) - 1).bit_count() <= radius * 200 for x, y in edges)
    for key in set(keys.tolist()):
        own = [p & (1 << 64) - 1 for k, p in rows if k == key]
        roots = brute_components(own, radius)
        assert len(own) >= len(set(roots))
    expected = sum(len(own) - len(set(brute_components(own, radius))) for own in (
        [p & (1 << 64) - 1 for k, p in rows if k == key] for key in set(keys.tolist())))
    assert len(a) == expected


def test_bit_counts_over_many_pieces(monkeypatch):
    monkeypatch.setattr(sh, "SHINGLES_AT_ONCE", 5)
    rng = random.Random(1)
    lengths = [0, 3, 0, 17, 1, 5, 5, 0, 0, 40, 0]
    hashes = [rng.getrandbits(64) for _ in range(sum(lengths))]
    sums = sh._bit_counts(np.array(hashes, np.uint64), np.cumsum(lengths))
    at = 0
    for n, own in zip(lengths, sums, strict=True):
        assert [sum(h >> b & 1 for h in hashes[at : at + n]) for b in range(64)] == own.tolist()
        at += n


def test_long_chain_is_one_component(spark):
    nodes = list(range(0, 300))
    random.Random(2).shuffle(nodes)
    edges = spark.createDataFrame(list(zip(nodes, nodes[1:], strict=False)), "a long, b long")
    assert {(r.node, r.root) for r in sh.components(edges).collect()} == {(n, 0) for n in nodes}


def test_planted_near_copy(spark, tmp_path):
    rng = random.Random(3)
    base = [f"w{rng.randrange(9000)}" for _ in range(2000)]
    near = base.copy()
    near[1000] = "changed"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(reversed(base)))]
    assert [r[2] for r in result(documents(spark, rows, tmp_path))] == [1, 1, 3]

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests_llm import SF, awkward, clashing, documents, rows_of
from tideline.llm import hyperminhash as hm


def shingles(text, words=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return frozenset()
    return frozenset(" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def brute(rows, hundredths=85):
    """Rows (doc_id, n_shingles, component_id, kept) over all pairs."""
    sets = [shingles(t) for _, t in rows]
    by_set = {}
    for i, s in enumerate(sets):
        by_set.setdefault(s, []).append(i)
    own = [s for s in by_set if s]
    root = {s: s for s in own}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    holds = {}
    for at, s in enumerate(own):
        for x in s:
            holds.setdefault(x, []).append(at)
    for at, s in enumerate(own):
        for other in {o for x in s for o in holds[x] if o < at}:
            t = own[other]
            both = len(s & t)
            if 100 * both >= hundredths * (len(s) + len(t) - both):
                root[find(s)] = find(t)
    least = {}
    for (doc_id, _), s in zip(rows, sets, strict=True):
        if s and doc_id is not None:
            r = find(s)
            least[r] = min(least.get(r, doc_id), doc_id)
    out = []
    for (doc_id, _), s in zip(rows, sets, strict=True):
        component = least.get(find(s)) if s else doc_id
        out.append((doc_id, len(s), component, doc_id == component))
    return sorted(out, key=repr)


def result(docs, **how):
    return rows_of(hm.near_groups(docs, **how).select("doc_id", "n_shingles", "component_id", "kept"))


def changed(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**9)}"
    return out


def near_texts(seed, groups=6, size=25, length=200, most=9):
    """Groups of copies with some words changed, around the threshold, chains among them."""
    rng, rows = random.Random(seed), []
    common = [f"c{rng.randrange(10**6)}" for _ in range(60)]
    for _ in range(groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        for _ in range(size):
            rows.append(" ".join(changed(rng, base, rng.randint(0, most)) + rng.choice([[], common])))
            if rng.random() < 0.3:
                base = changed(rng, base, 2)
    rng.shuffle(rows)
    return list(enumerate(rows + rows[:10]))


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark, tmp_path)
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert result(clashing(docs)) == result(docs)
    assert result(docs.where("false")) == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize(("seed", "run_rows", "slice_hashes"), [(1, 2048, 1 << 20), (2, 2048, 900), (3, 6, 2500)])
def test_links_around_the_threshold(spark, tmp_path, monkeypatch, seed, run_rows, slice_hashes):
    monkeypatch.setattr(hm, "SLICE_HASHES", slice_hashes)
    rows = near_texts(seed)
    found = result(documents(spark, rows, tmp_path), run_rows=run_rows)
    assert found == brute(rows)
    assert 1 < len({r[2] for r in found}) < len(rows) - 10


def test_short_texts(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 14)))) for i in range(300)]
    assert result(documents(spark, rows, tmp_path)) == brute(rows)


def test_other_thresholds(spark, tmp_path):
    rows = near_texts(4, groups=3, size=12)
    assert result(documents(spark, rows, tmp_path), hundredths=95) == brute(rows, 95)


def plain_register(hashes, bucket):
    own = [h & (1 << 57) - 1 for h in hashes if h >> 57 == bucket]
    if not own:
        return hm.EMPTY
    bits = f"{min(own):057b}"
    zeros = len(bits) - len(bits.lstrip("0"))
    after = (bits[zeros + 1 :] + "0" * 57)[:10]
    return zeros << 10 | int(after, 2)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=1, max_size=60), st.sampled_from([0, 7, 30, 57]))
def test_registers_bit_by_bit(hashes, shift):
    hashes = sorted({(h >> 57 << 57) | ((h & (1 << 57) - 1) >> shift) for h in hashes})
    least, held = hm._least(np.array(hashes, np.uint64))
    assert hm._registers(least[None], held[None])[0].tolist() == [plain_register(hashes, b) for b in range(128)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=1, max_size=12), st.sampled_from([2, 4096]))
def test_intersections(sets, columns):
    old, hm.COLUMNS_AT_ONCE = hm.COLUMNS_AT_ONCE, columns
    try:
        found = hm._in_common([np.array(sorted(s), np.uint64) for s in sets])
    finally:
        hm.COLUMNS_AT_ONCE = old
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert i == j or found[i, j] == len(a & b)


def test_estimate_keeps_every_pair_above_the_threshold():
    rng = np.random.default_rng(1)
    dropped = kept_far = 0
    for _ in range(300):
        n = int(rng.integers(3, 2000))
        base = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2)
        for similarity in (0.86, 0.3):
            both = round(2 * n * similarity / (1 + similarity) / 2) * 2
            a, b = np.sort(base[:n]), np.sort(np.concatenate([base[: max(1, both // 2)], base[n : 2 * n - max(1, both // 2)]]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            (x, y) = (hm._registers(l[None], h[None])[0] for l, h in (hm._least(a), hm._least(b)))
            equal, either = ((x == y) & (x != hm.EMPTY)).sum(), ((x != hm.EMPTY) | (y != hm.EMPTY)).sum()
            may = bool(hm._may_link(equal, either, np.int64(len(a)), np.int64(len(b)), 85))
            dropped += true >= 0.85 and not may
            kept_far += true < 0.4 and n > 200 and may
    assert not dropped and not kept_far

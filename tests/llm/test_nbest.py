from __future__ import annotations

import zlib
from array import array

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests_llm import SF, awkward, clashing
from tideline.llm import nbest as nb

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = nb.PieceModel.from_file(PATH)
SPACE = nb.SPACE
TINY = nb.PieceModel(
    {p: (i + 3, s) for i, (p, s) in enumerate({"a": -3.0, "b": -2.5, "ab": -4.0, "ba": -5.25, "aba": -6.5, SPACE: -1.0, SPACE + "a": -2.0, SPACE * 2: -1.25, "c" + SPACE: -0.5, "c": -3.5}.items())},
    {b: 100 + b for b in range(256)},
)
APART = nb.PieceModel({p: v for p, v in TINY.pieces.items() if p != "c" + SPACE}, TINY.byte_ids)


def brute(model, text):
    """All segmentations of a short text with their scores, best first."""
    if not text:
        return [(0.0, ())]
    marked = SPACE + text.replace(" ", SPACE)
    ends = [[(0.0, ())]] + [[] for _ in marked]
    for start in range(len(marked)):
        edges = [(e, model.pieces[marked[start:e]][1]) for e in range(start + 1, len(marked) + 1) if marked[start:e] in model.pieces]
        if not any(e == start + 1 for e, _ in edges):
            edges.append((start + 1, model.floor))
        for end, score in edges:
            ends[end] += [(total + score, (*parts, marked[start:end])) for total, parts in ends[start]]
    return sorted(((round(t, 6), tuple(model.ids(list(p)))) for t, p in ends[-1]), key=lambda x: -x[0])


@pytest.mark.parametrize("model", [TINY, APART], ids=["spanning", "apart"])
@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abc é", max_size=9), st.integers(1, 8))
def test_against_all_segmentations(model, text, n):
    expected = brute(model, text)
    found = [(round(s, 6), tuple(array("I", ids))) for s, ids in model.encode(text, n)]
    assert [s for s, _ in found] == pytest.approx([s for s, _ in expected[:n]])
    assert len(set(found)) == len(found) and set(found) <= set(expected)
    assert all(model.decode(array("I", ids).tobytes()) == text for _, ids in found)


def test_words_apart_is_seen():
    assert APART.words_apart and MODEL.words_apart and not TINY.words_apart


def test_best_first_and_scores_of_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ("Thoureand the ones,", "été à Zürich", "a  b"):
        found = MODEL.encode(text, 5)
        assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)
        for score, ids in found:
            ids = list(array("I", ids))
            assert score == pytest.approx(sum(library.get_score(i) for i in ids))
            assert library.decode(ids) == text
        merged = sum(library.get_score(i) for i in library.encode(text))
        assert found[0][0] >= merged  # no segmentation, the library's own included, scores higher


def test_bytes_and_odd_texts():
    for text in ("", " ", "  x", "x ", "\n\t", "中\U0001f600é́", "\x00", "a\nb\nc " * 50, "x" * 3000):
        for _, ids in MODEL.encode(text, 3):
            assert MODEL.decode(ids) == text
    assert MODEL.encode("", 3) == [(0.0, b"")]
    assert MODEL.decode(array("I", [MODEL.byte_ids[0xC3], MODEL.byte_ids[0x41], 10**6]).tobytes()) == "�A⁇"


def test_small_memory_gives_the_same(spark, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    expected = [MODEL.encode(t, 3) for t in texts]
    monkeypatch.setattr(nb, "WORDS_HELD", 20)
    monkeypatch.setattr(nb, "SECTIONS_HELD", 5)
    assert [nb.PieceModel.from_file(PATH).encode(t, 3) for t in texts] == expected


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark, tmp_path)
    rows = nb.best_segmentations(clashing(docs), model=PATH, n=2)
    back = rows.withColumn("text", nb.decoded(F.col("ids"), PATH)).collect()
    plain = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=repr)
    assert sorted(((r.doc_id, r.text) for r in back if r["rank"] == 1), key=repr) == plain
    for r in back:
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.n_ids == len(r.ids) // 4
        assert (r["rank"] == 1) == (r.round_trip is not None) and r.round_trip is not False
    assert sum(r["rank"] == 2 for r in back) == sum(len(MODEL.encode(t, 2)) > 1 for _, t in plain)
    assert nb.best_segmentations(docs.where("false"), model=PATH, n=2).count() == 0

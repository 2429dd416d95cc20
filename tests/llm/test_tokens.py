from __future__ import annotations

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests_llm import SF
from tideline.llm import tokens

WORD = tokens.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
BYTE = tokens.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
ODD = "aZéÉßΣςİǅ0٣ \n\t  '’.,!<|>_-&;#́‍\U0001f600ﬁ½中"


def test_which_tokenizers_may_be_cut():
    assert WORD.by_unit and WORD.plain and not BYTE.by_unit


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(alphabet=ODD, max_size=40), st.text(max_size=30)))
def test_units_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert WORD.encode([text]) == WORD._from_library([text])
    assert BYTE.encode([text]) == BYTE._from_library([text])


@pytest.mark.parametrize("text", ["<|endoftext|>", "x<|startoftext|>y", "a <|endoftext|>, b", "it's 'tis we'll", "Á B", ""])
def test_special_strings(text):
    assert WORD.encode([text]) == WORD._from_library([text])


def test_whole_table_and_small_memory(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    small = tokens.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), units_held=50)
    assert small.encode(texts) == WORD.encode(texts) == WORD._from_library(texts)


def test_case_and_marks_make_no_units_of_their_own():
    """One word in many guises is learned once: what is held grows with the words, not with the marks around them."""
    encoder = tokens.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    encoder.forget()
    texts = ["Größe größe, GRÖSSE; (größe) Größe's", "größe...größe,,GRÖßE 12größe12", "größe;"]
    assert encoder.encode(texts) == encoder._from_library(texts)
    assert set(encoder.units) == {"größe", "grösse", ",", ";", "(", ")", "'s", "...", ",,", "12"}


@pytest.mark.parametrize("size", [1, 7, 64])
def test_blocks_leave_no_seam(monkeypatch, size):
    monkeypatch.setattr(tokens, "BLOCK_BYTES", size)
    texts = ["", "a" * 200, " ", "Ab, c\nd's “é” " * 9, "x\n\n" * 30, "É×ß<|endoftext|>Y", "", "no-space-at-all," * 12, "end "]
    assert WORD.encode(texts) == WORD._from_library(texts)
    batch = pa.record_batch([list(range(len(texts) + 1)), [*texts, None]], names=["doc_id", "text"])
    cut = list(tokens.slices(batch, 1))
    assert pa.Table.from_batches(cut) == pa.Table.from_batches([batch]) and all(b.num_rows for b in cut)
    assert list(tokens.slices(batch.slice(0, 0), 1)) == []

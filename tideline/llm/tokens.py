"""Token ids of whole texts, as little-endian unsigned 32-bit numbers."""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

UNITS_HELD = 300_000  # of a generation; the one before is kept beside it
BLOCK_BYTES = 1 << 21  # of text that is cut at once; longer texts are cut in blocks at their spaces
END_ID = 2

_SPACE, _LETTER, _MARK, _DIGIT, _APOSTROPHE, _OTHER = range(6)
_WORD = re.compile("[a-zß-öø-ÿ]+")
_SIGNS = (b"\xc3\x97", b"\xc3\xb7")  # no letters, though they lie among them

_LOADED: dict[str, WordEncoder] = {}  # one per worker process and file: its words serve later tasks too


def encoder(path: str) -> WordEncoder:
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


def _packed(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else the next from 256 on."""
    shown = {b for b in range(33, 256) if b < 127 or b > 160 and b != 173}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows, each with about a block of text in that column."""
    at_end = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)) // BLOCK_BYTES
    cuts = [0, *(np.flatnonzero(at_end[1:] != at_end[:-1]) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if end > begin:
            yield batch.slice(begin, end - begin)


class WordEncoder:
    """Encodes texts with the tokenizers library, each distinct unit between spaces once while it is held.

    That equals encoding the whole text if the tokenizer joins and changes nothing across a space or line feed and drops
    both; this is probed when the file is loaded, and other tokenizers get whole texts. If it also lowers case and cuts
    letters, digits and marks from each other, so are units of ASCII and of letters from À to ÿ: whole blocks of text
    are lowered and cut by their bytes, and a word goes straight to the library's model. Lower case, composition and class
    of these letters are disputed by no version of Unicode. An apostrophe stays before the letters behind it
    (contractions), and a unit with any other character, or with one that may begin a special token, stays whole and as
    it is. All units but words go through the whole library.
    """

    PROBES = (
        "a b", "ab  cd", "Ab\ncd", " a ", "a, b.c\n\nd's 12 e", "é ́ x", "\n", "The, ÉTÉ!! (x) |", "Größe;; naïve--",
        "mañana. ß ÿ'", "x's,", "Ünterwegs&&& of%%% on***", "lowei\n\nQuoi?!", "a1b2c,3,'4'll 'x' ,'s don't,'re", "(A)b[C]'D1'E",
        "À×Þ÷x", "it’s A\u0301B, I\u0307b", "a\tB\r\nC",
    )

    def __init__(self, path: str, units_held: int = UNITS_HELD):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = _byte_letters()
        self.units_held = units_held
        self.plain = False
        self._lay_tables("")
        self.by_unit = self._equal_on_probes()
        if self.by_unit and self._lowers_and_cuts():
            self.plain = True
            self._lay_tables("".join(t.content[0] for t in self.library.get_added_tokens_decoder().values()))
            self.plain = self._equal_on_probes()
            if not self.plain:
                self._lay_tables("")

    def _lay_tables(self, special: str) -> None:
        """What each byte is and becomes, and which pairs of bytes a unit begins between."""
        kinds, becomes = np.full(256, _OTHER, np.uint8), np.arange(256, dtype=np.uint8)
        kinds[[32, 10]], becomes[10] = _SPACE, 32
        if self.plain:
            kinds[33:127] = _MARK
            kinds[48:58] = _DIGIT
            kinds[39] = _APOSTROPHE
            kinds[65:91] = kinds[97:123] = kinds[0xC3] = kinds[0x80:0xC0] = _LETTER
            for first in special.encode():
                kinds[first] = _OTHER
            becomes[65:91] += 32
            becomes[0x80:0x9F] += 32
        begins = np.zeros((8, 8), bool)
        begins[_SPACE, 1:6] = True
        cut = (_LETTER, _MARK, _DIGIT, _APOSTROPHE)
        begins[np.ix_(cut, cut)] = ~np.eye(4, dtype=bool)
        begins[_APOSTROPHE, [_LETTER, _MARK]] = begins[_MARK, _APOSTROPHE] = False
        self.kinds, self.becomes, self.begins = kinds.tobytes(), becomes.tobytes(), begins.tobytes().ljust(256, b"\0")

    def _equal_on_probes(self) -> bool:
        self.forget()
        return all(self._from_units([p]) == self._from_library([p]) for p in self.PROBES)

    def _lowers_and_cuts(self) -> bool:
        made = json.loads(self.library.to_str())

        def kinds(part: str, inner: str) -> list[str]:
            whole = made[part] or {}
            return [x["type"] for x in whole.get(inner, [whole]) if x]

        return (
            kinds("normalizer", "normalizers") == ["NFC", "Replace", "Lowercase"]
            and kinds("pre_tokenizer", "pretokenizers") == ["Split", "ByteLevel"]
            and made["model"]["type"] == "BPE"
        )

    def forget(self) -> None:
        """Drop all that is held: a worker that goes on to other work needs the room."""
        self.units: dict[str, bytes] = {}
        self.units_before: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}  # units but words of the block at hand, learned in one call

    def encode(self, texts: list[str]) -> list[bytes]:
        return self._from_units(texts) if self.by_unit else self._from_library(texts)

    def _from_library(self, texts: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return _packed([t.id for t in self.model.tokenize(spelled)])

    def _learn(self, new: list[str]) -> list[bytes]:
        others = [u for u in new if not (self.plain and _WORD.fullmatch(u))]
        self.parts = dict(zip(others, self._from_library(others), strict=True))
        ids = [self.parts[u] if u in self.parts else self._word(u) for u in new]
        self.parts = {}
        return ids

    def _ids(self, units: list[str]) -> list[bytes]:
        """The ids of different units. A full generation steps back and its predecessor goes; what is asked for again is
        taken over, not learned."""
        if len(self.units) > self.units_held:
            self.units_before, self.units = self.units, {}
        held, before, new = self.units, self.units_before, []
        found = list(map(held.get, units))
        for n, unit in enumerate(units):
            if found[n] is None:
                ids = before.get(unit)
                if ids is None:
                    new.append(n)
                else:
                    found[n] = held[unit] = ids
        if new:
            for n, ids in zip(new, self._learn([units[n] for n in new]), strict=True):
                found[n] = held[units[n]] = ids
        return found

    def _cut(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where in ``data`` each unit begins, where without its spaces, and what all bytes but the spaces become."""
        marked = data.translate(self.kinds)
        kinds = np.frombuffer(marked, np.uint8)
        becomes = np.frombuffer(data.translate(self.becomes), np.uint8)
        pairs = kinds.copy()
        pairs[1:] |= kinds[:-1] << 3
        begins = np.frombuffer(pairs.tobytes().translate(self.begins), bool)
        spaces = kinds == _SPACE
        spaces_before = np.cumsum(spaces, dtype=np.int32)
        if _OTHER in marked or any(s in data for s in _SIGNS):
            raw, other = np.frombuffer(data, np.uint8), kinds == _OTHER
            other[:-1] |= (raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
            whole = np.zeros(int(spaces_before[-1]) + 1, bool)
            whole[spaces_before[other]] = True
            kept = whole[spaces_before]
            becomes = np.where(kept, raw, becomes)
            begins = begins & (~kept | np.concatenate([[True], spaces[:-1]]))
        at = np.flatnonzero(begins)
        return at, at - spaces_before[at], becomes[~spaces]

    def _from_block(self, pieces: list[bytes]) -> list[bytes]:
        data = b"\n".join(pieces)
        if not data:
            return [b""] * len(pieces)
        at, offsets, letters = self._cut(data)
        offsets = np.append(offsets, len(letters)).astype(np.int32)
        units = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
        ids = pa.array(self._ids(units.dictionary.to_pylist()), pa.binary()).take(units.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int32)[: len(ids) + 1]
        held = memoryview(ids.buffers()[2]) if len(ids) else b""
        begin = np.cumsum([0, *(len(p) + 1 for p in pieces)])
        cuts = ends[np.searchsorted(at, begin)].tolist()
        return [bytes(held[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def _from_units(self, texts: list[str]) -> list[bytes]:
        out, block, size = [], [], 0
        for text in texts:
            raw, at, parts = text.encode(), 0, []
            if size and size + len(raw) > BLOCK_BYTES:
                out += self._from_block(block)
                block, size = [], 0
            while len(raw) - at > BLOCK_BYTES:
                end = max(raw.rfind(s, at + 1, at + BLOCK_BYTES) for s in (b" ", b"\n"))
                if end < 0:  # one unit fills the block
                    end = min((x for s in (b" ", b"\n") if (x := raw.find(s, at + BLOCK_BYTES)) >= 0), default=len(raw))
                parts += self._from_block([raw[at:end]])
                at = end
            if parts:
                out.append(b"".join([*parts, *self._from_block([raw[at:]])]))
            else:
                block.append(raw)
                size += len(raw) + 1
        return out + self._from_block(block)

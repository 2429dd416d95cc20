"""SentencePiece encoding and decoding: the N best segmentations of whole texts.

The pieces that match somewhere in a text form a lattice; a path's score is the sum of its pieces' scores. A forward Viterbi
pass gives the best score up to every place. These are exact heuristics for the way back: an A-star search from the end
takes up the partial path with the best total first, so it finishes the paths in order of score and looks at few others.

No piece spans two neighbouring characters that stand together in no piece. The lattice falls apart there, exactly, and each distinct word is
scored once while it is held. Of all words only those whose best and second best path differ
least can take part in the N best paths of the text; the search runs over them alone.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import number_rows, whole_text

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
WORDS_HELD = 400_000  # of a generation; the one before is kept beside it
SECTIONS_HELD = 400_000
WORST = float("-inf")

_LOADED: dict[str, PieceModel] = {}  # one per worker process and file: its sections serve later tasks too


def piece_model(path: str) -> PieceModel:
    if path not in _LOADED:
        _LOADED[path] = PieceModel.from_file(path)
    return _LOADED[path]


class PieceModel:
    """Pieces with scores; characters without a piece fall back to their bytes, at a penalty below the worst score."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: dict[int, int] | None = None, unknown: int = 0):
        self.pieces, self.unknown = pieces, unknown
        self.byte_ids = byte_ids or {}
        self.texts = {i: p for p, (i, _) in pieces.items()}
        self.texts.update((i, chr(b)) for b, i in self.byte_ids.items() if b < 128)  # a character of its own in any run
        self.bytes_of = {i: b for b, i in self.byte_ids.items() if b >= 128}
        self.listed = np.array([self.texts.get(i) for i in range(max(self.texts, default=-1) + 1)], object)
        self.floor = min((s for p, (_, s) in pieces.items() if p.strip(SPACE)), default=0.0) - UNKNOWN_PENALTY
        self.trie: dict[str, list] = {}  # by next character: [score of the piece that ends here or None, next]
        for piece, (_, score) in pieces.items():
            below = self.trie
            for char in piece:
                node = below.setdefault(char, [None, {}])
                below = node[1]
            if piece:
                node[0] = score
        self.pairs = {piece[at : at + 2] for piece in pieces for at in range(len(piece) - 1)}
        self.words_apart = all(p[0] == SPACE or p[1] != SPACE for p in self.pairs)
        self.held: dict[str, tuple[float, float, bytes]] = {}  # of words
        self.held_before: dict[str, tuple[float, float, bytes]] = {}
        self.cuts: dict[str, tuple[float, float, bytes]] = {}  # of sections of words
        self.cuts_before: dict[str, tuple[float, float, bytes]] = {}

    @classmethod
    def from_file(cls, path: str) -> PieceModel:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, {}
        for i in range(library.get_piece_size()):
            if library.is_byte(i):
                byte_ids[int(library.id_to_piece(i)[1:-1], 16)] = i
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                pieces[library.id_to_piece(i)] = (i, library.get_score(i))
        return cls(pieces, byte_ids, library.unk_id())

    # --- lattice -----------------------------------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """The text with its leading space mark, cut before each run of space marks, if no piece spans that place."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        if not self.words_apart:
            return [marked]
        if SPACE * 2 not in marked and marked[-1] != SPACE:
            return [SPACE + w for w in marked[1:].split(SPACE)]
        return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", marked)

    def sections(self, word: str) -> list[str]:
        """A word cut where no piece can span."""
        found, start = [], 0
        for at in range(1, len(word)):
            if word[at - 1 : at + 1] not in self.pairs:
                found.append(word[start:at])
                start = at
        found.append(word[start:])
        return found

    def _edges(self, section: str, start: int) -> Iterator[tuple[int, float]]:
        below, single = self.trie, False
        for end in range(start, len(section)):
            node = below.get(section[end])
            if node is None:
                break
            score, below = node
            if score is not None:
                single |= end == start
                yield end + 1, score
        if not single:
            yield start + 1, self.floor

    def forward(self, section: str) -> tuple[list[float], list[float], list[int]]:
        """Viterbi: best and second best score up to each place, and where the best path's last piece begins."""
        n, trie, floor = len(section), self.trie, self.floor
        best, second, back = [0.0] + [WORST] * n, [WORST] * (n + 1), [0] * (n + 1)
        for start in range(n):
            b, s, below, end, single = best[start], second[start], trie, start, False
            for char in section[start:]:
                node = below.get(char)
                if node is None:
                    break
                end += 1
                score, below = node
                if score is not None:
                    value = b + score
                    if value > best[end]:
                        other = s + score
                        second[end] = best[end] if best[end] > other else other
                        best[end], back[end] = value, start
                    elif value > second[end]:
                        second[end] = value
                    if end == start + 1:
                        single = True
            if not single:
                end, value = start + 1, b + floor
                if value > best[end]:
                    second[end] = max(best[end], s + floor)
                    best[end], back[end] = value, start
                elif value > second[end]:
                    second[end] = value
        return best, second, back

    def paths(self, section: str, n: int) -> list[tuple[float, list[str]]]:
        """The n best segmentations (score, parts): backward A-star with the forward scores as heuristics."""
        best, _, _ = self.forward(section)
        into: list[list[tuple[int, float]]] = [[] for _ in range(len(section) + 1)]
        for start in range(len(section)):
            for end, score in self._edges(section, start):
                into[end].append((start, score))
        queue: list = [(-best[-1], 0, len(section), 0.0, None)]
        pushed, found = 0, []
        while queue and len(found) < n:
            _, _, place, after, path = heapq.heappop(queue)
            if not place:
                parts, at = [], path
                while at:
                    parts.append(section[at[0] : at[1]])
                    at = at[2]
                found.append((after, parts))
                continue
            for start, score in into[place]:
                pushed += 1
                heapq.heappush(queue, (-(best[start] + score + after), pushed, start, score + after, (start, place, path)))
        return found

    def ids(self, parts: list[str]) -> list[int]:
        out = []
        for part in parts:
            if part in self.pieces:
                out.append(self.pieces[part][0])
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in part.encode()]
            else:
                out.append(self.unknown)
        return out

    def _section(self, section: str) -> tuple[float, float, bytes]:
        held = self.cuts.get(section)
        if held is None:
            held = self.cuts_before.get(section)
            if held is None:
                best, second, back = self.forward(section)
                parts, at = [], len(section)
                while at:
                    parts.append(section[back[at] : at])
                    at = back[at]
                held = best[-1], best[-1] - second[-1], array("I", self.ids(parts[::-1])).tobytes()
            if len(self.cuts) >= SECTIONS_HELD:  # a full generation steps back; what is asked for again is taken over
                self.cuts_before, self.cuts = self.cuts, {}
            self.cuts[section] = held
        return held

    def _learn(self, new: set[str]) -> None:
        """(score, what the second best path loses, ids) of the best path of each word."""
        for word in new:
            own = [self._section(s) for s in self.sections(word)]
            if len(own) == 1:
                self.held[word] = own[0]
            else:
                self.held[word] = sum(x[0] for x in own), min(x[1] for x in own), b"".join([x[2] for x in own])

    # --- whole texts -------------------------------------------------------------------------------------------------

    def encode(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """The n best (score, ids) of a text; all of them if there are fewer. An empty text has one, without ids.

        Equal scores come in the order of the search, which depends on the text alone.
        """
        words = self.words(text)
        different = set(words)
        if new := different.difference(self.held):
            if self.held and len(self.held) + len(new) > WORDS_HELD:
                self.held_before, self.held = self.held, {}
                new = different
            before = self.held_before
            known = {w: before[w] for w in new if w in before}
            self.held |= known
            self._learn(new.difference(known))
        own = list(map(self.held.__getitem__, words))
        ids = [x[2] for x in own]
        total = sum([x[0] for x in own])
        results = [(total, b"".join(ids))]
        if n == 1:
            return results
        changes = heapq.nsmallest(n - 1, zip([x[1] for x in own], range(len(own)), strict=True))
        changes = [c for c in changes if c[0] != float("inf")]
        if not changes:
            return results
        places = sorted(at for _, at in changes)
        options = []
        for at in places:
            first = own[at][0]
            ways = self.paths(words[at], n)
            options.append([(first - score, array("I", self.ids(parts)).tobytes()) for score, parts in ways])
            options[-1][0] = (0.0, ids[at])
        # the sections are a lattice again; the best of what lies before is no loss, so a state's loss is its exact total
        queue: list = [(0.0, 0, len(places), ())]
        pushed = 0
        results = []
        while queue and len(results) < n:
            loss, _, left, picked = heapq.heappop(queue)
            if not left:
                changed = dict(zip(places, (options[k][i][1] for k, i in enumerate(picked)), strict=True))
                results.append((total - loss, b"".join(changed.get(at, x) for at, x in enumerate(ids))))
                continue
            for i, (more, _) in enumerate(options[left - 1]):
                pushed += 1
                heapq.heappush(queue, (loss + more, pushed, left - 1, (i, *picked)))
        return results

    def decode(self, ids: bytes) -> str:
        """The text of packed ids: pieces joined, byte runs as UTF-8, the leading space mark dropped."""
        try:
            whole = "".join(self.listed[np.frombuffer(ids, "<u4")].tolist())
        except (TypeError, IndexError):  # bytes of longer characters, or ids that are no piece
            out, run = [], bytearray()
            for i in array("I", ids):
                if i in self.bytes_of:
                    run.append(self.bytes_of[i])
                    continue
                out.append(run.decode("utf-8", "replace"))
                out.append(self.texts.get(i, "⁇"))
                run.clear()
            whole = "".join(out) + run.decode("utf-8", "replace")
        return whole.replace(SPACE, " ").removeprefix(" ")


def _segment_batches(batches: Iterator[pa.RecordBatch], path: str, n: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    model = piece_model(path)
    for whole in batches:
        id_kind = whole.column(1).type
        for at in range(0, whole.num_rows, 64):
            batch, out = whole.slice(at, 64), []
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for rank, (score, ids) in enumerate(model.encode(text, n), 1):
                    same = model.decode(ids) == text if rank == 1 else None
                    out.append((row, doc_id, rank, score, len(ids) // 4, zlib.crc32(ids), same, ids if with_ids else None))
            columns = [list(c) for c in zip(*out, strict=True)]
            kinds = (pa.int64(), id_kind, pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            names = ("row_number", "doc_id", "rank", "score", "n_ids", "ids_crc32", "round_trip", "ids")
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def best_segmentations(
    docs: DataFrame, *, model: str, n: int, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True
) -> DataFrame:
    """The n best segmentations of every whole text: doc_id, rank (from 1), score, n_ids, ids_crc32, round_trip, ids.

    ``model`` is a sentencepiece file that every executor can read; its piece scores are added up along a path. Where they
    are not log probabilities (a BPE model's are minus the rank of the merge), the best path need not be the library's own
    encoding. ``ids`` are little-endian unsigned 32-bit numbers, null unless asked for; ``round_trip`` tells, at rank 1,
    whether decoding gives the text again (a text that holds the space mark itself does not come back). Null text counts as
    empty and has one segmentation, without ids; other texts have as many as there are, at most n. Null ids and repeated
    rows are documents of their own, told apart by ``row_number``, which holds within one evaluation; an empty table gives
    an empty result; other columns are not read.
    """
    rows = number_rows(docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("_text"))).select("_row", "doc_id", "_text")
    kind = dict(rows.dtypes)["doc_id"]
    schema = (
        f"row_number long, doc_id {kind}, rank int, score double, n_ids long, ids_crc32 long, round_trip boolean, ids binary"
    )
    return rows.mapInArrow(lambda b: _segment_batches(b, model, n, with_ids), schema).select(
        "doc_id", "rank", "score", "n_ids", "ids_crc32", "round_trip", "ids", "row_number"
    )


def decoded(ids: Column, model: str) -> Column:
    """The texts of little-endian unsigned 32-bit ids."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = piece_model(model)
        for batch in batches:
            yield batch.map(lambda b: None if b is None else own.decode(bytes(b)))

    return texts(ids)

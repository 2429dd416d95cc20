"""Bounded-space online packing of token ids into sequences of fixed length.

Each partition keeps a fixed number of open windows. A document's full lengths become sequences at once; its rest goes into
the open window that it fills best. If none has room, the fullest window is closed and a new one opened. What is still
open at the end of the partitions is merged: windows of 16 partitions at a time are put into each other, best fit again,
and at most the fixed number stays open for the next round.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import number_rows, whole_text
from tideline.llm.tokens import END_ID, encoder, slices
from tideline.session import settle

SEQUENCE_TOKENS = 4096
OPEN_WINDOWS = 128
MERGED_PARTITIONS = 16

_PIECE = [
    ("_row", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence", pa.int64()), ("offset", pa.int64()),
]
_PIECE_SQL = "_row long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence long, offset long"


class OpenWindows:
    """At most ``limit`` windows with room, by room left. ``place`` tells where a piece goes."""

    def __init__(self, capacity: int, limit: int, first: int):
        self.capacity, self.limit, self.next = capacity, limit, first
        self.rooms: list[tuple[int, int]] = []  # (room, window), ascending

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, length: int) -> tuple[int, int]:
        at = bisect_left(self.rooms, (length, -1))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if len(self.rooms) >= self.limit:
                self.rooms.pop(0)  # the fullest
            room, window = self.capacity, self.new()
        if room > length:
            insort(self.rooms, (room - length, window))
        return window, self.capacity - room


def _piece_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Pieces in windows; at the end a row without document per window that is left open (its length is what is in it)."""
    windows, end, size = None, np.array([end_id], "<u4").tobytes(), 4 * capacity
    words = encoder(path)
    for whole in batches:
        for batch in slices(whole, 1):
            rows = batch.column(0).to_pylist()
            if windows is None:
                windows = OpenWindows(capacity, limit, (rows[0] >> 33) << 32)
            out, origins = [], []
            for origin, (row, ids) in enumerate(zip(rows, words.encode(batch.column(1).to_pylist()), strict=True)):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * start + size]
                    length = len(piece) // 4
                    window, offset = (windows.new(), 0) if length == capacity else windows.place(length)
                    out.append((row, start, length, piece, zlib.crc32(piece), total, window, offset))
                    origins.append(origin)
            schema = pa.schema([*_PIECE, ("doc_id", batch.column(2).type)])
            yield pa.record_batch([*(list(c) for c in zip(*out, strict=True)), batch.column(2).take(pa.array(origins))], schema)
    words.forget()  # a task's texts fill a generation, so little would be asked for again
    if windows and windows.rooms:
        left = [(None, None, capacity - room, None, None, None, window, None, None) for room, window in windows.rooms]
        yield pa.record_batch([list(c) for c in zip(*left, strict=True)], schema)


def merge_windows(windows: pd.DataFrame, capacity: int, limit: int) -> pd.DataFrame:
    """Put windows of one group into each other: (sequence, host, shift, filled, open), one row per window."""
    by_size = windows.sort_values(["length", "sequence"], ascending=[False, True])
    hosts = OpenWindows(capacity, len(windows), 0)
    first: dict[int, int] = {}
    rows, filled = [], {}
    for sequence, length in zip(by_size["sequence"], by_size["length"], strict=True):
        number, shift = hosts.place(int(length))
        host = first.setdefault(number, int(sequence))
        filled[host] = shift + int(length)
        rows.append((int(sequence), host, shift))
    emptiest = sorted(filled, key=lambda h: (filled[h], h))[:limit]
    still = {h for h in emptiest if filled[h] < capacity}
    return pd.DataFrame(
        [(s, h, shift, filled[h], h in still and s == h) for s, h, shift in rows],
        columns=["sequence", "host", "shift", "filled", "open"],
    )


def _merged(left: DataFrame, capacity: int, limit: int) -> DataFrame:
    """(sequence, host, shift) of all windows left open, over as many rounds as there are groups of partitions."""
    schema = "sequence long, host long, shift long, filled long, open boolean"
    parts = (left.agg(F.max(F.shiftright("sequence", 32))).first()[0] or 0) + 1
    state, moves, width = left.select("sequence", "length"), None, 1
    while True:
        width *= MERGED_PARTITIONS
        group = F.floor(F.shiftright("sequence", 32) / width)
        merged = settle(
            state.groupBy(group.alias("g")).applyInPandas(lambda w: merge_windows(w, capacity, limit), schema), "merged-windows"
        )
        step = merged.select("sequence", "host", "shift")
        if moves is None:
            moves = step
        else:
            later = step.select(F.col("sequence").alias("host"), F.col("host").alias("_host"), F.col("shift").alias("_shift"))
            moves = moves.join(later, "host", "left").select(
                "sequence", F.coalesce("_host", "host").alias("host"), (F.col("shift") + F.coalesce("_shift", F.lit(0))).alias("shift")
            )
        if width >= parts:
            return moves
        state = merged.where("open").select("sequence", F.col("filled").alias("length"))


def pack_documents(
    docs: DataFrame,
    *,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    capacity: int = SEQUENCE_TOKENS,
    open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """Pieces: doc_id, start, length, ids (little-endian unsigned 32-bit), ids_crc32, doc_tokens, sequence_id, offset,
    row_number.

    ``tokenizer`` is a tokenizers file that every executor can read. Each document is encoded whole and ends with
    ``end_id``; null text counts as empty and gives that id alone. Each id lies in exactly one piece, and the pieces of a
    sequence leave no gap before its padding. Repeated rows and null ids are documents of their own; an empty table gives
    an empty result. Other columns are not read. ``docs`` is read once.
    """
    numbered = number_rows(docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("_text")))
    kind = dict(numbered.dtypes)["doc_id"]
    pieces = settle(
        numbered.select("_row", "_text", "doc_id").mapInArrow(
            lambda b: _piece_batches(b, tokenizer, end_id, capacity, open_windows), f"{_PIECE_SQL}, doc_id {kind}"
        ),
        "pieces",
    )
    moves = _merged(pieces.where("_row is null").select("sequence", "length"), capacity, open_windows)
    return (
        pieces.where("_row is not null")
        .join(moves, "sequence", "left")
        .select(
            "doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens",
            F.coalesce("host", "sequence").alias("sequence_id"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
            F.col("_row").alias("row_number"),
        )
    )

"""Line dedup: repeated runs of lines, found by prefix doubling over line-id sequences.

Each non-blank line gets a 128-bit id; a document is its sequence of ids. Prefix doubling names the runs of 1, 2, 4, .. lines
that start at each place: equal names mean equal runs, and sorting by them is the suffix array's order by that many lines.
Places whose run occurs once can begin no longer repeated run and drop out after each round.

A maximal repeated run is the union of its shortest windows that still hold ``min_words`` words, taken from each of its
places on and up to each of its places. Such a window of t lines is named by its first and last 2^k lines; the suffixes
that share it are an interval of common prefixes at least t long. All windows of an interval but the first are later copies,
and their lines go. Windows have at most ``min_words`` lines, so log2(min_words) rounds do at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import integer_names, number_rows, whole_text
from tideline.session import settle

MIN_WORDS = 50

_LINE = pa.schema([("_row", pa.int64()), ("pos", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("words", pa.int64())])
_LINE_SQL = "_row long, pos long, h1 long, h2 long, words long"
LINES_AT_ONCE = 50_000


def _line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh3_128_digest

    rows, places, digests, words = [], [], [], []

    def made():
        ids = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        return pa.record_batch([rows, places, ids[:, 0], ids[:, 1], words], _LINE)

    for batch in batches:
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            lines = [line for line in text.as_py().split("\n") if line and not line.isspace()]
            rows += [row] * len(lines)
            places += range(len(lines))
            digests += [xxh3_128_digest(line.encode()) for line in lines]
            words += [len(line.split()) for line in lines]
            if len(rows) >= LINES_AT_ONCE:
                yield made()
                rows, places, digests, words = [], [], [], []
    if rows:
        yield made()


def windows(places: np.ndarray, words: np.ndarray, min_words: int) -> tuple[list[int], list[int]]:
    """(start, lines) of the shortest runs of neighbouring places with enough words, from each place and up to each."""
    found: dict[tuple[int, int], None] = {}
    breaks = np.flatnonzero(np.diff(places) != 1) + 1
    for part, own in zip(np.split(places, breaks), np.split(words, breaks), strict=True):
        upto = np.concatenate([[0], np.cumsum(own)])
        ends = np.searchsorted(upto, upto[:-1] + min_words, side="left")
        for at in np.flatnonzero(ends < len(upto)):
            found[int(part[at]), int(ends[at] - at)] = None
        begins = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1
        for at in np.flatnonzero(begins >= 0):
            found[int(part[begins[at]]), int(at + 1 - begins[at])] = None
    return [s for s, _ in found], [t for _, t in found]


def _window_frames(frames: Iterator[pd.DataFrame], min_words: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for row, lines in zip(frame["_row"], frame["lines"], strict=True):
            numbers = np.array([(x["pos"], x["words"]) for x in lines], np.int64)
            starts, sizes = windows(numbers[:, 0], numbers[:, 1], min_words)
            out.append(pd.DataFrame({"_row": np.full(len(starts), row, np.int64), "start": starts, "t": sizes}))
        if out:
            yield pd.concat(out).astype("int64")


def _rank(placed: DataFrame, by: list[str], label: str) -> DataFrame:
    """(_row, pos, name) of the places whose values in ``by`` occur more than once; other columns are kept."""
    counts = placed.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1")
    names = integer_names(counts, by, "n").select(*by, "name")
    return settle(placed.join(names, by).drop(*by), label)


def later_copies(rows: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """(_row, pos): lines of (_row, doc_id, _text) that lie in a run of at least ``min_words`` words found earlier."""
    lines = rows.select("_row", "_text").mapInArrow(_line_batches, _LINE_SQL)
    ranks = _rank(lines, ["h1", "h2"], "line-names")
    grouped = ranks.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("pos", "words"))).alias("lines"))
    found = grouped.mapInPandas(lambda f: _window_frames(f, min_words), "_row long, start long, t long")
    ids = rows.select("_row", "doc_id")
    found = settle(found.join(ids, "_row"), "line-windows")
    named, width = None, 1
    while width <= min_words:
        own = found.where((F.col("t") >= width) & (F.col("t") < 2 * width))
        first = ranks.select("_row", F.col("pos").alias("start"), F.col("name").alias("a"))
        own = own.join(first, ["_row", "start"]).withColumn("end", F.col("start") + F.col("t") - width)
        last = ranks.select("_row", F.col("pos").alias("end"), F.col("name").alias("b"))
        own = own.join(last, ["_row", "end"]).select("_row", "doc_id", "start", "t", "a", "b")
        named = own if named is None else named.unionByName(own)
        if 2 * width <= min_words:
            here = ranks.select("_row", "pos", F.col("name").alias("a"))
            next_ = ranks.select("_row", (F.col("pos") - width).alias("pos"), F.col("name").alias("b"))
            ranks = _rank(here.join(next_, ["_row", "pos"]), ["a", "b"], "line-ranks")
        width *= 2
    named = settle(named, "line-intervals")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_row", "start")
    intervals = named.groupBy("t", "a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = named.join(intervals, ["t", "a", "b"]).where(
        (F.col("_row") != F.col("first._row")) | (F.col("start") >= F.col("first.start") + F.col("t"))
    )
    spot = F.explode(F.sequence("start", F.col("start") + F.col("t") - 1)).alias("pos")
    return later.select("_row", spot).distinct()


def without_lines(text: str, gone: set[int]) -> str:
    """The text without the non-blank lines of these numbers."""
    kept, at = [], -1
    for line in text.split("\n"):
        if line and not line.isspace():
            at += 1
            if at in gone:
                continue
        kept.append(line)
    return "\n".join(kept)


def _clean_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, removed = [], []
        for text, gone in zip(batch.column("_text"), batch.column("gone"), strict=True):
            places = set(gone.as_py() or ())
            texts.append(without_lines(text.as_py(), places) if places else text.as_py())
            removed.append(len(places))
        yield pa.record_batch(
            [batch.column("_row"), batch.column("doc_id"), texts, removed],
            schema=pa.schema([("_row", pa.int64()), ("doc_id", batch.column("doc_id").type), ("text", pa.string()), ("removed", pa.int64())]),
        )


def drop_repeated_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, text without later copies, removed (lines), row_number.

    A line goes if it lies in a run of neighbouring non-blank lines with at least ``min_words`` words that stands earlier
    as well: in a document of smaller doc_id (null ids last, equal ids by row), or before it in its own document without
    overlap. Lines are equal when identical; blank lines neither count nor go. The first copy always stays whole unless
    it lies itself in a copy of something earlier. Null text counts as empty; repeated rows are documents of their own;
    an empty table gives an empty result; other columns are not read. ``docs`` is read once.
    """
    rows = settle(number_rows(docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("_text"))), "numbered-texts")
    gone = later_copies(rows, min_words=min_words).groupBy("_row").agg(F.collect_list("pos").alias("gone"))
    kind = dict(rows.dtypes)["doc_id"]
    joined = rows.join(gone, "_row", "left").select("_row", "doc_id", "_text", "gone")
    cleaned = joined.mapInArrow(_clean_batches, f"_row long, doc_id {kind}, text string, removed long")
    return cleaned.select("doc_id", "text", "removed", F.col("_row").alias("row_number"))

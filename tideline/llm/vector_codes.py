"""Vector code compression: each part of a vector becomes the index of its nearest codebook entry.

The nearest entry is found exactly by slicing and intersecting bitmasks. Per dimension of a part the entries' coordinates are
sorted, and a prefix mask (one bit per entry, uint64) tells which entries lie up to each place; the entries within a radius
of a coordinate are the difference of two prefix masks. Masks of all dimensions, ANDed, hold every entry within the radius
on each axis. The initial radius is the distance of an entry at hand, so the nearest entry is always among them, and only
the entries left are measured.

All arithmetic is on integers: a component x is floor(256 * x).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.skew import heavy_groups, sliced_join
from tideline.session import settle

SCALE = 256
PARTS = 16
ENTRIES = 64  # a mask is one uint64
ROUNDS = 2
LARGEST = 1 << 28  # of a component as an integer: squares summed over a part stay exact
ROWS_AT_ONCE = 1 << 13

Codebooks = list[np.ndarray]  # per part: entries x dimensions


# --- vectors ---------------------------------------------------------------------------------------------------------


def _whole_vectors(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their components as integers): not null, nor holding null or non-finite components."""
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null components become NaN
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(valid, np.array(column.value_lengths().fill_null(0)), 0)
    begin = np.cumsum(lengths) - lengths
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    rows = np.flatnonzero(valid & (bad[begin + lengths] == bad[begin]))
    if not len(rows):
        return rows, np.zeros((0, 0), np.int64)
    width = int(lengths[rows[0]])
    if (lengths[rows] != width).any():
        raise ValueError("the vectors differ in length")
    with np.errstate(over="ignore"):
        found = np.floor(scale * values[begin[rows][:, None] + np.arange(width)])
    if found.size and np.abs(found).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // scale}: squared distances would not be exact")
    return rows, found.astype(np.int64)


def _cut(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    if vectors.shape[1] % parts:
        raise ValueError(f"vectors of {vectors.shape[1]} components can't be cut into {parts} equal parts")
    return np.split(vectors, parts, axis=1)


# --- nearest entries -------------------------------------------------------------------------------------------------


class EntryMasks:
    """One part's entries (64 at most), sorted along each dimension, with prefix masks."""

    def __init__(self, entries: np.ndarray):
        if len(entries) > 64:
            raise ValueError("a mask holds at most 64 entries")
        self.entries = entries
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0)
        bits = np.left_shift(np.uint64(1), order.astype(np.uint64))
        none = np.zeros((1, entries.shape[1]), np.uint64)
        self.prefix = np.concatenate([none, np.bitwise_or.accumulate(bits, axis=0)])
        self.order = order

    def within(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Per point, the mask of the entries at most ``radius`` away along every dimension."""
        found = np.full(len(points), ~np.uint64(0) >> np.uint64(64 - len(self.entries)), np.uint64)
        for d in range(points.shape[1]):
            low = np.searchsorted(self.sorted[:, d], points[:, d] - radius, side="left")
            high = np.searchsorted(self.sorted[:, d], points[:, d] + radius, side="right")
            found &= self.prefix[high, d] ^ self.prefix[low, d]
        return found

    def at_hand(self, points: np.ndarray) -> np.ndarray:
        """The smallest squared distance of the entries next to each point along any dimension."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        for d in range(points.shape[1]):
            place = np.searchsorted(self.sorted[:, d], points[:, d])
            for near in (place - 1, place):
                entry = self.order[np.clip(near, 0, len(self.entries) - 1), d]
                best = np.minimum(best, ((points - self.entries[entry]) ** 2).sum(axis=1))
        return best

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each point's nearest entry; ties to the lower index."""
        if not points.shape[1]:
            return np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        radius = np.floor(np.sqrt(self.at_hand(points).astype(np.float64))).astype(np.int64) + 1
        masks = self.within(points, radius)
        bits = np.unpackbits(masks.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, entry = np.nonzero(bits)  # by row, then index; every row has one
        distance = ((points[row] - self.entries[entry]) ** 2).sum(axis=1)
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        least = np.minimum.reduceat(distance, first)
        hit = np.flatnonzero(distance == np.repeat(least, np.diff(np.append(first, len(row)))))
        own = hit[np.concatenate([[True], row[hit][1:] != row[hit][:-1]])]
        return entry[own], least


# --- codebooks -------------------------------------------------------------------------------------------------------


def _sum_batches(batches: Iterator[pa.RecordBatch], codebooks: Codebooks) -> Iterator[pa.RecordBatch]:
    """Per entry: the number of parts assigned to it and their sums. One row an entry and task."""
    masks = [EntryMasks(c) for c in codebooks]
    counts = [np.zeros(len(c), np.int64) for c in codebooks]
    sums = [np.zeros(c.shape, np.int64) for c in codebooks]
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            rows, vectors = _whole_vectors(batch.column(0).slice(at, ROWS_AT_ONCE))
            if len(rows):
                for part, points in enumerate(_cut(vectors, len(codebooks))):
                    code, _ = masks[part].nearest(points)
                    counts[part] += np.bincount(code, minlength=len(counts[part]))
                    np.add.at(sums[part], code, points)
    found = [(p, e, int(counts[p][e]), sums[p][e].tolist()) for p in range(len(codebooks)) for e in np.flatnonzero(counts[p])]
    if found:
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=["part", "entry", "n", "sums"])


def _first_codebooks(vectors: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the smallest ids (null ids take no part here); equal ids by their components."""
    known = vectors.where("id is not null").where(
        F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    first = known.orderBy("id", "vector").limit(entries).select("vector").toArrow().column(0).combine_chunks()
    rows, found = _whole_vectors(first)
    return _cut(found, parts) if len(rows) else []


def fit_codebooks(
    vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """Codebooks of (id, vector) after ``rounds`` of assigning every part and replacing each entry by its parts' floored mean.

    All vectors count in every round. Each task sums up its own; the driver gets parts x entries rows of totals.
    """
    codebooks = _first_codebooks(vectors, parts, entries)
    for _ in range(rounds if codebooks else 0):
        held = codebooks
        made = vectors.select("vector").mapInArrow(lambda b: _sum_batches(b, held), "part int, entry int, n long, sums array<long>")
        width = codebooks[0].shape[1]
        totals = made.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[d].cast("decimal(38,0)")) for d in range(width)]).alias("sums")
        )
        codebooks = [c.copy() for c in codebooks]
        for row in totals.collect():  # at most parts x entries
            codebooks[row.part][row.entry] = [int(x) // row.n for x in row.sums]
    return codebooks


def codebooks_digest(codebooks: Codebooks) -> str:
    """Lowercase hex sha256 of all components, decimal, by part, entry and place, joined by commas."""
    return sha256(",".join(str(x) for c in codebooks for x in c.reshape(-1).tolist()).encode()).hexdigest()


# --- operator --------------------------------------------------------------------------------------------------------


def _code_batches(batches: Iterator[pa.RecordBatch], codebooks: Codebooks) -> Iterator[pa.RecordBatch]:
    masks = [EntryMasks(c) for c in codebooks]
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(at, ROWS_AT_ONCE)
            rows, vectors = _whole_vectors(batch.column(2))
            if not len(rows):
                continue
            codes, error = np.zeros((len(rows), len(masks)), np.uint8), np.zeros(len(rows), np.int64)
            for part, points in enumerate(_cut(vectors, len(masks))):
                codes[:, part], distance = masks[part].nearest(points)
                error += distance
            kept = pa.array(rows)
            told = [x.tobytes() for x in codes]
            yield pa.record_batch(
                [batch.column(0).take(kept), batch.column(1).take(kept), pa.array(told, pa.binary()), pa.array(error)],
                names=["id", "label", "code", "error"],
            )


def compress(
    table: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code (one byte a part), error, label_error) per vector, and the codebooks.

    Codebooks start from the vectors with the smallest ids and are fitted on all vectors; fewer vectors than entries give
    fewer entries. ``error`` is the squared distance to what the code stands for, ``label_error`` its sum over all rows
    with that label (nulls together). Vectors that are null or hold null or non-finite components are dropped. Null ids
    keep their row but begin no entry; repeated rows are rows of their own; an empty table gives no codebooks and an empty
    result. Vectors of different lengths, or of a length that the number of parts does not divide, are an error; so are
    components beyond ``LARGEST`` as integers. Columns other than those named are not read.
    """
    vectors = table.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    codebooks = fit_codebooks(vectors.select("id", "vector"), parts=parts, entries=entries, rounds=rounds)
    kinds = dict(vectors.dtypes)
    schema = f"id {kinds['id']}, label {kinds['label']}, code binary, error long"
    if codebooks:
        coded = vectors.select("id", "label", "vector").mapInArrow(lambda b: _code_batches(b, codebooks), schema)
    else:
        coded = vectors.where("false").select("id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
    coded = settle(coded, "vector-codes")
    per_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    summed = sliced_join(
        coded, per_label.drop("n"), ["label"], heavy_left=heavy_groups(per_label, ["label"], "n"), spread_left=["id", "error"]
    )
    return summed.select(
        F.col("id").alias(vec_id), F.col("label").alias(label), "code", "error", "label_error"
    ), codebooks


def decompress(codes: Sequence[bytes], codebooks: Codebooks) -> np.ndarray:
    """The integer vectors that codes stand for."""
    index = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), len(codebooks))
    return np.concatenate([c[index[:, part]] for part, c in enumerate(codebooks)], axis=1)

"""SimHash near-dedup: fingerprints of word shingles, linked by bit-sliced comparison.

A pair within the radius r agrees on one of r + 1 slices (two at least) of the 64 bits, and the rest of its bits again on one of r + 1
sub-slices. Distinct fingerprints therefore meet under (r + 1)^2 keys of about 28 bits (r = 3); keys under which too many
meet are refined by a third cut, and what is still heavy is compared slice against slice in tasks of its own. No pair
within the radius is lost.

Fingerprints that meet are compared bit-sliced: 64 of them stand in the 64 bit planes of one word column. A query's bit is
spread over a word and xored with each plane; carry-save counters add up 64 distances at once, and a block is abandoned as
soon as all of its distances exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import number_rows, whole_text
from tideline.session import settle

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
RUN_ROWS = 2048
BITS = 64
SHINGLES_AT_ONCE = 1 << 17
WORDS_AT_ONCE = 1 << 14
ALL_ONES = np.uint64(0xFFFF_FFFF_FFFF_FFFF)

_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


# --- fingerprints ----------------------------------------------------------------------------------------------------


def _shingle_hashes(data: bytes, words: int) -> list[int]:
    from itertools import repeat

    from xxhash import xxh64_intdigest

    found = data.translate(_lowered()).split()
    if not found:
        return []
    if len(found) <= words:
        return [xxh64_intdigest(b" ".join(found), SEED)]
    shingles = zip(*(found[at:] for at in range(words)), strict=False)
    return list(map(xxh64_intdigest, map(b" ".join, shingles), repeat(SEED)))


def _lowered() -> bytes:
    """A-Z to a-z; every other byte stays. ``bytes.split`` cuts at exactly 20 and 09 to 0D."""
    return bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _bit_counts(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How often each bit is set within each document's hashes; ``ends`` are cumulative numbers of hashes."""
    sums = np.zeros((len(ends), BITS), np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[at : at + SHINGLES_AT_ONCE]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = int(np.searchsorted(ends, at, side="right"))
        last = int(np.searchsorted(ends, at + len(part), side="left"))
        starts = np.maximum(np.concatenate([[0], ends])[first : last + 1] - at, 0)
        full = np.flatnonzero(np.diff(np.append(starts, len(part))) > 0)
        sums[first + full] += np.add.reduceat(bits, starts[full], axis=0, dtype=np.int32)
    return sums


def _prints(hashes: list[int], lengths: list[int]) -> np.ndarray:
    lengths = np.array(lengths, np.int64)
    sums = _bit_counts(np.array(hashes, np.uint64), np.cumsum(lengths))
    return np.packbits(2 * sums > lengths[:, None], axis=1, bitorder="little").view(np.int64)[:, 0]


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    rows, ids, hashes, lengths = [], [], [], []

    def made():
        schema = pa.schema([("_row", pa.int64()), ("doc_id", kind), ("fingerprint", pa.int64())])
        return pa.record_batch([rows, ids, _prints(hashes, lengths)], schema)

    for batch in batches:
        kind = batch.column(1).type
        for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            found = _shingle_hashes(text.as_py(), words)
            rows.append(row)
            ids.append(doc_id)
            lengths.append(len(found))
            hashes += found
            if len(hashes) >= SHINGLES_AT_ONCE:
                yield made()
                rows, ids, hashes, lengths = [], [], [], []
    if rows:
        yield made()


def fingerprints(rows: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(_row, doc_id, fingerprint) of (_row, doc_id, _text): a bit is set if it is set in over half of the shingles' hashes."""
    data = rows.select("_row", "doc_id", F.col("_text").cast("binary"))
    kind = dict(rows.dtypes)["doc_id"]
    return data.mapInArrow(lambda b: _fingerprint_batches(b, words), f"_row long, doc_id {kind}, fingerprint long")


# --- bit-sliced comparison -------------------------------------------------------------------------------------------


def _planes(prints: np.ndarray) -> np.ndarray:
    """(64, words): bit b of 64 neighbouring fingerprints in each word of plane b."""
    padded = np.zeros(-(-len(prints) // 64) * 64, np.int64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _within(planes: np.ndarray, queries: np.ndarray, word: np.ndarray, lanes: np.ndarray, radius: int) -> np.ndarray:
    """Per (query, word of 64 fingerprints): of the given lanes, those within the radius of the query.

    Counters start so that adding one more than ``radius`` differences overflows them.
    """
    kept, near = np.arange(len(queries)), np.zeros(len(queries), np.uint64)
    width = radius.bit_length()
    start = (1 << width) - 1 - radius
    counters = [np.full(len(kept), ALL_ONES if start >> c & 1 else 0, np.uint64) for c in range(width)]
    alive = lanes.copy()
    for bit in range(BITS):
        spread = (np.uint64(0) - ((queries >> np.uint64(bit)) & np.uint64(1))).astype(np.uint64)
        carry = planes[bit][word] ^ spread
        for counter in counters:
            carry, counter[:] = counter & carry, counter ^ carry
        alive &= ~carry
        if bit % 8 == 7:
            on = alive != 0
            if not on.all():  # abandon blocks in which every distance exceeds the radius
                kept, queries, word, alive = kept[on], queries[on], word[on], alive[on]
                counters = [c[on] for c in counters]
            if not len(kept):
                break
    near[kept] = alive
    return near


def _spanning(keys: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by key: edges that connect what links within runs of equal keys, one fewer than each group."""
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(heads, len(keys)))
    keep = np.repeat(sizes > 1, sizes)
    prints, sizes = prints[keep], sizes[sizes > 1]
    if not len(prints):
        return prints, prints
    item = np.arange(len(prints))
    stop = np.repeat(np.cumsum(sizes), sizes)
    words = np.where(stop > item + 1, (stop - 1 >> 6) - (item + 1 >> 6) + 1, 0)
    planes, label = _planes(prints), item.copy()
    upto = np.cumsum(words)
    at = 0
    while at < len(prints):
        base = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, base + WORDS_AT_ONCE, side="right")))
        query = np.repeat(item[at:end], words[at:end])
        if len(query):
            begin = np.repeat(upto[at:end] - words[at:end] - base, words[at:end])
            word = (query + 1 >> 6) + np.arange(len(query)) - begin
            low = np.clip(query + 1 - 64 * word, 0, 63).astype(np.uint64)
            high = np.clip(stop[query] - 64 * word, 1, 64).astype(np.uint64)
            lanes = (ALL_ONES << low) & (ALL_ONES >> (np.uint64(64) - high))
            near = _within(planes, prints.view(np.uint64)[query], word, lanes, radius)
            hit = np.flatnonzero(near)
            if len(hit):
                bits = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                which, lane = np.nonzero(bits)
                _join(label, query[hit[which]], 64 * word[hit[which]] + lane)
        at = end
    linked = np.flatnonzero(label != item)
    return prints[label[linked]], prints[linked]


def _join(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Merge the labels of linked items: the smallest label of a group wins."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            higher = label[label]
            if (higher == label).all():
                break
            label[:] = higher


def _edge_batches(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; a run may go on in the next batch."""
    keys, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        prints = np.concatenate([prints, batch.column(1).to_numpy()])
        if len(keys) < 1 << 15:
            continue
        last = int(np.searchsorted(keys, keys[-1], side="left"))
        if last:
            yield pa.record_batch(list(_spanning(keys[:last], prints[:last], radius)), _EDGE)
            keys, prints = keys[last:], prints[last:]
    if len(keys):
        yield pa.record_batch(list(_spanning(keys, prints, radius)), _EDGE)


# --- keys ------------------------------------------------------------------------------------------------------------


def _cut(bits: Column, width: int, parts: int) -> list[tuple[Column, Column, int]]:
    """(a slice, the bits without it, their number) for each of ``parts`` slices of a number of ``width`` bits."""
    out, low = [], 0
    for at in range(parts):
        size = width // parts + (at < width % parts)
        high = low + size
        piece = F.shiftrightunsigned(bits, low).bitwiseAND(F.lit((1 << size) - 1))
        below = bits.bitwiseAND(F.lit((1 << low) - 1))
        above = F.shiftleft(F.shiftrightunsigned(bits, high), low) if high < width else F.lit(0).cast("long")
        out.append((piece, above.bitwiseOR(below), width - size))
        low = high
    return out


def _meeting_keys(prints: DataFrame, radius: int) -> DataFrame:
    """(key, fingerprint, rest, left): every pair within the radius shares a key. ``rest`` are the bits not in the key."""
    parts = max(2, radius + 1)
    found = []
    for i, (piece, rest, width) in enumerate(_cut(F.col("fingerprint"), BITS, parts)):
        for j, (inner, left, size) in enumerate(_cut(rest, width, parts)):
            found.append(F.struct(F.xxhash64(F.lit(i), F.lit(j), piece, inner).alias("key"), left.alias("rest"), F.lit(size).alias("width")))
    return prints.select("fingerprint", F.explode(F.array(*found)).alias("m")).select("m.key", "fingerprint", "m.rest", "m.width")


def _refined(met: DataFrame, radius: int) -> DataFrame:
    """The same rows under keys with one more slice of the bits left. Widths differ by one bit at most."""
    parts, cuts = max(2, radius + 1), None
    sizes = sorted({w for _, _, width in _cut(F.lit(0), BITS, parts) for _, _, w in _cut(F.lit(0), width, parts)})
    for size in sizes:
        options = F.array(
            *[F.xxhash64(F.col("key"), F.lit(s), piece) for s, (piece, _, _) in enumerate(_cut(F.col("rest"), size, parts))]
        )
        cuts = options if cuts is None else F.when(F.col("width") == size, options).otherwise(cuts)
    return met.select(F.explode(cuts).alias("key"), "fingerprint")


def _heavy(met: DataFrame, run_rows: int) -> DataFrame:
    counts = met.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > run_rows)
    return settle(counts, "heavy-keys")


def _sliced(met: DataFrame, heavy: DataFrame, run_rows: int) -> DataFrame:
    """Rows of heavy keys under pairs of slices: each slice meets itself and every other one."""
    parts = F.ceil(F.col("n") / run_rows).cast("int")
    mine = F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.col("parts")).cast("int")
    placed = met.join(heavy.select("key", parts.alias("parts")), "key").withColumn("mine", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return placed.withColumn("other", other).select(
        F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "fingerprint"
    )


def near_edges(prints: DataFrame, *, radius: int = MAX_BITS, run_rows: int = RUN_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect exactly what links within the radius connect.

    Within a key only a spanning set of edges is given, never all pairs of a group.
    """
    def compared(met: DataFrame) -> DataFrame:
        laid = met.select("key", "fingerprint").repartition("key").sortWithinPartitions("key", "fingerprint")
        return laid.mapInArrow(lambda b: _edge_batches(b, radius), "a long, b long")

    met = _meeting_keys(prints, radius)
    heavy = _heavy(met, run_rows)
    if heavy.isEmpty():
        return compared(met).distinct()
    light = compared(met.join(heavy, "key", "left_anti"))
    finer = _refined(met.join(heavy, "key", "left_semi"), radius)
    hot = _heavy(finer, run_rows)
    light = light.unionByName(compared(finer.join(hot, "key", "left_anti")))
    return light.unionByName(compared(_sliced(finer, hot, run_rows))).distinct()


# --- components ------------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component, for every node that has an edge.

    Alternating large and small stars: nodes hook onto the smallest neighbour until every component is one star. A
    node's neighbours are never gathered; its smallest one is aggregated and joined back.
    """
    def stars(pairs: DataFrame, small: bool) -> DataFrame:
        both = pairs if small else pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        joined = both.join(least, "a")
        if small:  # rows are (larger a, smaller b): both go to the smallest
            out = joined.select(F.explode(F.array(F.struct(F.col("b").alias("x")), F.struct(F.col("a").alias("x")))).alias("s"), "m")
            out = out.select(F.col("s.x").alias("a"), F.col("m").alias("b"))
        else:  # larger neighbours go to the smallest
            out = joined.where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        return out.where("a <> b").distinct()

    pairs = settle(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    mark = None
    while True:
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = now
        pairs = settle(stars(stars(pairs, small=False), small=True), "edges")


# --- operator --------------------------------------------------------------------------------------------------------


def near_groups(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    row: str | None = None,
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, kept, row_number.

    ``component_id`` is the smallest doc_id reachable over links of at most ``max_bits`` differing bits, itself included;
    null ids are passed over, and a component with null ids only has none. ``kept`` is true for one row of each
    component: the smallest doc_id, of equal ids the first row. A text without words has fingerprint zero and links
    like any other; null text counts as empty. Repeated rows are rows of their own; an empty table gives an empty
    result. Other columns are not read. ``docs`` is read once; ``row`` names its row numbers, if it has them.
    """
    rows = (docs.withColumnRenamed(row, "_row") if row else number_rows(docs.select(doc_id, text))).select(
        "_row", F.col(doc_id).alias("doc_id"), whole_text(text).alias("_text")
    )
    named = settle(fingerprints(rows, words), "fingerprints")
    prints = named.groupBy("fingerprint").agg(F.lit(1).alias("one")).select("fingerprint")
    roots = components(near_edges(prints, radius=max_bits, run_rows=run_rows))
    rooted = prints.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root")
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_row"))
    per_print = named.groupBy("fingerprint").agg(first.alias("first"))
    per_root = rooted.join(per_print, "fingerprint")
    best = per_root.groupBy("root").agg(F.min("first").alias("best"))
    told = per_root.select("fingerprint", "root").join(best, "root").select("fingerprint", "best")
    return named.join(told, "fingerprint").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"),
        (F.col("_row") == F.col("best._row")).alias("kept"),
        F.col("_row").alias("row_number"),
    )


def drop_near_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents with one left of each component of ``near_groups``, with all their columns."""
    numbered = settle(number_rows(docs, "_near_row"), "numbered-docs")
    dropped = near_groups(numbered, doc_id=doc_id, text=text, row="_near_row", **how).where("not kept")
    return numbered.join(dropped.select(F.col("row_number").alias("_near_row")), "_near_row", "left_anti").select(*docs.columns)

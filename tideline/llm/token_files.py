"""Token files: canonical, length-limited Huffman code, decoded by table in independent blocks.

A token store is a folder with two tables. ``code`` holds one row per id in use: its code length; the codes follow from
the lengths (canonical: ascending by length, then id), and no code is longer than 16 bits. ``ids`` holds the segments:

    part, segment   place in the order of documents
    doc_ids         the segment's documents, ascending
    lengths         their numbers of ids
    n_ids           their sum
    bits            the codes of all ids, first bit first, padded to whole bytes and three more
    checkpoints     the bit at which each block of 256 ids begins

A block can be decoded alone from its checkpoint; all blocks of a segment are decoded side by side.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.common import whole_text
from tideline.llm.tokens import END_ID, encoder, slices
from tideline.session import settle

MAX_BITS = 16
BLOCK_IDS = 256
RUN_IDS = 64 * BLOCK_IDS
SEGMENT_IDS = 1 << 17

_STAGED = pa.schema(
    [("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("ids", pa.binary()),
     ("counts", pa.binary())]  # a task's last row, without a segment, tells how often it met each id
)
_STAGED_SQL = "segment int, doc_ids array<long>, lengths array<long>, ids binary, counts binary"
_SEGMENT = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
     ("n_ids", pa.int64()), ("bits", pa.binary()), ("checkpoints", pa.list_(pa.int64()))]
)
_SEGMENT_SQL = "part int, segment int, doc_ids array<long>, lengths array<long>, n_ids long, bits binary, checkpoints array<long>"
_DOCUMENT = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()),
     ("ids", pa.binary()), ("ids_crc32", pa.int64())]
)
_DOCUMENT_SQL = "part int, segment int, doc_id long, before long, n_tokens long, ids binary, ids_crc32 long"


# --- the code ----------------------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); zero for ids that do not occur."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) > 1 << limit:
        raise ValueError("more ids than codes of that length")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.lexsort((used, counts[used]))]
    leaves = counts[order].astype(np.float64)
    merged, is_leaf = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by_weight = np.argsort(both, kind="stable")
        merged = both[by_weight]
        is_leaf.append(by_weight < len(leaves))
    taken, depth = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for level in reversed(is_leaf):
        of_leaves = int(level[:taken].sum())
        depth[:of_leaves] += 1
        taken = 2 * (taken - of_leaves)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: ascending by length, then id."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    width = int(lengths.max()) if len(used) else 0
    steps = 1 << (width - lengths[order].astype(np.int64))
    codes = np.zeros(len(lengths), np.uint32)
    codes[order] = (np.cumsum(steps) - steps) >> (width - lengths[order].astype(np.int64))
    return codes


def decoding_table(lengths: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """For each ``limit`` next bits: id * 32 + length of the code that they begin with."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    own = order.astype(np.int64) * 32 + lengths[order]
    table = np.zeros(1 << limit, np.int64)
    filled = np.repeat(own, 1 << (limit - lengths[order].astype(np.int64)))
    table[: len(filled)] = filled
    return table


def encode_ids(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits and the blocks' checkpoints. Runs of ids are laid one after the other: their arrays stay in the cache."""
    sizes = lengths[ids]
    total = int(sizes.sum(dtype=np.int64))
    words = np.zeros((total >> 5) + 3, np.uint32)
    checkpoints, base = [np.zeros(0, np.int64)], 0
    for start in range(0, len(ids), RUN_IDS):
        size = sizes[start : start + RUN_IDS].astype(np.int64)
        end = np.cumsum(size) + base
        begin = end - size
        base = int(end[-1])
        checkpoints.append(begin[::BLOCK_IDS])
        at = begin >> 5
        window = codes[ids[start : start + RUN_IDS]].astype(np.uint64) << (64 - (begin & 31) - size).view(np.uint64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        sums = np.add.reduceat(window, first)  # codes do not overlap: adding is or-ing
        place = at[first]
        words[place] += (sums >> np.uint64(32)).astype(np.uint32)
        words[place + 1] += sums.astype(np.uint32)
    return words.astype(">u4").tobytes()[: (total + 7) // 8 + 3], np.concatenate(checkpoints)


def decode_ids(bits: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """All blocks side by side: the k-th id of every block in step k."""
    if not n:
        return np.zeros(0, "<u4")
    data = np.frombuffer(bits, np.uint8).astype(np.int32)
    windows = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    at = np.array(checkpoints, np.int64)
    out = np.zeros((len(at), BLOCK_IDS), "<u4")
    last = n - (len(at) - 1) * BLOCK_IDS
    mask = (1 << limit) - 1
    for step in range(min(n, BLOCK_IDS)):
        if step == last and len(at) > 1:
            at = at[:-1]
        found = table[windows[at >> 3] >> (24 - limit - (at & 7)) & mask]
        out[: len(at), step] = found >> 5
        at = at + (found & 31)
    return out.reshape(-1)[:n]


# --- writing -----------------------------------------------------------------------------------------------------------


def _staged_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    words, end = encoder(path), np.array([end_id], "<u4").tobytes()
    segment, docs, lengths, ids, held = 0, [], [], [], 0
    counts = np.zeros(0, np.int64)

    def made() -> pa.RecordBatch:
        nonlocal counts
        whole = np.frombuffer(b"".join(ids), "<u4")
        own = np.bincount(whole)
        counts = _added(counts, own)
        stored = whole.astype("<u2") if len(own) <= 1 << 16 else whole  # half the bytes to pack, unpack and hand over
        return pa.record_batch([[segment], [docs], [lengths], [stored.tobytes()], pa.nulls(1, pa.binary())], _STAGED)

    for whole in batches:
        for batch in slices(whole, 1):
            for doc_id, found in zip(batch.column(0).to_pylist(), words.encode(batch.column(1).to_pylist()), strict=True):
                docs.append(doc_id)
                lengths.append(len(found) // 4 + 1)
                ids += [found, end]
                held += lengths[-1]
                if held >= SEGMENT_IDS:
                    yield made()
                    segment, docs, lengths, ids, held = segment + 1, [], [], [], 0
    if docs:
        yield made()
    if len(counts):
        yield pa.record_batch([pa.nulls(1, pa.int32()), [None], [None], [None], [counts.astype("<i8").tobytes()]], _STAGED)


def _added(counts: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The sum of two lists of counts by id, as long as the longer one."""
    longer, other = (own, counts) if len(own) > len(counts) else (counts, own)
    longer[: len(other)] += other
    return longer


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        for own in batch.column(0):
            counts = _added(counts, np.frombuffer(own.as_py(), "<i8").copy())
    used = np.flatnonzero(counts)
    yield pa.record_batch([used, counts[used]], names=["id", "n"])


def _segment_batches(batches: Iterator[pa.RecordBatch], lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    codes = canonical_codes(lengths)
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], f"<u{len(row['ids']) // sum(row['lengths'])}")
            bits, checkpoints = encode_ids(ids, lengths, codes)
            yield pa.record_batch(
                [[row["part"]], [row["segment"]], [row["doc_ids"]], [row["lengths"]], [len(ids)], [bits], [checkpoints]], _SEGMENT
            )


def write_token_files(
    docs: DataFrame, path: str, *, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> None:
    """Encode every whole text, append ``end_id`` to each document, and write the ids in ascending order of doc_id.

    Null text counts as empty and gives the end id alone; null ids come first; of equal ids the order follows the text's
    hash. Repeated rows are written each. Other columns are not read. An empty table gives an empty store. The ids are
    integers; ``tokenizer`` is a tokenizers file that every executor can read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("_text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("_text")]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = settle(
        laid.mapInArrow(lambda b: _staged_batches(b, tokenizer, end_id), _STAGED_SQL).withColumn("part", F.spark_partition_id()),
        "staged-ids",
    )
    told = staged.where("counts is not null").select("counts")
    counted = told.mapInArrow(_count_batches, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counted.collect()  # at most one row per id of the vocabulary
    counts = np.zeros(max((r.id for r in found), default=-1) + 1, np.int64)
    for r in found:
        counts[r.id] = r.n
    lengths = code_lengths(counts)
    spark = docs.sparkSession
    code = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(code, "id long, length int").coalesce(1).write.parquet(f"{path}/code")
    segments = staged.where("segment is not null").drop("counts")
    segments.mapInArrow(lambda b: _segment_batches(b, lengths), _SEGMENT_SQL).write.option("compression", "none").parquet(f"{path}/ids")


# --- reading -----------------------------------------------------------------------------------------------------------


def _document_batches(batches: Iterator[pa.RecordBatch], lengths: np.ndarray, with_ids: bool) -> Iterator[pa.RecordBatch]:
    table = decoding_table(lengths)
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_ids(row["bits"], row["checkpoints"], row["n_ids"], table).tobytes()
            sizes = np.array(row["lengths"], np.int64)
            before = np.cumsum(sizes) - sizes
            own = [ids[4 * b : 4 * (b + n)] for b, n in zip(before.tolist(), row["lengths"], strict=True)]
            n = len(own)
            told = own if with_ids else pa.nulls(n, pa.binary())
            yield pa.record_batch(
                [[row["part"]] * n, [row["segment"]] * n, row["doc_ids"], before, sizes, told, [zlib.crc32(x) for x in own]], _DOCUMENT
            )


def read_token_files(spark: SparkSession, path: str, *, with_ids: bool = True) -> DataFrame:
    """Documents of a token store, decoded: doc_id, start (ids of all documents before it), n_tokens, ids, ids_crc32.

    Every id is decoded either way; without ``with_ids`` the column ``ids`` is null and only the checksum tells them.
    """
    code = spark.read.schema("id long, length int").parquet(f"{path}/code").collect()  # one row per id of the vocabulary
    lengths = np.zeros(max((r.id for r in code), default=-1) + 1, np.uint8)
    for r in code:
        lengths[r.id] = r.length
    segments = spark.read.schema(_SEGMENT_SQL).parquet(f"{path}/ids")
    sizes = segments.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn(
        "base", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row per partition
    )
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.withColumn("within", within).join(parts, "part").select(
        "part", "segment", (F.coalesce("base", F.lit(0)) + F.coalesce("within", F.lit(0))).alias("base")
    )
    documents = segments.mapInArrow(lambda b: _document_batches(b, lengths, with_ids), _DOCUMENT_SQL)
    return documents.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids", "ids_crc32"
    )

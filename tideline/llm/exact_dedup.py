"""Exact dedup by deterministic block naming.

Each text is cut into blocks of a fixed size. All distinct blocks are sorted into integer names, a document becomes the
sequence of its names, and adjacent pairs of names are named again until one name is left. Equal names at the end mean
equal texts: names come from sorting, no hash decides.

A document that holds a block or pair that occurs nowhere else already has an identity of its own, and takes no part in
further rounds. So the rounds after the first work on copies only.

Blocks travel once. Every chunk of documents (at most ``CHUNK_BYTES`` of text) sends each of its distinct blocks with a
local number; what comes back is the name per local number. A passage that fills a third of the table is therefore one
row per chunk, not one per copy. Which documents share a chunk depends on how the scan is cut, so one pass gives the blocks
and the documents as numbers, and is settled.
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

BLOCK_BYTES = 1024
CHUNK_BYTES = 8 << 20

_BLOCK = [("chunk", pa.int64()), ("local", pa.int32()), ("n", pa.int64()), ("block", pa.binary())]
_DOCUMENT = [("_row", pa.int64()), ("locals", pa.binary()), ("text_sha256", pa.string())]
_CHUNK_SQL = "chunk long, local int, n long, block binary, _row long, locals binary, text_sha256 string"


def _chunk_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Number the distinct blocks of each chunk; emit the numbered blocks (without ``_row``), then the documents as numbers."""
    chunk, held, numbers, counts, rows, sequences, hashes, ids = None, 0, {}, [], [], [], [], []

    def emitted():
        schema = pa.schema([*_BLOCK, *_DOCUMENT, ("doc_id", kind)])
        names = list(numbers)
        step = max(1, (8 << 20) // size)
        for at in range(0, len(names), step):
            part = names[at : at + step]
            local = np.arange(at, at + len(part), dtype=np.int32)
            own = [np.full(len(part), chunk), local, np.array(counts[at : at + len(part)], np.int64), part]
            yield pa.record_batch([*own, *([None] * len(part) for _ in range(4))], schema)
        none = [None] * len(rows)
        yield pa.record_batch([np.full(len(rows), chunk), none, none, none, rows, sequences, hashes, ids], schema)

    for batch in batches:
        kind = batch.column("doc_id").type
        columns = [batch.column(c).to_pylist() for c in ("_row", "doc_id", "text_sha256")]
        for row, doc_id, sha256, text in zip(*columns, batch.column("_text"), strict=True):
            data = text.as_py()
            if chunk is None or held + len(data) > CHUNK_BYTES:
                if chunk is not None:
                    yield from emitted()
                chunk, held, numbers, counts, rows, sequences, hashes, ids = row, 0, {}, [], [], [], [], []
            held += len(data)
            found = []
            for at in range(0, max(1, len(data)), size):
                block = data[at : at + size]
                number = numbers.setdefault(block, len(counts))
                if number == len(counts):
                    counts.append(0)
                counts[number] += 1
                found.append(number)
            rows.append(row)
            sequences.append(np.array(found, np.int32).tobytes())
            hashes.append(sha256)
            ids.append(doc_id)
    if chunk is not None:
        yield from emitted()


def _replace(sequences: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
    """A chunk's documents with names for local numbers, and whether one of them occurs nowhere else."""
    if sequences.empty:
        return pd.DataFrame({"_row": [], "names": [], "alone": []})
    name, total = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    name[names["local"].to_numpy()] = names["name"].to_numpy()
    total[names["local"].to_numpy()] = names["total"].to_numpy()
    found = [np.frombuffer(s, np.int32) for s in sequences["locals"]]
    return pd.DataFrame(
        {
            "_row": sequences["_row"].to_numpy(),
            "names": [name[f] for f in found],
            "alone": [bool((total[f] == 1).any()) for f in found],
        }
    )


def _chunks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """The blocks and the documents (rows with a ``_row``) of (_row, doc_id, _text), settled in one pass."""
    kind = dict(rows.dtypes)["doc_id"]
    hashed = rows.select("_row", "doc_id", "_text", F.sha2("_text", 256).alias("text_sha256"))
    return settle(hashed.mapInArrow(lambda b: _chunk_batches(b, block_bytes), f"{_CHUNK_SQL}, doc_id {kind}"), "chunks")


def _first_names(chunks: DataFrame) -> DataFrame:
    """(_row, names, alone): each document as the sequence of its blocks' names."""
    blocks = chunks.where("_row is null").select("chunk", "local", "n", "block")
    sequences = chunks.where("_row is not null").select("chunk", "_row", "locals")
    names = integer_names(blocks, ["block"], "n").select("chunk", "local", "name", "total")
    return (
        sequences.groupBy("chunk")
        .cogroup(names.groupBy("chunk"))
        .applyInPandas(_replace, "_row long, names array<long>, alone boolean")
    )


def _next_names(state: DataFrame) -> DataFrame:
    """One round: adjacent pairs of names get names; an odd last name is paired with none (-1)."""
    pairs = F.expr(
        "transform(sequence(0, size(names) - 1, 2), i -> struct(i as pos, names[i] as a, coalesce(get(names, i + 1), -1L) as b))"
    )
    placed = state.select("_row", F.explode(pairs).alias("p")).select("_row", "p.pos", "p.a", "p.b")
    named = integer_names(placed.groupBy("a", "b").agg(F.count("*").alias("n")), ["a", "b"], "n")
    back = placed.join(named.select("a", "b", "name", "total"), ["a", "b"])
    return back.groupBy("_row").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("names"),
        (F.min("total") == 1).alias("alone"),
    )


def _finished(state: DataFrame) -> DataFrame:
    return state.where("not alone and size(names) = 1").select("_row", "blocks", F.col("names")[0].alias("name"))


def _open(state: DataFrame) -> DataFrame:
    return state.where("not alone and size(names) > 1").select("_row", "blocks", "names")


def shared_identities(chunks: DataFrame) -> DataFrame:
    """(_row, blocks, name) of the documents of ``_chunks`` that no block told apart from all others.

    Equal (blocks, name) mean equal texts; a row that is missing here has a text of its own.
    """
    first = _first_names(chunks).withColumn("blocks", F.size("names"))
    state = settle(first, "block-names")
    done, state = _finished(state), _open(state)
    width = state.agg(F.max("blocks")).first()[0] or 1
    while width > 1:
        state = settle(_next_names(state).join(state.select("_row", "blocks"), "_row"), "pair-names")
        done, state, width = done.unionByName(_finished(state)), _open(state), (width + 1) // 2
    return done


def exact_groups(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", row: str | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row_number.

    Of equal texts the row with the largest doc_id stays (null ids come last; of equal ids the first row stays), and
    ``kept`` is true for exactly one row of each group. Null text counts as empty. Repeated rows are rows of their own.
    An empty table gives an empty result. Other columns of ``docs`` are not read. ``docs`` is read once; ``row`` names
    its row numbers, if it has them (see ``number_rows``).
    """
    rows = (docs.withColumnRenamed(row, "_row") if row else number_rows(docs.select(doc_id, text))).select(
        "_row", F.col(doc_id).alias("doc_id"), whole_text(text).cast("binary").alias("_text")
    )
    chunks = _chunks(rows, block_bytes)
    shared = shared_identities(chunks)
    ids = chunks.where("_row is not null").select("_row", "doc_id", "text_sha256")
    members = shared.join(ids.select("_row", F.col("doc_id").alias("_id")), "_row")
    best = F.max(F.struct(F.col("_id").isNotNull().alias("known"), "_id", (-F.col("_row")).alias("first")))
    groups = members.groupBy("blocks", "name").agg(best.alias("best"), F.count("*").alias("group_size"))
    found = members.join(groups, ["blocks", "name"]).select(
        "_row", F.col("best._id").alias("keep_id"), "group_size", (F.col("_row") == -F.col("best.first")).alias("kept")
    )
    grouped = F.col("group_size").isNotNull()
    return ids.join(found, "_row", "left").select(
        "doc_id",
        F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
        "text_sha256",
        F.col("_row").alias("row_number"),
    )


def drop_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without their exact copies, with all their columns; rules as in ``exact_groups``.

    The numbers of the rows that go are hashed per partition, so the rows with their texts are neither sorted nor held.
    """
    numbered = settle(number_rows(docs, "_copy_row"), "numbered-docs")
    dropped = exact_groups(numbered, doc_id=doc_id, text=text, row="_copy_row").where("not kept")
    gone = dropped.select(F.col("row_number").alias("_copy_row")).hint("shuffle_hash")
    return numbered.join(gone, "_copy_row", "left_anti").select(*docs.columns)

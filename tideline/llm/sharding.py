"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows lie in partitions. How many rows of partition p go to shard s is drawn first, for all (p, s), with exactly the
distribution a uniform permutation of all rows would give: the partitions are halved again and again, and each half draws
its share of every shard's seats from a multivariate hypergeometric law. Each partition then permutes its rows and deals
them out by its row of the matrix, and each shard permutes what it gets. Sizes differ by one row at most and are exact
before any row moves; nothing is ever sorted or numbered over the whole table.

Only DataFrame functions are used. Randomness is a hash of (seed, row number), so a lost task deals its rows out alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import number_rows
from tideline.session import settle

PARTITIONS = 256
SLOT_BUCKETS = 1024
ROW_BYTES = 16


def _uniform(*of) -> Column:
    """In (0, 1), from a hash: 53 bits."""
    return (F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") + 0.5) * F.lit(2.0**-53)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` rows are marked, by inversion of the distribution function at ``u``.

    Probabilities follow from each other by exact ratios; beyond ten standard deviations (and ten) they are below
    what a double can tell from zero.
    """
    N, K, n = (c.cast("double") for c in (total, marked, drawn))
    mean = n * K / N
    spread = 10 * F.sqrt(mean * (1 - K / N) * (N - n) / F.greatest(N - 1, F.lit(1.0))) + 10
    first = F.greatest(F.lit(0.0), n + K - N, F.floor(mean - spread).cast("double")).cast("long")
    last = F.least(n, K, F.ceil(mean + spread).cast("double")).cast("long")
    values = F.sequence(first, last)

    def ratio(k: Column) -> Column:
        k = k.cast("double")
        return (K - k) * (n - k) / ((k + 1) * (N - K - n + k + 1))

    weight = F.aggregate(
        values,
        F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")),
        lambda s, k: F.struct((s["w"] * ratio(k)).alias("w"), (s["sum"] + s["w"]).alias("sum")),
        lambda s: s["sum"],
    )
    found = F.aggregate(
        values,
        F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), first.alias("k"), (u * weight).alias("goal")),
        lambda s, k: F.struct(
            (s["w"] * ratio(k)).alias("w"),
            (s["sum"] + s["w"]).alias("sum"),
            (s["k"] + F.when(s["sum"] + s["w"] < s["goal"], 1).otherwise(0).cast("long")).alias("k"),
            s["goal"].alias("goal"),
        ),
        lambda s: F.least(s["k"], last),
    )
    return F.when(N > 0, found).otherwise(F.lit(0).cast("long"))


def _share(seats: Column, drawn: Column, *of) -> Column:
    """Seats of each shard that go to a group of ``drawn`` rows: multivariate hypergeometric, shard by shard."""
    start = F.struct(
        F.aggregate(seats, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
        drawn.alias("open"),
        F.array().cast("array<long>").alias("out"),
    )

    def step(state: Column, own: Column) -> Column:
        shard = F.size(state["out"])
        won = F.array(hypergeometric(state["total"], own, state["open"], _uniform(*of, shard)))
        # the draw is held in an array so that it is evaluated once
        return F.transform(
            won,
            lambda x: F.struct(
                (state["total"] - own).alias("total"),
                (state["open"] - x).alias("open"),
                F.concat(state["out"], F.array(x)).alias("out"),
            ),
        )[0]

    return F.aggregate(seats, start, step, lambda s: s["out"])


def communication_matrix(counts: DataFrame, *, shards: int, partitions: int = PARTITIONS, seed: int = 0) -> DataFrame:
    """(part, ends): for each partition the running sums over shards of its row of the matrix.

    ``counts`` is (part, n), at most ``partitions`` rows, a power of two; partitions without rows may be missing.
    """
    if partitions & (partitions - 1):
        raise ValueError("partitions must be a power of two")
    listed = F.map_from_entries(F.collect_list(F.struct("part", "n")))
    sizes = F.transform(
        F.sequence(F.lit(0), F.lit(partitions - 1)),
        lambda p: F.coalesce(F.try_element_at(F.col("listed"), p), F.lit(0).cast("long")),
    )
    all_rows = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    seats = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.expr("rows div " + str(shards)) + F.when(s < F.col("rows") % shards, 1).otherwise(0).cast("long"),
    )
    nodes = counts.agg(listed.alias("listed")).select(sizes.alias("sizes")).withColumn("rows", all_rows)
    nodes = nodes.select(F.lit(0).alias("part"), "sizes", seats.alias("seats"))
    width = partitions
    while width > 1:
        width //= 2
        left = F.slice("sizes", 1, width)
        rows = F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x)
        drawn = nodes.withColumn("won", _share(F.col("seats"), rows, F.lit(seed), F.lit(width), F.col("part")))
        rest = F.zip_with("seats", "won", lambda a, b: a - b)
        halves = F.array(
            F.struct(F.col("part"), left.alias("sizes"), F.col("won").alias("seats")),
            F.struct((F.col("part") + width).alias("part"), F.slice("sizes", width + 1, width).alias("sizes"), rest.alias("seats")),
        )
        nodes = drawn.select(F.explode(halves).alias("h")).select("h.*")
    ends = F.aggregate(
        "seats",
        F.array().cast("array<long>"),
        lambda a, x: F.concat(a, F.array(x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast("long")))),
    )
    return nodes.select("part", ends.alias("ends"))


def shard_rows(
    docs: DataFrame,
    *,
    shards: int,
    doc_id: str = "doc_id",
    text: str = "text",
    partitions: int = PARTITIONS,
    seed: int = 0,
    row: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, row_number.

    Every assignment of rows to shards and slots with these sizes is equally likely; shard sizes differ by one row at
    most, slots run from 0 without gaps. ``size`` is the text's UTF-8 bytes plus 16, null text counts none; its crc32 is
    that of no bytes. Equal texts, repeated rows and null ids are rows like any other: rows are dealt out by their
    number. An empty table gives an empty result. Other columns are not read. ``docs`` is a stored table; ``row`` names
    its row numbers, if it has them.
    """
    rows = docs.withColumnRenamed(row, "_row") if row else number_rows(docs.select(doc_id, text))
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    placed = settle(
        rows.select(
            "_row",
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(data).cast("long") + ROW_BYTES).alias("size"),
            F.crc32(data).alias("text_crc32"),
            F.pmod(F.xxhash64(F.lit(seed), F.lit("part"), "_row"), F.lit(partitions)).cast("int").alias("part"),
        ),
        "shard-rows",
    )
    matrix = settle(
        communication_matrix(placed.groupBy("part").agg(F.count("*").alias("n")), shards=shards, partitions=partitions, seed=seed),
        "shard-matrix",
    )
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), F.lit("deal"), "_row"), "_row"))
    order = F.xxhash64(F.lit(seed), F.lit("slot"), "_row")
    dealt = settle(
        placed.withColumn("rank", rank)
        .join(F.broadcast(matrix), "part")  # partitions x shards numbers
        .withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("rank"))))
        .select(
            "_row", "doc_id", "size", "text_crc32", "shard", order.alias("order"),
            F.shiftrightunsigned(order, 64 - SLOT_BUCKETS.bit_length() + 1).cast("int").alias("bucket"),
        ),
        "dealt-rows",
    )
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    )
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("order", "_row"))
    return (
        dealt.withColumn("within", within)
        .join(F.broadcast(offsets), ["shard", "bucket"])  # shards x SLOT_BUCKETS rows
        .select(
            "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("within") - 1).cast("long").alias("slot"),
            F.col("_row").alias("row_number"),
        )
    )

"""MinHash near-dedup with HyperMinHash registers.

A document's set holds its distinct word shingles as 64-bit hashes. The first bits of a hash choose one of 128 buckets; of the
least hash in a bucket its register stores the number of leading zeros and the ten bits that follow the first one: 16 bits
in place of 64. Two documents agree in a register with a probability that is their similarity (a little more: equal
registers of unequal hashes, which the estimate takes off).

Registers are banded by four. Documents that share a band are candidates: at a similarity of 0.85 a pair misses all 32 bands
with probability 6e-11. Candidates are dropped only if the estimate lies six standard deviations below the threshold; all
others are confirmed on their full sets.

Copies are one set. Within a band no more pairs are checked than needed. First each document is confirmed with the one that
shares most bands with others, if they have a quarter of all bands in common. Of the components so found, those that the estimate cannot tell apart form clusters; a
band gives only as many ties as join them, never its pairs. In a cluster every document stands once, and all of its pairs
that are not of one component are confirmed at once, as a product of matrices of documents and shared shingles. A band that
very many share is refined by a second band (a pair that shares one band only: 2e-9), and beyond that cut into slices that
meet pairwise, as are large clusters.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import whole_text
from tideline.llm.simhash import _join as merge_labels
from tideline.llm.simhash import components
from tideline.operators.skew import heavy_groups, sliced_join
from tideline.session import settle

SHINGLE_WORDS = 5
SIMILARITY = 85  # in hundredths
SEED = 42
BUCKET_BITS = 7
MANTISSA_BITS = 10
REGISTERS = 1 << BUCKET_BITS
BAND = 4
STAR_BANDS = 8  # of 32: at a similarity of 0.85 a pair shares 17 on average, at 0.6 four
EMPTY = 0xFFFF
DEVIATIONS = 6.0
RUN_ROWS = 2048
SLICE_HASHES = 1 << 20
COLUMNS_AT_ONCE = 4096
MIN_SLICE = 4096
CELLS_AT_ONCE = 1 << 22

_LOWERED = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BELOW_BUCKET = 64 - BUCKET_BITS


# --- sets and registers ----------------------------------------------------------------------------------------------


def shingle_set(data: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles' hashes, ascending. Fewer words than a shingle make one; no words, none."""
    from itertools import repeat

    from xxhash import xxh64_intdigest

    found = data.translate(_LOWERED).split()  # A-Z to a-z; cut at exactly 20 and 09 to 0D
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) <= words:
        return np.array([xxh64_intdigest(b" ".join(found), SEED)], np.uint64)
    shingles = map(b" ".join, zip(*(found[at:] for at in range(words)), strict=False))
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(found) - words + 1)
    hashes.sort()
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])]


_BUCKETS = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(_BELOW_BUCKET)


def _least(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the least hash of each bucket, without the bucket's bits; whether the bucket holds any) of ascending hashes."""
    first = np.searchsorted(hashes, _BUCKETS)
    held = np.diff(np.append(first, len(hashes))) > 0
    least = np.zeros(REGISTERS, np.uint64)
    least[held] = hashes[first[held]] & np.uint64((1 << _BELOW_BUCKET) - 1)
    return least, held


def _registers(least: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa in 16 bits; ``EMPTY`` for buckets that hold nothing."""
    alone = least & ~(least >> np.uint64(1))  # has the same first one, and does not round up as a float
    length = np.frexp(alone.astype(np.float64))[1].astype(np.int64)
    aligned = least << (_BELOW_BUCKET - length).astype(np.uint64)
    mantissa = (aligned >> np.uint64(_BELOW_BUCKET - 1 - MANTISSA_BITS)) & np.uint64((1 << MANTISSA_BITS) - 1)
    code = (_BELOW_BUCKET - length) << MANTISSA_BITS | mantissa.astype(np.int64)
    return np.where(held, code, EMPTY).astype("<u2")


def _set_batches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            sizes, digests, least, held = [], [], [], []
            for text in batch.column(2):
                hashes = shingle_set(text.as_py(), words)
                sizes.append(len(hashes))
                digests.append(blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
                own = _least(hashes)
                least.append(own[0])
                held.append(own[1])
            registers = _registers(np.array(least), np.array(held))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array([r.tobytes() for r in registers], pa.binary())],
                names=["doc_id", "text_key", "n", "digest", "registers"],
            )


# --- estimate --------------------------------------------------------------------------------------------------------


def _may_link(equal: np.ndarray, either: np.ndarray, n: np.ndarray, m: np.ndarray, hundredths: int) -> np.ndarray:
    """Whether a pair may reach the similarity: ``equal`` of the registers that ``either`` set fills agree; sizes n and m.

    The expected number of equal registers of unequal hashes is taken off; it is largest for sets of equal size.
    """
    least = hundredths / 100
    small, large = np.minimum(n, m), np.maximum(n, m)
    share = 4 * (large / small) / (1 + large / small) ** 2
    collisions = 0.169919487159739 * REGISTERS / (1 << MANTISSA_BITS) * share
    estimate = (equal - collisions) / either
    margin = DEVIATIONS * np.sqrt(least * (1 - least) / either)
    return (100 * small >= hundredths * large) & (estimate >= least - margin)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, REGISTERS)


def _likely_batches(batches: Iterator[pa.RecordBatch], hundredths: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = _matrix(batch.column(2)), _matrix(batch.column(4))
        filled, other = left != EMPTY, right != EMPTY
        equal, either = ((left == right) & filled).sum(axis=1), (filled | other).sum(axis=1)
        kept = _may_link(equal, either, batch.column(3).to_numpy(), batch.column(5).to_numpy(), hundredths)
        yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(kept))


def _ties(group: np.ndarray, registers: np.ndarray, sizes: np.ndarray, hundredths: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of groups that tie together what may link across groups: one fewer than each tied lot of groups.

    Rows of the largest group are not compared with one another.
    """
    names, of, counts = np.unique(group, return_inverse=True, return_counts=True)
    rest = np.flatnonzero(of != counts.argmax())
    filled, label = registers != EMPTY, np.arange(len(names))
    step = max(1, CELLS_AT_ONCE // (len(group) * REGISTERS))
    for at in range(0, len(rest), step):
        rows = rest[at : at + step]
        equal = ((registers[rows][:, None] == registers[None]) & filled[None]).sum(axis=2)
        either = (filled[rows][:, None] | filled[None]).sum(axis=2)
        may = _may_link(equal, either, sizes[rows][:, None], sizes[None], hundredths) & (of[rows][:, None] != of[None])
        i, j = np.nonzero(may)
        merge_labels(label, of[rows[i]], of[j])
    tied = np.flatnonzero(label != np.arange(len(names)))
    return names[label[tied]], names[tied]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows come sorted by their first column; every run of equal values as a table of its own."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        if held and held[-1].column(0)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        heads = np.append(np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])), len(keys))
        for begin, end in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
            held.append(batch.slice(begin, end - begin))
            if end < len(keys):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _tie_batches(batches: Iterator[pa.RecordBatch], hundredths: int) -> Iterator[pa.RecordBatch]:
    for run in _runs(batches):
        if run.num_rows > 1:
            group = np.array(run.column("root").to_pylist(), object)
            a, b = _ties(group, _matrix(run.column("registers")), run.column("n").to_numpy(), hundredths)
            yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


# --- confirmation ----------------------------------------------------------------------------------------------------


def _hash_batches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            sets = [shingle_set(t.as_py(), words).tobytes() for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], names=["digest", "hashes"])


def _confirmed_batches(batches: Iterator[pa.RecordBatch], hundredths: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for left, right in zip(batch.column(2), batch.column(3), strict=True):
            a, b = np.frombuffer(left.as_py(), np.uint64), np.frombuffer(right.as_py(), np.uint64)
            if len(a) > len(b):
                a, b = b, a
            place = np.minimum(np.searchsorted(b, a), len(b) - 1)
            both = int((b[place] == a).sum())
            kept.append(100 * both >= hundredths * (len(a) + len(b) - both))
        yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _attached(pairs: DataFrame, table: DataFrame, end: str, columns: list[str]) -> DataFrame:
    """Pairs with columns of the document at one end; a document in very many pairs is met slice by slice."""
    other = "b" if end == "a" else "a"
    heavy = heavy_groups(pairs.groupBy(end).agg(F.count("*").alias("_n")), [end], "_n", min_rows=MIN_SLICE)
    side = table.select(F.col("digest").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in columns])
    return sliced_join(pairs, side, [end], heavy_left=heavy, spread_left=[other])


def _confirmed(pairs: DataFrame, sets: DataFrame, hundredths: int) -> DataFrame:
    both = _attached(_attached(pairs, sets, "a", ["hashes"]), sets, "b", ["hashes"])
    told = both.select("a", "b", "a_hashes", "b_hashes")
    return settle(told.mapInArrow(lambda b: _confirmed_batches(b, hundredths), "a binary, b binary"), "hyper-links")


def _in_common(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairs' intersections: the product of the matrix of sets and shingles with itself.

    Only shingles of two sets or more have a column. Counts stay below 2^24, which single precision holds exactly.
    """
    hashes, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    shared = np.repeat(np.diff(np.append(np.flatnonzero(new), len(hashes))) > 1, np.diff(np.append(np.flatnonzero(new), len(hashes))))
    owner, column = owner[shared], np.cumsum(new[shared]) - 1
    common = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS_AT_ONCE):
        low, high = np.searchsorted(column, [first, first + COLUMNS_AT_ONCE])
        matrix = np.zeros((len(sets), int(column[high - 1]) + 1 - first), np.float32)
        matrix[owner[low:high], column[low:high] - first] = 1
        common += matrix @ matrix.T
    return common


def _exact_batches(batches: Iterator[pa.RecordBatch], hundredths: int) -> Iterator[pa.RecordBatch]:
    """Links that connect what all links of a run connect; documents of one component are connected already."""
    for run in _runs(batches):
        digests = np.array(run.column("digest").to_pylist(), object)
        _, root = np.unique(np.array(run.column("root").to_pylist(), object), return_inverse=True)
        if root.max() == 0:
            continue
        sets = [np.frombuffer(x, np.uint64) for x in run.column("hashes").to_pylist()]
        size, common, label = np.array([len(x) for x in sets]), _in_common(sets), np.arange(root.max() + 1)
        a, b = [], []
        for at in range(0, len(sets), 256):
            own = common[at : at + 256].astype(np.int64)
            linked = 100 * own >= hundredths * (size[at : at + 256, None] + size[None] - own)
            i, j = np.nonzero(linked & (root[at : at + 256, None] != root[None]))
            i += at
            for x, y in zip(*_spanning(label, root, i, j), strict=True):
                a.append(digests[x])
                b.append(digests[y])
        yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _spanning(label: np.ndarray, root: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[list[int], list[int]]:
    """Of links (i, j), those that join components that were apart; ``label`` is brought up to date."""
    left, right = [], []
    while len(i):
        apart = label[root[i]] != label[root[j]]
        i, j = i[apart], j[apart]
        if len(i):  # the first link of each component that has one: no two of them are the same
            _, first = np.unique(np.maximum(label[root[i]], label[root[j]]), return_index=True)
            for x, y in zip(i[first].tolist(), j[first].tolist(), strict=True):
                if label[root[x]] != label[root[y]]:
                    left.append(x)
                    right.append(y)
                    merge_labels(label, root[[x]], root[[y]])
    return left, right


# --- candidates ------------------------------------------------------------------------------------------------------


def _bands(at: Column | str) -> Column:
    """The keys of a set's bands, null where a band's buckets are all empty."""
    found = []
    for band in range(REGISTERS // BAND):
        piece = F.substring(at, 1 + 2 * BAND * band, 2 * BAND)
        found.append(F.when(piece != F.lit(b"\xff" * 2 * BAND), F.xxhash64(F.lit(band), piece)))
    return F.array(*found)


def _shared(rows: DataFrame) -> DataFrame:
    """The rows (key, digest) whose key more than one set has, with the number ``n`` of these."""
    counts = settle(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "hyper-keys")
    heavy = heavy_groups(counts, ["key"], "n", min_rows=MIN_SLICE)
    return settle(sliced_join(rows, counts, ["key"], heavy_left=heavy, spread_left=["digest"]), "hyper-bands")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _stars(met: DataFrame, least: int = STAR_BANDS) -> DataFrame:
    """Each set of a band with the one of the band that shares most bands with others, if they share ``least`` or more.

    These pairs need not be all that link: what they leave apart is looked at by the ties.
    """
    known = met.join(met.groupBy("digest").agg(F.sum("n").alias("shared")), "digest")
    leaders = known.groupBy("key").agg(F.count("*").alias("n"), F.max(F.struct("shared", "digest")).alias("leader"))
    leaders = settle(leaders.select("key", "n", F.col("leader.digest").alias("a")), "hyper-leaders")
    heavy = heavy_groups(leaders, ["key"], "n", min_rows=MIN_SLICE)
    pairs = sliced_join(met.drop("n"), leaders.drop("n"), ["key"], heavy_left=heavy, spread_left=["digest"])
    ends = pairs.select(F.least("a", "digest").alias("a"), F.greatest("a", "digest").alias("b")).where("a <> b")
    return settle(ends.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= least).drop("n"), "hyper-pairs")


def _apart(rows: DataFrame) -> DataFrame:
    """The rows (key, digest, root) of keys whose sets are not all of one component, with the number ``n`` of these."""
    keys = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("_low"), F.max("root").alias("_high"))
    keys = settle(keys.where("_low <> _high").select("key", "n"), "hyper-apart")
    heavy = heavy_groups(keys, ["key"], "n", min_rows=MIN_SLICE)
    return settle(sliced_join(rows, keys, ["key"], heavy_left=heavy, spread_left=["digest"]), "hyper-rows")


def _tied(met: DataFrame, reps: DataFrame, roots: DataFrame, hundredths: int, run_rows: int) -> DataFrame:
    """Ties (a, b) of components that share a band and that the estimate cannot tell apart."""
    rows = _apart(met.drop("n").join(roots, "digest"))
    light, heavy = rows.where(F.col("n") <= run_rows), rows.where(F.col("n") > run_rows)
    runs = light.select("key", "digest", "root")
    if not heavy.isEmpty():
        bands = reps.select("digest", F.filter(_bands("registers"), lambda x: x.isNotNull()).alias("bands"))
        second = heavy.drop("n").join(bands, "digest").withColumn("second", F.explode("bands"))
        # a set whose hashes fill this one band only would meet none of its own in a second
        second = second.where((F.col("second") != F.col("key")) | (F.size("bands") == 1))
        finer = _apart(second.select(F.xxhash64("key", F.least("key", "second"), F.greatest("key", "second")).alias("key"), "digest", "root"))
        runs = runs.unionByName(finer.where(F.col("n") <= run_rows).select("key", "digest", "root"))
        parts = F.ceil(F.col("n") / run_rows).cast("int")
        hot = finer.where(F.col("n") > run_rows).withColumns(
            {"parts": parts, "mine": F.pmod(F.xxhash64("digest", F.lit(1)), parts).cast("int")}
        )
        hot = hot.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        runs = runs.unionByName(
            hot.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "digest", "root")
        )
    laid = runs.join(reps.select("digest", "n", "registers"), "digest").select("key", "root", "n", "registers")
    found = laid.repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: _tie_batches(b, hundredths), "a binary, b binary")
    return settle(_ordered(found), "hyper-ties")


def _within_clusters(members: DataFrame, hundredths: int) -> DataFrame:
    """Links across components of (cluster, digest, root, n, hashes), confirmed on the full sets.

    Slices of a large cluster meet pairwise, but for those of its largest component, which do not meet one another.
    """
    per_root = members.groupBy("cluster", "root").agg(F.sum("n").alias("w"))
    per = per_root.groupBy("cluster").agg(F.sum("w").alias("total"), F.max(F.struct("w", "root")).alias("bulk"))
    cut = F.col("total") > SLICE_HASHES
    rest = F.ceil((F.col("total") - F.col("bulk.w")) / SLICE_HASHES)
    per = settle(per.select(
        "cluster", F.col("total").alias("_hashes"), F.when(cut, F.col("bulk.root")).alias("bulk"),
        F.when(cut, F.ceil(F.col("bulk.w") / SLICE_HASHES)).otherwise(0).cast("int").alias("p"),
        F.when(cut, rest).otherwise(1).cast("int").alias("q"),
    ), "hyper-clusters")
    heavy = heavy_groups(per, ["cluster"], "_hashes", min_rows=SLICE_HASHES)
    placed = sliced_join(members, per.drop("_hashes"), ["cluster"], heavy_left=heavy, spread_left=["digest"])

    def upto(n: str) -> Column:
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))

    in_bulk = F.coalesce(F.col("root") == F.col("bulk"), F.lit(False))
    mine = F.pmod(F.xxhash64("digest", F.lit(2)), F.when(in_bulk, F.col("p")).otherwise(F.col("q"))).cast("int")
    dealt = placed.withColumns({"in_bulk": in_bulk, "mine": mine})
    with_rest = F.transform(upto("q"), lambda j: F.xxhash64("cluster", F.lit("rest"), F.least("mine", j), F.greatest("mine", j)))
    with_bulk = F.transform(upto("p"), lambda j: F.xxhash64("cluster", F.lit("bulk"), "mine", j))
    of_bulk = F.transform(upto("q"), lambda i: F.xxhash64("cluster", F.lit("bulk"), i, "mine"))
    keys = F.when(F.col("in_bulk"), of_bulk).otherwise(F.concat(with_rest, with_bulk))
    laid = dealt.select(F.explode(keys).alias("key"), "digest", "root", "hashes")
    found = laid.repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: _exact_batches(b, hundredths), "a binary, b binary")
    return settle(found, "hyper-links")


# --- operator --------------------------------------------------------------------------------------------------------


def near_groups(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    hundredths: int = SIMILARITY,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are what stands between white space (20, 09 to 0D), A-Z in lower case; the set holds the distinct shingles of
    ``words`` words, of a shorter text all its words as one. Documents link if their sets have at least ``hundredths``
    hundredths of their union in common. ``component_id`` is the smallest doc_id reachable, itself included (null ids are
    passed over; a component with null ids only has none); ``kept`` tells whether it is the row's own. A null text, or
    one without words, has an empty set and links with nothing. Repeated rows are rows of their own; an empty table
    gives an empty result. Other columns are not read.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("_text"))
    kind = dict(plain.dtypes)["doc_id"]
    keyed = plain.withColumn("text_key", F.unhex(F.sha2("_text", 256)))
    named = settle(
        keyed.select("doc_id", "text_key", F.col("_text").cast("binary")).mapInArrow(
            lambda b: _set_batches(b, words), f"doc_id {kind}, text_key binary, n long, digest binary, registers binary"
        ),
        "hyper-sets",
    )
    per_set = named.where("n > 0").groupBy("digest").agg(
        F.min(F.struct("text_key", F.col("doc_id"))).alias("one"), F.max("n").alias("n"), F.count("*").alias("rows"),
        F.min("doc_id").alias("least"), F.min("registers").alias("registers"),
    )
    reps = settle(per_set, "hyper-reps")
    keys = reps.select("digest", F.explode(F.filter(_bands("registers"), lambda x: x.isNotNull())).alias("key"))
    met = _shared(keys)
    links = _links(met, reps, keyed, words, hundredths, run_rows)
    roots = components(links).withColumnsRenamed({"node": "digest"})

    rooted = reps.join(roots, "digest", "left").select("digest", "rows", "least", F.coalesce("root", "digest").alias("root"))
    told = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    told = settle(told.select("digest", "rows", "component_id"), "hyper-roots")
    heavy = heavy_groups(told, ["digest"], "rows", min_rows=MIN_SLICE)
    full = named.where("n > 0").select("doc_id", "n", "digest", "text_key", F.monotonically_increasing_id().alias("_at"))
    linked = sliced_join(full, told.drop("rows"), ["digest"], heavy_left=heavy, spread_left=["_at"])
    alone = named.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n", "component_id").unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _links(
    met: DataFrame, reps: DataFrame, keyed: DataFrame, words: int, hundredths: int, run_rows: int
) -> DataFrame:
    """Confirmed links (a, b) between sets that connect exactly what all links connect."""
    wanted = met.select("digest").distinct().join(reps, "digest").select("digest", "one.text_key", F.col("one.doc_id").alias("at"), "rows")
    wanted = settle(wanted, "hyper-wanted")
    heavy = heavy_groups(wanted, ["text_key"], "rows", min_rows=MIN_SLICE)
    texts = sliced_join(
        keyed, wanted.drop("rows"), ["text_key"], heavy_left=heavy, spread_left=["doc_id"]
    ).where(F.col("doc_id").eqNullSafe(F.col("at")))
    hashed = texts.select("digest", F.col("_text").cast("binary")).mapInArrow(
        lambda b: _hash_batches(b, words), "digest binary, hashes binary"
    )
    sets = settle(hashed.groupBy("digest").agg(F.first("hashes").alias("hashes")), "hyper-hashes")

    stars = _stars(met)
    near = _attached(_attached(stars, reps, "a", ["registers", "n"]), reps, "b", ["registers", "n"])
    likely = settle(
        near.select("a", "b", "a_registers", "a_n", "b_registers", "b_n").mapInArrow(
            lambda b: _likely_batches(b, hundredths), "a binary, b binary"
        ),
        "hyper-likely",
    )
    links = _confirmed(likely, sets, hundredths)
    roots = components(links).withColumnsRenamed({"node": "digest"})
    roots = settle(
        met.select("digest").distinct().join(roots, "digest", "left").select("digest", F.coalesce("root", "digest").alias("root")),
        "hyper-stars",
    )
    tied = components(_tied(met, reps, roots, hundredths, run_rows))
    clusters = tied.select(F.col("node").alias("root"), F.col("root").alias("cluster"))
    per_root = roots.groupBy("root").agg(F.count("*").alias("_n"))
    heavy = heavy_groups(per_root, ["root"], "_n", min_rows=MIN_SLICE)
    members = sliced_join(roots, clusters, ["root"], heavy_left=heavy, spread_left=["digest"])
    members = members.join(reps.select("digest", "n"), "digest").join(sets, "digest")
    return links.unionByName(_within_clusters(members, hundredths))

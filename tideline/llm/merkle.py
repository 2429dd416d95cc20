"""Merkle dataset manifest by butterfly exchange.

Every row is a leaf. The leaves of a source, in order, are dealt into blocks of ``fanout ** levels`` leaves, so every block
is a whole subtree. Blocks then swap subtree roots round by round: in round r, the (at most ``fanout``) blocks whose numbers
differ in their digit r only meet, each learns the others' roots as its siblings of that level, and each group hashes the
parent for itself. After the last round every block knows the source's root and its own proof up to it; nothing is sent
down. A last subtree with fewer blocks lacks partners for some others: its blocks stand in, in turn, for those missing. The
roots of the sources are the leaves of one more tree, built the same way.

``H`` is the lowercase hex sha256 of its inputs, concatenated; digests enter as hex text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.skew import heavy_groups, null_safe_join, sliced_join
from tideline.session import settle

FANOUT = 3
BLOCK_LEVELS = 7

_PROOF = "array<struct<left:string,right:string>>"
_PROOF_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_ROOT = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("blocks", pa.int64()), ("node", pa.string())])

Sides = list[tuple[str, str]]


# --- leaves ----------------------------------------------------------------------------------------------------------


def leaf_digest(*values: Column) -> Column:
    """H of the values: ``-`` for null, else the number of UTF-8 bytes, ``:``, and the value (integers decimal)."""
    told = []
    for value in values:
        text = value.cast("string")
        told.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*told), 256)


def _placed(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add ``tree`` (ascending with the group, null first), ``pos`` (within the group, from 0) and ``size`` (of the group).

    Rows are laid out by range of (group, order) and settled; a group may span any number of partitions. Positions follow
    from the counts per group and partition.
    """
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    laid = settle(
        rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumns(
            {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}
        ),
        "merkle-order",
    )
    held = laid.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(group)  # one row per partition that holds some of the group
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
            "size": F.sum("_n").over(whole),
            "tree": F.min("_first").over(whole),  # row numbers ascend with the range
        }
    ).drop("_n")
    return (
        null_safe_join(laid, starts, [group, "_part"])
        .withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first"))
        .drop("_part", "_at", "_first", "_before")
    )


# --- blocks ----------------------------------------------------------------------------------------------------------


def _h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _levels(digests: list[str], fanout: int, levels: int, alone: bool) -> list[list[str]]:
    """The block's nodes from its leaves up: as many levels as blocks have, or, if it is the only one, up to one node."""
    found = [digests]
    while len(found[-1]) > 1 if alone else len(found) <= levels:
        last = found[-1]
        found.append([_h(*last[at : at + fanout]) for at in range(0, len(last), fanout)])
    return found


def _sides(levels: list[list[str]], fanout: int) -> list[Sides]:
    """Per leaf of a block: its siblings left and right, level by level."""
    by_level = []
    for nodes in levels[:-1]:
        runs = (nodes[at : at + fanout] for at in range(0, len(nodes), fanout))
        by_level.append([("".join(run[:i]), "".join(run[i + 1 :])) for run in runs for i in range(len(run))])
    return [[sides[leaf // fanout**up] for up, sides in enumerate(by_level)] for leaf in range(len(levels[0]))]


def _fold(node: str, proof: Sides) -> str:
    for left, right in proof:
        node = _h(left, node, right)
    return node


def _root_batches(batches: Iterator[pa.RecordBatch], fanout: int, levels: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tree, block, blocks, digests in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield pa.record_batch([[tree], [block], [blocks], _levels(digests, fanout, levels, blocks == 1)[-1]], _ROOT)


def _gathered(placed: DataFrame, payload: Sequence[str], span: int) -> DataFrame:
    """One row per block: tree, block, blocks (of the tree), leaves (in order, with their payload)."""
    leaves = F.array_sort(F.collect_list(F.struct("pos", *payload)))  # at most ``span``
    return settle(
        placed.groupBy("tree", F.expr(f"pos div {span}").alias("block")).agg(
            F.max(F.expr(f"(size + {span - 1}) div {span}")).alias("blocks"), leaves.alias("leaves")
        ),
        "merkle-blocks",
    )


# --- butterfly -------------------------------------------------------------------------------------------------------


def _swapped(state: DataFrame, stride: int, fanout: int) -> DataFrame:
    """One round: subtrees of ``stride`` blocks become subtrees of ``fanout`` times as many, in each of their blocks.

    Trees of at most ``stride`` blocks are done and pass unchanged.
    """
    subtree, low = F.expr(f"block div {stride}"), F.expr(f"block % {stride}")
    members = F.least(F.lit(stride), F.col("blocks") - F.col("subtree") * stride)
    stands_in = (F.col("members") < stride) & (F.col("subtree") % fanout > 0)  # only a last subtree lacks blocks
    targets = F.sequence("low", F.when(stands_in, F.lit(stride - 1)).otherwise(F.col("low")), "members")
    sent = (
        state.withColumns({"subtree": subtree.cast("long"), "low": low.cast("long")})
        .withColumn("members", members.cast("long"))
        .withColumn("to", F.explode(targets))
    )
    home = F.col("to") == F.col("low")
    met = sent.groupBy("tree", "blocks", F.expr(f"subtree div {fanout}").alias("parent"), "to").agg(
        F.array_sort(
            F.collect_list(F.struct("subtree", "node", "block", home.alias("home"), F.when(home, F.col("proof")).alias("proof")))
        ).alias("run")
    )

    def joined(of: Column) -> Column:
        return F.array_join(F.transform(of, lambda x: x["node"]), "")

    hashed = met.withColumn("up", F.sha2(joined(F.col("run")), 256))
    own = hashed.withColumn("me", F.explode(F.filter("run", lambda x: x["home"])))
    done, me = F.col("blocks") <= stride, F.col("me")
    siblings = F.struct(
        joined(F.filter("run", lambda x: x["subtree"] < me["subtree"])).alias("left"),
        joined(F.filter("run", lambda x: x["subtree"] > me["subtree"])).alias("right"),
    )
    return own.select(
        "tree",
        me["block"].alias("block"),
        "blocks",
        F.when(done, me["node"]).otherwise(F.col("up")).alias("node"),
        F.when(done, me["proof"]).otherwise(F.array_append(me["proof"], siblings)).cast(_PROOF).alias("proof"),
    )


def butterfly(roots: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(tree, block, blocks, node, proof) of (tree, block, blocks, node): the tree's root and each block's proof up to it."""
    most = roots.agg(F.max("blocks")).first()[0] or 1
    state, stride = roots.withColumn("proof", F.array().cast(_PROOF)), 1
    while stride < most:
        state, stride = _swapped(state, stride, fanout), stride * fanout
    return settle(state, "merkle-proofs")


def _upper(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    digests = blocks.select("tree", "block", "blocks", F.transform("leaves", lambda x: x["leaf"]).alias("digests"))
    made = digests.mapInArrow(lambda b: _root_batches(b, fanout, levels), "tree long, block long, blocks long, node string")
    return butterfly(settle(made, "merkle-roots"), fanout)


# --- operator --------------------------------------------------------------------------------------------------------


def _proof_batches(
    batches: Iterator[pa.RecordBatch], fanout: int, levels: int, schema: pa.Schema, with_proofs: bool
) -> Iterator[pa.RecordBatch]:
    """Per leaf of a block: its whole proof, and the root folded from what is claimed to be the leaf."""
    for batch in batches:
        for row in batch.to_pylist():
            leaves, upper = row["leaves"], [(s["left"], s["right"]) for s in row["proof"]]
            below = _levels([x["leaf"] for x in leaves], fanout, levels, row["blocks"] == 1)
            out = []
            for leaf, own in zip(leaves, _sides(below, fanout), strict=True):
                proof = own + upper
                folded = _fold(leaf["claim"] or leaf["leaf"], proof)
                told = [{"left": a, "right": b} for a, b in proof] if with_proofs else None
                siblings = _h(*[x for sides in proof for x in sides])
                out.append((leaf["id"], leaf["leaf"], row["subroot"], row["root"], siblings, folded, folded == row["root"], told))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def manifest(
    rows: DataFrame,
    fields: Sequence[str],
    *,
    order: str,
    group: str,
    claim: Column | None = None,
    fanout: int = FANOUT,
    levels: int = BLOCK_LEVELS,
    with_proofs: bool = True,
) -> DataFrame:
    """One row per row: ``order``, leaf, subroot (of its group), root, proof_sha256, folded_root, verified, proof.

    A leaf is the digest of ``fields``. ``claim`` is a digest to verify in its place (null: the leaf itself): ``folded_root``
    is made from it and the proof, ``verified`` tells whether that is the root. ``proof`` lists the siblings left and right of
    the path, from the leaf up; it is null unless asked for, and ``proof_sha256`` is H of all of them.

    Leaves stand in ascending order of ``order`` within their group (null first; of equal ones the order follows the
    leaf's digest), groups in ascending order (null first, by UTF-8 bytes). A group of one has its leaf as subroot, a
    single group its subroot as root. Repeated rows are leaves of their own; null fields count as ``-``, empty texts as
    ``0:``; an empty table gives an empty result. Columns other than those named are not read.
    """
    span = fanout**levels
    leaf = leaf_digest(*[F.col(f) for f in fields])
    leaves = rows.select(
        F.col(group).alias("group"), F.col(order).alias("id"), leaf.alias("leaf"),
        (F.lit(None) if claim is None else claim).cast("string").alias("claim"),
        F.monotonically_increasing_id().alias("row"),  # lets ranges cut a run of repeated rows
    )
    placed = _placed(settle(leaves, "merkle-leaves"), "group", ["id", "leaf", "row"])
    blocks = _gathered(placed, ["id", "leaf", "claim"], span)
    upper = _upper(blocks, fanout, levels)

    sources = upper.where("block = 0").select(
        F.lit(0).alias("all"), F.col("tree").alias("id"), F.col("node").alias("leaf"), F.lit(None).cast("string").alias("claim")
    )
    top_blocks = _gathered(_placed(sources, "all", ["id"]), ["id", "leaf", "claim"], span)
    top = top_blocks.join(_upper(top_blocks, fanout, levels).withColumnRenamed("node", "root"), ["tree", "block", "blocks"])
    paths = _expanded(top.withColumn("subroot", F.lit("")), "long", fanout, levels, True).select(
        F.col("id").alias("tree"), "root", F.col("proof").alias("above")
    )

    counts = upper.groupBy("tree").agg(F.count("*").alias("n"))
    known = sliced_join(
        upper, paths, ["tree"], heavy_left=heavy_groups(counts, ["tree"], "n"), spread_left=["block"]
    ).select("tree", "block", F.col("node").alias("subroot"), "root", F.concat("proof", "above").alias("proof"))
    whole = blocks.join(known, ["tree", "block"])
    return _expanded(whole, dict(leaves.dtypes)["id"], fanout, levels, with_proofs).withColumnRenamed("id", order)


def _expanded(blocks: DataFrame, kind: str, fanout: int, levels: int, with_proofs: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(blocks.schema["leaves"].dataType.elementType["id"].dataType)
    schema = pa.schema(
        [("id", id_type), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
         ("folded_root", pa.string()), ("verified", pa.bool_()), ("proof", _PROOF_TYPE)]
    )
    told = (
        f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
        f"proof {_PROOF}"
    )
    return blocks.select("leaves", "blocks", "subroot", "root", "proof").mapInArrow(
        lambda b: _proof_batches(b, fanout, levels, schema, with_proofs), told
    )

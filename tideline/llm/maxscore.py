"""Exact top-k inner products by MaxScore over sharded postings.

The terms of a query are its dimensions with the sign they ask for: a vector stands in the posting list of (dimension, +)
or (dimension, -) with its component as impact, and only terms whose signs agree raise a score. In each shard a query's
terms are split by their score bounds: as long as the bounds of the smallest terms together cannot reach the worst score
among the k best so far, these terms are non-essential, and only the postings of the essential ones are traversed. Vectors
found there are then probed on the remaining dimensions, largest bound first, while they can still compete; components of
the other sign lower them on the way. Shards keep their k best, and those are merged.

Query blocks meet shards by an equi-join on the shard number: every query sees every vector, in blocks of bounded size.
The join is always a sort-merge one: the blocks are as many as queries times shards, which a plan's estimate does not see,
and a broadcast of them would pass through the driver. One shard at a time is held beside the blocks that stream past it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import number_rows
from tideline.session import settle

SHARD_VECTORS = 8192
BLOCK_QUERIES = 512
TRAVERSED_AT_ONCE = 2048
PROBED_AT_ONCE = 8
GATHERED = 8  # places are gathered one by one where fewer than one in so many are asked for
NO_SCORE = np.iinfo(np.int64).min
EXACT = 2.0**53  # whole numbers below are exact as floats, whatever the order of a sum

_HIT = pa.schema([("query", pa.int64()), ("_row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class Shard:
    """Vectors of a shard, by dimension, with posting lists per (dimension, sign) and block of vectors."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        order = np.lexsort((rows, ids))  # ties go to the smaller id: ascending ids let equal scores lose later on
        self.ids, self.rows = ids[order], rows[order]
        self.by_dim = np.ascontiguousarray(vectors[order].T)
        self.most = np.abs(self.by_dim.astype(np.float64)).max(axis=1, initial=0)
        self.blocks = {}

    def blocks_of(self, kind: type) -> list[tuple]:
        """The blocks as numbers of this kind, made when a query first asks for it."""
        if kind not in self.blocks:
            self.blocks[kind] = made = []
            for at in range(0, len(self.ids), TRAVERSED_AT_ONCE):
                part = np.ascontiguousarray(self.by_dim[:, at : at + TRAVERSED_AT_ONCE], kind)
                made.append((at, part, np.maximum(part.max(axis=1), 0), np.maximum(-part.min(axis=1), 0), {}))
        return self.blocks[kind]

    @staticmethod
    def posting(part: np.ndarray, lists: dict, dim: int, positive: bool) -> np.ndarray:
        """Places of the vectors whose component has the sign; built when a query first asks for it."""
        key = (dim, positive)
        if key not in lists:
            lists[key] = np.flatnonzero(part[dim] > 0 if positive else part[dim] < 0)
        return lists[key]

    def best(self, query: np.ndarray, own_row: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the k best vectors other than the query's own row.

        Products are taken in floats where no sum of them can leave the whole numbers that floats hold, else in integers.
        """
        kind = np.float64 if np.abs(query.astype(np.float64)) @ self.most < EXACT else np.int64
        query = query.astype(kind)
        places, scores = np.zeros(0, np.int64), np.zeros(0, kind)
        for at, part, highest, lowest, lists in self.blocks_of(kind):
            least = scores[-1] if len(scores) == k else None
            found, values = self._block(query, part, highest, lowest, lists, least)
            if len(found):
                other = self.rows[found + at] != own_row
                places = np.concatenate([places, found[other] + at])
                scores = np.concatenate([scores, values[other]])
                order = np.lexsort((places, -scores))[:k]
                places, scores = places[order], scores[order]
        return places, scores.astype(np.int64)

    def _block(self, query, part, highest, lowest, lists, least):
        bound = np.where(query > 0, query * highest, -query * lowest)
        if least is None:
            return np.arange(part.shape[1]), query @ part
        order = np.argsort(bound, kind="stable")  # smallest bounds first
        reach = np.cumsum(bound[order])
        essential = order[reach >= least][::-1] if least > 0 else None
        if essential is None:  # a vector that no list holds could compete
            alive = np.arange(part.shape[1])
            essential = order[:0]
        else:
            touched = np.zeros(part.shape[1], bool)
            for dim in essential:
                if bound[dim]:
                    touched[self.posting(part, lists, int(dim), bool(query[dim] > 0))] = True
                    if touched.all():
                        break
            alive = np.flatnonzero(touched)
        if not len(essential) or not len(alive):
            scores = np.zeros(len(alive), query.dtype)
        elif len(alive) * GATHERED < part.shape[1]:
            scores = query[essential] @ part[np.ix_(essential, alive)]
        else:  # the same sums: a product over whole rows costs less than gathering most of them
            asked = np.zeros_like(query)
            asked[essential] = query[essential]
            scores = (asked @ part)[alive]
        rest = order[: len(order) - len(essential)][::-1]
        for step in range(0, len(rest) + 1, PROBED_AT_ONCE):
            competitive = scores + bound[rest[step:]].sum() > least  # an equal score has a larger id here: it loses
            alive, scores = alive[competitive], scores[competitive]
            dims = rest[step : step + PROBED_AT_ONCE]
            if not len(alive) or not len(dims):
                break
            scores = scores + query[dims] @ part[np.ix_(dims, alive)]
        return alive, scores


def _matrix(vectors: list) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for at, v in enumerate(vectors):
        out[at, : len(v)] = v
    return out


PACKED = (np.int8, np.int16, np.int32, np.int64)


def _packed(group: pd.DataFrame) -> pd.DataFrame:
    """The vectors of a shard or block in one row, in the fewest bytes that hold them; shorter ones are filled up with zeros."""
    vectors = _matrix(group["v"].tolist())
    least, most = (vectors.min(), vectors.max()) if vectors.size else (0, 0)
    vectors = vectors.astype(next(t for t in PACKED if np.iinfo(t).min <= least and most <= np.iinfo(t).max))
    row = {
        "rows": group["_row"].to_numpy(np.int64).tobytes(), "ids": group["vec_id"].to_numpy(np.int64).tobytes(),
        "width": vectors.shape[1], "vectors": vectors.tobytes(),
    }
    return pd.DataFrame([row])


def _unpacked(row: dict, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, ids = (np.frombuffer(row[f"{name}_{c}"], np.int64) for c in ("rows", "ids"))
    width = row[f"{name}_width"]
    kind = np.dtype(f"i{len(row[f'{name}_vectors']) // (len(rows) * width)}") if width else np.int8
    return np.frombuffer(row[f"{name}_vectors"], kind).reshape(len(rows), width), ids, rows


def _hits(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    shard, number = None, None
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            if row["s_group"][0].as_py() != number:  # the join's rows lie by shard
                number = row["s_group"][0].as_py()
                shard = Shard(*_unpacked(row.to_pylist()[0], "s"))
            queries, _, own = _unpacked(row.select([c for c in row.schema.names if c.startswith("q_")]).to_pylist()[0], "q")
            width = len(shard.by_dim)  # what lies beyond one side's end meets zeros
            queries = np.pad(queries[:, :width], ((0, 0), (0, max(0, width - queries.shape[1]))))
            out = []
            for query, own_row in zip(queries, own, strict=True):
                places, scores = shard.best(query, own_row, k)
                out.append((np.full(len(places), own_row), shard.rows[places], shard.ids[places], scores))
            yield pa.record_batch([np.concatenate(c) for c in zip(*out, strict=True)], _HIT)


def quantised(vector: Column) -> Column:
    """floor(256 * x) of each component, as integers."""
    return F.transform(vector, lambda x: F.floor(256 * x.cast("double")))


def usable(vector: Column) -> Column:
    """Not null, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _in_groups(table: DataFrame, name: str, rows: int) -> tuple[DataFrame, int]:
    """Rows packed into groups of about ``rows``, dealt by a hash of the row number; and the number of groups."""
    groups = max(1, -(-table.count() // rows))
    schema = "rows binary, ids binary, width int, vectors binary"
    dealt = table.withColumn("_group", F.pmod(F.xxhash64("_row", F.lit(7)), F.lit(groups)).cast("int"))
    packed = dealt.groupBy("_group").applyInPandas(
        lambda key, g: _packed(g).assign(group=key[0])[["group", "rows", "ids", "width", "vectors"]], f"group int, {schema}"
    )
    return packed.withColumnsRenamed({c: f"{name}_{c}" for c in ("group", "rows", "ids", "width", "vectors")}), groups


def top_k(
    vectors: DataFrame,
    *,
    is_query: Column,
    k: int,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_vectors: int = SHARD_VECTORS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """Each query's k best other rows: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id.

    Queries are the usable rows for which ``is_query`` holds, candidates all usable rows but the query's own. Vectors
    that are null or hold null or non-finite components take no part, nor do rows without an id; an empty vector and the
    missing end of a shorter one count as zeros. Repeated rows are candidates and queries of their own. Fewer than k
    candidates are all returned; an empty table gives an empty result. Other columns are not read. Scores are exact as
    long as they fit into 64 bits. ``vectors`` is a stored table.
    """
    rows = number_rows(vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("_vector"), is_query.alias("_asks")))
    good = settle(
        rows.where(usable(F.col("_vector")) & F.col("vec_id").isNotNull()).select(
            "_row", F.col("vec_id").cast("long"), quantised(F.col("_vector")).alias("v"), "_asks"
        ),
        "quantised",
    )
    shards, n = _in_groups(good.drop("_asks"), "s", shard_vectors)
    queries, _ = _in_groups(good.where("_asks").drop("_asks"), "q", block_queries)
    everywhere = queries.withColumn("s_group", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    met = everywhere.hint("merge").join(shards.hint("merge"), "s_group").select(
        "s_group", "s_rows", "s_ids", "s_width", "s_vectors", "q_rows", "q_ids", "q_width", "q_vectors"
    )
    hits = met.mapInArrow(lambda b: _hits(b, k), "query long, _row long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "_row")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ids = good.where("_asks").select(F.col("_row").alias("query"), F.col("vec_id").alias("query_id"))
    return ranked.join(ids, "query").select("query_id", "rank", "vec_id", "score")

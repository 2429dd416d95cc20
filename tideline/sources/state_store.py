"""The rolling state in hash buckets, one row per key.

A key's readings of the last days are few, so they lie in one array (``history``, by day). Files are bucketed by key: a merge
joins the feed to them and shuffles the feed only, and merging and rolling are expressions on arrays, without a window or a
sort. A new version holds only the buckets in which some key changed; its entry in the log tells where each bucket lies.
A key is in the same bucket in every version.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.state import STATE_DAYS
from tideline.schema import KEY, STATE_COLUMNS, STATE_SCHEMA
from tideline.sources.commits import commit, fresh_folder, log_entries, newest

BUCKETS = 64
MOST_FOLDERS = 8  # a version that would lie in more is written as a whole
VALUES = tuple(c for c in STATE_COLUMNS if c not in KEY)

_HISTORY = T.ArrayType(T.StructType([STATE_SCHEMA[c] for c in VALUES]))
_ROWS = T.StructType([*[STATE_SCHEMA[c] for c in KEY], T.StructField("history", _HISTORY)])


def bucket_of(buckets: int, key: Sequence[str] = KEY) -> Column:
    """The number of a key's bucket: the hash that Spark lays out bucketed files by."""
    return F.pmod(F.hash(*key), F.lit(buckets))


def by_key(rows: DataFrame) -> DataFrame:
    """Rows in state layout (one per key and day) as one row per key; keys that hold a null are left out."""
    known = rows.where(" and ".join(f"{k} is not null" for k in KEY))
    return known.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct(*VALUES))).cast(_HISTORY).alias("history"))


def by_day(keyed: DataFrame, history: str = "history") -> DataFrame:
    """One row per key and day again."""
    return keyed.select(*KEY, F.explode(history).alias("_r")).select(
        *[F.col(c) if c in KEY else F.col(f"_r.{c}").alias(c) for c in STATE_COLUMNS]
    )


def merge_histories(old: Column, fresh: Column) -> Column:
    """The readings of both, by day; of the same day those of ``fresh``."""
    kept = F.filter(old, lambda x: ~F.exists(fresh, lambda y: y["day"].eqNullSafe(x["day"])))
    return F.array_sort(F.concat(kept, fresh))


def roll_history(history: str, as_of: date | str, keep_days: int = STATE_DAYS) -> Column:
    """The last ``keep_days`` days and the last older reading; the rule of :func:`operators.state.roll_state`."""
    cutoff = F.date_sub(F.lit(str(as_of)).cast("date"), keep_days)
    following = F.concat(F.slice(F.transform(history, lambda x: x["day"]), 2, F.size(history)), F.array(F.lit(None).cast("date")))
    paired = F.arrays_zip(F.col(history).alias("r"), following.alias("next"))
    kept = F.filter(paired, lambda x: (x["r"]["day"] >= cutoff) | x["next"].isNull() | (x["next"] >= cutoff))
    return F.transform(kept, lambda x: x["r"])


@contextmanager
def _catalog_name(spark: SparkSession):
    """A name for a moment: bucketed files are written and read through the catalog, which keeps nothing of them."""
    name = f"tideline_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay


def _write(keyed: DataFrame, path: str, buckets: int) -> None:
    with _catalog_name(keyed.sparkSession) as name:
        writer = keyed.select(*KEY, "history").write.format("parquet").option("compression", "zstd").option("path", path)
        writer.bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(name)


def _folder(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    with _catalog_name(spark) as name:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _ROWS)
        keys = ", ".join(KEY)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS "
            f"LOCATION '{path}'"
        )
        return spark.table(name)


class StateVersion:
    """One version: the folder of every bucket."""

    def __init__(self, spark: SparkSession, folders: list[str]):
        self.spark, self.folders = spark, folders

    @property
    def buckets(self) -> int:
        return len(self.folders)

    def parts(self) -> list[tuple[list[int], DataFrame]]:
        """(buckets, one row per key) per folder."""
        places: dict[str, list[int]] = {}
        for bucket, path in enumerate(self.folders):
            places.setdefault(path, []).append(bucket)
        out = []
        for path, own in places.items():
            stored = _folder(self.spark, path, self.buckets)
            out.append((own, stored if len(own) == self.buckets else stored.where(bucket_of(self.buckets).isin(own))))
        return out

    def rows(self) -> DataFrame:
        """The state, one row per key and day."""
        parts = [p for _, p in self.parts()]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return by_day(whole)

    def merged(self, feed: DataFrame, as_of: date | str, keep_days: int = STATE_DAYS) -> DataFrame:
        """One row per key: ``merged`` (state and feed, the feed wins), ``history`` (what the next run needs), ``before``.

        ``feed`` is in state layout and the only side that is shuffled: once per key and day, once by bucket.
        """
        fresh = by_key(feed).withColumnRenamed("history", "fresh").repartition(self.buckets, *KEY)
        none = F.array().cast(_HISTORY)
        found = None
        for own, stored in self.parts():
            mine = fresh if len(own) == self.buckets else fresh.where(bucket_of(self.buckets).isin(own))
            both = stored.withColumnRenamed("history", "before").join(mine.hint("shuffle_hash"), list(KEY), "full_outer")
            found = both if found is None else found.unionByName(both)
        joined = found.withColumn("merged", merge_histories(F.coalesce("before", none), F.coalesce("fresh", none)))
        return joined.withColumn("history", roll_history("merged", as_of, keep_days)).select(*KEY, "before", "merged", "history")


def start_store(spark: SparkSession, root: str, version: str, state: DataFrame, buckets: int = BUCKETS) -> StateVersion:
    """Write a state (one row per key and day) as the first version."""
    path = fresh_folder(root, "buckets")
    _write(by_key(state).repartition(buckets, *KEY), path, buckets)
    return _commit(spark, root, version, [path] * buckets)


def read_store(spark: SparkSession, root: str, *, before: str | None = None) -> StateVersion:
    """The newest version, or the newest one that sorts before ``before``: a repeated run starts from the same state."""
    entries = log_entries(spark, root, "state")
    last = newest(entries if before is None else entries.where(F.col("version") < F.lit(before)), "version")
    if last is None:
        raise ValueError(f"no state version before {before} in {root}")
    return StateVersion(spark, last.paths)


def write_store(base: StateVersion, merged: DataFrame, root: str, version: str) -> StateVersion:
    """Write the version that follows ``base`` from :meth:`StateVersion.merged`: the buckets that changed, then the commit.

    The new version lies in at most ``MOST_FOLDERS`` folders.
    """
    number = bucket_of(base.buckets)
    changed = merged.where(~F.col("history").eqNullSafe(F.col("before"))).select(number.alias("bucket")).distinct()
    touched = sorted(r.bucket for r in changed.collect())  # at most one a bucket
    folders = list(base.folders)
    if touched:
        path = fresh_folder(root, "buckets")
        for bucket in touched:
            folders[bucket] = path
        if len(set(folders)) > MOST_FOLDERS:
            touched, folders = list(range(base.buckets)), [path] * base.buckets
        kept = merged if len(touched) == base.buckets else merged.where(number.isin(touched))
        _write(kept, path, base.buckets)
    return _commit(base.spark, root, version, folders)


def _commit(spark: SparkSession, root: str, version: str, folders: list[str]) -> StateVersion:
    commit(spark, root, "state", version=version, paths=folders)
    return StateVersion(spark, folders)

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "tideline", **conf: str) -> SparkSession:
    """A session with the settings the plans assume; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # the panel grows behind its last shuffle: keep those partitions small
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application; not needed where it is installed there."""
    package = os.path.dirname(os.path.abspath(__file__))
    context = spark.sparkContext
    if any(f.endswith("/tideline-package.zip") for f in context.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tideline-"), "tideline-package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine: executors on other hosts could
    neither read nor recover what is written there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = os.path.join(tempfile.gettempdir(), "tideline-shared")
    return named.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative training a place to cut its lineage; keeps a folder that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, never used folder under the shared one; removed with the scope (:func:`scratch`) it is made in, if any."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of any file system that Spark knows; a missing one is no error."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Own the folders that are made within: they are removed at the end, also after a failure.

    For work that ends with its outputs written. A table settled within, or made from one, can't be read afterwards, so
    functions that return such tables leave the scope to their caller. Scopes may be nested; each owns what is made in it.
    """
    owned: list[str] = []
    token = _OWNED.set(owned)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in owned:
            remove_folder(spark, path)


def settle(table: DataFrame, label: str) -> DataFrame:
    """Compute a table once for several uses: write it to the shared folder and read it back.

    The copy outlives lost executors, cuts the lineage, and each use reads only the columns it needs. It stays until the
    end of the scope (:func:`scratch`) it was made in, or, outside of one, until the shared folder is cleaned: results that
    were not computed yet may still read it.
    """
    path = fresh_path(table.sparkSession, label)
    table.write.option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)

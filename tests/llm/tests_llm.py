"""Awkward tables that every operator has to take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i * 7919 % 1009}" for i in range(30_000))


def documents(spark: SparkSession, rows, folder, schema: str = DOCS) -> DataFrame:
    """A stored table of (doc_id, text) rows."""
    full = [(*r, None, None, None) if len(r) == 2 else r for r in rows] if schema == DOCS else rows
    path = f"{folder}/documents.parquet"
    spark.createDataFrame(full, schema).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def awkward(spark: SparkSession, folder) -> DataFrame:
    """Null and empty texts, null and repeated ids, repeated rows, copies, a very long text, odd characters."""
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a"), (5, "a"), (5, "a"), (None, "a"), (None, None), (None, "b c"),
        (6, "one two three four"), (7, "One  two\nthree FOUR"), (8, LONG), (9, LONG), (10, LONG + "x"), (11, "é́ \U0001f600 \x00 zß"),
        (12, "x" * 5000), (13, "x" * 5001), (14, "x" * 5000),
    ]
    return documents(spark, rows, folder)


def clashing(table: DataFrame) -> DataFrame:
    """The same rows with more columns, named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["row", "key", "name", "blocks", "kept", "n", "chunk", "local", "part", "shard", "fingerprint", "root", "pos", "ids"]
    return table.withColumns({c: F.lit("?") for c in names})


def rows_of(frame: DataFrame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)

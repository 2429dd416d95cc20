"""Small tables for the tests."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tideline.operators.calendar import daily_calendar
from tideline.schema import READING_SCHEMA

PLACE = (46.0, 2.0, "69300", "R", "Lyon", "1 rue A")


def reading(entity, at, price, product="E10", place=PLACE):
    observed = datetime.fromisoformat(at) if at else None
    return (entity, product, observed, price, *place)


def readings(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, READING_SCHEMA)


def empty_days(spark: SparkSession, extra: str = "") -> DataFrame:
    return spark.createDataFrame([], f"day date{extra}")


def plain_calendar(spark: SparkSession, start: str, end: str, ref=(), holidays=()) -> DataFrame:
    return daily_calendar(
        spark, start, end,
        ref=spark.createDataFrame([(date.fromisoformat(d), v) for d, v in ref], "day date, ref double"),
        holidays=spark.createDataFrame([(date.fromisoformat(d),) for d in holidays], "day date"),
        breaks=empty_days(spark, ", break_zone_a int, break_zone_b int, break_zone_c int"),
        warmup_days=10,
    )


def d(text: str) -> date:
    return date.fromisoformat(text)

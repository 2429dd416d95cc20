"""The test tables seen as price readings, calendars, stations and postal codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.operators.calendar import calendar_range, daily_calendar
from tideline.operators.readings import entity_span, last_per_day, plausible, with_area

SCALE = 100  # event and line-item values have two decimals
LOW, HIGH = 0.5, 350.0
TIE = ("reading_id",)

START, END = "2024-01-01", "2024-01-30"  # the days of the given events
LONG_TIE = ("l_orderkey", "l_linenumber", "l_partkey")


# The tables the stand-ins use; a declared schema saves the job that reads file footers.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def span(spark: SparkSession, sf_dir: str, name: str = "events", time: str = "ts") -> tuple[str, str]:
    """First and last day of a table, from one aggregation of one column; an empty table has one day."""
    days = table(spark, sf_dir, name).selectExpr(f"min(to_date({time})) as first", f"max(to_date({time})) as last").first()
    return str(days.first or START), str(days.last or START)


def place(key: str) -> list[str]:
    """Coordinates and postal code derived from a numeric key."""
    return [
        f"42.0D + ({key} * 37 % 900) / 100.0D as latitude",
        f"-4.0D + ({key} * 53 % 1200) / 100.0D as longitude",
        f"lpad(cast({key} * 137 % 95000 as string), 5, '0') as postal_code",
    ]


def area_names(spark: SparkSession, sf_dir: str, name: str, key: str, product: str) -> DataFrame:
    """Product and area of every row, for counting peer groups from two columns."""
    return table(spark, sf_dir, name).selectExpr(
        f"{product} as product", f"substring(lpad(cast({key} * 137 % 95000 as string), 5, '0'), 1, 2) as area"
    )


def all_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings; the address changes from reading to reading."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) as entity", "event_type as product", "ts as observed_at", "value as price",
        "event_id as reading_id",
        *place("user_id"),
        "if(user_id % 10 = 0, 'A', 'R') as road_type",
        "concat('City ', user_id % 50) as city",
        "concat(event_id % 4, ' High Street') as address",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plausible(all_readings(spark, sf_dir), LOW, HIGH)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_per_day(readings(spark, sf_dir), tie_break=TIE, unique_tie=True)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_area(entity_span(readings(spark, sf_dir)))


def reference_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of weekdays as quotes: several a day (the highest counts), none at weekends."""
    return table(spark, sf_dir, "events").where("event_type = 'purchase' and weekday(ts) < 5").selectExpr(
        "to_date(ts) as day", "value as ref"
    )


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 1st and 15th on which something happened, listed once per event."""
    return table(spark, sf_dir, "events").where("dayofmonth(ts) in (1, 15)").selectExpr("to_date(ts) as day")


def breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0/1 flags of the observed days; zone c is unknown."""
    days = table(spark, sf_dir, "events").selectExpr("to_date(ts) as day").distinct()
    return days.selectExpr("day", *_break_flags())


def _break_flags() -> list[str]:
    return [
        "int(dayofmonth(day) between 10 and 20) as break_zone_a",
        "int(dayofmonth(day) between 5 and 12) as break_zone_b",
        "cast(null as int) as break_zone_c",
    ]


def bare_calendar(spark: SparkSession) -> DataFrame:
    """2023-12-20 .. 2024-02-05."""
    return calendar_range(spark, "2023-12-20", "2024-02-06")


def calendar(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The calendar of the events' days, or of those asked for."""
    if start is None or end is None:
        first, last = span(spark, sf_dir)
        start, end = start or first, end or last
    return daily_calendar(
        spark, start, end,
        ref=reference_price(spark, sf_dir), holidays=holidays(spark, sf_dir), breaks=breaks(spark, sf_dir),
        warmup_days=12,
    )


def long_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as seven years of readings, with several readings per key and day."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_suppkey as string) as entity", "l_returnflag as product", "l_shipdate as observed_at",
        "l_extendedprice as price", *LONG_TIE,
        *place("l_suppkey"),
        "if(l_suppkey % 10 = 0, 'A', 'R') as road_type",
        "concat('City ', l_suppkey % 50) as city",
        "concat(l_suppkey, ' High Street') as address",
    )


def long_calendar(spark: SparkSession, sf_dir: str, start: str, end: str) -> DataFrame:
    """Highest order total of each weekday as the reference price; 1st of January and 14th of July off."""
    orders = table(spark, sf_dir, "orders").selectExpr("to_date(o_orderdate) as day", "o_totalprice as ref")
    return daily_calendar(
        spark, start, end,
        ref=orders.where("weekday(day) < 5"),
        holidays=orders.where("date_format(day, 'MM-dd') in ('01-01', '07-14')"),
        breaks=orders.select("day").distinct().selectExpr("day", *_break_flags()),
    )

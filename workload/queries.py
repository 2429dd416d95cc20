"""One query per operator, on whole tables. Names match :mod:`workload.oracles`."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline import functions as fn
from tideline.operators import calendar as cal
from tideline.operators import geo, intervals, metrics, nearest, readings as rd, series, state
from tideline.plans import comparator, forecast, model, panel as pl
from tideline.session import fresh_path, settle
from tideline.sources import commits, readers, state_store, writers
from workload import standins as st

AS_OF = "2024-01-25"
STATE_AS_OF = "2024-01-24"
SEGMENTS = (5.0, 50.0, 150.0)  # the stand-in's prices move by tens, not cents
RADIUS_M = 50_000.0
STATE_BUCKETS = 8
VALID_DAYS = 10

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


# --- shared inputs -------------------------------------------------------------------------------------------------


def event_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = pl.count_peer_groups(st.area_names(spark, sf_dir, "events", "user_id", "event_type"))
    start, end = st.span(spark, sf_dir)
    return pl.training_panel(
        st.readings(spark, sf_dir), st.calendar(spark, sf_dir, start, end),
        start=start, end=end, tie_break=st.TIE, unique_tie=True, scale=st.SCALE, peer_groups=groups,
    )


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled daily panel with the previous price."""
    return series.with_prev_price(intervals.asof_daily(st.daily(spark, sf_dir)))


def raw_delta():
    return fn.half_even(F.col("rolling_gap").cast("double") * F.lit(-0.0005), 4)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prices of the event panel with a predicted change from a fixed formula."""
    history = intervals.price_history(st.daily(spark, sf_dir), scale=st.SCALE)
    start, end = st.span(spark, sf_dir)
    return (
        pl.price_panel(history, start=start, end=end, scale=st.SCALE)
        .select("entity", "product", "day", "price", "prev_price", "rolling_gap")
        .withColumn("raw_delta", raw_delta())
        .withColumn("delta", fn.dead_band(F.col("raw_delta")))
    )


def old_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    past = st.readings(spark, sf_dir).where(F.to_date("observed_at") <= F.lit(STATE_AS_OF).cast("date"))
    return state.roll_state(state.feed_to_state(past, tie_break=st.TIE), STATE_AS_OF)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest reading of every key up to the day, under its original time: mostly re-sent ones."""
    until = st.readings(spark, sf_dir).where(F.to_date("observed_at") <= F.lit(AS_OF).cast("date"))
    columns = [c for c in until.columns if c not in ("entity", "product")]
    ordered = dict.fromkeys(("observed_at", "reading_id", *columns))
    return (
        until.groupBy("entity", "product")
        .agg(F.max(F.struct(*ordered)).alias("_latest"))
        .select("entity", "product", *[F.col("_latest")[c].alias(c) for c in ordered])
    )


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.merged_state(
        old_state(spark, sf_dir), feed(spark, sf_dir), low=st.LOW, high=st.HIGH, not_after=AS_OF, tie_break=st.TIE
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stations: market segment as the product, balance as the price."""
    return st.table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) as entity", "c_mktsegment as product", "c_acctbal as price",
        *st.place("c_custkey"), "c_name as address", "concat('City & Co ', c_nationkey) as city",
    )


def communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as communes; several can share a postal code."""
    return st.table(spark, sf_dir, "supplier").selectExpr(
        "s_name as commune", "lpad(cast(s_suppkey * 137 % 9500 as string), 5, '0') as code",
        *st.place("s_suppkey")[:2],
    )


# --- ingest: tables written as the files the readers take ------------------------------------------------------------


def _station_files(spark: SparkSession, sf_dir: str) -> str:
    """Events as station XML, some without a value, a time or a latitude."""
    path = fresh_path(spark, "stations-xml")
    st.table(spark, sf_dir, "events").selectExpr(
        "string(user_id) as _id",
        "if(user_id % 13 = 0, '', string(4200000 + user_id * 37 % 900 * 1000)) as _latitude",
        "string(-400000 + user_id * 53 % 1200 * 1000) as _longitude",
        "lpad(string(user_id * 137 % 95000), 5, '0') as _cp", "if(user_id % 10 = 0, 'A', 'R') as _pop",
        "if(user_id % 3 = 0, null, string(user_id % 7)) as _lanes",
        "concat(event_id % 4, ' rue de l\u2019\u00c9t\u00e9 & Fils') as adresse", "concat('City ', user_id % 50) as ville",
        "array(struct(event_type as _nom, if(event_id % 11 = 0, null, string(ts)) as _maj,"
        " if(event_id % 7 = 0, '', string(value)) as _valeur)) as prix",
    ).write.format("xml").option("rootTag", "pdv_liste").option("rowTag", "pdv").save(path)
    return path


@query
def ingest_stations(spark, sf_dir):
    path = _station_files(spark, sf_dir)
    return readers.read_station_xml(spark, path, charset="UTF-8", more={"_lanes": "lanes"})


@query
def ingest_checked(spark, sf_dir):
    """Station files with broken stations, missing ids and unreadable values: finds and readings, counted."""
    path = fresh_path(spark, "station-text")
    st.table(spark, sf_dir, "events").selectExpr(
        "concat('<pdv', if(event_id % 23 = 0, '', concat(' id=\"', user_id, '\"')), ' cp=\"75001\" pop=\"R\"><adresse>x</adresse><ville>City',"
        " if(event_id % 17 = 0, '', '</ville>'), '<prix nom=\"', event_type, '\" maj=\"', if(event_id % 13 = 0, 'gestern', string(ts)),"
        " '\" valeur=\"', if(event_id % 19 = 0, 'n/a', string(value)), '\"/></pdv>') as value"
    ).write.text(path)
    readings, quarantine = readers.read_station_xml_checked(spark, path, charset="UTF-8")
    timed = F.when(F.col("observed_at").isNull(), "reading without a time").otherwise("reading")
    counted = [t.groupBy("kind").agg(F.count("*").alias("n_rows")) for t in (quarantine, readings.select(timed.alias("kind")))]
    return counted[0].unionByName(counted[1])


@query
def ingest_feed(spark, sf_dir):
    return readers.read_station_xml(spark, _station_files(spark, sf_dir), charset="UTF-8", require_time=True)


@query
def ingest_quotes(spark, sf_dir):
    """Order totals as an exported sheet: other text in place of some days and prices."""
    path = fresh_path(spark, "quotes-csv")
    st.table(spark, sf_dir, "orders").selectExpr(
        "if(o_orderkey % 9 = 0, 'Date', string(o_orderdate)) as day",
        "if(o_orderkey % 5 = 0, 'n/a', string(o_totalprice)) as ref",
    ).write.csv(path)
    return readers.read_ref_csv(spark, path, since="1996-01-01")


@query
def ingest_breaks(spark, sf_dir):
    path = fresh_path(spark, "breaks-csv")
    st.table(spark, sf_dir, "orders").selectExpr(
        "date_format(o_orderdate, 'yyyy-MM-dd') as date", "if(o_orderkey % 2 = 0, 'True', 'False') as vacances_zone_a",
        "if(o_orderkey % 3 = 0, '', 'False') as vacances_zone_b", "if(o_orderkey % 5 = 0, 'True', null) as vacances_zone_c",
        "o_orderpriority as nom_vacances",
    ).write.option("header", True).csv(path)
    return readers.read_breaks_csv(spark, path, since="1996-01-01")


@query
def ingest_holidays(spark, sf_dir):
    """One JSON object with an entry per first of a month; its size is bounded by the calendar."""
    path = fresh_path(spark, "holidays-json")
    days = st.table(spark, sf_dir, "orders").where("dayofmonth(o_orderdate) = 1").selectExpr("string(to_date(o_orderdate)) as day")
    entries = F.collect_set(F.struct("day", F.lit("off").alias("label")))
    days.agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.text(path)
    return readers.read_holidays_json(spark, path)


@query
def ingest_communes(spark, sf_dir):
    path = fresh_path(spark, "communes-csv")
    st.table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as code_commune_INSEE", "s_name as nom_commune_postal", "s_suppkey * 137 % 9500 as code_postal",
        "if(s_suppkey % 4 = 0, null, s_acctbal) as latitude", "if(s_suppkey % 6 = 0, 'unknown', string(s_acctbal)) as longitude",
    ).write.option("header", True).csv(path)
    return readers.read_communes_csv(spark, path)


# --- sources and sinks ---------------------------------------------------------------------------------------------

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


@query
def scan_glob(spark, sf_dir):
    events = readers.read_parquet(spark, f"{sf_dir}/event*.parquet", EVENTS)
    return events.groupBy(F.col("event_type").alias("product")).agg(
        F.count("*").alias("n_rows"), F.sum(fn.units(F.col("value"), 100)).alias("cents")
    )


@query
def json_keys_explode(spark, sf_dir):
    return readers.json_keys(st.table(spark, sf_dir, "events").select("event_id", "props"), "props", "name")


@query
def calendar_range(spark, sf_dir):
    """Days from each product's first to its last, end-exclusive."""
    day = F.to_date("ts")
    bounds = st.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("product")).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )
    return bounds.select("product", F.explode(cal.day_range(F.col("first_day"), F.col("last_day"))).alias("day"))


@query
def sink_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "roundtrip")
    daily = st.daily(spark, sf_dir)
    writers.write_table(daily, path)
    return readers.read_parquet(spark, path, daily.schema)


@query
def rolling_state(spark, sf_dir):
    return state.roll_state(merged(spark, sf_dir), AS_OF)


@query
def union_state(spark, sf_dir):
    return merged(spark, sf_dir)


def _forecast(spark, sf_dir):
    groups = pl.count_peer_groups(st.area_names(spark, sf_dir, "events", "user_id", "event_type"))
    return forecast.daily_forecast(
        settle(merged(spark, sf_dir), "merged"), st.calendar(spark, sf_dir, start=AS_OF, end=AS_OF),
        forecast.column_scorer(raw_delta()), as_of=AS_OF, scale=st.SCALE, peer_groups=groups,
    )


@query
def daily_forecast(spark, sf_dir):
    return _forecast(spark, sf_dir)


@query
def publish_snapshot(spark, sf_dir):
    root = fresh_path(spark, "publish")
    predictions = _forecast(spark, sf_dir)
    writers.publish_snapshot(predictions, root, AS_OF)
    return spark.read.schema(predictions.schema).parquet(f"{root}/latest")


@query
def bucketed_state(spark, sf_dir):
    """The rolling state by way of a bucketed store: start, merge the feed, write the next version, read it back."""
    root = fresh_path(spark, "state-store")
    base = state_store.start_store(spark, root, "a", old_state(spark, sf_dir), STATE_BUCKETS)
    kept = rd.plausible(feed(spark, sf_dir), st.LOW, st.HIGH).where(F.to_date("observed_at") <= F.lit(AS_OF).cast("date"))
    merged = base.merged(state.feed_to_state(kept, tie_break=st.TIE), AS_OF)
    state_store.write_store(base, merged, root, "b")
    return state_store.read_store(spark, root).rows()


@query
def publish_run(spark, sf_dir):
    """Two runs of one day by commit, the first without rows: readers see the second."""
    root = fresh_path(spark, "publish-run")
    predictions = _forecast(spark, sf_dir)
    commits.publish_run(predictions.where("false"), root, AS_OF)
    commits.publish_run(predictions, root, AS_OF)
    return commits.read_snapshot(spark, root, predictions.schema)


@query
def late_readings(spark, sf_dir):
    """Readings older than the last state day of each key, if that was all the state held."""
    held = old_state(spark, sf_dir)
    newest = held.groupBy("entity", "product").agg(F.max("day").alias("day"))
    found = state.late_readings(newest, st.readings(spark, sf_dir))
    return found.groupBy("product").agg(F.count("*").alias("n_rows"), F.sum(fn.units(F.col("price"), 100)).alias("cents"))


# --- projections and predicates ------------------------------------------------------------------------------------


@query
def typed_casts(spark, sf_dir):
    return st.table(spark, sf_dir, "events").select(
        "event_id",
        F.to_date("ts").alias("day"),
        F.col("value").cast("float").alias("value_float"),
        F.floor("value").cast("int").alias("value_int"),
        (F.col("user_id") % 100).cast("tinyint").alias("user_tiny"),
        F.regexp_extract("props", "[0-9]+", 0).try_cast("smallint").alias("prop_small"),
        F.substring("event_type", 1, 1).try_cast("int").alias("not_a_number"),
        F.col("user_id").cast("string").alias("user_text"),
    )


@query
def plausible_range(spark, sf_dir):
    kept = rd.plausible(st.all_readings(spark, sf_dir), st.LOW, st.HIGH)
    return kept.select("reading_id", "entity", "product", "price")


@query
def split_by_date(spark, sf_dir):
    return pl.with_split(
        st.daily(spark, sf_dir), train=("2024-01-03", "2024-01-20"), valid_from="2024-01-22"
    )


@query
def null_audit(spark, sf_dir):
    audited = dense(spark, sf_dir).join(st.breaks(spark, sf_dir), "day")
    return metrics.null_audit(audited, ["price", "prev_price", "break_zone_a", "break_zone_c"])


@query
def latest_day(spark, sf_dir):
    return pl.latest_day(st.daily(spark, sf_dir))


@query
def param_lookup(spark, sf_dir):
    return comparator.lookup_code(spark, communes(spark, sf_dir), "01096")


@query
def valid_code(spark, sf_dir):
    key = F.col("c_custkey")
    code = F.when(key % 4 == 0, F.concat(key.cast("string"), F.lit("x"))).otherwise((key * 137).cast("string"))
    return st.table(spark, sf_dir, "customer").select(
        "c_custkey", code.alias("code"), fn.valid_code(code).alias("is_valid")
    )


# --- calendars -----------------------------------------------------------------------------------------------------


def _filled(spark, sf_dir, backfill=False):
    known = cal.with_facts(st.bare_calendar(spark), ref=st.reference_price(spark, sf_dir))
    return cal.ref_fill(known, backfill=backfill)


@query
def ref_ffill(spark, sf_dir):
    return _filled(spark, sf_dir)


@query
def ref_backfill(spark, sf_dir):
    return _filled(spark, sf_dir, backfill=True)


@query
def ref_lags(spark, sf_dir):
    return cal.ref_lags(_filled(spark, sf_dir))


@query
def ref_diffs(spark, sf_dir):
    return cal.ref_diffs(cal.ref_lags(_filled(spark, sf_dir))).select("day", "ref_diff_1d", "ref_diff_7d")


@query
def holiday_flags(spark, sf_dir):
    # a calendar that starts on a holiday: no day before it
    days = cal.calendar_range(spark, "2024-01-01", "2024-01-31")
    return cal.holiday_neighbours(cal.with_facts(days, holidays=st.holidays(spark, sf_dir)))


@query
def flag_coalesce(spark, sf_dir):
    return cal.with_facts(st.bare_calendar(spark), breaks=st.breaks(spark, sf_dir))


# --- panel ---------------------------------------------------------------------------------------------------------


@query
def dedup_last_per_day(spark, sf_dir):
    return st.daily(spark, sf_dir)


@query
def entity_span(spark, sf_dir):
    return rd.entity_span(st.readings(spark, sf_dir))


@query
def panel_grid(spark, sf_dir):
    return intervals.panel_grid(rd.entity_span(st.readings(spark, sf_dir)))


@query
def panel_fill(spark, sf_dir):
    return intervals.asof_daily(st.daily(spark, sf_dir))


@query
def asof_daily(spark, sf_dir):
    """As of every day of a later window, the last days of which have no reading at all."""
    return intervals.asof_daily(st.daily(spark, sf_dir), start="2024-01-10", end="2024-02-02")


@query
def panel_enriched(spark, sf_dir):
    return pl.enrich(intervals.asof_daily(st.daily(spark, sf_dir)), st.calendar(spark, sf_dir))


@query
def prev_price(spark, sf_dir):
    return dense(spark, sf_dir)


@query
def change_flag(spark, sf_dir):
    return series.with_change_flag(dense(spark, sf_dir))


@query
def run_groups(spark, sf_dir):
    return series.with_run_id(series.with_change_flag(dense(spark, sf_dir)))


@query
def days_unchanged(spark, sf_dir):
    runs = series.with_run_id(series.with_change_flag(dense(spark, sf_dir)).where("prev_price is not null"))
    return series.with_days_unchanged(runs).drop("changed", "run_id")


@query
def rolling_gap(spark, sf_dir):
    return series.with_rolling_gap(dense(spark, sf_dir).where("prev_price is not null"), scale=st.SCALE)


@query
def peer_gap(spark, sf_dir):
    rows = dense(spark, sf_dir).where("prev_price is not null")
    placed = rows.join(st.entities(spark, sf_dir).select("entity", "product", "area"), ["entity", "product"])
    return series.with_peer_gap(placed, scale=st.SCALE)


@query
def feature_panel(spark, sf_dir):
    return event_panel(spark, sf_dir)


@query
def long_history(spark, sf_dir):
    """The panel over seven years of line items, added up per product and year in whole units."""
    groups = pl.count_peer_groups(st.area_names(spark, sf_dir, "lineitem", "l_suppkey", "l_returnflag"))
    start, end = st.span(spark, sf_dir, "lineitem", "l_shipdate")
    panel = pl.training_panel(
        st.long_readings(spark, sf_dir), st.long_calendar(spark, sf_dir, start, end),
        start=start, end=end, tie_break=st.LONG_TIE, scale=st.SCALE, peer_groups=groups,
    )

    def cents(column):
        return F.sum(fn.units(F.col(column).cast("double"), 100)).alias(column)

    return panel.groupBy("product", F.year("day").alias("year")).agg(
        F.count("*").alias("n_rows"),
        F.sum("days_unchanged").alias("days_unchanged"),
        F.count_if("before_holiday").alias("before_holiday"),
        cents("price"), cents("prev_price"), cents("rolling_gap"), cents("peer_gap"), cents("ref_diff_7d"),
    )


# --- scalar functions ----------------------------------------------------------------------------------------------


@query
def area_code(spark, sf_dir):
    code = F.col("c_custkey") * 137
    return st.table(spark, sf_dir, "customer").select("c_custkey", fn.area_code(code).alias("area"))


@query
def weekday_index(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return st.table(spark, sf_dir, "orders").select("o_orderkey", fn.weekday_index(day).alias("weekday"))


@query
def ref_spread(spark, sf_dir):
    rows = dense(spark, sf_dir).join(F.broadcast(_filled(spark, sf_dir)), "day", "left")
    return rows.select(
        "entity", "product", "day", fn.ref_spread(F.col("prev_price"), F.col("ref_lag0")).alias("ref_spread")
    )


@query
def map_link(spark, sf_dir):
    return stations(spark, sf_dir).select(
        "entity", fn.map_link(F.col("address"), F.lit(None).cast("string"), F.col("city")).alias("map_link")
    )


# --- decisions and evaluation --------------------------------------------------------------------------------------


@query
def target_weight(spark, sf_dir):
    rows = dense(spark, sf_dir).where("prev_price is not null")
    target = fn.price_change(F.col("price"), F.col("prev_price"))
    return rows.select("entity", "product", "day", target.alias("target")).withColumn(
        "weight", fn.target_weight(F.col("target"))
    )


@query
def dead_band(spark, sf_dir):
    return scored(spark, sf_dir).select("entity", "product", "day", "raw_delta", "delta")


@query
def trend_label(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "entity", "product", "day",
        fn.trend_label(F.col("delta")).alias("predicted"),
        fn.actual_label(F.col("price") - F.col("prev_price")).alias("actual"),
    )


@query
def predicted_price(spark, sf_dir):
    return forecast.decide(scored(spark, sf_dir)).select(
        "entity", "product", "day", "predicted_price", "predicted_delta"
    )


@query
def naive_mae(spark, sf_dir):
    return metrics.naive_mae(dense(spark, sf_dir).where("prev_price is not null"))


@query
def model_mae(spark, sf_dir):
    return metrics.model_mae(scored(spark, sf_dir))


@query
def segment_report(spark, sf_dir):
    return metrics.segment_report(scored(spark, sf_dir), bounds=SEGMENTS)


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(scored(spark, sf_dir))


@query
def confusion_matrix_pct(spark, sf_dir):
    return metrics.confusion_matrix_pct(scored(spark, sf_dir))


@query
def merged_segments(spark, sf_dir):
    """The segment report from sums per day, of which one day was run again."""
    rows = scored(spark, sf_dir)
    held = metrics.day_partials(rows, bounds=SEGMENTS)
    again = metrics.day_partials(rows.where(F.col("day") == F.lit(AS_OF).cast("date")), bounds=SEGMENTS)
    return metrics.reports_of(metrics.replace_days(held, again), bounds=SEGMENTS)["segments"]


@query
def classification_report(spark, sf_dir):
    return metrics.classification_report(scored(spark, sf_dir))


def _trained(spark, sf_dir):
    """Fit on the event panel but its last ten days, with the production settings: model, reports and those days."""
    panel = settle(event_panel(spark, sf_dir), "panel")
    start, end = st.span(spark, sf_dir)
    valid_from = date.fromisoformat(end) - timedelta(VALID_DAYS - 1)
    parts = pl.with_split(panel, train=(start, valid_from - timedelta(1)), valid_from=valid_from)
    valid = parts.where("part = 'valid'")
    return *model.train_and_evaluate(parts.where("part = 'train'"), valid), valid


@query
def train_evaluate(spark, sf_dir):
    """What must hold of the reports whatever the trees say, and of the scores of the saved and reloaded model."""
    fitted, reports, valid = _trained(spark, sf_dir)
    path = fresh_path(spark, "model")
    model.save_model(fitted, path)
    once = model.score(fitted, valid).withColumnRenamed("raw_delta", "first_delta")
    twice = model.score(model.load_model(path), once)
    measures = [
        reports["classes"].where("label in ('down', 'stable', 'up')").selectExpr("'support ' || label as measure", "support as value"),
        reports["confusion"].groupBy("actual").agg(F.sum("n_rows").alias("n"))
        .selectExpr("'cells ' || actual as measure", "n as value"),
        reports["errors"].selectExpr("stack(2, 'rows', double(n_rows), 'naive error', naive_mae) as (measure, value)"),
        twice.selectExpr(
            "count(distinct entity, product, day) as n", "count_if(raw_delta is null or isnan(raw_delta)) as empty",
            "count_if(raw_delta <> first_delta) as changed",
        ).selectExpr("stack(3, 'scores', n, 'scores missing', empty, 'scores changed by a reload', changed) as (measure, value)"),
    ]
    typed = [m.select("measure", F.col("value").cast("double").alias("value")) for m in measures]
    return typed[0].unionByName(typed[1]).unionByName(typed[2]).unionByName(typed[3])


@query
def train_reports(spark, sf_dir):
    """The reports of the same fit, one row per figure: errors, segments, confusion and classes."""
    _, reports, _ = _trained(spark, sf_dir)

    def told(name):
        report = reports[name]
        texts = [c for c, kind in report.dtypes if kind == "string"]
        numbers = [c for c in report.columns if c not in texts]
        row = F.concat_ws(" ", *texts) if texts else F.lit("")
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("figure"), F.col(c).cast("double").alias("value")) for c in numbers]))
        return report.select(F.lit(name).alias("report"), row.alias("row"), pairs.alias("p")).select("report", "row", "p.figure", "p.value")

    found = [told(name) for name in ("errors", "segments", "confusion", "confusion_pct", "classes")]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3]).unionByName(found[4])


# --- locations -----------------------------------------------------------------------------------------------------


@query
def radius_search(spark, sf_dir):
    predictions = stations(spark, sf_dir).withColumns(
        {
            "predicted_delta": F.rint(F.col("price") * 0.01) / 100.0,
            "predicted_price": fn.predicted_price(F.col("price"), F.col("price") * 0.01),
            "trend": fn.trend_label(F.col("price")),
        }
    )
    return comparator.cheapest_around(
        spark, communes(spark, sf_dir), predictions, code="01096", product="BUILDING", radius_km=200
    )


@query
def radius_topk(spark, sf_dir):
    return geo.nearest(stations(spark, sf_dir), 46.0, 2.0, 100_000.0, limit=25).select(
        "entity", "product", F.rint("distance_m").cast("bigint").alias("distance_m")
    )


@query
def radius_join(spark, sf_dir):
    centres = st.table(spark, sf_dir, "supplier").selectExpr("s_suppkey as code", *st.place("s_suppkey")[:2])
    pairs = geo.radius_join(centres, stations(spark, sf_dir), RADIUS_M)
    return pairs.select("code", "entity", "product", F.rint("distance_m").cast("bigint").alias("distance_m"))


@query
def nearest_join(spark, sf_dir):
    centres = st.table(spark, sf_dir, "supplier").selectExpr("s_suppkey as code", *st.place("s_suppkey")[:2])
    found = nearest.nearest_join(centres, stations(spark, sf_dir), 5, radius_m=RADIUS_M)
    return found.select("code", "rank", "entity", "product", F.rint("distance_m").cast("bigint").alias("distance_m"))
